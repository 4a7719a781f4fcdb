"""Headline timings: prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is forced with the ``noop`` sink (full execution, nothing
collected); BPE training is an action by itself.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quill import catalog  # noqa: E402
from quill.operators import bpe, pack  # noqa: E402
from quill.session import build_session  # noqa: E402


def _force(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="quill-bench")
    sf = sf_dir.rsplit("sf", 1)[-1] if "sf" in sf_dir else sf_dir
    try:
        sf = float(sf)
    except ValueError:
        pass
    times: dict[str, float] = {}
    extra: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        fn()
        times[name] = round(time.time() - t0, 3)

    q = catalog.QUERIES
    # warm-up: JVM, Python workers, file listing
    _force(q["crop_docs"](spark, sf_dir))

    timed("chunk_stats_by_lang", lambda: _force(q["chunk_stats_by_lang"](spark, sf_dir)))
    timed("pretokenize_chunk_counts", lambda: _force(q["chunk_counts"](spark, sf_dir)))

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    merges_box = {}

    def train():
        merges_box["m"] = bpe.train_bpe(docs, 1024)
    timed("bpe_train_vocab1024", train)
    extra["bpe_rounds"] = bpe.TRAIN_STATS.get("rounds", 0)
    extra["bpe_merges"] = bpe.TRAIN_STATS.get("merges", 0)
    catalog._MERGES_CACHE[(sf_dir, 1024)] = [tuple(r) for r in merges_box["m"].collect()]

    timed("count_tokens", lambda: _force(bpe.count_tokens(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("text"), merges_box["m"])))
    timed("encode_docs", lambda: _force(bpe.encode(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), merges_box["m"])))

    def do_pack():
        ids = catalog._cp_ids(spark, sf_dir)
        _force(pack.pack(ids, 8, 1024, ["doc_id"]))
    timed("pack_B8_T1024", do_pack)
    n_chars = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("sum(length(text)) AS n").collect()[0].n
    extra["pack_tokens_per_sec"] = round(n_chars / max(times["pack_B8_T1024"], 1e-9), 1)

    for name in ["qa_pairs", "sentences", "render_segments", "validate_chat", "bits_per_byte",
                 "mix_tasks", "char_budget", "pass_at_k", "run_metrics"]:
        timed(name, lambda n=name: _force(q[n](spark, sf_dir)))

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times,
                      "extra": extra, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
