"""Results do not depend on how the input is partitioned (1 / 4 / 17)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from quill.operators import chat, corpus, pack
from quill.sources import sinks


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_partition_count_invariance(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    results = []
    for n in (1, 4, 17):
        d = docs.repartition(n)
        ids = d.select("doc_id", F.concat(F.array(F.lit(0)), F.transform(
            F.regexp_extract_all("text", F.lit("(?s)(.)"), 1), lambda c: F.ascii(c))).alias("ids"))
        packed = pack.pack(ids, 2, 32).select("block", "row", F.md5(F.array_join("inputs", ",")))
        budget = corpus.take_char_budget(d, ["doc_id"], 50_000).select("doc_id", "chars_before")
        split = chat.ratio_split(d.select("doc_id"), "doc_id", 0.1).select("doc_id", "rank", "split")
        shards = sinks.shard_by_chars(d, "doc_id", budget=20_000, group=4).select("doc_id", "shard", "is_tail")
        results.append([_rows(packed), _rows(budget), _rows(split), _rows(shards)])
    assert results[0] == results[1] == results[2]
