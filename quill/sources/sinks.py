"""Sinks: sharded Parquet writers, Q/A shards, CSV results, JSONL, publish.

Shard ids are computed as DataFrame columns (dense positions, greedy
segmentation) so the assignment itself is checkable in SQL; the writers hand them to
``shard_writer``: one task per shard names its file, one commit publishes all.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quill.plans.order import dense_index
from quill.plans.segment import greedy_segments
from quill.sources.shard_writer import write_shards

# ---------------------------------------------------------------------------
# Fixed values of the corpus shard layout.
CHARS_PER_SHARD = 250_000_000
ROW_GROUP_ROWS = 1024
ROWS_PER_TEXT_SHARD = 10_000
# ---------------------------------------------------------------------------


def shard_by_chars(df: DataFrame, order: str, text: str = "text", budget: int = CHARS_PER_SHARD,
                   group: int = ROW_GROUP_ROWS, keep_tail: bool = True) -> DataFrame:
    """K1 assignment: a shard closes when its chars reach ``budget`` *and* its
    row count is a multiple of ``group``.

    Closing can only happen at a group end, so rows are first reduced to
    ``group``-row summaries (1/``group`` of the data) which are segmented
    greedily, then joined back on the group number. ``keep_tail=False``
    drops the final partial shard like the reference repackager.
    """
    rows = dense_index(df, [order], out="__pos").withColumn("__g", F.floor(F.col("__pos") / group))
    groups = rows.groupBy("__g").agg(F.sum(F.length(text)).cast("long").alias("__chars"))
    seg = greedy_segments(groups, "__g", "__chars", budget, out="shard").select("__g", "shard", "is_tail")
    out = rows.join(seg, "__g")
    if not keep_tail:
        out = out.where(~F.col("is_tail"))
    return out.drop("__g")


def shard_by_rows(df: DataFrame, order: str, rows: int = ROWS_PER_TEXT_SHARD) -> DataFrame:
    """K2 assignment: ``rows`` rows per shard in order."""
    d = dense_index(df, [order], out="__pos")
    return d.withColumn("shard", F.floor(F.col("__pos") / rows).cast("long"))


def shard_qa_pairs(pairs: DataFrame, doc: str = "doc_id", rows: int = ROWS_PER_TEXT_SHARD) -> DataFrame:
    """K3 assignment: Q/A shards close at document boundaries once ≥ ``rows`` pairs."""
    per_doc = pairs.groupBy(doc).agg(F.count(F.lit(1)).cast("long").alias("__n"))
    seg = greedy_segments(per_doc, doc, "__n", rows, out="shard").select(doc, "shard", "is_tail")
    return pairs.join(seg, doc)


@F.pandas_udf(T.StringType())
def qa_messages_json(q: pd.Series, a: pd.Series) -> pd.Series:
    """``messages`` as the reference writes it: ``json.dumps`` with ASCII escapes."""
    return pd.Series([json.dumps([{"role": "user", "content": x}, {"role": "assistant", "content": y}],
                                 ensure_ascii=True) for x, y in zip(q, a)], dtype=object)


def write_shards_by_chars(df: DataFrame, path: str, order: str, text: str = "text",
                          budget: int = CHARS_PER_SHARD, group: int = ROW_GROUP_ROWS,
                          keep_tail: bool = True, compat: bool = False, keep: tuple[str, ...] = ()) -> None:
    """K1 (*action*): text shards closed by chars and row multiple, zstd, 1024-row groups;
    ``keep`` names columns written beside the text."""
    a = shard_by_chars(df, order, text, budget, group, keep_tail).select("__pos", *keep, text, "shard")
    write_shards(a, path, ["__pos"], ROW_GROUP_ROWS, dictionary=not compat)


def write_shards_by_rows(df: DataFrame, path: str, order: str, text: str = "text",
                         rows: int = ROWS_PER_TEXT_SHARD, keep: tuple[str, ...] = ()) -> None:
    """K2 (*action*): text shards of ``rows`` rows."""
    a = shard_by_rows(df, order, rows).select("__pos", *keep, text, "shard")
    write_shards(a, path, ["__pos"], ROW_GROUP_ROWS)


def write_qa_shards(pairs: DataFrame, path: str, doc: str = "doc_id", pos: str = "pos",
                    rows: int = ROWS_PER_TEXT_SHARD, keep: tuple[str, ...] = ()) -> None:
    """K3 (*action*): question, answer, messages (ASCII-escaped JSON) shards."""
    a = shard_qa_pairs(pairs, doc, rows)
    a = a.select(F.col(doc).alias("__doc"), F.col(pos).alias("__pos"), "shard", *keep, "question", "answer",
                 qa_messages_json(F.col("question"), F.col("answer")).alias("messages"))
    write_shards(a, path, ["__doc", "__pos"], ROW_GROUP_ROWS)


def publish(spark: SparkSession, write_fn, final_path: str, skip_if_complete: bool = True) -> bool:
    """K4 (*action*): write to ``final_path + '.tmp'`` then swap in; skip when a
    complete output (``_SUCCESS`` or shard files) already exists. Returns True
    when written."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    final = jvm.org.apache.hadoop.fs.Path(final_path)
    tmp = jvm.org.apache.hadoop.fs.Path(final_path + ".tmp")
    fs = final.getFileSystem(conf)
    if skip_if_complete and fs.exists(final):
        names = [s.getPath().getName() for s in fs.listStatus(final)]
        if any(n.endswith(".parquet") and not n.endswith(".tmp") for n in names) or "_SUCCESS" in names:
            return False
    if fs.exists(tmp):
        fs.delete(tmp, True)
    write_fn(final_path + ".tmp")
    # the old output steps aside first, so that one of the two is always there
    old = jvm.org.apache.hadoop.fs.Path(final_path + ".old")
    if fs.exists(old):
        fs.delete(old, True)
    had = fs.exists(final) and fs.rename(final, old)
    if not fs.rename(tmp, final):
        if had:
            fs.rename(old, final)
        raise OSError(f"cannot publish {final_path}")
    if had:
        fs.delete(old, True)
    return True


def write_results_csv(scores: DataFrame, path: str) -> None:
    """K5 (*action*): result-sized table as one CSV: (task, accuracy, centered) and the
    CORE row, whose accuracy is empty."""
    core = scores.agg(F.round(F.avg("centered"), 6).alias("centered")).select(
        F.lit("CORE").alias("task"), F.lit(None).cast("double").alias("accuracy"), "centered")
    scores.select("task", "accuracy", "centered").unionByName(core).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def conversations_jsonl(df: DataFrame, valid: DataFrame | None = None, key: str = "conv_id",
                        turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """K6 lines: one JSON array of ``{role, content}`` per (valid) conversation."""
    d = df if valid is None else df.join(valid.where("valid").select(key), key, "left_semi")
    g = d.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(turn, role, text))).alias("m"))
    msgs = F.transform("m", lambda x: F.struct(x[role].alias("role"), x[text].alias("content")))
    return g.select(key, F.to_json(msgs).alias("value"))


def write_conversations_jsonl(df: DataFrame, path: str, valid: DataFrame | None = None, **kw) -> None:
    """K6 (*action*)."""
    conversations_jsonl(df, valid, **kw).select("value").write.mode("overwrite").text(path)
