"""Scans: sharded corpora, conversation/QA files, word lists, shard manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quill.functions.text import strip_ws


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """File listing as a DataFrame (``binaryFile`` with the content column pruned)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
            .select("path", "modificationTime", "length")
            .withColumn("file_name", F.element_at(F.split("path", "/"), -1)))


def shard_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted shard paths (file metadata only; ``.tmp`` leftovers excluded)."""
    files = list_files(spark, path).where(~F.col("file_name").endswith(".tmp"))
    return [r.path for r in files.select("path").orderBy("file_name").collect()]


def read_corpus(spark: SparkSession, path: str, columns=("text",)) -> DataFrame:
    """A1: text shards with scan metadata ``shard, row_in_shard``.

    Only the requested columns reach the Parquet reader.
    """
    df = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)   # no .tmp leftovers
    return df.select(*columns, F.col("_metadata.file_name").alias("shard"),
                     F.col("_metadata.row_index").alias("row_in_shard"))


def split_paths(paths: list[str], split: str) -> list[str]:
    """A2 on paths (pruned before the read): the last shard is ``val``."""
    if split not in ("train", "val"):
        raise ValueError("split must be 'train' or 'val'")
    paths = sorted(paths)
    return paths[:-1] if split == "train" else paths[-1:]


def read_split(spark: SparkSession, path: str, split: str, columns=("text",)) -> DataFrame:
    paths = split_paths(shard_names(spark, path), split)
    if not paths:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns]
                              + [T.StructField("shard", T.StringType()),
                                 T.StructField("row_in_shard", T.LongType())])
        return spark.createDataFrame([], schema)
    df = spark.read.parquet(*paths)
    return df.select(*columns, F.col("_metadata.file_name").alias("shard"),
                     F.col("_metadata.row_index").alias("row_in_shard"))


def split_column(df: DataFrame, shard: str = "shard") -> DataFrame:
    """A2 in column form: ``split`` = 'val' for the greatest shard, else 'train'."""
    last = df.agg(F.max(shard)).scalar()   # scalar subquery, evaluated once
    return df.withColumn("split", F.when(F.col(shard) == last, "val").otherwise("train"))


_MSG = T.ArrayType(T.StructType([T.StructField("role", T.StringType()),
                                 T.StructField("content", T.StringType())]))


def read_conversations_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """A5: one JSON array of messages per line; blank lines skipped.

    Output ``(f, messages)``; validation is C1's job (reasons, not aborts).
    """
    lines = spark.read.text(path).withColumn("f", F.col("_metadata.file_name"))
    lines = lines.withColumn("value", strip_ws("value")).where(F.col("value") != "")
    return lines.select("f", F.from_json("value", _MSG).alias("messages"))


def messages_to_turns(df: DataFrame, messages: str = "messages") -> DataFrame:
    """Conversations as arrays → the long form that C1-C6 take: the other columns
    plus ``turn, role, text``."""
    rest = [c for c in df.columns if c != messages]
    return df.select(*rest, F.posexplode(messages).alias("turn", "__m")).select(
        *rest, "turn", F.col("__m.role").alias("role"), F.col("__m.content").alias("text"))


def read_qa(df: DataFrame) -> DataFrame:
    """Messages JSON when present, else trimmed question/answer (both non-empty)."""
    if "messages" in df.columns:
        return df.select(F.from_json("messages", _MSG).alias("messages"))
    if {"question", "answer"} <= set(df.columns):
        q, a = strip_ws("question"), strip_ws("answer")
        return (df.select(q.alias("q"), a.alias("a"))
                .where((F.col("q") != "") & (F.col("a") != ""))
                .select(F.array(F.struct(F.lit("user").alias("role"), F.col("q").alias("content")),
                                F.struct(F.lit("assistant").alias("role"), F.col("a").alias("content")))
                        .alias("messages")))
    raise ValueError("expected a messages column or question/answer columns")


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, stripped."""
    return spark.read.text(path).select(strip_ws("value").alias("word"))


def shard_manifest(spark: SparkSession, path: str, expected: int) -> DataFrame:
    """Which shard indices 0..expected-1 are present (left anti join on listing)."""
    want = spark.range(expected).select(F.col("id").cast("int").alias("shard_idx"))
    have = (list_files(spark, path)
            .where(F.col("file_name").rlike(r"^shard_[0-9]{5}\.parquet$"))
            .select(F.regexp_extract("file_name", r"([0-9]{5})", 1).cast("int").alias("shard_idx")))
    return want.join(have, "shard_idx", "left_anti").withColumn("status", F.lit("missing"))


def artifact_catalog(listing: DataFrame) -> DataFrame:
    """Latest step per tag from ``model_%06d`` names; default tag = largest
    ``d<N>`` else newest modification.

    ``listing``: ``(tag, file_name, mtime)``.
    """
    steps = (listing.where(F.col("file_name").rlike(r"^model_[0-9]+"))
             .select("tag", "mtime", F.regexp_extract("file_name", r"^model_([0-9]+)", 1).cast("int").alias("step")))
    per_tag = steps.groupBy("tag").agg(F.max("step").alias("last_step"), F.max("mtime").alias("mtime"))
    depth = F.regexp_extract("tag", r"^d([0-9]+)$", 1)
    rank_key = F.struct(F.when(depth != "", depth.cast("int")).alias("d"), F.col("mtime"))
    w = Window.orderBy(F.desc_nulls_last(rank_key.getField("d")), F.desc("mtime"))
    # one row per tag: result-sized
    return per_tag.withColumn("is_default", F.row_number().over(w) == 1)
