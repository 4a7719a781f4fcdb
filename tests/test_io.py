import json
import os
import tempfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quill.operators import chat, corpus
from quill.sources import files, sinks
from quill.sources.shard_writer import ShardSource, ShardsWritten, write_shards


def _tmp():
    return tempfile.mkdtemp(prefix="quill-io-", dir="/tmp")


def test_write_shards_by_chars_and_read_back(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    out = os.path.join(_tmp(), "shards")
    sinks.write_shards_by_chars(docs, out, "doc_id", budget=30000, group=16, keep_tail=False, compat=True)
    names = sorted(os.listdir(out))
    shard_files = [n for n in names if n.startswith("shard_")]
    assert shard_files and shard_files[0] == "shard_00000.parquet"
    back = files.read_corpus(spark, out)
    n_back = back.count()
    assert n_back % 16 == 0 and 0 < n_back <= docs.count()
    for f in shard_files:
        md = pq.ParquetFile(os.path.join(out, f)).metadata
        assert md.num_rows % 16 == 0
        assert md.row_group(0).column(0).compression == "ZSTD"
    # split and manifest on the written layout
    val = files.read_split(spark, out, "val").count()
    train = files.read_split(spark, out, "train").count()
    assert val + train == n_back
    missing = files.shard_manifest(spark, out, len(shard_files) + 2).collect()
    assert sorted(r.shard_idx for r in missing) == [len(shard_files), len(shard_files) + 1]


def test_publish_skips_complete_output(spark):
    base = _tmp()
    final = os.path.join(base, "final")
    df = spark.range(5)
    assert sinks.publish(spark, lambda p: df.write.parquet(p), final)
    assert not sinks.publish(spark, lambda p: df.write.parquet(p), final)
    assert not os.path.exists(final + ".tmp")


def test_jsonl_roundtrip_and_validation(spark):
    conv = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    out = os.path.join(_tmp(), "jsonl")
    valid = chat.validate_conversations(conv, "jsonl")
    sinks.write_conversations_jsonl(conv, out, valid)
    back = files.read_conversations_jsonl(spark, out)
    assert back.count() == valid.where("valid").count()
    assert back.where(F.size("messages") < 2).count() == 0


def test_qa_shards_messages_json(spark):
    rows = [(1, 1, "Why é?", "Because."), (1, 2, "Q2?", "A2"), (2, 1, "Q3?", "A3")]
    pairs = spark.createDataFrame(rows, "doc_id LONG, pos INT, question STRING, answer STRING")
    out = os.path.join(_tmp(), "qa")
    sinks.write_qa_shards(pairs, out, rows=2)
    t = pq.read_table(os.path.join(out, "shard_00000.parquet")).to_pylist()
    assert len(t) == 2    # doc 1's two pairs close the first shard
    m = t[0]["messages"]
    assert "\\u00e9" in m and json.loads(m)[0] == {"role": "user", "content": "Why é?"}
    back = files.read_qa(spark.read.parquet(out))
    assert back.count() == 3


def test_read_qa_question_answer_branch(spark):
    df = spark.createDataFrame([(" q ", "a"), ("", "a"), ("q", " ")], "question STRING, answer STRING")
    assert files.read_qa(df).count() == 1


def test_results_csv(spark):
    out = os.path.join(_tmp(), "csv")
    sinks.write_results_csv(spark.createDataFrame([("t", 0.5, 0.1)], "task STRING, accuracy DOUBLE, centered DOUBLE"), out)
    assert any(n.endswith(".csv") for n in os.listdir(out))


def test_shard_writer_commits_all_or_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.range(100).selectExpr("id", "id % 7 AS shard", "cast(id AS string) AS text").repartition(5)
    write_shards(df, out, ["id"], row_group_rows=4)
    assert sorted(n for n in os.listdir(out) if n.startswith("shard_")) == [f"shard_{k:05d}.parquet" for k in range(7)]
    for k in range(7):
        t = pq.ParquetFile(os.path.join(out, f"shard_{k:05d}.parquet"))
        assert t.read().column("text").to_pylist() == [str(i) for i in range(100) if i % 7 == k]
        assert [t.metadata.row_group(i).num_rows for i in range(t.num_row_groups - 1)] == [4] * (t.num_row_groups - 1)
    with open(os.path.join(out, "_shards.json")) as f:
        assert [x["rows"] for x in json.load(f)] == [15, 15] + [14] * 5
    bad = df.selectExpr("id", "shard", "CASE WHEN id = 50 THEN cast(raise_error('no') AS string) ELSE text END AS text")
    with pytest.raises(Exception, match="no"):
        write_shards(bad, out, ["id"])
    assert files.read_corpus(spark, out).count() == 100         # the old output is whole
    assert os.listdir(tmp_path) == ["out"]                      # and nothing is left over
    write_shards(df.limit(0), out, ["id"])
    assert sorted(os.listdir(out)) == ["_SUCCESS", "_shards.json"]


def test_shard_writer_refuses_a_shard_of_two_tasks():
    w = ShardSource({"path": "/tmp/never-written"}).writer(None, True)
    with pytest.raises(ValueError, match="several tasks"):
        w.commit([ShardsWritten([(1, 5)]), None, ShardsWritten([(1, 6)])])
