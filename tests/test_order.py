"""Prefix sums at any bucket count, on ties of the first key, and on odd key types."""

import json
import time

import pytest
from pyspark.sql import functions as F

from quill.plans.order import _range_bounds, dense_index, prefix_sum


@pytest.mark.parametrize("buckets", [1, 2, 200, 2000, 8000])
def test_any_number_of_buckets(spark, buckets):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("k"))
    t = time.time()
    got = dense_index(df, ["k"], n_buckets=buckets)
    got._jdf.queryExecution().executedPlan()
    assert time.time() - t < 30
    want = {k: i for i, k in enumerate(sorted(i * 7919 % 20_011 for i in range(20_000)))}
    assert {r.k: r.idx for r in got.collect()} == want


@pytest.mark.parametrize("parts", [200, 2000])
def test_default_buckets_follow_the_session(spark, parts):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    df = spark.range(9_000).select((F.col("id") * 31 % 9_001).alias("k"), (F.col("id") % 5).alias("v")).repartition(3).persist()
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = {r.k: r.prefix for r in prefix_sum(df, ["k"], "v").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    total, want = 0, {}
    for k, v in sorted((r.k, r.v) for r in df.collect()):
        total += v
        want[k] = total
    assert got == want


def test_input_is_read_once(spark, tmp_path):
    spark.range(100).select("id").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = dense_index(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path) not in plan        # only the written table remains


def test_one_first_key_is_still_split(spark):
    rows = spark.range(5_000).select(F.lit("hot").alias("a"), F.col("id").alias("b"))
    bounds = json.loads(_range_bounds(rows, ["a", "b"], 50, 5_000))
    assert len(bounds) == 49 and {x["k0"] for x in bounds} == {"hot"}
    got = dense_index(rows, ["a", "b"], n_buckets=50)
    assert [r.idx for r in got.orderBy("b").collect()] == list(range(5_000))


@pytest.mark.parametrize("kind,keys", [
    ("string", [None, "", "a", "B", "é", "\U0001f642", '"quoted"', "x\\y", "line\n"]),
    ("double", [None, -1.5, 0.0, 1e300, 2.25, -1e-9]),
    ("timestamp", [None, *(__import__("datetime").datetime(2020, 1, d, 3, 4, 5, d) for d in range(1, 9))]),
    ("decimal(20,3)", [None, *(__import__("decimal").Decimal(d) for d in range(9))]),
    ("binary", [None, b"", b"\x00", b"\xff", b"a"]),
])
def test_key_types(spark, kind, keys):
    df = spark.createDataFrame([(k,) for k in reversed(keys)], f"k {kind}")
    got = [tuple(r) for r in dense_index(df, ["k"], n_buckets=4).orderBy("idx").collect()]
    low = [k for k in keys if k is None]
    rest = sorted((k for k in keys if k is not None), key=lambda k: k.encode() if isinstance(k, str) else k)
    assert got == [(bytes(k) if kind == "binary" and k is not None else k, i) for i, k in enumerate(low + rest)]


def test_long_string_keys(spark):
    keys = [f"{'x' * (i % 3) * 400}{i:05d}" for i in range(3_000)]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(4)
    assert max(map(len, json.loads(_range_bounds(df, ["k"], 40, 3_000))), default=0) < 1_000
    got = [r.k for r in dense_index(df, ["k"], n_buckets=40).orderBy("idx").collect()]
    assert got == sorted(keys)


def test_self_join_of_the_result(spark):
    d = dense_index(spark.createDataFrame([(i * 37 % 101,) for i in range(101)], "k int"), ["k"], n_buckets=7)
    assert d.join(d.select("k", F.col("idx").alias("j")), "k").where("idx = j and k = idx").count() == 101


def test_empty(spark):
    df = spark.createDataFrame([], "k string, v int")
    assert prefix_sum(df, ["k"], "v", n_buckets=5).count() == 0
    assert dense_index(df, ["k"]).count() == 0


def test_odd_column_names_pass_through(spark):
    df = spark.range(20).selectExpr("id", "id * 2 AS `a.b`", "'x' AS `c d`", "id AS __bucket2")
    got = dense_index(df, ["id"], n_buckets=3)
    assert got.columns == ["id", "a.b", "c d", "__bucket2", "idx"] and got.where("`a.b` = 2 * idx AND `c d` = 'x'").count() == 20


def test_null_group(spark):
    df = spark.range(3_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"))
    got = {r.id: r.idx for r in dense_index(df, ["id"], partition_by=["g"], n_buckets=9).collect()}
    assert got == {i: i // 3 for i in range(3_000)}


def test_small_groups_are_shuffled_once(spark):
    """before, rows of small groups were dealt by range, joined with the totals of their ranges and dealt again."""
    rows = [(k, i, i % 7) for k in range(300) for i in range(1 + k % 9)]
    df = spark.createDataFrame(rows, "k long, i long, n long").repartition(4)
    out = prefix_sum(df, ["i"], "n", out="before", inclusive=False, partition_by=["k"])
    per_group = out.groupBy("k").agg(F.sum("before").alias("s"))
    plan = per_group._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    got = {(r.k, r.i): r.before for r in out.collect()}
    assert got == {(k, i): sum(j % 7 for j in range(i)) for k, i, _ in rows}


def test_one_large_group_is_still_split(spark):
    rows = [(0, i, 1) for i in range(3000)] + [(k, 0, 5) for k in range(1, 40)]
    df = spark.createDataFrame(rows, "k long, i long, n long").repartition(4)
    out = prefix_sum(df, ["i"], "n", out="before", inclusive=False, partition_by=["k"])
    assert "Join" in out._jdf.queryExecution().executedPlan().toString()
    assert {(r.k, r.i): r.before for r in out.collect()} == {(k, i): i for k, i, _ in rows}
