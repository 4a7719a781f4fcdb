import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quill.plans.segment import bucket_steps, greedy_segments


def _ref(weights, t):
    seg, acc, out = 0, 0, []
    closes = []
    for i, w in enumerate(weights):
        out.append(seg)
        acc += w
        if acc >= t:
            closes.append(i)
            seg += 1
            acc = 0
    return out, closes


def test_greedy_segments_matches_sequential(spark):
    rng = random.Random(3)
    for trial in range(3):
        n = rng.randint(1, 60)
        weights = [rng.choice([0, 1, 2, 5, 9]) for _ in range(n)]
        t = rng.choice([1, 4, 10, 25])
        df = spark.createDataFrame([(i * 3 + 7, w) for i, w in enumerate(weights)], "k LONG, w LONG")
        got = greedy_segments(df, "k", "w", t).orderBy("k").collect()
        seg, closes = _ref(weights, t)
        assert [r.segment for r in got] == seg, (weights, t)
        assert [i for i, r in enumerate(got) if r.is_close] == closes
        n_closes = len(closes)
        assert [r.is_tail for r in got] == [s == n_closes for s in seg]


def sequential(weights, threshold):
    out, held, seg = [], 0, 0
    for w in weights:
        held += w
        out.append((seg, held >= threshold))
        if held >= threshold:
            seg, held = seg + 1, 0
    return out, seg, held


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), max_size=30), min_size=1, max_size=7), st.integers(1, 25), st.integers(0, 24))
def test_step_functions_compose(buckets, threshold, held):
    held = min(held, threshold - 1)
    total = None
    for b in buckets:
        s = bucket_steps(np.array(b, np.int64), threshold)
        total = s if total is None else total.then(s, threshold)
    closes, left = total(held, threshold)
    run = sequential([held, *(w for b in buckets for w in b)], threshold)
    assert (int(closes), int(left)) == (run[1], run[2])


@pytest.mark.parametrize("n_buckets,fan,few", [(1, 16, 1 << 18), (2, 2, 0), (37, 2, 0), (64, 4, 0), (50, 16, 1 << 18)])
def test_any_fan(spark, n_buckets, fan, few):
    rng = random.Random(n_buckets)
    w = [rng.choice([0, 0, 1, 5, 40]) for _ in range(700)]
    df = spark.createDataFrame([(f"{i:05d}", x, "extra") for i, x in enumerate(w)], "k string, w int, node string").repartition(5)
    for threshold in (1, 33, 5_000, 10**9):
        got = greedy_segments(df, "k", "w", threshold, n_buckets=n_buckets, fan=fan, few_steps=few).orderBy("k").collect()
        want, last, _ = sequential(w, threshold)
        assert [(r.segment, r.is_close) for r in got] == want
        assert all(r.is_tail == (r.segment == last) and r.node == "extra" for r in got)


def test_segments_read_the_input_once(spark, tmp_path):
    spark.range(500).selectExpr("id", "id % 7 AS w").write.parquet(str(tmp_path / "t"))
    got = greedy_segments(spark.read.parquet(str(tmp_path / "t")), "id", "w", 20)
    assert str(tmp_path) not in got._jdf.queryExecution().toString()
