"""Greedy threshold segmentation by contraction.

Items in a total order carry weights w ≥ 0. A segment closes after item i
when the weight accumulated since the previous close (inclusive of i)
reaches ``threshold`` — the counter restarts at every close, so this is not
a division of the running sum.

What a range bucket of items does to the counter is a step function: the weight
missing on entry decides the first close in the bucket, and from there the closes
follow. So:

1. First pass over the rows: each bucket gives its step function, one step for each
   item that can be the first close, equal neighbours merged.
2. Functions compose. Runs of ``fan`` neighbouring buckets are composed in one task each,
   level by level up to one function; on the way back every bucket learns the counter and the
   number of closes on its entry. Only steps travel, never rows.
3. Second pass over the rows: with its entry state each bucket names the segment
   of its items.

Both passes read the same written table of rows and hold one bucket in a task: the
number of buckets (a parameter, by default four a shuffle partition) bounds its rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.plans.order import ROWS_PER_BUCKET, _bucket_column, _range_bounds
from quill.session import ship_package, written

FAN = 16                # buckets composed in one task
FEW_STEPS = 1 << 18     # steps in all that one task may compose at once

_STEPS = "node bigint, high bigint, closes bigint, left bigint, total bigint"


class Steps:
    """Effect on the counter. An entry that misses at most ``high[i]`` (and more than the
    one before) sees ``closes[i]`` closes and leaves ``left[i]`` in the counter; one
    that misses more than all of them only adds ``total``."""

    def __init__(self, high, closes, left, total: int):
        self.high, self.closes, self.left, self.total = high, closes, left, total

    def __call__(self, held, threshold: int):
        """Counter on entry -> (closes, counter on exit)."""
        held = np.asarray(held, np.int64)
        i = np.searchsorted(self.high, threshold - held)
        inside = i < len(self.high)
        i = np.minimum(i, max(len(self.high) - 1, 0))
        if not len(self.high):
            return np.zeros_like(held), held + self.total
        return np.where(inside, self.closes[i], 0), np.where(inside, self.left[i], held + self.total)

    def then(self, other: Steps, threshold: int) -> Steps:
        more, left = other(self.left, threshold)
        high, closes = self.high, self.closes + more
        if not len(high) or high[-1] < threshold:       # some entries pass without a close
            reach = other.high + self.total
            keep = slice(int(np.searchsorted(reach, high[-1], side="right")) if len(high) else 0,
                         int(np.searchsorted(reach, threshold)) + 1)
            high = np.concatenate((high, reach[keep]))
            closes, left = np.concatenate((closes, other.closes[keep])), np.concatenate((left, other.left[keep]))
        return merged(high, closes, left, self.total + other.total)


def merged(high, closes, left, total: int) -> Steps:
    """Steps without those that their upper neighbour repeats."""
    keep = np.append((closes[1:] != closes[:-1]) | (left[1:] != left[:-1]), True) if len(high) else np.zeros(0, bool)
    return Steps(high[keep], closes[keep], left[keep], int(total))


def _next_close(sums: np.ndarray, threshold: int) -> np.ndarray:
    return np.searchsorted(sums, sums + threshold)


def bucket_steps(weights: np.ndarray, threshold: int) -> Steps:
    """The step function of items with these weights."""
    sums = np.cumsum(weights, dtype=np.int64)
    n, total = len(sums), int(sums[-1]) if len(sums) else 0
    after = np.append(_next_close(sums, threshold), n)
    closes, last = np.append(np.ones(n, np.int64), 0), np.arange(n + 1)
    while (after[:n] < n).any():        # every item's chain of closes to its end, doubling
        closes = closes + closes[after]
        last = np.where(after < n, last[after], last)
        after = after[after]
    first = np.flatnonzero(np.diff(sums, prepend=0) > 0)      # of equal sums the first closes
    first = first[:int(np.searchsorted(sums[first], threshold)) + 1]
    return merged(sums[first], closes[first], total - sums[last[first]], total)


def _table(node: int, s: Steps) -> pa.Table:
    """A function as rows; the last one carries the total only."""
    n = len(s.high) + 1

    def column(x, end):
        return pa.array(np.append(x, end).astype(np.int64))
    return pa.table({"node": pa.array(np.full(n, node, np.int64)), "high": column(s.high, -1), "closes": column(s.closes, 0),
                     "left": column(s.left, 0), "total": pa.array(np.full(n, s.total, np.int64))})


def _functions(t: pa.Table) -> list[tuple[int, Steps]]:
    node, high, closes, left, total = (t.column(c).to_numpy() for c in ("node", "high", "closes", "left", "total"))
    order = np.lexsort((high, node))
    out = []
    for part in np.split(order, np.flatnonzero(np.diff(node[order])) + 1):
        k = part[1:]            # the row with the total comes first (-1)
        out.append((int(node[part[0]]), Steps(high[k], closes[k], left[k], int(total[part[0]]))))
    return out


def _sorted(t: pa.Table, order: str, weight: str) -> pa.Table:
    return t.take(pc.sort_indices(t, sort_keys=[(order, "ascending"), (weight, "ascending")], null_placement="at_start"))


def _entries(levels, threshold: int, fan: int) -> dict[int, tuple[int, int]]:
    """{bucket: (closes before it, counter on its entry)}. ``levels`` are the
    written functions from the buckets up to a single node; a level's entries, at
    most the number of buckets, pass through the driver."""
    entry = {0: (0, 0)}
    for level in reversed(levels[:-1]):
        known = entry

        def down(t):
            out, state = [], None
            for node, s in _functions(t):
                before, held = known[node // fan] if state is None else state
                out.append((node, before, held))
                more, held = s(held, threshold)
                state = before + int(more), int(held)
            return pa.table({n: pa.array([r[i] for r in out], pa.int64()) for i, n in enumerate(("node", "before", "held"))})
        rows = level().groupBy(F.floor(F.col("node") / fan)).applyInArrow(down, "node bigint, before bigint, held bigint").collect()
        entry = {r.node: (r.before, r.held) for r in rows}
    return entry


def greedy_segments(df: DataFrame, order: str, weight: str, threshold: int, out: str = "segment",
                    n_buckets: int | None = None, fan: int = FAN, few_steps: int = FEW_STEPS) -> DataFrame:
    """Adds ``out`` (0-based segment id), ``is_close`` and ``is_tail``
    (item belongs to the final segment that never reached the threshold).

    ``order`` is unique; null weights count as 0. An empty table gives no rows."""
    if threshold <= 0:
        raise ValueError("threshold must be positive")
    spark = df.sparkSession
    ship_package(spark)
    rows = written(df.withColumn("__w", F.coalesce(F.col(weight).cast("long"), F.lit(0))), "segments")
    n = rows().count()
    names, kinds = df.columns, dict(df.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names) + f", `{out}` bigint, is_close boolean, is_tail boolean"
    if n == 0:
        return spark.createDataFrame([], schema)
    if n_buckets is None:
        n_buckets = min(max(8, int(spark.conf.get("spark.sql.shuffle.partitions")) * 4), n // ROWS_PER_BUCKET + 1)
    bounds = _range_bounds(rows(), [order], n_buckets, n) if n_buckets > 1 else "[]"

    def bucketed():
        r = rows()
        return r.withColumn("__bucket", _bucket_column(r, [order], bounds, n_buckets).cast("bigint") if n_buckets > 1 else F.lit(0).cast("bigint"))

    def steps(key, t):
        return _table(key[0].as_py(), bucket_steps(_sorted(t, order, "__w").column("__w").to_numpy(), threshold))
    levels = [written(bucketed().select(order, "__w", "__bucket").groupBy("__bucket").applyInArrow(steps, _STEPS), "steps")]

    def up(t):
        functions = _functions(t)
        node, total = functions[0][0] // fan, functions[0][1]
        for _, s in functions[1:]:
            total = total.then(s, threshold)
        return _table(node, total)
    fan = n_buckets if levels[0]().count() <= few_steps else fan
    width = n_buckets
    while width > 1:
        levels.append(written(levels[-1]().groupBy(F.floor(F.col("node") / fan)).applyInArrow(up, _STEPS), "steps"))
        width = -(-width // fan)
    top = _functions(levels[-1]().toArrow())[0][1]      # steps of the first segment's items at most
    n_closes = int(top(0, threshold)[0])
    entry = _entries(levels, threshold, fan)

    def name(key, t):
        t = _sorted(t, order, "__w")
        before, held = entry[key[0].as_py()]
        sums = np.cumsum(t.column("__w").to_numpy(), dtype=np.int64)
        after = _next_close(sums, threshold).tolist()
        closed = np.zeros(len(sums), bool)
        i = int(np.searchsorted(sums, threshold - held))
        while i < len(sums):
            closed[i] = True
            i = after[i]
        segment = before + np.cumsum(closed) - closed
        return t.select(names).append_column(out, pa.array(segment)).append_column("is_close", pa.array(closed)).append_column("is_tail", pa.array(segment == n_closes))
    return bucketed().groupBy("__bucket").applyInArrow(name, schema)
