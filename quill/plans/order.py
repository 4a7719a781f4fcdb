"""Seeded deterministic order and distributed prefix sums.

Seeded randomness is ``md5('<seed>:<id>')``: the same bits in Spark and in
DuckDB, stable across partition counts and retries. We promise a fixed,
well-mixed order, not any particular RNG sequence.

Prefix sums never use an unpartitioned window. The input is evaluated once, into
a table in the shared checkpoint folder. A bounded sample of its order keys gives
range bounds over the whole order tuple (so many rows with one first key are
still split); each row finds its bucket by binary search in that sorted array,
whose size is a parameter. Per-bucket totals are tiny and get a small window, their
running bases are broadcast back (size bound = number of buckets), and the
local running sum is a window partitioned by bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quill.session import written

SAMPLE_PER_BUCKET = 20
ROWS_PER_BUCKET = 512      # default buckets hold no fewer rows
KEY_CHARS = 256            # of a string key in a bound


def seeded_key(seed, *cols) -> Column:
    """Hex md5 of ``seed:c1:c2…`` — the shuffle sort key."""
    parts = [F.lit(str(seed))] + [F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                                  for c in cols]
    return F.md5(F.concat_ws(":", *parts))


def seeded_uniform(seed, *cols) -> Column:
    """Uniform double in [0,1) from the first 8 hex digits of the seeded md5."""
    return F.conv(F.substring(seeded_key(seed, *cols), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def seeded_int(seed, n, *cols) -> Column:
    """Integer in [0, n) from the seeded md5 (n may be a column)."""
    n_col = n if isinstance(n, Column) else F.lit(n)
    return F.floor(seeded_uniform(seed, *cols) * n_col).cast("long")


def _range_bounds(rows: DataFrame, order: Sequence[str], n_buckets: int, n_rows: int) -> str:
    """JSON array of at most ``n_buckets - 1`` ascending order tuples that cut ``rows``
    into even ranges. The sample (about ``SAMPLE_PER_BUCKET`` tuples a bucket) is
    picked by the tuples' own hashes, so it does not depend on partitioning."""
    kinds = dict(rows.dtypes)
    # a beginning of a long string bounds as well as the whole
    short = [F.substring(c, 1, KEY_CHARS) if kinds[c] == "string" else F.col(c) for c in order]
    keys = rows.select(F.struct(*(c.alias(f"k{i}") for i, c in enumerate(short))).alias("k"))
    want = SAMPLE_PER_BUCKET * n_buckets
    if n_rows > want:
        keys = keys.where(F.pmod(F.xxhash64("k"), F.lit(1 << 40)) <= (1 << 40) * want // n_rows)
    picked = keys.distinct().agg(F.array_sort(F.collect_list("k")).alias("a"))
    cuts = F.expr(f"array_distinct(transform(sequence(1, {n_buckets - 1}), "
                  f"i -> element_at(a, cast(i * size(a) div {n_buckets} as int) + 1)))")
    return picked.select(F.when(F.size("a") > 0, F.to_json(cuts))).collect()[0][0] or "[]"


def _bucket_column(rows: DataFrame, order: Sequence[str], bounds: str, n_buckets: int) -> Column:
    """Number of bounds that are not above the row's order tuple: a binary search,
    one halving of the step at a time. NULLs come first, as in an ascending sort."""
    kinds = dict(rows.dtypes)
    spec = "array<struct<" + ",".join(f"k{i}:{kinds[c]}" for i, c in enumerate(order)) + ">>"
    table = F.from_json(F.lit(bounds), spec)    # folded into one literal when the plan is made
    key = F.struct(*(F.col(c).alias(f"k{i}") for i, c in enumerate(order)))
    steps = F.array(*(F.lit(1 << s) for s in reversed(range(n_buckets.bit_length()))))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= F.size(table)) & (F.get(table, at + step - 1) <= key), at + step).otherwise(at))


Spec = tuple[Column | str, str, bool]      # value, "sum", "min" or "max", whether the row itself counts


def prefix_aggregates(df: DataFrame, order: Sequence[str], specs: dict[str, Spec], n_buckets: int | None = None,
                      partition_by: Sequence[str] = (), stop_above: float | None = None) -> DataFrame:
    """Running aggregates in ``order`` (a total order), optionally per group, all from one
    pass: ``specs`` maps a new column to what it runs over.

    ``order`` may hold columns of any sortable type. Work is split into at most
    ``n_buckets`` range buckets (by default four a shuffle partition, fewer on small
    inputs); only per-bucket totals pass through a small
    window and a broadcast. Groups that hold no more rows than a bucket each are not split at
    all. ``stop_above`` (the first column is a sum of non-negative
    values) drops rows of buckets whose running base already exceeds it — for budgets that
    keep a prefix of a huge input. The input is evaluated and written once, here.
    """
    order, partition_by = list(order), list(partition_by)
    fn = {"sum": F.sum, "min": F.min, "max": F.max}
    combine = {"sum": lambda a, b: a + F.coalesce(b, F.lit(0)), "min": F.least, "max": F.greatest}    # the last two pass over NULLs
    how = list(enumerate((agg, inclusive) for _, agg, inclusive in specs.values()))
    values = {f"__v{i}": F.col(v) if isinstance(v, str) else v for i, (v, _, _) in enumerate(specs.values())}
    rows = written(df.withColumns(values), "prefix")
    n_rows = rows().count()
    if n_buckets is None:
        n_buckets = min(max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4), n_rows // ROWS_PER_BUCKET + 1)
        if partition_by and n_buckets > 1:
            largest = rows().groupBy(*partition_by).count().agg(F.max("count")).collect()[0][0]
            n_buckets = 1 if largest <= ROWS_PER_BUCKET else n_buckets      # no group is worth splitting
    b = "__bucket"
    if n_buckets > 1:
        bounds = _range_bounds(rows(), order, n_buckets, n_rows)
        staged = [r.withColumn(b, _bucket_column(r, order, bounds, n_buckets)) for r in (rows(), rows())]
        totals = staged[0].groupBy(*partition_by, b).agg(*(fn[agg](f"__v{i}").alias(f"__t{i}") for i, (agg, _) in how))
        wt = Window.partitionBy(*partition_by).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
        base = [(F.coalesce(F.sum(f"__t{i}").over(wt), F.lit(0)) if agg == "sum" else fn[agg](f"__t{i}").over(wt)).alias(f"__base{i}") for i, (agg, _) in how]
        # bases has at most n_buckets rows per group: size bounded by a parameter
        bases = totals.select(*(F.col(p).alias(f"__p{i}") for i, p in enumerate(partition_by)), F.col(b).alias("__b"), *base)
        if not partition_by:
            bases = F.broadcast(bases)
        same = F.col(b) == F.col("__b")
        for i, p in enumerate(partition_by):        # null is a group like others
            same = same & F.col(p).eqNullSafe(F.col(f"__p{i}"))
        joined = staged[1].join(bases, same, "left").drop(*(f"__p{i}" for i in range(len(partition_by))), "__b")
        if stop_above is not None:
            # a running sum never falls below its bucket's base (non-negative
            # values): buckets already past the limit skip the local sort entirely
            joined = joined.where(F.col("__base0") <= stop_above)
    else:
        kinds = dict(rows().dtypes)
        joined = rows().withColumn(b, F.lit(0)).withColumns({f"__base{i}": F.lit(0 if agg == "sum" else None).cast(kinds[f"__v{i}"]) for i, (agg, _) in how})
    # small groups whole: what follows on the same groups needs no further shuffle
    w = Window.partitionBy(*partition_by, *([b] if n_buckets > 1 or not partition_by else [])).orderBy(*order)
    upto = {inclusive: w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1) for inclusive in (True, False)}
    found = [combine[agg](F.col(f"__base{i}"), fn[agg](f"__v{i}").over(upto[inclusive])).alias(out) for out, (i, (agg, inclusive)) in zip(specs, how)]
    return joined.select(*(F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c not in specs), *found)


def prefix_sum(df: DataFrame, order: Sequence[str], value: Column | str,
               out: str = "prefix", inclusive: bool = True,
               n_buckets: int | None = None, partition_by: Sequence[str] = (),
               agg: str = "sum", stop_above: float | None = None) -> DataFrame:
    """One running aggregate; see ``prefix_aggregates``."""
    return prefix_aggregates(df, order, {out: (value, agg, inclusive)}, n_buckets, partition_by, stop_above if agg == "sum" else None)


def dense_index(df: DataFrame, order: Sequence[str], out: str = "idx",
                partition_by: Sequence[str] = (), n_buckets: int | None = None,
                below: int | None = None) -> DataFrame:
    """0-based position in ``order`` without a single-partition window.

    ``below`` keeps only positions < below, skipping later buckets before
    their sort (a top-n cap over a huge input)."""
    d = prefix_sum(df, order, F.lit(1), out=out, inclusive=False, partition_by=partition_by,
                   n_buckets=n_buckets, stop_above=None if below is None else below - 1)
    return d if below is None else d.where(F.col(out) < below)
