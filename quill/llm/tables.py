"""Shared plumbing of the operators: reading, written intermediate tables, folds.

Intermediate results are written as Parquet below the folder the cluster names
in ``spark.checkpoint.dir`` and read back: a lost executor loses no data, the
lineage is cut, and nothing is computed twice. Shuffle files go as soon as the table
that needed them is written, the folders when their reader discards them, or else when
the application ends.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quill.session import ensure_checkpoint_dir, ship_package


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder, deleted at the application's end."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop)
    fs.deleteOnExit(hadoop)
    return path


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside are deleted when it has run, instead of when the
    driver's collector comes past them."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a shared table and read back (same schema)."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    schema = df.schema
    with shuffles_go(spark):
        df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.stored_at = path
    for made in _scopes:
        made.append(out)
    return out


_scopes: list[list[DataFrame]] = []


@contextlib.contextmanager
def only_result_stays() -> Iterator[None]:
    """Of the tables stored inside, the last one stays: the others have been read for it."""
    _scopes.append([])
    try:
        yield
    finally:
        made = _scopes.pop()
    discard(*made[:-1])


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing reads any more."""
    for df in tables:
        discard_folders(df.sparkSession, df.stored_at)


def discard_folders(spark: SparkSession, *paths: str) -> None:
    """Delete folders of ``shared_folder`` that nothing reads any more."""
    sc = spark.sparkContext
    for path in paths:
        hadoop = sc._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hadoop, True)


def open_uri(path: str):
    """File system and path, for files that tasks write and read themselves."""
    return pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:/", "file:///", 1) if path.startswith("file:/") else "file://" + path)


def bit_table(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bit for each slot ``pmod(column, bits)``, 64 to a word."""
    slot = F.pmod(F.col(column), F.lit(bits)).alias("s")
    with shuffles_go(df.sparkSession):      # at most bits / 64 rows
        words = df.select(slot).groupBy(F.shiftright("s", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(s % 64 as int)))").alias("bits")).toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[words.column("w").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return table


def bits_for(rows: int, most: int) -> int:
    """Bits of a table in which few of the slots that ``rows`` hashes leave free are hit."""
    return min(most, max(1 << 16, 1 << (16 * rows).bit_length()))


def has_bit(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (table[slots >> 6] >> (slots & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def crc32_mod(col: str, m: int) -> Column:
    """crc32 of the column as text, modulo m (a null id counts as fold 0)."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % m, F.lit(0))


def text_bytes(col: str = "text") -> Column:
    """Whole text as UTF-8 bytes; null becomes empty."""
    return F.coalesce(F.col(col).cast("binary"), F.lit(b""))


def named(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


BATCH_BYTES = 4 << 20       # of rows that an operator's Python sees at once


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with this package's sources sent to the executors first. ``fn`` gets
    batches of at most ``BATCH_BYTES`` (a longer row comes alone), and what the worker
    no longer needs goes back to the system when the task ends."""
    ship_package(df.sparkSession)

    def run(batches):
        try:
            yield from fn(part for batch in batches for part in _rows_up_to(batch, _row_bytes(batch), BATCH_BYTES))
        finally:
            release_memory()
    return df.mapInArrow(run, schema)


def release_memory() -> None:
    """Freed memory back to the system: workers are reused by later stages."""
    import ctypes
    import gc
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):      # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def skew_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Equi-join on one column whose right side is an aggregate by that column.

    Such a side already lies by the key, so Spark would not exchange it again, and
    adaptive execution splits a hot key only where both sides are exchanged. The
    join therefore runs on a key derived from ``on``.
    """
    def derived(df):
        c = F.col(on)
        return F.bitwise_not(c) if dict(df.dtypes)[on] == "bigint" else F.concat(F.lit("="), c.cast("string"))
    r = right.withColumn("__key", derived(right)).drop(on)
    return left.withColumn("__key", derived(left)).join(r, "__key", how).drop("__key")


def _column_bytes(values: pa.Array) -> np.ndarray | int:
    """Bytes of each row of a column; a list counts eight for an item."""
    kind = values.type
    if pa.types.is_list(kind):
        size = pc.multiply(pc.list_value_length(values), 8)
    elif pa.types.is_binary(kind) or pa.types.is_string(kind) or pa.types.is_large_binary(kind) or pa.types.is_large_string(kind):
        size = pc.binary_length(values)
    else:
        return 8
    return pc.fill_null(size, 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _row_bytes(batch: pa.RecordBatch) -> np.ndarray:
    return sum((_column_bytes(c) for c in batch.columns), np.zeros(batch.num_rows, np.int64))


def _rows_up_to(batch: pa.RecordBatch, size: np.ndarray, budget: int) -> Iterator[pa.RecordBatch]:
    ends, at = np.cumsum(size), 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + budget, side="right")))
        yield batch.slice(at, to - at)
        at = to


def slabs(batch: pa.RecordBatch, column: int, budget: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch whose ``column`` holds at most ``budget`` bytes
    together; a longer row comes alone."""
    return _rows_up_to(batch, _column_bytes(batch.column(column)), budget)
