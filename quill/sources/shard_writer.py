"""A Spark data source that writes one Parquet file per shard, with a commit protocol.

A task names and writes the files of the shards it holds: first under a name of its own
attempt, then moved to ``shard_%05d.parquet`` inside the job's staging folder. A repeated
attempt replaces a file by an equal one. Its commit message lists what it wrote. The commit
checks that no shard came from two tasks, writes a manifest beside the files and
publishes everything by renaming the staging folder. Readers see all shards or none; an
aborted job leaves nothing.

Paths may be plain, or URIs that ``pyarrow.fs`` opens on driver and executors.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from quill.session import ship_package

FORMAT = "quill_shards"
SHARD_NAME = "shard_{:05d}.parquet"
MANIFEST = "_shards.json"


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path for a plain path or a URI (``file:/x`` included)."""
    if path.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    return (fs.LocalFileSystem(), path) if "://" not in path else fs.FileSystem.from_uri(path)


@dataclass
class ShardsWritten(WriterCommitMessage):
    shards: list[tuple[int, int]]       # (shard, rows)


class _Shard:
    """One open file; row groups hold exactly ``group`` rows but the last."""

    def __init__(self, store, at: str, final: str, schema: pa.Schema, group: int, dictionary: bool):
        self.store, self.at, self.final, self.group = store, at, final, group
        self.writer = pq.ParquetWriter(at, schema, filesystem=store, compression="zstd", compression_level=3, use_dictionary=dictionary)
        self.held: list[pa.RecordBatch] = []
        self.waiting = self.rows = 0

    def add(self, batch: pa.RecordBatch) -> None:
        self.held.append(batch)
        self.waiting += batch.num_rows
        self.rows += batch.num_rows
        if self.waiting >= self.group:
            self.flush(self.waiting // self.group * self.group)

    def flush(self, n: int) -> None:
        t = pa.Table.from_batches(self.held)
        self.writer.write_table(t.slice(0, n), row_group_size=self.group)
        self.held, self.waiting = t.slice(n).to_batches(), self.waiting - n

    def close(self) -> None:
        if self.waiting:
            self.flush(self.waiting)
        self.writer.close()
        self.store.move(self.at, self.final)


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.group = int(options.get("rowgrouprows", 1024))
        self.dictionary = options.get("dictionary", "true") == "true"
        self.overwrite = overwrite
        self.staging = f"{self.path}.staging-{uuid.uuid4().hex}"

    def write(self, iterator) -> ShardsWritten:
        store, staging = open_path(self.staging)
        attempt = f"{staging}/.attempt-{uuid.uuid4().hex}"
        done: list[tuple[int, int]] = []
        shard, now = None, None
        for batch in iterator:
            number = batch.column(batch.schema.names.index("shard"))
            rows = batch.select([n for n in batch.schema.names if n != "shard"])
            cuts = [0, *(i + 1 for i in pc.indices_nonzero(pc.not_equal(number[1:], number[:-1])).to_pylist()), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi == lo:
                    continue
                n = number[lo].as_py()
                if n != shard:
                    if now:
                        now.close()
                        done.append((shard, now.rows))
                    if any(n == k for k, _ in done):
                        raise ValueError(f"rows of shard {n} do not come together; sort by shard within partitions")
                    store.create_dir(attempt, recursive=True)
                    name = SHARD_NAME.format(n)
                    shard, now = n, _Shard(store, f"{attempt}/{name}", f"{staging}/{name}", rows.schema, self.group, self.dictionary)
                now.add(rows.slice(lo, hi - lo))
        if now:
            now.close()
            done.append((shard, now.rows))
            store.delete_dir(attempt)
        return ShardsWritten(done)

    def commit(self, messages) -> None:
        shards = sorted(s for m in messages if m for s in m.shards)
        twice = {a[0] for a, b in zip(shards, shards[1:]) if a[0] == b[0]}
        if twice:
            self.abort(messages)
            raise ValueError(f"shards written by several tasks: {sorted(twice)[:5]}; repartition by shard")
        store, staging = open_path(self.staging)
        path = open_path(self.path)[1]
        store.create_dir(staging, recursive=True)
        with store.open_output_stream(f"{staging}/{MANIFEST}") as f:
            f.write(json.dumps([{"file": SHARD_NAME.format(k), "rows": n} for k, n in shards]).encode())
        with store.open_output_stream(f"{staging}/_SUCCESS"):
            pass
        old = f"{path}.old-{uuid.uuid4().hex}"
        had = store.get_file_info(path).type != fs.FileType.NotFound
        if had and not self.overwrite:
            self.abort(messages)
            raise FileExistsError(self.path)
        if had:                 # the old output steps aside first, so that one of the two is always there
            store.move(path, old)
        store.move(staging, path)
        if had:
            store.delete_dir(old)

    def abort(self, messages) -> None:
        store, staging = open_path(self.staging)
        if store.get_file_info(staging).type != fs.FileType.NotFound:
            store.delete_dir(staging)


class ShardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options), overwrite)


def write_shards(df: DataFrame, path: str, order: list[str], row_group_rows: int = 1024, dictionary: bool = True, overwrite: bool = True) -> None:
    """(*action*) Rows of ``df`` into one file for each value of ``shard`` below ``path``, in
    ``order`` (columns that are not written). An empty table publishes an empty folder."""
    spark = df.sparkSession
    ship_package(spark)
    spark.dataSource.register(ShardSource)
    names = [c for c in df.columns if c not in order]
    rows = df.withColumn("shard", df["shard"].cast("bigint")).repartition("shard").sortWithinPartitions("shard", *order).select(*names)
    (rows.write.format(FORMAT).mode("overwrite" if overwrite else "append").option("path", path)
     .option("rowGroupRows", row_group_rows).option("dictionary", str(dictionary).lower()).save())
