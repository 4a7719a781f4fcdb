"""An endless, resumable streaming source over the row groups of a sharded corpus.

The corpus is read shard after shard in name order, epoch after epoch. Within a shard
row group g belongs to rank ``g % ranks``, and each row carries its rank's running number
``seq`` (0, 1, 2, … over all epochs), so a consumer per rank can restore the order
whatever the order of arrival. Offsets are (epoch, shard name, row group, next number of
each rank): small, and found with the footers of the shards of one micro-batch only. A task
reads a run of neighbouring row groups.

A micro-batch costs the same few seconds whatever it holds. With ``grow`` above 1 a query that is
behind therefore takes ever larger ones, so that their number grows with the logarithm of
the backlog up to ``most`` rows a micro-batch. Rows and their numbers are the same either way.

Spark logs the offsets in the query's checkpoint, so a restart continues exactly
after the last row group of a committed batch. What was handed out last is also kept
in ``progress``, since Spark does not tell a restarted Python source where it was.

Options: ``path``; ``progress`` (a folder for the position, one per query);
``columns`` (their DDL); ``ranks`` (1); ``groups`` (row groups of the first micro-batch, 8);
``grow`` (how many times the one before the next may hold, 1); ``most`` (rows at which a grown
micro-batch ends, 262144); ``tasks`` (input partitions of a micro-batch at most, 32); ``epochs`` (0: endless).
"""

from __future__ import annotations

import bisect
import json
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from quill.session import ship_package
from quill.sources.shard_writer import open_path

FORMAT = "quill_corpus"
MOST_ROWS = 1 << 18
KEPT_FOOTERS = 1 << 16      # sizes of row groups by shard, a few numbers each


@dataclass
class RowGroup:
    epoch: int
    shard: str
    group: int
    rank: int
    seq: int
    rows: int


@dataclass
class Run(InputPartition):
    """Row groups that one task reads one after another."""

    groups: list[RowGroup]

    @property
    def seq(self) -> int:
        return self.groups[0].seq


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict, schema):
        self.store, self.path = open_path(options["path"].rstrip("/"))
        self.ranks, self.step, self.epochs = (int(options.get(k, d)) for k, d in (("ranks", 1), ("groups", 8), ("epochs", 0)))
        self.grow, self.most, self.tasks = (int(options.get(k, d)) for k, d in (("grow", 1), ("most", MOST_ROWS), ("tasks", 32)))
        self.first = self.step
        self.columns = [f.name for f in schema.fields[6:]]
        self.mark_store, folder = open_path(options["progress"].rstrip("/"))
        self.mark = f"{folder}/position.json"
        found = self.store.get_file_info(fs.FileSelector(self.path))
        self.shards = sorted(f.base_name for f in found if f.type == fs.FileType.File and f.base_name.endswith(".parquet"))
        self.sizes = lru_cache(maxsize=KEPT_FOOTERS)(self._sizes)
        self.at = None

    def __getstate__(self):     # tasks only need what read() uses
        return {"path": self.path, "store": self.store, "columns": self.columns}

    def _sizes(self, shard: str) -> list[int]:
        """Rows of each row group, from the footer."""
        with self.store.open_input_file(f"{self.path}/{shard}") as f:
            m = pq.ParquetFile(f).metadata
            return [m.row_group(i).num_rows for i in range(m.num_row_groups)]

    def initialOffset(self) -> dict:
        return {"epoch": 0, "shard": self.shards[0] if self.shards else "", "group": 0, "seq": [0] * self.ranks}

    def _steps(self, start: dict):
        """Row groups from ``start`` on, each with the offset after it."""
        epoch, shard, group, seq = start["epoch"], start["shard"], start["group"], list(start["seq"])
        while self.shards and (not self.epochs or epoch < self.epochs):
            k = bisect.bisect_left(self.shards, shard)
            if k == len(self.shards):
                epoch, shard, group = epoch + 1, self.shards[0], 0
                if not any(self._sizes(s) for s in self.shards):
                    return
                continue
            if self.shards[k] != shard:     # the shard is gone: its successor from its start
                shard, group = self.shards[k], 0
            sizes = self.sizes(shard)
            if group >= len(sizes):
                shard, group = shard + "\0", 0      # just after this name
                continue
            rank = group % self.ranks
            part = RowGroup(epoch, shard, group, rank, seq[rank], sizes[group])
            seq[rank] += sizes[group]
            group += 1
            yield part, {"epoch": epoch, "shard": shard, "group": group, "seq": list(seq)}

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self.initialOffset()
            if self.mark_store.get_file_info(self.mark).type == fs.FileType.File:
                with self.mark_store.open_input_file(self.mark) as f:
                    self.at = json.loads(f.read())
        taken = rows = 0
        for part, self.at in self._steps(self.at):
            taken, rows = taken + 1, rows + part.rows
            if taken >= self.step or (taken >= self.first and rows >= self.most):
                break
        if taken == self.step:      # more may be waiting
            self.step *= self.grow
        folder = self.mark.rsplit("/", 1)[0]
        self.mark_store.create_dir(folder, recursive=True)
        with self.mark_store.open_output_stream(self.mark + ".new") as f:
            f.write(json.dumps(self.at).encode())
        self.mark_store.move(self.mark + ".new", self.mark)
        return self.at

    def partitions(self, start: dict, end: dict) -> list[Run]:
        if start == end:
            return []
        parts = []
        for part, after in self._steps(start):
            parts.append(part)
            if after == end:
                each = -(-len(parts) // self.tasks)
                return [Run(parts[i:i + each]) for i in range(0, len(parts), each)]
        raise ValueError(f"the corpus does not lead from {start} to {end}; is the progress folder of another query?")

    def read(self, partition: Run):
        for shard, groups in groupby(partition.groups, key=lambda g: g.shard):
            with self.store.open_input_file(f"{self.path}/{shard}") as f:
                file = pq.ParquetFile(f)
                for g in groups:
                    yield from self._rows(file, g)

    def _rows(self, file: pq.ParquetFile, g: RowGroup):
        done = 0
        for b in file.iter_batches(row_groups=[g.group], columns=self.columns, batch_size=1024):
            n = b.num_rows
            own = {"epoch": pa.array([g.epoch] * n, pa.int64()), "shard": pa.array([g.shard] * n),
                   "row_group": pa.array([g.group] * n, pa.int64()), "row": pa.array(range(done, done + n), pa.int64()),
                   "rank": pa.array([g.rank] * n, pa.int32()), "seq": pa.array(range(g.seq + done, g.seq + done + n), pa.int64())}
            done += n
            yield pa.RecordBatch.from_arrays([*own.values(), *(b.column(c) for c in self.columns)], names=[*own, *self.columns])


class CorpusSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "epoch bigint, shard string, row_group bigint, row bigint, rank int, seq bigint, " + self.options.get("columns", "text string")

    def streamReader(self, schema) -> _Reader:
        return _Reader(dict(self.options), schema)


def stream_epochs(spark: SparkSession, path: str, progress: str, columns: str = "text string", ranks: int = 1, groups: int = 8, epochs: int = 0, grow: int = 1) -> DataFrame:
    """A4: (epoch, shard, row_group, row, rank, seq, columns) of a corpus folder, endless
    unless ``epochs`` is given; see the module's text for resuming and for ``grow``."""
    ship_package(spark)
    spark.dataSource.register(CorpusSource)
    return (spark.readStream.format(FORMAT).option("path", path).option("progress", progress).option("columns", columns)
            .option("ranks", ranks).option("groups", groups).option("epochs", epochs).option("grow", grow)
            .option("tasks", 2 * spark.sparkContext.defaultParallelism).load())
