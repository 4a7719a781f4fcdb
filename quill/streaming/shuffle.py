"""B5 as a stream: the document-aligned buffered shuffle over micro-batches.

``BufferedShuffle`` is a ``foreachBatch`` function. The sentences of the unfinished buffer
are carried from batch to batch as a table, with the number of the next buffer and the next
rank; each batch closes the buffers that its documents fill and writes them shuffled. All it
keeps is named by the batch's number and replaced when a batch is repeated, so output is
exactly-once. Documents must arrive in ascending ``key`` order over the batches; the result then
equals ``corpus.shuffle_buffered`` over all of them. A batch costs a dozen Spark jobs whatever
it holds: read a long backlog in growing batches (``stream_epochs``, ``grow``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quill.plans.order import dense_index, seeded_key
from quill.plans.segment import greedy_segments


class BufferedShuffle:
    """Writes (columns of the sentences, buffer, shuffle_key, rank) below ``path``; ``sentences`` maps a
    batch to rows with ``key`` and ``pos``."""

    def __init__(self, path: str, sentences: Callable[[DataFrame], DataFrame], n: int = 50_000, seed: int = 42, key: str = "doc_id", pos: str = "pos"):
        self.path, self.sentences, self.n, self.seed, self.key, self.pos = path.rstrip("/"), sentences, n, seed, key, pos

    def _place(self, kind: str, batch: int) -> str:
        return f"{self.path}/{kind}/batch={batch}"

    def _before(self, spark: SparkSession, batch: int) -> tuple[DataFrame | None, int, int]:
        if batch < 0:
            return None, 0, 0
        at = spark.read.parquet(self._place("position", batch)).collect()[0]
        return spark.read.parquet(self._place("carried", batch)), at.buffer, at.rank

    def _write(self, rows: DataFrame, buffer: int, rank: int, batch: int) -> None:
        keyed = rows.withColumn("shuffle_key", seeded_key(self.seed, self.key, self.pos))
        ranked = dense_index(keyed, ["buffer", "shuffle_key"], out="rank")
        (ranked.withColumn("buffer", F.col("buffer") + buffer).withColumn("rank", F.col("rank") + rank)
         .write.mode("overwrite").parquet(self._place("out", batch)))

    def __call__(self, df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        carried, buffer, rank = self._before(spark, batch - 1)
        rows = self.sentences(df)
        rows = (rows if carried is None else rows.unionByName(carried)).persist()      # read three times below
        per_doc = rows.groupBy(self.key).agg(F.count(F.lit(1)).alias("__n"))
        seg = greedy_segments(per_doc, self.key, "__n", self.n, out="buffer").select(self.key, "buffer", "is_tail")
        met = rows.join(seg, self.key)
        met.where("is_tail").drop("buffer", "is_tail").write.mode("overwrite").parquet(self._place("carried", batch))
        self._write(met.where("NOT is_tail").drop("is_tail"), buffer, rank, batch)
        done = spark.read.parquet(self._place("out", batch)).agg(F.max("buffer"), F.count(F.lit(1))).collect()[0]
        spark.createDataFrame([(buffer if done[0] is None else done[0] + 1, rank + done[1])], "buffer bigint, rank bigint").coalesce(1) \
            .write.mode("overwrite").parquet(self._place("position", batch))
        rows.unpersist()

    def finish(self, spark: SparkSession, batches: int) -> DataFrame:
        """After the last of ``batches``: flush the unfinished buffer and read all."""
        carried, buffer, rank = self._before(spark, batches - 1)
        if carried is not None:
            self._write(carried.withColumn("buffer", F.lit(0).cast("bigint")), buffer, rank, batches)
        return spark.read.parquet(f"{self.path}/out").drop("batch")
