"""Session helpers.

The library never creates a global session: every operator takes DataFrames.
These helpers exist for tests, the bench and the driver contract.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "quill") -> SparkSession:
    """Session tuned for correctness checks and local benchmarks.

    AQE stays on so shuffle partitions coalesce at runtime and skewed joins
    split; the UI is off (no server).
    """
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. Where it is unset, a
    scratch directory is registered in local mode only: on a cluster a
    machine-local folder would be invisible to the other machines.
    """
    sc = spark.sparkContext
    ship_package(spark)
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="quill-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_quill_shipped", False):
        return
    sc._quill_shipped = True
    package = os.path.dirname(os.path.abspath(__file__))
    if not os.path.isdir(package):      # already running from a shipped archive
        return
    folder = tempfile.mkdtemp(prefix="quill-src-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "quill_src.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for top, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(archive)


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reliable_checkpoint(df):
    """``checkpoint()`` into the cluster's checkpoint directory without computing
    the plan twice: the eager checkpoint job reads the persisted copy."""
    ensure_checkpoint_dir(df.sparkSession)
    df = df.persist()
    cp = df.checkpoint(eager=True)
    df.unpersist()
    return cp


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"     # when an execution ends

_scratch: list[list[str]] = []


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder, deleted at the application's end."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop)
    fs.deleteOnExit(hadoop)
    for made in _scratch:
        made.append(path)
    return path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete folders that nothing reads any more."""
    for path in paths:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextlib.contextmanager
def settings(spark: SparkSession, want: dict[str, str]) -> Iterator[None]:
    """Session settings inside, restored afterwards."""
    before = {k: spark.conf.get(k, None) for k in want}
    try:
        for k, v in want.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """For a result that is written inside: shared folders made for it go at the end, and
    shuffle files as soon as the execution that needed them has run."""
    _scratch.append([])
    try:
        with settings(spark, {SHUFFLES_GO: "true"}):
            yield
    finally:
        discard(spark, *_scratch.pop())


def written(df, name: str):
    """``df`` written once to a shared table. Returns a function that reads it: two
    reads are two relations, so joining them needs no re-aliasing of attributes."""
    spark, schema, path = df.sparkSession, df.schema, shared_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return lambda: spark.read.schema(schema).parquet(path)
