"""Session set-up, and where multi-stage plans write intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: The folder of the job that owns the intermediate tables written now, if one does.
_JOB: ContextVar[str | None] = ContextVar("wattlane_job", default=None)

def build_session(app: str = "wattlane", master: str = "local[8]", shuffle_partitions: int = 8,
                  **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; on a cluster pass your own."""
    builder = (
        SparkSession.builder.appName(app).master(master)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, taken from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if sc.master.split("[")[0] != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            configured = tempfile.mkdtemp(prefix="wattlane-")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


@contextmanager
def job_folder(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables written inside the block belong to it and go when it ends. What
    outlives the block must be written elsewhere before. A nested block belongs to the outer one."""
    if _JOB.get() is not None:
        yield _JOB.get()
        return
    folder = f"{shared_dir(spark)}/job-{uuid.uuid4().hex}"
    token = _JOB.set(folder)
    try:
        yield folder
    finally:
        _JOB.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table: in the folder of the running job, else in the shared one."""
    return f"{_JOB.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage (lost executors re-read files instead of redoing the
    shuffle) and gives Catalyst the real size of the table, so a later join
    broadcasts it only below ``spark.sql.autoBroadcastJoinThreshold`` and
    shuffles otherwise. No broadcast hint is needed anywhere.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    with _shuffles_go(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write go when it ends: what they led to is in the shared folder by then.
    Otherwise they stay on the executors' disks until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def gather(df: DataFrame, most: int = 10_000) -> tuple[DataFrame, pa.Table | None]:
    """A table of at most ``most`` rows becomes part of the plan: no job reads it again, and a join
    broadcasts it by its known size. Its rows are returned too. A larger one, which should be a
    written table, stays what it is, without rows."""
    rows = df.limit(most + 1).toArrow()
    if rows.num_rows > most:
        return df, None
    return df.sparkSession.createDataFrame(rows, df.schema), rows


def spread(df: DataFrame) -> DataFrame:
    """Use every core for a table that many passes will read but that its files cut
    into too few splits. A table with enough splits is left alone. Call it on a plain
    scan or projection, before any shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def choose_method(df: DataFrame, method: str = "auto") -> str:
    """``bracket``, two bounded passes, at every size. ``direct``, one aggregate that holds the
    distinct values of a group in a task, is for callers who know their groups are small."""
    if method not in ("auto", "direct", "bracket"):
        raise ValueError(f"unknown method {method!r}")
    return "bracket" if method == "auto" else method


def stage(df: DataFrame, method: str, name: str = "stage") -> DataFrame:
    """Settle a statistics table of a large plan; leave a small one lazy."""
    return settle(df, name) if method == "bracket" else df


def unnest(df: DataFrame, method: str, name: str = "stage") -> DataFrame:
    """Cut the plan of a small table, whose statistics are nested in it unevaluated.
    In a large plan they are settled already, and the table is a cheap projection
    over its files that is not worth writing again."""
    return settle(df, name) if method == "direct" else df
