"""Folders shared by all executors, and the session used by tests and bench."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which an action deletes its shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Paths, and the tables that stand for them, of the scope that is open.
_kept: ContextVar[list[tuple[str, str | None]] | None] = ContextVar("kept", default=None)


def build_session(cpus: str = "*", app: str = "riskloom", **conf: str) -> SparkSession:
    """Local session for tests and bench; a cluster supplies its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one beside the warehouse's tables.

    Both are shared by all executors; a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/riskloom-scratch"


def fresh_dir(spark: SparkSession, tag: str) -> str:
    """A path under the shared folder that nobody has used before."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give the context a checkpoint folder unless the cluster set one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(fresh_dir(spark, "checkpoint"))


def settle(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the files.

    For a result that several later jobs read: unlike a cache it outlives
    lost executors, and the written table starts a short lineage. Shuffle files go with the
    action that wrote them; else they stay until the driver collects its garbage, which in a job of
    long stages is after the job. Whatever value the session has been given for that is left.
    """
    spark = df.sparkSession
    if spark.conf.get(CLEANUP, None) is None:
        spark.conf.set(CLEANUP, "true")
    path = fresh_dir(spark, tag)
    note_scratch(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def note_scratch(path: str, table: str | None = None) -> None:
    """Let the open ``scratch`` scope, if any, delete this path and drop this table."""
    if (kept := _kept.get()) is not None:
        kept.append((path, table))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end, failed or not, what was settled inside by the thread that opened it.

    Results are lazy and read those files: write them out before the end. A scope within another
    deletes its own. Nothing else in the shared folder is touched.
    """
    kept: list[tuple[str, str | None]] = []
    token = _kept.set(kept)
    try:
        yield
    finally:
        _kept.reset(token)
        hadoop, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
        for path, table in kept:
            if table:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(hadoop).delete(at, True)
