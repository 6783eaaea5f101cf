"""Session settings and the one way this package cuts lineage."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SEED = 42

#: Whether Spark deletes the shuffle files of an execution as soon as it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths made since the innermost ``settled`` began.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def build_session(app: str = "parley", cpus: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.host": "127.0.0.1",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, or else one beside the warehouse.

    Both are places that driver and executors share; the master makes no difference.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder is None:
        folder = context.getCheckpointDir()
    if folder is None:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/parley-shared"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, kind: str = "table") -> str:
    """A path in the shared folder that no one has used; it goes when the session ends."""
    path = f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    target, files = _files(spark, path)
    files.mkdirs(target)
    files.deleteOnExit(target)
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


def _files(spark: SparkSession, path: str):
    """A path and its file system, as Hadoop has them."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and go on from its files.

    This cuts the lineage as a checkpoint does, and later reads are columnar. Nothing reads the shuffles of the
    write again, so they go at once, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = new_path(spark)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """The written result of ``make``; the tables that it had written on the way are deleted."""
    outer, made = _MADE.get(), []
    token = _MADE.set(made)
    try:
        out = materialise(make())
    finally:
        _MADE.reset(token)
    for path in made[:-1]:  # the last one is the result's
        target, files = _files(out.sparkSession, path)
        files.delete(target, True)
    if outer is not None:
        outer.append(made[-1])
    return out


def forget(df: DataFrame) -> None:
    """Delete the files of a table that ``materialise`` made and that nothing reads any more."""
    for file in df.inputFiles()[:1]:
        jvm = df.sparkSession.sparkContext._jvm
        target, files = _files(df.sparkSession, jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)).getParent().toString())
        files.delete(target, True)
