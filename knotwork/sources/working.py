"""Working tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset, one in the warehouse, or in local mode a temporary one."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if folder is None:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = known.get() if known.isDefined() else None
    if folder is None:
        local = spark.sparkContext.master.startswith("local")
        folder = tempfile.mkdtemp(prefix="knotwork-") if local else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/knotwork-work"
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A folder for a working table. It goes when the session's Python process ends, if the session is still there."""
    path = f"{shared_dir(spark)}/knotwork/{name}-{uuid.uuid4().hex}"
    _WORK.setdefault(spark.sparkContext, set()).add(path)
    return path


_WORK: dict = {}


def working(spark: SparkSession) -> set[str]:
    """The working tables that there are now."""
    return set(_WORK.get(spark.sparkContext, ()))


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete working tables, or files that a frame was read from."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
        _WORK.get(spark.sparkContext, set()).discard(path)


@atexit.register
def _discard_all() -> None:
    for context, paths in _WORK.items():
        with contextlib.suppress(Exception):  # the session may be gone
            if context._jsc is not None and SparkSession.getActiveSession() is not None:
                discard(SparkSession.getActiveSession(), *list(paths))


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession):
    """What is run within leaves no shuffle files behind: each job's go as soon as it has ended."""
    before = spark.conf.get(FREED, "false")
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before)


def staged(frame: DataFrame, name: str, path: str | None = None, compression: str = "snappy", *parts: str) -> DataFrame:
    """Write the frame to the shared folder and read it back: it is computed once, and its lineage ends there.

    parts: columns that get a folder a value, which can be discarded alone.
    """
    spark = frame.sparkSession
    path = path or new_path(spark, name)
    with shuffles_freed(spark):
        frame.write.option("compression", compression).partitionBy(*parts).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
