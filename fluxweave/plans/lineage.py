"""The folder that driver and executors share, and tables written to it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a folder of this machine, which serves a local master alone."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    own = spark.sparkContext.getCheckpointDir()
    if own is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        atexit.register(shutil.rmtree, folder, True)
        spark.sparkContext.setCheckpointDir(f"file://{folder}")
        own = spark.sparkContext.getCheckpointDir()
    return own.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Of Spark: shuffle files go when the query that made them has ended, not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind: nothing reads those of a write again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def cut(df: DataFrame, path: str, by: str | None = None, **options: str) -> DataFrame:
    """df written as Parquet and read back: its lineage ends, and its size is known. by: a column whose values get folders of their own."""
    with shuffles_dropped(df.sparkSession):
        df.write.options(**options).parquet(path, partitionBy=by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, *paths: str) -> None:
    """Folders that `cut` has written and no later query reads."""
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
