"""Scratch tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; a local one is made only for local sessions that name none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="ledgerloom-")
        spark.sparkContext.setCheckpointDir(named)
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Whether Spark removes the shuffle files of a query when that ends; else they lie on disk until the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that end within leave no shuffle files; a plan that is run again makes them anew."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def staged(df: DataFrame, path: str | None = None) -> DataFrame:
    """`df` written once and read back, for what several branches of a plan read: nothing stays in executors' memory."""
    path = path or scratch_path(df.sparkSession, "staged")
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged_for(df: DataFrame) -> Iterator[DataFrame]:
    """`df` staged for what is done within; its files go then."""
    spark = df.sparkSession
    path = scratch_path(spark, "staged")
    try:
        yield staged(df, path)
    finally:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
