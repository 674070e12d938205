"""Pieces that several corpus operators share: scratch tables, folds, text normalisation."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Maps A-Z to a-z in UTF-8 bytes and leaves every other byte alone.
ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: The characters that separate words in every contract here.
ASCII_SPACES = b"\t\n\x0b\x0c\r "


#: Rows of one Arrow batch: long texts make the usual ten thousand too many.
BATCH_ROWS = "1024"


def mapped(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """`df.mapInArrow(f, schema)` in small batches; a worker gives its free memory back at the end of each task, as it outlives it."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one is made only where the session names none (local tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: its lineage is cut, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(df: DataFrame, rows: int, times: int = 1) -> int:
    """How many partitions `times` as many rows as `df` has are dealt to: about `rows` each, whatever the session's setting."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() * times // rows))


#: A core that would get fewer rows than this on average may get none, as readers deal out whole row groups.
FEW_ROWS = 4096


def spread(df: DataFrame) -> DataFrame:
    """`df` over all cores: a table too small for its row groups to occupy them is dealt out row by row, any other stays as it is read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.count() < FEW_ROWS * cores else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(column: Column, folds: int) -> Column:
    """crc32 of the value's text modulo `folds`; null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
