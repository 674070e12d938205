"""Cached raw documents: saving, metadata and scans (SNK-01, SRC-15, SRC-16, PIP-08)."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def artifact_path(root: str, accession: str, role: str, filename: str) -> str:
    return f"{root}/raw/filings/{accession}/{role}__{re.sub('[^A-Za-z0-9._-]+', '_', filename)}"


def save_artifact(root: str, accession: str, role: str, url: str, filename: str, body: bytes, content_type: str | None = None) -> dict:
    """Write the document (over an earlier one), to any Hadoop file system, and describe it."""
    path = artifact_path(root, accession, role, filename)
    context = SparkSession.getActiveSession().sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(body))
    finally:
        stream.close()
    return {"accession_number": accession, "role": role, "url": url, "filename": filename, "path": path, "sha256": hashlib.sha256(body).hexdigest(), "content_type": content_type, "size_bytes": len(body)}


def batch_folder(root: str, seq: int) -> str:
    """Where the documents of one batch lie as a table: accession_number, role, url, filename, content."""
    return f"{root}/raw/batches/batch={seq}"


CACHED = "accession_number string, role string, filename string, path string, content binary, sha256 string, size_bytes bigint, cached_seq bigint"


def read_artifacts(spark: SparkSession, root: str, accessions: Sequence[str] | None = None) -> DataFrame:
    """accession_number, role, filename, content, sha256 and size of cached documents, of some filings or of all, read in parallel.

    Documents lie in files of their own and in batches; `cached_seq` tells which of a role was cached last.
    """
    folder, batches = f"{root}/raw/filings", f"{root}/raw/batches"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = [f for f in ([folder] if accessions is None else (f"{folder}/{a}" for a in accessions)) if files.exists(path(f))]
    found = spark.createDataFrame([], CACHED)
    if folders:
        place = r"/raw/filings/([^/]+)/([^/]+?)__([^/]+)$"
        alone = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
        found = alone.select(*(F.regexp_extract("path", place, i).alias(n) for i, n in enumerate(("accession_number", "role", "filename"), 1)), "path", "content", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size_bytes"), F.shiftleft(F.unix_millis("modificationTime"), 20).alias("cached_seq"))
    if files.exists(path(batches)):
        rows = spark.read.schema("accession_number string, role string, filename string, content binary, batch bigint, step string").parquet(batches).where("content IS NOT NULL")
        if accessions is not None:
            rows = rows.where(F.col("accession_number").isin(*accessions))
        dealt = rows.select("accession_number", "role", "filename", F.concat(F.lit(f"{batches}/batch="), F.col("batch").cast("string")).alias("path"), "content", F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("long").alias("size_bytes"), F.col("batch").alias("cached_seq"))
        found = found.unionByName(dealt) if folders else dealt
    return found


def artifacts_of(artifacts: DataFrame, accession: str) -> DataFrame:
    return artifacts.where(F.col("accession_number") == accession).orderBy("role")


def filings_to_reprocess(filings: DataFrame, family: str, accession: str | None = None, start=None, end=None) -> DataFrame:
    """Stored filings of a family within optional bounds, in order of date and accession number."""
    rows = filings.where(F.col("filing_family") == family)
    if accession:
        rows = rows.where(F.col("accession_number") == accession)
    if start:
        rows = rows.where(F.col("filed_date") >= F.lit(start))
    if end:
        rows = rows.where(F.col("filed_date") <= F.lit(end))
    return rows.orderBy("filed_date", "accession_number")
