"""Acquisition as Spark jobs (SRC-04, SRC-05, SRC-15, SNK-01, PIP-04): many filings at once.

A source adds `content` and `error` to rows that have a `url`; a document that
is `optional` and missing has neither. `mirror` joins with a table of documents,
such as a bulk download, and knows no rate; `fetching` asks the archive in tasks that
share one rate. What a source gives is written once, as Parquet below the raw
documents, before anything is decided by it: a task that is lost repeats its own requests only,
and a batch is a few files, not one for each document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import shuffles_dropped
from ..sources.index import decoded
from ..sources.submission import documents, holdings_documents, periodic_documents
from .fetch import Fetcher, FetchError, NotFound

Source = Callable[[DataFrame], DataFrame]
#: Answers that a task holds before it passes them on.
HELD = 16


def mirror(table: DataFrame) -> Source:
    """Documents out of a table of `url` and `content`; of rows that repeat an address the greatest content counts."""
    known = table.where("url IS NOT NULL AND content IS NOT NULL").groupBy("url").agg(F.max("content").alias("content"))

    def get(urls: DataFrame) -> DataFrame:
        missing = F.col("content").isNull() & ~F.col("optional")
        return urls.join(known, "url", "left").withColumn("error", F.when(missing, F.concat(F.lit("NotFound: "), F.coalesce("url", F.lit("no address")))))

    return get


def fetching(fetcher: Callable[[float], Fetcher], per_second: float = 5.0, tasks: int = 8) -> Source:
    """Documents from the archive. `fetcher` makes one that keeps to the rate that it is given: each of `tasks` has an equal share."""

    def answer(one: Fetcher, url: str | None, optional: bool) -> tuple[bytes | None, str | None]:
        try:
            return (one.get(url, optional), None) if url else (None, None if optional else "NotFound: no address")
        except (FetchError, NotFound) as problem:
            return None, f"{type(problem).__name__}: {problem}"

    def get(urls: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            one = fetcher(per_second / tasks)
            for batch in batches:
                for at in range(0, len(batch), HELD):
                    part = batch.slice(at, HELD)
                    got = [answer(one, u, o) for u, o in zip(part["url"].to_pylist(), part["optional"].to_pylist(), strict=True)]
                    added = [pa.array([c for c, _ in got], pa.binary()), pa.array([e for _, e in got], pa.string())]
                    yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*part.schema.names, "content", "error"])

        schema = T.StructType([*urls.schema, T.StructField("content", T.BinaryType()), T.StructField("error", T.StringType())])
        return urls.repartition(tasks).mapInArrow(run, schema)

    return get


def _written(df: DataFrame, path: str) -> DataFrame:
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def index_texts(urls: DataFrame, source: Source, path: str) -> DataFrame:
    """Texts of the index files at `urls`; missing ones (holidays) are passed over, any other failure ends the run."""
    got = _written(source(urls.select("url", F.lit(True).alias("optional"))), path)
    if problem := got.where("error IS NOT NULL").first():
        raise FetchError(problem.error)
    return got.where("content IS NOT NULL").select(decoded(F.col("content")).alias("text"))


def acquire(entries: DataFrame, holdings: bool, source: Source, folder: str) -> tuple[DataFrame, DataFrame]:
    """Documents of the filings in `entries`, written below `folder`, and accession_number and error of filings that cannot be had.

    First every filing's directory and submission, then the documents that its submission names.
    """
    lit, col = F.lit, F.col

    def asked(rows: DataFrame, wanted) -> DataFrame:
        return rows.select("accession_number", "form_type", "filing_directory_url", F.explode(wanted).alias("d")).select("accession_number", "form_type", "filing_directory_url", "d.*").where("url IS NOT NULL OR NOT optional")

    def one(role, url, filename, optional: bool):
        return F.struct(role.alias("role"), url.alias("url"), filename.alias("filename"), lit(optional).alias("optional"))

    own = F.array(one(lit("directory_index"), col("index_url"), lit("index.json"), True), one(lit("submission_text"), col("submission_url"), F.substring_index("archive_path", "/", -1), False))
    first = _written(source(asked(entries, own)), f"{folder}/step=filings")

    choose = holdings_documents if holdings else periodic_documents
    opened = first.where("role = 'submission_text' AND content IS NOT NULL")
    chosen = opened.select("accession_number", "form_type", "filing_directory_url", choose(col("form_type"), documents(decoded(col("content")))).alias("c"))

    def place(doc):
        return F.concat_ws("/", "filing_directory_url", doc.filename)

    if holdings:
        named = F.filter(F.array(*(F.when(d.isNotNull(), one(lit(role), place(d), d.filename, False)) for role, d in (("primary_xml", col("c.primary")), ("information_table_xml", col("c.info_table"))))), lambda d: d.isNotNull())
    else:
        exhibits = F.transform("c.xbrl", lambda d, i: one(F.concat(lit("xbrl_artifact_"), (i + 1).cast("string")), place(d), d.filename, True))
        named = F.concat(F.array(one(lit("primary_document"), place(col("c.primary")), col("c.primary.filename"), False)), exhibits)
    second = _written(source(asked(chosen.where("c.error IS NULL"), named)), f"{folder}/step=documents")

    both = first.unionByName(second)
    unfit = chosen.where("c.error IS NOT NULL").select("accession_number", F.concat(lit("ValueError: "), "c.error").alias("error"))
    failures = both.where("error IS NOT NULL").select("accession_number", "error").unionByName(unfit).groupBy("accession_number").agg(F.min("error").alias("error"))
    kept = both.where("content IS NOT NULL").select("accession_number", "role", "url", "filename", "content")
    return kept, failures
