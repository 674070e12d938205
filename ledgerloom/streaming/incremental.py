"""Incremental ingestion as a stream (STR-*): the file source keeps progress, batches are upserted.

Reading with `availableNow` processes what has arrived since the last run and
stops; the query's checkpoint folder is the durable progress. Writes go
through `foreachBatch` into commits of the store, which also hold the number of
the last batch, so a batch that is replayed after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.events import effective_members
from ..operators.upsert import clock, upsert_latest
from ..scratch import staged
from ..sources.index import index_entries


def index_stream(spark: SparkSession, folder: str, archive: str) -> DataFrame:
    """Index files that arrive in a folder, parsed as they come (compressed ones too)."""
    files = spark.readStream.format("text").schema("value string").option("wholetext", "true").load(folder)
    return index_entries(files.withColumnRenamed("value", "text"), archive=archive)


def run_available(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Apply all that has arrived since the last run, then stop."""
    query = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _source(batch: DataFrame) -> str:
    """The stream's own name, which its checkpoint folder keeps."""
    return f"stream {batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId') or 'without name'}"


def upserting(store, table: str, key: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """A batch function that upserts into a table.

    Its rows are ingested after all that the store holds, by the clock that other
    ways of ingesting use; a batch that was committed before is passed over.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        with store.commit((_source(batch), batch_id)) as new:
            if new:
                columns = store.read(table).columns
                rows = staged((batch.withColumn("ingest_seq", F.lit(clock())) if "ingest_seq" in columns else batch).select(*columns))
                store.update(table, rows, lambda now: upsert_latest(now, rows, key))

    return apply


def upserting_until(store, table: str, late: str, key: Sequence[str], time: str, days: int = 7) -> Callable[[DataFrame, int], None]:
    """As `upserting`, with a watermark: rows up to `days` behind the latest date seen before their batch are upserted, those further behind are counted by date in table `late` (STR-02).

    The latest date is part of the store's commits, so batches that are replayed,
    or streams that begin anew, decide as they did.
    """
    seen = f"latest {table}.{time}"

    def apply(batch: DataFrame, batch_id: int) -> None:
        with store.commit((_source(batch), batch_id)) as new:
            if not new:
                return
            marks = store.manifest()["marks"]
            bound = F.date_add(F.lit(date(1970, 1, 1)), marks[seen] - days) if seen in marks else None
            columns = store.read(table).columns
            rows = staged((batch.withColumn("ingest_seq", F.lit(clock())) if "ingest_seq" in columns else batch).select(*columns))
            behind = rows.where(F.col(time) < bound) if bound is not None else rows.limit(0)
            kept = rows.where(F.col(time).isNull() | (F.col(time) >= bound)) if bound is not None else rows
            store.update(table, kept, lambda now: upsert_latest(now, kept, key))
            counts = behind.groupBy(time).agg(F.count("*").alias("n"))
            if store.exists(late):
                counts = store.read(late).unionByName(counts).groupBy(time).agg(F.sum("n").alias("n"))
            store.write(late, counts)
            latest = rows.agg(F.datediff(F.max(time), F.lit(date(1970, 1, 1)))).first()[0]
            if latest is not None:
                marks[seen] = max(latest, marks.get(seen, latest))

    return apply


def effective_after(events: DataFrame, touched: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Members of the groups that a batch touched, from all their events: a late reset invalidates what was output before."""
    return effective_members(events.join(touched.select(*group).distinct(), [*group], "left_semi"), group, order)


def late_aware_counts(events: DataFrame, time: str, window: str, lateness: str, *by: str) -> DataFrame:
    """Event-time counts per window; rows later than the watermark are dropped."""
    return events.withWatermark(time, lateness).groupBy(F.window(time, window), *by).agg(F.count("*").alias("n"))
