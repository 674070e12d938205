"""Idempotent writes as set operations (SNK-*): merge, replace children, fingerprints.

Parquet has no MERGE: a table's next state is computed from its current state
and a batch and written to a new snapshot. Every row carries `ingest_seq`, so
duplicates, within a batch too, resolve to the row ingested last.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .events import latest_row

SEQ = "ingest_seq"


def clock() -> int:
    """The `ingest_seq` that a batch begins at: greater than any before, with room to number its rows. Runs and streams share it."""
    return int(datetime.now(timezone.utc).timestamp() * 1000) << 20


def upsert_latest(current: DataFrame, batch: DataFrame, key: Sequence[str], seq: str = SEQ, frozen: Sequence[str] = ()) -> DataFrame:
    """The latest row per key; columns in `frozen` keep the value of the earliest row (a conflict does not update them)."""
    both = current.unionByName(batch)
    if not frozen:
        return latest_row(both, key, [seq])
    rest = [c for c in both.columns if c not in key]
    picked = [(F.min_by(c, seq) if c in frozen else F.max_by(c, seq)).alias(c) for c in rest]
    return both.groupBy(*key).agg(*picked).select(*both.columns)


def upsert_span(current: DataFrame, batch: DataFrame, key: Sequence[str], last: Sequence[str], least: Sequence[str], greatest: Sequence[str], seq: str = SEQ) -> DataFrame:
    """Last-written, smallest and greatest columns per key, nulls ignored by the latter two (SNK-02)."""
    both = current.unionByName(batch)
    aggs = {c: F.max_by(c, seq) for c in last} | {c: F.min(c) for c in least} | {c: F.max(c) for c in greatest} | {seq: F.max(seq)}
    return both.groupBy(*key).agg(*(a.alias(c) for c, a in aggs.items())).select(*both.columns)


def replace_children(current: DataFrame, batch: DataFrame, parents: DataFrame, key: Sequence[str]) -> DataFrame:
    """Children of the written parents are exactly those of the batch; others stay (SNK-06, SNK-09). Merged, as parents may be many: see `events.filing_events`."""
    return current.join(parents.select(*key).distinct().hint("merge"), [*key], "left_anti").select(*current.columns).unionByName(batch)


def insert_missing(current: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is new are added, others left alone (SNK-16)."""
    return current.unionByName(batch.dropDuplicates([*key]).join(current.select(*key), [*key], "left_anti"))


def update_from(current: DataFrame, other: DataFrame, key: Sequence[str], columns: Sequence[str], default: Column | None = None) -> DataFrame:
    """Columns taken from the row of `other` with the same key, else kept, else the default (SNK-18)."""
    side = other.select(*key, *(F.col(c).alias(f"_{c}") for c in columns))
    joined = current.join(side, [*key], "left")
    return joined.select(*((F.coalesce(f"_{c}", c, default) if default is not None else F.coalesce(f"_{c}", c)).alias(c) if c in columns else F.col(c) for c in current.columns))


def legacy_profile_name(model: Column, dimension: Column) -> Column:
    """Name of the profile that older embeddings belong to (SNK-17)."""
    return F.concat(F.lit("legacy-"), F.md5(F.concat(model, F.lit(":"), dimension.cast("string"))))


def artifact_fingerprint(artifacts: DataFrame, key: str = "accession_number") -> DataFrame:
    """SHA-256 over sorted `role:sha256` lines; the order of arrival does not matter (SNK-22)."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct("role", "filename", "sha256"))), lambda a: F.concat(a.role, F.lit(":"), a.sha256, F.lit("\n")))
    return artifacts.groupBy(key).agg(F.sha2(F.array_join(lines, ""), 256).alias("artifact_fingerprint"))


def processing_state(events: DataFrame, key: Sequence[str]) -> DataFrame:
    """Current state from an append-only log: status and error of the last event, first start, finish of the last unless it is running (SNK-10)."""
    last = F.max_by("status", SEQ)
    return events.groupBy(*key).agg(
        last.alias("status"),
        F.max_by("error", SEQ).alias("error"),
        F.max(F.when(F.col("status") == "RUNNING", F.col("at"))).alias("started_at"),
        F.when(last != "RUNNING", F.max_by("at", SEQ)).alias("finished_at"),
    )
