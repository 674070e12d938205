"""Index calendars (SRC-01 to SRC-03) and ingestion windows (FLT-04)."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARCHIVE = "https://www.sec.gov/Archives"
#: Structured holdings reports begin here; no window starts earlier.
EARLIEST = date(2013, 5, 20)
DEV_DAYS, OVERLAP_DAYS = 183, 7
MODES = ("dev", "full", "daily")


@dataclass(frozen=True)
class Window:
    start: date
    end: date


@dataclass(frozen=True)
class Checkpoint:
    filed_date: date
    accession_number: str | None = None


def resolve_window(mode: str, today: date, start: date | None = None, end: date | None = None, checkpoint: Checkpoint | None = None) -> Window:
    """Explicit bounds win; otherwise half a year, everything, or a week before the checkpoint (or today)."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    last = end or today
    if start is None:
        if mode == "full":
            start = EARLIEST
        else:
            base = checkpoint.filed_date if mode == "daily" and checkpoint else today
            start = base - timedelta(days=DEV_DAYS if mode == "dev" else OVERLAP_DAYS)
    start = max(start, EARLIEST)
    if start > last:
        raise ValueError(f"window is empty: {start} is after {last}")
    return Window(start, last)


def _bounds(spark: SparkSession, start: date, end: date) -> DataFrame:
    return spark.range(1).select(F.lit(start).alias("s"), F.lit(end).alias("e"))


def quarter_urls(spark: SparkSession, start: date, end: date, archive: str = ARCHIVE) -> DataFrame:
    """One master index per quarter that the window touches."""
    quarters = F.sequence(F.trunc("s", "quarter"), F.col("e"), F.expr("interval 3 months"))
    days = _bounds(spark, start, end).select(F.explode(quarters).alias("period_start"))
    return days.select("period_start", F.format_string(f"{archive}/edgar/full-index/%d/QTR%d/master.idx", F.year("period_start"), F.quarter("period_start")).alias("url"))


def day_urls(spark: SparkSession, start: date, end: date, archive: str = ARCHIVE) -> DataFrame:
    """One master index per weekday."""
    days = _bounds(spark, start, end).select(F.explode(F.sequence("s", "e", F.expr("interval 1 day"))).alias("period_start")).where(F.weekday("period_start") < 5)
    name = F.format_string(f"{archive}/edgar/daily-index/%d/QTR%d/master.%s.idx", F.year("period_start"), F.quarter("period_start"), F.date_format("period_start", "yyyyMMdd"))
    return days.select("period_start", name.alias("url"))


def index_urls(spark: SparkSession, mode: str, window: Window, archive: str = ARCHIVE) -> DataFrame:
    """Quarterly for full runs, daily otherwise (PIP-07)."""
    return (quarter_urls if mode == "full" else day_urls)(spark, window.start, window.end, archive)
