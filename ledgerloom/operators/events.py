"""Ordered event folding: which events still count (VIW-01, VIW-02).

A RESET discards what came before it, a SUPPLEMENT adds to the last RESET,
anything else is ignored; without a RESET nothing counts. The state of a group
therefore needs no order of all its events: the last RESET is a maximum and the
latest event that counts is another, so both are aggregations that combine
before the shuffle (sorted by group within a task, as what they hold is a whole
row), and a group of any size stays distributed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESET, SUPPLEMENT, NOTICE = "RESET", "SUPPLEMENT", "NOTICE"


def latest_effective(events: DataFrame, group: Sequence[str], order: Sequence[str], kind: str = "kind") -> DataFrame:
    """The latest event that counts of each group that has a RESET."""
    counts = F.col(kind).isin(RESET, SUPPLEMENT)
    whole = F.struct(*events.columns)
    folded = events.where(counts).groupBy(*group).agg(F.max_by(whole, F.struct(*order)).alias("_latest"), F.max(F.col(kind) == RESET).alias("_reset"))
    return folded.where("_reset").select("_latest.*")


def effective_members(events: DataFrame, group: Sequence[str], order: Sequence[str], kind: str = "kind") -> DataFrame:
    """All events that count: those from the last RESET of their group on."""
    last = events.where(F.col(kind) == RESET).groupBy(*group).agg(F.max(F.struct(*order)).alias("_from"))
    joined = events.where(F.col(kind).isin(RESET, SUPPLEMENT)).join(last.hint("merge"), [*group])
    return joined.where(F.struct(*order) >= F.col("_from")).select(*events.columns)


def latest_row(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each group that is last in order (WIN-02, SNK-03): an aggregation, combined before its shuffle."""
    return df.groupBy(*group).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_r")).select("_r.*")


def event_kind(form: Column, is_notice: Column, amendment: Column) -> Column:
    return (
        F.when(is_notice, NOTICE)
        .when(form == "13F-HR", RESET)
        .when((form == "13F-HR/A") & (amendment == "RESTATEMENT"), RESET)
        .when((form == "13F-HR/A") & (amendment == "NEW HOLDINGS"), SUPPLEMENT)
    )


_GROUP, _ORDER = ("cik", "report_period"), ("sort_datetime", "accession_number")
EFFECTIVE_FILING = ["accession_number", "cik", "company_name", "form_type", "report_period", "report_calendar_or_quarter", "filing_manager_name", "is_notice", "is_amendment", "table_entry_total", "table_value_total_usd", "filed_date", "acceptance_datetime"]


def filing_events(filings: DataFrame, thirteenf: DataFrame) -> DataFrame:
    """Filings as events. Tables that grow with the filings are merged: by the size of their compressed files Spark would broadcast them, at many times that size, through the driver."""
    joined = thirteenf.drop("ingest_seq").join(filings.select("accession_number", "cik", "company_name", "form_type", "filed_date", "acceptance_datetime").hint("merge"), "accession_number")
    return joined.withColumns(
        {
            "sort_datetime": F.coalesce("acceptance_datetime", F.col("filed_date").cast("timestamp")),
            "kind": event_kind(F.col("form_type"), F.col("is_notice"), F.col("amendment_type_code")),
        }
    )


def effective_filings(filings: DataFrame, thirteenf: DataFrame) -> DataFrame:
    """Per filer and period at most one filing that holds and one notice; a notice never clears holdings."""
    events = filing_events(filings, thirteenf)
    holding = latest_effective(events.where("NOT is_notice"), _GROUP, _ORDER)
    notice = latest_row(events.where("is_notice"), _GROUP, _ORDER)
    return holding.select(*EFFECTIVE_FILING).unionByName(notice.select(*EFFECTIVE_FILING))


def effective_holdings(filings: DataFrame, thirteenf: DataFrame, holdings: DataFrame) -> DataFrame:
    """Holdings of every filing since the last reset of its filer and period."""
    members = effective_members(filing_events(filings, thirteenf).where("NOT is_notice"), _GROUP, _ORDER)
    return members.select("accession_number", "cik", "company_name", "report_period", "filing_manager_name").hint("merge").join(holdings, "accession_number")
