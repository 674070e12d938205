"""Identities, position rollups and period changes (VIW-03 to VIW-05, SRT-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MONEY = "decimal(38,2)"
POSITION_KEY = ["cik", "security_reference_key", "put_call_key", "shares_principal_type_key"]


def filer_identities(filers: DataFrame, filings: DataFrame, thirteenf: DataFrame) -> DataFrame:
    """Canonical name and sorted aliases per filer; aliases are empty, not null, where there are none."""
    own = filings.where(F.col("filing_family") == "13F").select("cik", "accession_number", "company_name")
    named = own.join(thirteenf.select("accession_number", "filing_manager_name").hint("merge"), "accession_number", "left")
    aliases = named.groupBy("cik").agg(F.min("company_name").alias("least_name"), F.sort_array(F.collect_set("company_name")).alias("company_name_aliases"), F.sort_array(F.collect_set("filing_manager_name")).alias("filing_manager_aliases"))
    none = F.array().cast("array<string>")
    return filers.join(aliases.hint("merge"), "cik", "left").select(
        "cik",
        F.coalesce(F.nullif(F.col("filer_name"), F.lit("")), "least_name").alias("canonical_filer_name"),
        "first_seen_filed_date",
        "last_seen_filed_date",
        F.coalesce("company_name_aliases", none).alias("company_name_aliases"),
        F.coalesce("filing_manager_aliases", none).alias("filing_manager_aliases"),
    )


def rollup(df: DataFrame, keys: Sequence[Column | str], sums: dict[str, Column], firsts: dict[str, Column] | None = None, count: str = "source_row_count") -> DataFrame:
    """Sums with null as zero, greatest values and a row count per key: one aggregation, combined before its shuffle (AGG-01)."""
    return df.groupBy(*keys).agg(*(F.max(c).alias(n) for n, c in (firsts or {}).items()), *(F.sum(F.coalesce(c, F.lit(0))).cast(MONEY).alias(n) for n, c in sums.items()), F.count("*").alias(count))


def filer_positions(effective: DataFrame, identities: DataFrame, securities: DataFrame) -> DataFrame:
    """Effective holdings summed per period, filer, security, option kind and amount kind."""
    lines = effective.select("report_period", "cik", "filing_manager_name", "company_name", "security_reference_key", F.coalesce("put_call", F.lit("NONE")).alias("put_call_key"), F.coalesce("shares_principal_type", F.lit("UNKNOWN")).alias("shares_principal_type_key"), "value_usd", "value_reported", "shares_principal_amount")
    # Rolled up before the joins: names depend on the filer and the security alone.
    summed = rollup(
        lines,
        ["report_period", *POSITION_KEY],
        {"total_value_usd": F.col("value_usd"), "total_value_reported": F.col("value_reported"), "total_shares_principal_amount": F.col("shares_principal_amount")},
        {"_manager": F.col("filing_manager_name"), "_company": F.col("company_name")},
    )
    named = summed.join(identities.select("cik", "canonical_filer_name"), "cik", "left").join(securities.select("security_reference_key", "issuer_name", "class_title", "cusip", "figi").hint("merge"), "security_reference_key")
    return named.select(
        "report_period",
        "cik",
        F.coalesce("canonical_filer_name", "_manager", "_company").alias("canonical_filer_name"),
        "security_reference_key",
        "issuer_name",
        "class_title",
        "cusip",
        "figi",
        "put_call_key",
        "shares_principal_type_key",
        "total_value_usd",
        "total_value_reported",
        "total_shares_principal_amount",
        "source_row_count",
    )


def with_previous(df: DataFrame, key: Sequence[str], period: str, values: dict[str, str], previous_period: str) -> DataFrame:
    """The period held before, and each value's previous amount and change; the first has previous amounts of zero (WIN-05)."""
    held = Window.partitionBy(*key).orderBy(period)
    out = df.withColumn(previous_period, F.lag(period).over(held))
    for value, name in values.items():
        before = F.coalesce(F.lag(value).over(held), F.lit(0)).cast(MONEY)
        out = out.withColumn(f"previous_{name}", before).withColumn(f"delta_{name}", (F.col(value) - F.col(f"previous_{name}")).cast(MONEY))
    return out


def position_changes(positions: DataFrame) -> DataFrame:
    moved = with_previous(positions, POSITION_KEY, "report_period", {"total_value_usd": "value_usd", "total_shares_principal_amount": "shares_principal_amount"}, "previous_report_period")
    return moved.select(
        "report_period",
        "previous_report_period",
        "cik",
        "canonical_filer_name",
        "security_reference_key",
        "issuer_name",
        "class_title",
        "cusip",
        "figi",
        "put_call_key",
        "shares_principal_type_key",
        F.col("total_value_usd").alias("current_value_usd"),
        "previous_value_usd",
        "delta_value_usd",
        F.col("total_shares_principal_amount").alias("current_shares_principal_amount"),
        "previous_shares_principal_amount",
        "delta_shares_principal_amount",
    )


def top(df: DataFrame, where: Column, by: Column, n: int, ties: Sequence[str]) -> DataFrame:
    """The n rows of greatest `by`, ties in order of key columns (SRT-01 to SRT-06)."""
    return df.where(where).orderBy(by, *ties).limit(n)


def after_key(df: DataFrame, key: str, after, n: int) -> DataFrame:
    """Keyset pagination: the next n rows by key (SRT-07)."""
    return df.where(F.col(key) > F.lit(after)).orderBy(key).limit(n)


def report_summaries(reports: DataFrame, filings: DataFrame, tickers: DataFrame) -> DataFrame:
    """Report and filing metadata with tickers; a company without tickers has null, not an empty list (VIW-07)."""
    symbols = tickers.groupBy("cik").agg(F.min("ticker").alias("ticker"), F.sort_array(F.collect_set("ticker")).alias("tickers"))
    columns = ["accession_number", "cik", "company_name", "form_type", "filed_date", "period_of_report", "acceptance_datetime", "submission_url", "filing_directory_url", "primary_document_filename"]
    joined = reports.drop("ingest_seq").join(filings.select(*columns), "accession_number").join(symbols, "cik", "left")
    return joined.select(
        "accession_number",
        "cik",
        "company_name",
        "ticker",
        F.when(F.size("tickers") > 0, F.col("tickers")).alias("tickers"),
        "form_type",
        "filed_date",
        F.coalesce("report_period", "period_of_report").alias("report_period"),
        "acceptance_datetime",
        "submission_url",
        "filing_directory_url",
        "primary_document_filename",
        "fiscal_year",
        "fiscal_period",
        "is_amendment",
        "primary_document_title",
        "section_count",
        "chunk_count",
        "xbrl_fact_count",
    )
