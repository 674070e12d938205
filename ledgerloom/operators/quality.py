"""Constraint checks that Parquet does not enforce: keys, references, required values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, columns: Sequence[str], parent: DataFrame, key: Sequence[str]) -> DataFrame:
    """Child rows that refer to no parent; null references are allowed."""
    names = parent.select(*(F.col(k).alias(f"_{k}") for k in key))
    match = [F.col(c) == F.col(f"_{k}") for c, k in zip(columns, key, strict=True)]
    present = child.where(F.expr(" AND ".join(f"{c} IS NOT NULL" for c in columns)))
    return present.join(names, match, "left_anti")


def missing_values(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row: how many rows lack each required column."""
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in required))
