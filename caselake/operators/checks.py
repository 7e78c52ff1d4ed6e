"""Data tests. Each returns the failing rows; an empty result passes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, columns: list[str], count_as: str = "cnt") -> DataFrame:
    """Keys that occur more than once (NULL is a value here, as in GROUP BY)."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(count_as)).where(F.col(count_as) > 1)


def unique_column(df: DataFrame, column: str) -> DataFrame:
    """Column-level uniqueness ignores NULLs."""
    return unique(df.where(F.col(column).isNotNull()), [column])


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child values without a parent; NULL references pass."""
    missing = child.where(F.col(column).isNotNull())
    keys = parent.select(F.col(field).alias("_parent_key"))
    return missing.join(keys, F.col(column) == F.col("_parent_key"), "left_anti")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list with their counts; NULL passes."""
    return df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))


def passes(failing: DataFrame) -> bool:
    return failing.isEmpty()
