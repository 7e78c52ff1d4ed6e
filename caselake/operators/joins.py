"""Join shapes used by the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sentinels that make NULL equal to the default.
TEXT_SENTINEL = ""
DATE_SENTINEL = "1900-01-01"


def lookup(left: DataFrame, right: DataFrame, key: str, spread: str | None = None) -> DataFrame:
    """Left equi-join to a table that is unique on ``key``.

    Rows whose key is NULL match nothing but would all hash to one partition;
    with ``spread`` they are dealt out over that column instead.
    """
    if spread is None:
        return left.join(right, key, "left")
    dealt = F.coalesce(F.col(key), F.concat(F.lit("null:"), F.col(spread).cast("string")))
    joined = left.withColumn("_join_key", dealt).join(
        right.withColumnRenamed(key, "_join_right"), F.col("_join_key") == F.col("_join_right"), "left"
    )
    return joined.drop("_join_key", "_join_right")


def sentinel_join(left: DataFrame, right: DataFrame, text: dict[str, str], dates: dict[str, str]) -> DataFrame:
    """Left join on several columns where NULL equals the sentinel on both sides.

    Written as equality of coalesced values, so it stays a hash or merge join.
    """
    pairs = [
        F.coalesce(left[a], F.lit(TEXT_SENTINEL)) == F.coalesce(right[b], F.lit(TEXT_SENTINEL)) for a, b in text.items()
    ] + [
        F.coalesce(left[a], F.lit(DATE_SENTINEL).cast("date")) == F.coalesce(right[b], F.lit(DATE_SENTINEL).cast("date"))
        for a, b in dates.items()
    ]
    condition = pairs[0]
    for p in pairs[1:]:
        condition = condition & p
    return left.join(right, condition, "left")


def touched(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(keys, on, "left_semi")
