"""Latest-row-per-key with a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.functions.keys import total_order


def latest_by(df: DataFrame, keys: list[str], newest: list[str], then: list[str] | None = None) -> DataFrame:
    """Keep one row per key: newest first, ties by every other column.

    ``row_number() = 1`` makes Spark cut each key to one row per map task before
    the shuffle, so a key holding a large share of the rows does not travel
    whole to one task.
    """
    if then is None:
        then = [c for c in df.columns if c not in keys and c not in newest]
    return first_by(df, keys, total_order(newest, then))


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    ranked = df.withColumn("_row_num", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_row_num") == 1).drop("_row_num")
