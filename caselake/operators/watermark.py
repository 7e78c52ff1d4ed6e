"""High-water marks for incremental reads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.functions.dates import EPOCH_WATERMARK


def high_water_mark(target: DataFrame, column: str) -> dt.datetime:
    """Largest load time in the target; 1900-01-01 when it is empty.

    One aggregated row comes back, so that the later filter is a literal the
    scan can use to skip files.
    """
    return target.agg(F.max(column).alias("m")).first()["m"] or EPOCH_WATERMARK


def newer_than(df: DataFrame, column: str, mark: dt.datetime | Column | None) -> DataFrame:
    """Rows loaded after the mark; all rows when there is no mark."""
    if mark is None:
        return df
    if isinstance(mark, dt.datetime):
        # compare in the column's own type, else the filter cannot be pushed down
        mark = F.lit(mark.isoformat(sep=" ")).cast(df.schema[column].dataType)
    return df.where(F.col(column) > mark)
