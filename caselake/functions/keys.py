"""Surrogate keys and total orders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and NULL marker of the md5 surrogate key.
KEY_SEPARATOR = "-"
KEY_NULL = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: str | Column) -> Column:
    """32-hex md5 over the natural-key columns, NULL-safe."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(KEY_NULL)) for c in columns]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def total_order(newest_first: list[str], then: list[str]) -> list[Column]:
    """Newest rows first; ties fall to the remaining columns, NULLs last."""
    return [F.desc_nulls_last(c) for c in newest_first] + [F.asc_nulls_last(c) for c in then]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
