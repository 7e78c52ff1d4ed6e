"""Optional filters and column choice for served queries."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# The entries that stand for no choice.
NO_CHOICE = frozenset({"All", "All Clusters", "All Years"})


def selected(values: Sequence[str] | None, no_choice: Collection[str] = NO_CHOICE) -> list[str]:
    """Chosen values; empty when nothing or an entry of ``no_choice`` itself is chosen."""
    values = list(values or [])
    return [] if any(v in no_choice for v in values) else values


def optional_filters(df: DataFrame, choices: dict[str, Sequence[str] | None], exprs: dict[str, Column] | None = None) -> DataFrame:
    """Conjunction of IN filters; an empty choice adds no filter."""
    for name, values in choices.items():
        values = selected(values)
        if values:
            df = df.where((exprs or {}).get(name, F.col(name)).isin(values))
    return df


def choose(df: DataFrame, columns: Sequence[str] | None = None, filters: dict[str, Sequence[str] | None] | None = None) -> DataFrame:
    """User-chosen rows and columns."""
    out = optional_filters(df, filters or {})
    return out if not columns else out.select(*columns)
