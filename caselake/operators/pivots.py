"""Fixed-column pivots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_sum(
    df: DataFrame,
    index: list[str],
    column: str,
    values: list[str],
    measure: str,
    other: str | None = None,
) -> DataFrame:
    """Sum of ``measure`` per index and column value, missing cells 0.

    The value list fixes the columns and their order, so no pass over the data
    is needed to find them. Rows with a NULL index or column value drop out;
    ``other`` collects the values outside the list.
    """
    rows = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*index, column]]))

    def cell(condition):
        return F.coalesce(F.sum(F.when(condition, F.col(measure))), F.lit(0))

    cells = [cell(F.col(column) == v).alias(v) for v in values]
    if other is not None:
        cells.append(cell(~F.col(column).isin(*values)).alias(other))
    return rows.groupBy(*index).agg(*cells)


def pivot_all(df: DataFrame, index: list[str], column: str, first: list[str], measure: str) -> DataFrame:
    """As ``pivot_sum`` with a column for every value: known ones first and always, then the rest by name.

    Spark finds the labels in a first small query and refuses an unbounded domain.
    """
    rows = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*index, column]]))
    wide = rows.groupBy(*index).pivot(column).agg(F.sum(measure)).fillna(0)
    labels = [c for c in wide.columns if c not in index]
    kind = rows.agg(F.sum(measure)).schema[0].dataType
    known = [F.col(f"`{v}`") if v in labels else F.lit(0).cast(kind).alias(v) for v in first]
    return wide.select(*index, *known, *[f"`{v}`" for v in sorted(v for v in labels if v not in first)])
