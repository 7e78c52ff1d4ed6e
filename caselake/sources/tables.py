"""Table scans, parameterised statements and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_table(spark: SparkSession, table: str, limit: int | None = None) -> DataFrame:
    df = spark.table(table)
    return df if limit is None else df.limit(limit)


def query(spark: SparkSession, text: str, params: dict | None = None, **frames: DataFrame) -> DataFrame:
    """SQL with named parameters (``:name``) over tables and given frames (``{name}``)."""
    return spark.sql(text, args=params or None, **frames)


def execute(spark: SparkSession, text: str, params: dict | None = None) -> None:
    """A statement without result."""
    spark.sql(text, args=params or None).collect()


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header; ``single_file`` is for small final results only."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").csv(path, header=True, nullValue="", emptyValue='""')


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "overwrite") -> None:
    """Partitioned parquet with a bounded number of files.

    The rebalance hint groups rows by partition value and lets the adaptive
    planner cut large values into several files, so a dominant value does not
    become one task.
    """
    df.hint("rebalance", *[F.col(c) for c in by]).write.mode(mode).partitionBy(*by).parquet(path)


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Column comments, kept by parquet and by catalog tables."""
    return df.select(
        *[F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c) for c in df.columns]
    )


def save_table(df: DataFrame, name: str, comments: dict[str, str] | None = None, by: list[str] | None = None, path: str | None = None) -> None:
    """Catalog table with comments on columns, rebuilt in full; managed, or with its files at ``path``."""
    writer = with_comments(df, comments or {}).write.mode("overwrite").format("parquet")
    writer = writer.option("path", path) if path else writer
    (writer.partitionBy(*by) if by else writer).saveAsTable(name)
