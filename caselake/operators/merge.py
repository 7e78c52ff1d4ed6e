"""Upserts and deletes by key, as DataFrames; checked appends; MERGE for catalogs that have it.

Plain parquet has no MERGE: the new content is the rows of the target that the
source does not replace, plus the source. Tables that are replaced this way lie
behind a manifest (``versioned``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target with ``source`` merged in. ``source`` must be unique on ``keys``.

    Keys compare NULL-safe, so that a repeated load of a NULL key replaces
    itself instead of piling up.
    """
    return minus_keys(target, source, keys).unionByName(source)


def minus_keys(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is not in ``source``."""
    return target.join(_renamed(source, keys), _same(keys), "left_anti")


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_src_{k}") for k in keys])


def _same(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_src_{k}")) for k in keys])


def append_checked(df: DataFrame, path: str, by: list[str]) -> None:
    """Append to a partitioned table; refuses a changed schema."""
    spark = df.sparkSession
    if path_exists(spark, path):
        have = {f.name: f.dataType for f in spark.read.parquet(path).schema}
        new = {f.name: f.dataType for f in df.schema}
        drift = {n for n in have.keys() | new.keys() if n not in by and have.get(n) != new.get(n)}
        if drift or have.keys() != new.keys():
            raise ValueError(f"schema changed on append: {sorted(drift or (have.keys() ^ new.keys()))}")
    _write_by(df, by).mode("append").partitionBy(*by).parquet(path)


def _write_by(df: DataFrame, by: list[str]):
    return df.hint("rebalance", *[F.col(c) for c in by]).write


def merge_into(spark: SparkSession, table: str, source: DataFrame, keys: list[str]) -> None:
    """Real MERGE, for catalogs whose tables support it."""
    on = " AND ".join(f"t.{k} <=> s.{k}" for k in keys)
    source.createOrReplaceTempView("_caselake_merge_source")
    spark.sql(
        f"MERGE INTO {table} t USING _caselake_merge_source s ON {on} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the folders v000001, v000002, ... whose write has committed."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[1:]) for n in names if n.startswith("v") and path_exists(spark, f"{path}/{n}/_SUCCESS"))
