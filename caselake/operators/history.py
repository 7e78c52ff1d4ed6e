"""Versioned history: snapshots of keyed rows and versioned dimensions."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.operators.dedup import latest_by


def observed_history(df: DataFrame, keys: list[str], updated_at: str) -> DataFrame:
    """Interval rows from a feed that holds one row per key and load.

    A version is valid until the next load that carries the key. Equal to
    replaying ``snapshot_step`` load by load. The window holds at most one row
    per load of a key, so its size follows the number of loads, not the data.
    """
    upcoming = F.lead(updated_at).over(Window.partitionBy(*keys).orderBy(updated_at))
    return df.withColumns(
        {"valid_from": F.col(updated_at), "valid_to": upcoming, "updated_at": F.col(updated_at)}
    )


def snapshot_step(
    history: DataFrame,
    source: DataFrame,
    keys: list[str],
    updated_at: str,
    as_of: Column | dt.datetime,
    close_missing: bool = True,
) -> DataFrame:
    """One snapshot run over the open rows.

    new key -> open row; newer ``updated_at`` -> close the old row and open a
    new one; key gone from the source -> close it at ``as_of``.
    """
    now = as_of if isinstance(as_of, Column) else F.lit(as_of).cast(source.schema[updated_at].dataType)
    payload = [c for c in source.columns if c not in keys]
    is_open = F.col("valid_to").isNull()
    closed = history.where(~is_open)
    paired = (
        history.where(is_open)
        .withColumn("_known", F.lit(True))
        .select(*keys, F.struct(*[c for c in history.columns if c not in keys], "_known").alias("old"))
        .join(source.select(*keys, F.struct(*payload, F.lit(True).alias("_seen")).alias("new")), keys, "full_outer")
    )
    seen, known = F.col("new._seen").isNotNull(), F.col("old._known").isNotNull()
    changed = seen & known & (F.col(f"new.{updated_at}") > F.col("old.updated_at"))
    gone = known & ~seen if close_missing else F.lit(False)
    end = F.when(changed, F.col(f"new.{updated_at}")).when(gone, now).otherwise(F.col("old.valid_to"))
    names = [c for c in history.columns if c not in keys]
    old_rows = paired.where(known).select(*keys, *[(end if c == "valid_to" else F.col(f"old.{c}")).alias(c) for c in names])
    stamp = {
        "valid_from": F.col(f"new.{updated_at}"),
        "updated_at": F.col(f"new.{updated_at}"),
        "valid_to": F.lit(None).cast(history.schema["valid_to"].dataType),
    }
    new_rows = paired.where(seen & (changed | ~known)).select(
        *keys, *[(stamp[c] if c in stamp else F.col(f"new.{c}")).alias(c) for c in names]
    )
    return closed.unionByName(old_rows).unionByName(new_rows)


def empty_history(source: DataFrame, updated_at: str) -> DataFrame:
    """History before the first run."""
    stamp = source.schema[updated_at].dataType
    return source.where(F.lit(False)).withColumns(
        {"valid_from": F.col(updated_at), "valid_to": F.lit(None).cast(stamp), "updated_at": F.col(updated_at)}
    )


def observed_versions(df: DataFrame, key: str, tracked: list[str], seen_on: str) -> DataFrame:
    """Versions of a dimension from everything observed so far.

    Collapses the feed to one row per key and day before the window (partial
    aggregation does most of it ahead of the shuffle), keeps the days on which a
    tracked column changed, and closes each version the day before the next.
    """
    daily = latest_by(
        df.select(key, *tracked, "_file_date", F.to_date(seen_on).alias("_seen")).distinct(), [key, "_seen"], ["_file_date"]
    )
    by_day = Window.partitionBy(key).orderBy("_seen")
    state = F.struct(*tracked)
    changed = F.lag(state).over(by_day).isNull() | ~F.lag(state).over(by_day).eqNullSafe(state)
    marked = daily.withColumn("_start", F.when(changed, F.col("_seen"))).withColumn(
        "row_start_date", F.max("_start").over(by_day)
    )
    versions = marked.groupBy(key, "row_start_date").agg(
        *[F.max_by(c, "_seen").alias(c) for c in tracked], F.max("_file_date").alias("_file_date")
    )
    return versions.withColumn(
        "row_end_date",
        F.date_sub(F.lead("row_start_date").over(Window.partitionBy(key).orderBy("row_start_date")), 1),
    )


def version_step(existing: DataFrame, batch: DataFrame, key: str, tracked: list[str], as_of: dt.date) -> DataFrame:
    """One incremental run of a versioned dimension.

    ``batch`` holds one row per key. Unchanged keys keep their open version,
    changed keys get it closed the day before ``as_of`` and a new one opened.
    """
    is_open = F.col("row_end_date").isNull()
    extra = [c for c in batch.columns if c != key and c not in tracked]
    open_rows = existing.where(is_open)
    incoming = batch.select(key, F.struct(*tracked, *extra, F.lit(True).alias("_seen")).alias("new"))
    joined = open_rows.withColumn("_known", F.lit(True)).join(incoming, key, "full_outer")
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"new.{c}")) for c in tracked])
    known, seen = F.col("_known").isNotNull(), F.col("new._seen").isNotNull()
    today = F.lit(as_of)
    changed = known & seen & differs
    kept = joined.where(known).select(
        key,
        *tracked,
        *[F.when(seen & ~differs, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) for c in extra],
        "row_start_date",
        F.when(changed, F.date_sub(today, 1)).alias("row_end_date"),
    )
    opened = joined.where(seen & (~known | differs)).select(
        key,
        *[F.col(f"new.{c}").alias(c) for c in [*tracked, *extra]],
        today.alias("row_start_date"),
        F.lit(None).cast("date").alias("row_end_date"),
    )
    columns = [key, *tracked, *extra, "row_start_date", "row_end_date"]
    closed = existing.where(~is_open).select(*columns)
    return closed.unionByName(kept).unionByName(opened)


def valid_on(day: Column, start: Column, end: Column, first: Column) -> Column:
    """Interval test for a version: the first version also covers earlier days, an unknown day takes the open one."""
    when = F.coalesce(day, F.lit(dt.date(9999, 12, 31)))
    return (first | (when >= start)) & (end.isNull() | (when <= end))
