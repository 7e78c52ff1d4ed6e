"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``target / source size`` times. Along a
fixed order the expectations are summed; with one random offset per source, a
document is emitted once for every integer its sum passes. Documents are ordered
by size class, then by a hash of their id, so each size takes its share.

The order is cut into (source, size class, hash) chunks: counts of chunks are
summed per source, positions inside a chunk by a window, so a source with a third
of all rows is spread over many tasks. The table of sources has one row each and
is ranked in one task.

Targets: sources in code point order, null last, weigh 1, 2, 3 and so on again,
and share the total; a target stops at ``MOST`` times its source's size and the
rest is shared anew by weight, which a single pass over the sources in order of
that limit per weight solves.

Defined results: a null text has size 0; a null source is a source; repeated rows
take places of their own; sources of size 0 have target 0 and take nothing; an
empty table gives no row. Reruns agree: offsets and order are hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.storage import materialized

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _size_class(size: Column) -> Column:
    """Sizes that agree in length and first three binary digits."""
    digits = F.bin(size)
    return F.concat(F.lpad(F.length(digits).cast("string"), 2, "0"), F.substring(digits, 1, 3))


def _unit(text: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sources: DataFrame) -> DataFrame:
    """source, source_size -> also target. One row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("_weight", ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("double"))
    limit = F.lit(MOST) * F.col("source_size")
    order = Window.orderBy((limit / F.col("_weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    weight_left = F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    level = ranked.withColumn("_level", left / weight_left).withColumn("_limit", limit.cast("double"))
    # the level that holds is that of the first source whose limit it doesn't exceed
    holds = F.when(F.col("_limit") >= F.col("_level") * F.col("_weight"), F.col("_level"))
    final = F.first(holds, ignorenulls=True).over(whole)
    # rounding must not leave a target above its limit or all sources without a level
    return level.withColumn("target", F.least("_limit", F.coalesce(final * F.col("_weight"), F.col("_limit")))).select("source", "source_size", "target")


def mixed(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``docs`` (doc_id, source, size and others) with _source_size, _target and _copies."""
    rows = docs.withColumn("_class", _size_class(F.col("size"))).withColumn("_key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = rows.withColumn("_chunk", F.substring("_key", 1, 2))
    chunks = materialized(
        rows.groupBy("source", "_class", "_chunk").agg(F.count(F.lit(1)).alias("_cnt"), F.sum("size").alias("_size")), "mix-chunks"
    )
    rates = targets(chunks.groupBy("source").agg(F.sum("_size").alias("source_size")))
    running = Window.partitionBy("source").orderBy("_class", "_chunk").rowsBetween(Window.unboundedPreceding, -1)
    placed = chunks.withColumn("_before", F.coalesce(F.sum("_cnt").over(running), F.lit(0)))
    placed = placed.join(rates.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("source").alias("_s"), F.col("_class").alias("_c"), F.col("_chunk").alias("_h"), "_before", F.col("source_size").alias("_source_size"), F.col("target").alias("_target")
    )
    inside = Window.partitionBy("source", "_class", "_chunk").orderBy("_key", "doc_id", "size")
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("_class") == F.col("_c")) & (F.col("_chunk") == F.col("_h"))
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(0.0)
    offset = _unit(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))))
    place = F.col("_before") + F.col("_place")
    copies = F.floor(offset + rate * place) - F.floor(offset + rate * (place - 1))
    return (
        rows.withColumn("_place", F.row_number().over(inside))
        .join(placed, same)
        .withColumn("_copies", F.least(copies, F.lit(MOST)).cast("long"))
        .drop("_class", "_key", "_chunk", "_place", "_s", "_c", "_h", "_before")
    )


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    sized = materialized(docs.select(F.col("doc_id").cast("long"), "source", words(F.col("text")).alias("size")), "mix-sizes")
    return mixed(sized, seed).select(
        "doc_id", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_copies") * F.col("size")).alias("taken")
    )


#: The same in SQL. The order, the offsets and the targets are those of the functions above.
SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM {{table}}
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY lpad(length(bin(size))::VARCHAR, 2, '0') || substr(bin(size), 1, 3),
    substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 2), md5(coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST, size) AS place
  FROM sized
), weighed AS (
  SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, {MOST} * source_size::DOUBLE AS most,
    (sum(source_size) OVER () - coalesce(sum({MOST} * source_size) OVER before, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level,
    row_number() OVER (ORDER BY {MOST} * source_size / weight, source NULLS LAST) AS nth
  FROM weighed WINDOW before AS (ORDER BY {MOST} * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), rates AS (
  SELECT source, source_size, least(most, coalesce((SELECT arg_min(level, nth) FROM levels WHERE most >= level * weight) * weight, most)) AS target FROM levels
), copied AS (
  SELECT doc_id, size, source_size, target, place, p.source,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
    ('0x' || substr(md5('{SEED}:' || coalesce('s' || p.source, 'n')), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS shift
  FROM placed p JOIN rates r ON p.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target,
  (least(floor(shift + rate * place) - floor(shift + rate * (place - 1)), {MOST}) * size)::BIGINT AS taken
FROM copied
"""
