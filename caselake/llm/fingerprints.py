"""Document fingerprints: SimHash by votes of weighted term hashes, in built-in functions.

Terms are pairs of neighbouring words, lower-cased; a term's weight is how often
it occurs, since every occurrence votes. Each of the 64 bits is decided by the
sign of its votes: set hashes count +1, others -1.

The votes of 64 bits are kept in eight longs of eight one-byte lanes: up to 127
hashes are summed with a shift, a mask and an addition per long, then the lanes
are added up. Nothing is exploded; a document stays one row.

``within_radius`` finds fingerprints near given ones by permuted block tables: 64
bits are cut into blocks, each table keys on a choice of blocks, and any
fingerprint within the radius agrees in all blocks of at least one choice.

Defined results: null and empty texts have fingerprint 0; equal texts have equal
fingerprints; rows that agree in doc_id and text stand at one place in the order
and so share their next document; a null doc_id is the smallest; a single
document is its own next; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.storage import materialized

SPACE = r"[\x20\x09-\x0D]+"
LANES = 0x0101010101010101
RUN = 127
BLOCKS = 6


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def term_hashes(text: Column) -> Column:
    """Hashes of all pairs of neighbouring words; the last word also stands alone."""
    words = F.filter(F.split(F.lower(text), SPACE), lambda w: w != "")
    singles = F.transform(words, lambda w: F.xxhash64(w))
    return let(singles, lambda h: F.zip_with(h, F.slice(h, F.lit(2), F.greatest(F.size(h), F.lit(1))), lambda a, b: F.xxhash64(a, b)))


def _lanes(hashes: Column, shift: int) -> Column:
    """Sums of every eighth bit, a long of eight lanes per run of hashes."""

    def run(i: Column) -> Column:
        part = F.slice(hashes, i * RUN + 1, F.lit(RUN))
        return F.aggregate(part, F.lit(0).cast("long"), lambda acc, h: acc + F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(LANES)))

    return F.transform(F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / RUN).cast("int")), run)


def _lane(sums: Column, lane: Column) -> Column:
    """Sum of one lane over all runs."""
    byte = F.lit(255).cast("long")
    return F.aggregate(sums, F.lit(0).cast("long"), lambda acc, s: acc + F.call_function("shiftrightunsigned", s, lane * 8).bitwiseAND(byte))


def simhash(text: Column) -> Column:
    """The 64-bit fingerprint of a text as a long."""

    def decide(n: Column, lanes: Column) -> Column:
        def add(fp: Column, bit: Column) -> Column:
            votes = _lane(F.get(lanes, bit % 8), F.floor(bit / 8).cast("int"))
            set_bit = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
            return F.when(votes * 2 > n, fp.bitwiseOR(set_bit)).otherwise(fp)

        return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), add)

    def of(hashes: Column) -> Column:
        return let(F.array(*[_lanes(hashes, k) for k in range(8)]), lambda lanes: decide(F.size(hashes), lanes))

    return let(term_hashes(text), lambda h: F.when(F.size(h) == 0, F.lit(0).cast("long")).otherwise(of(h)))


def likeness(a: Column, b: Column) -> Column:
    """Share of bits two fingerprints have in common."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _same(left: DataFrame, right: DataFrame, doc_id: str, th: str) -> Column:
    """Null-safe equality of the key of ``left`` with columns of ``right``."""
    return left["doc_id"].eqNullSafe(right[doc_id]) & (left["th"] == right[th])


def _order(docs: DataFrame, partitions: int) -> DataFrame:
    """k_id, k_th of each document, with id, hash and length of the previous one and id and hash of the next.

    Keys alone are ranged, and neighbours found inside a range; the first and last
    key of each range, one row per range, link the ranges.
    """
    keys = docs.groupBy("doc_id", "th").agg(F.first("n").alias("n"))
    keys = materialized(keys.repartitionByRange(partitions, "doc_id", "th").withColumn("range", F.spark_partition_id()), "doc-order")
    key = F.struct("doc_id", "th", "n")
    inside = Window.partitionBy("range").orderBy(F.col("doc_id").desc_nulls_last(), F.col("th").desc())
    ends = keys.groupBy("range").agg(F.max(key).alias("top"), F.min(key).alias("bottom"))
    along = Window.orderBy(F.col("range").desc())
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        F.col("range").alias("r"),
        F.coalesce(F.lag("bottom").over(along), F.last("bottom").over(whole)).alias("above"),
        F.coalesce(F.lead("top").over(along), F.first("top").over(whole)).alias("below"),
    )
    near = keys.withColumn("up", F.lag(key).over(inside)).withColumn("down", F.lead(key).over(inside))
    near = near.join(ends, near["range"] == ends["r"]).withColumn("up", F.coalesce("up", "above")).withColumn("down", F.coalesce("down", "below"))
    return near.select(
        F.col("doc_id").alias("k_id"), F.col("th").alias("k_th"), F.col("up.doc_id").alias("up_id"), F.col("up.th").alias("up_th"), F.col("up.n").alias("up_n"),
        F.col("down.doc_id").alias("next_id"), F.col("down.th").alias("next_th"),
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text replaces a document's last third by the start of the next
    document, in descending doc_id, the first after the last. Whole texts are
    shuffled once: both joins below read the same exchange; only what a document
    lends to the one before it travels a second time.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    lengths = rows.select("doc_id", "th", F.length("text").alias("n"))
    order = materialized(_order(lengths, int(spark.conf.get("spark.sql.shuffle.partitions"))), "doc-neighbours")
    ups = order.select("k_id", "k_th", "up_id", "up_th", "up_n")
    lent = rows.join(ups, _same(rows, ups, "k_id", "k_th")).select("up_id", "up_th", F.expr("left(text, up_n div 3)").alias("lent")).dropDuplicates(["up_id", "up_th"])
    edited = F.concat(F.expr("left(text, length(text) - length(text) div 3)"), F.col("lent"))
    made = rows.join(lent, _same(rows, lent, "up_id", "up_th")).select("doc_id", "th", F.length("text").cast("long").alias("n_chars"), "text", edited.alias("edited"))
    made = made.select(
        "doc_id", "th", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        simhash(F.col("text")).alias("fp"), simhash(F.col("edited")).alias("edited_fp"),
    )
    made = materialized(made, "doc-fingerprints")
    following = made.select("doc_id", "th", F.col("fp").alias("next_fp")).distinct()
    nexts = order.select("k_id", "k_th", "next_id", "next_th")
    pairs = following.join(nexts, _same(following, nexts, "next_id", "next_th")).select("k_id", "k_th", "next_fp")
    return made.join(pairs, _same(made, pairs, "k_id", "k_th")).select(
        "doc_id", "n_chars", "edited_sha256", hexadecimal(F.col("fp")).alias("fingerprint"), hexadecimal(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def tables(radius: int, blocks: int = BLOCKS) -> list[int]:
    """Masks of the block tables: all choices of blocks - radius blocks."""
    if not 0 <= radius < blocks:
        raise ValueError("the radius must be below the number of blocks")
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    bits = [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(blocks)]
    masks = [sum(chosen) for chosen in combinations(bits, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def within_radius(asked: DataFrame, every: DataFrame, radius: int = 3, blocks: int = BLOCKS) -> DataFrame:
    """fp, near, distance: for each distinct fp of ``asked`` all distinct fps of ``every`` within ``radius``.

    A pair that agrees in several tables is kept from the first of them only, so no
    pass over all pairs is needed to make them distinct.
    """
    masks = tables(radius, blocks)

    def dealt(df: DataFrame, name: str) -> DataFrame:
        keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])
        return df.select("fp").where(F.col("fp").isNotNull()).distinct().select(F.col("fp").alias(name), F.posexplode(keys).alias("t", "key"))

    apart = F.col("fp").bitwiseXOR(F.col("near"))
    first = F.array_position(F.array(*[apart.bitwiseAND(F.lit(m)) for m in masks]), F.lit(0).cast("long")) - 1
    found = dealt(asked, "fp").join(dealt(every, "near"), ["t", "key"])
    found = found.where((F.bit_count(apart) <= radius) & (first == F.col("t")))
    return found.select("fp", "near", F.bit_count(apart).alias("distance"))
