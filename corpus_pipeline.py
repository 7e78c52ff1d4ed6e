"""From raw documents to token files, in five stages.

Each stage takes what the one before kept, applies its decision and returns the
columns of documents; the last returns what the token files hold. ``run`` writes
each stage's result to the shared folder and reads it back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm import decontaminate, mixing, simhash, token_files, toxicity
from caselake.llm.queries import table, tokenizer_path
from caselake.llm.storage import materialized

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _free(name: str, taken: list[str]) -> str:
    """``name``, made longer until no column has it; Spark does not tell cases apart."""
    used = {c.lower() for c in taken}
    while name in used:
        name += "_"
    return name


def _named(names: list[str]) -> list[Column]:
    """Columns by their whole names, dots and all."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the ordinal model does not reject.

    A null or empty text has no marked word and stays, unless the model rejects texts
    without any; repeated rows share their verdict; a null doc_id is scored like any
    other; columns of any name and type are kept; an empty table gives no row.
    """
    names = docs.columns
    verdict = _free("_tox", names)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, into=verdict).where(~F.col(f"{verdict}.toxic")).select(*_named(names))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near duplicates: that with the smallest doc_id.

    Rows are numbered and the table written first, so a row is itself whatever it holds:
    among rows of one doc_id, or without any, that of the smallest text hash stays, of rows
    that agree in both, the first. A group without any doc_id keeps one row. Null and empty
    texts have one fingerprint and are one group. An empty table gives no row.
    """
    names = docs.columns
    row = _free("_row", names)
    numbered = materialized(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = simhash.near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text"), simhash.SHINGLE, simhash.RADIUS)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"), F.col(row).alias("row"))
    rows = numbered.select(F.col(row).alias("doc_id"), order.alias("order"))
    first = groups.join(rows, "doc_id").groupBy("component_id").agg(F.min("order").alias("first")).select(F.col("first.row").alias("kept"))
    kept = numbered.join(first, numbered[row] == first["kept"], "left_semi").select(*_named(names))
    # files do not keep that a list or map holds no null; only rows of such types are given them again
    as_given = [f.dataType for f in kept.schema] == [f.dataType for f in docs.schema]
    return kept if as_given else spark.createDataFrame(kept.rdd, docs.schema, verifySchema=False)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    A null or empty text holds none; rows are judged by their own text, so a null or shared
    doc_id does not carry a verdict over to another text, and repeated rows share theirs;
    other columns are kept as they are; an empty table or benchmark drops nothing.
    """
    found = decontaminate.contaminated_texts(docs, table(spark, sf_dir, "benchmark"))
    found = found.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"))
    same = docs["doc_id"].eqNullSafe(found["_doc"]) & (F.xxhash64(docs["text"]) == found["_key"])
    return docs.join(found, same, "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    A null source is a source of its own; a null or empty text has size 0 and comes as often
    as its place in the order says; repeated rows and rows without doc_id have places of their
    own; columns of any name and type are kept; an empty table gives no row.
    """
    row = F.struct(*_named(docs.columns)).alias("_row")
    sized = docs.select("doc_id", "source", mixing.words(F.col("text")).alias("size"), row)
    taken = mixing.mixed(sized).where(F.col("_copies") > 0)
    return taken.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select("_row.*")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the token files.

    A null text has the end id only; a null doc_id comes first; repeated rows are written as
    often as they occur; an empty table gives no row.
    """
    return token_files.roundtrip(spark, docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", one_of_each),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: A trained model, near duplicates and a tokenizer are beyond SQL; tests compare stages with brute force.
ORACLE_SQL = None


#: Rows handed to a Python worker at once. Stages follow each other in the same executors, so what the largest
#: batch takes on both sides of the pipe stays with them; Spark's 10,000 rows are tens of megabytes of text.
BATCH_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block; the caller's own come back after it."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with _settings(spark, BATCH_ROWS):
        for name, stage in STAGES:
            docs = materialized(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
