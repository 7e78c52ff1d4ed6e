"""Incremental landing: every file of a drop folder once, then stop.

The stream itself carries file names only; each batch of files is read as what its
files say they are and fitted to the newest version of the source's schema
(``sources.evolution``). A batch has a folder of its own in the landing table, so a batch
that is repeated after a failure replaces itself, and readers can tell batches apart.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from caselake.sources.evolution import SchemaLog, land_files, landed_schema
from caselake.sources.files import infer_schema
from caselake.sources.registry import SourceSpec

FILES_PER_TRIGGER = 1000
#: Column that tells the batches of a landing table apart.
BATCH = "_batch"
SCHEMAS = "_schemas"
#: What Spark's reader of whole files returns.
FILE_ROW = "path string, modificationTime timestamp, length long, content binary"


def landing_schema(spark: SparkSession, spec: SourceSpec, folder: str, schema_path: str, column_types: bool = False) -> T.StructType:
    """Schema of a source: inferred on the first run, kept, and reused after."""
    log = SchemaLog(spark, schema_path)
    return log.read() or log.start(infer_schema(spark, spec.file_format, folder, column_types))


def land(
    spark: SparkSession, spec: SourceSpec, root: str, table: str, state: str, column_types: bool = False, evolve: bool = True
) -> StreamingQuery:
    """Start draining one source folder into its landing table.

    The checkpoint in ``state`` remembers which files were taken, so a rerun
    appends only new ones and a failed run resumes where it stopped. With
    ``evolve`` new columns widen the schema, else they are rescued.
    """
    log = SchemaLog(spark, f"{table}/{SCHEMAS}")

    def take(files: DataFrame, batch: int) -> None:
        paths = sorted(r["path"] for r in files.select("path").collect())  # at most FILES_PER_TRIGGER
        if paths:
            rows = land_files(spark, spec, paths, log, evolve, column_types)
            rows.write.mode("overwrite").parquet(f"{table}/{BATCH}={batch}")

    names = spark.readStream.format("binaryFile").schema(FILE_ROW).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", FILES_PER_TRIGGER)
    return (
        names.load(f"{root}/{spec.subfolder}")
        .select("path")  # contents are not read here
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", f"{state}/{spec.name}/checkpoint")
        .trigger(availableNow=True)
        .queryName(f"land_{spec.name}")
        .start()
    )


def land_all(spark: SparkSession, specs: Iterable[SourceSpec], root: str, tables: str, state: str) -> None:
    """Drain every active source: all streams run side by side, then end."""
    for query in [land(spark, s, root, f"{tables}/{s.name}", state) for s in specs]:
        query.awaitTermination()


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """Landing table in the newest version of its schema; ``_batch`` is the batch a row came with.

    Columns that appeared later are NULL in earlier files. The schema comes from the log,
    so no footers are merged.
    """
    schema = SchemaLog(spark, f"{table}/{SCHEMAS}").read() or T.StructType()
    whole = T.StructType([*landed_schema(schema).fields, T.StructField(BATCH, T.IntegerType())])
    return spark.read.schema(whole).parquet(table)


def write_drops(df: DataFrame, spec: SourceSpec, root: str, stamp: str = "_file_date") -> None:
    """Write rows as a folder of timestamped CSV drops, one per file date.

    The date is part of the folder name of each drop, where the source's file
    pattern finds it.
    """
    name = F.concat(F.lit(f"{spec.name}_"), F.date_format(stamp, spec.date_format), F.lit(".csv"))
    rows = df.select(*spec.business_columns, name.alias("drop"))
    rows.hint("rebalance", F.col("drop")).write.mode("overwrite").partitionBy("drop").csv(
        f"{root}/{spec.subfolder}", header=True, nullValue="", emptyValue='""', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
