"""File-level operators shared by batch and stream: lineage, file dates, rescued values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake.sources.registry import SourceSpec

CORRUPT = "_corrupt_record"


def file_date(path: str | Column, pattern: str, date_format: str = "yyyyMMddHHmmss") -> Column:
    """Timestamp in the file name; NULL when the name does not match."""
    stamp = F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))
    return F.try_to_timestamp(stamp, F.lit(date_format))


def with_lineage(df: DataFrame, spec: SourceSpec, ingested_at: Column | None = None, files: list[str] | None = None) -> DataFrame:
    """Add file path, ingest time and file date.

    With the ``files`` given that ``df`` reads (a trigger's worth), a date is parsed once a file and
    looked up by the rows; rows of any other path parse it themselves.
    """
    path = F.col("_metadata.file_path")
    stamp = (F.current_timestamp() if ingested_at is None else ingested_at).alias("_ingested_at")
    dated = file_date(path, spec.date_pattern, spec.date_format)
    if not files:
        return df.select("*", path.alias("_source_file"), stamp, dated.alias("_file_date"))
    listed = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(f) for f in dict.fromkeys(files)])).alias("_listed"))
    dates = listed.select("_listed", file_date("_listed", spec.date_pattern, spec.date_format).alias("_listed_date"))
    rows = df.select("*", path.alias("_source_file"), stamp).join(F.broadcast(dates), F.col("_source_file") == F.col("_listed"), "left")
    own = file_date("_source_file", spec.date_pattern, spec.date_format)
    date = F.when(F.col("_listed").isNull(), own).otherwise(F.col("_listed_date"))
    return rows.withColumn("_file_date", date).drop("_listed", "_listed_date")


def rescue(df: DataFrame, types: dict[str, str], corrupt: str | None = None) -> DataFrame:
    """Type text columns and keep what does not fit as JSON in ``_rescued_data``.

    ``types`` maps column to Spark type; a value that cannot be cast becomes
    NULL in its column and is kept whole in the JSON object. A malformed line
    (column ``corrupt``) is kept the same way.
    """
    misfit = {
        c: F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.col(c))
        for c, t in types.items()
        if t != "string"
    }
    if corrupt is not None:
        misfit[corrupt] = F.col(corrupt)
    typed = [
        (F.col(c).try_cast(types[c]) if c in types else F.col(c)).alias(c) for c in df.columns if c != corrupt
    ]
    if not misfit:
        return df.select(*typed, F.lit(None).cast("string").alias("_rescued_data"))
    kept = F.to_json(F.struct(*[v.alias(k) for k, v in misfit.items()]))
    bad = F.coalesce(*misfit.values()).isNotNull()
    return df.select(*typed, F.when(bad, kept).alias("_rescued_data"))


def text_schema(columns: list[str] | tuple[str, ...], corrupt: bool = True) -> T.StructType:
    fields = [T.StructField(c, T.StringType()) for c in columns]
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType()))
    return T.StructType(fields)


def infer_schema(spark: SparkSession, file_format: str, path: str, column_types: bool = True) -> T.StructType:
    """Schema of the files now in a folder.

    With ``column_types=False`` only names are taken (a header read, no pass over
    the data), which is what a text landing needs.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if file_format == "csv":
        return reader.csv(path, header=True, inferSchema=column_types).schema
    if file_format == "json":
        return reader.option("primitivesAsString", str(not column_types).lower()).json(path).schema
    return reader.parquet(path).schema


def save_schema(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """Persist a schema as one line of JSON next to the data."""
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    import json

    return T.StructType.fromJson(json.loads(spark.read.text(path, wholetext=True).first()["value"]))


def read_landing(spark: SparkSession, spec: SourceSpec, path: str, ingested_at: Column | None = None) -> DataFrame:
    """Batch read of one source folder with lineage and rescued values."""
    reader = spark.read.option("recursiveFileLookup", "true").schema(text_schema(spec.business_columns))
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("mode", "PERMISSIVE")
    if spec.file_format == "csv":
        raw = reader.option("header", "true").csv(path)
    elif spec.file_format == "json":
        raw = reader.json(path)
    else:
        raw = spark.read.option("recursiveFileLookup", "true").parquet(path)
        return rescue(with_lineage(raw, spec, ingested_at), {})
    types = {c.source: c.spark_type for c in spec.columns if c.source in spec.business_columns}
    return rescue(with_lineage(raw, spec, ingested_at), types, CORRUPT)
