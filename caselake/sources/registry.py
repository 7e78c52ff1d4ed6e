"""The control metadata that drives landing and typing.

The registry is control data (one row per source, one per column), so it is
read on the driver; everything it describes stays distributed.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass
from functools import reduce
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake.operators import checks

# Metadata type names and landing formats.
DATA_TYPES = {
    "STRING": "string",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
    "DATETIME": "timestamp",
}
FILE_FORMATS = ("csv", "parquet", "json")
LINEAGE = ("_source_file", "_ingested_at", "_file_date")

SEED_SCHEMAS = {
    "metadata_tables": T.StructType(
        [
            T.StructField("source_name", T.StringType(), False),
            T.StructField("subfolder", T.StringType(), False),
            T.StructField("file_format", T.StringType(), False),
            T.StructField("date_pattern", T.StringType(), False),
            T.StructField("date_format", T.StringType(), True),
            T.StructField("natural_key", T.StringType(), False),
            T.StructField("active", T.BooleanType(), False),
        ]
    ),
    "metadata_columns": T.StructType(
        [
            T.StructField("source_name", T.StringType(), False),
            T.StructField("source_column", T.StringType(), False),
            T.StructField("target_column", T.StringType(), False),
            T.StructField("data_type", T.StringType(), False),
            T.StructField("nullable", T.BooleanType(), False),
            T.StructField("active", T.BooleanType(), False),
        ]
    ),
    "public_holidays": T.StructType(
        [T.StructField("holiday_date", T.DateType(), False), T.StructField("holiday_name", T.StringType(), False)]
    ),
    "court_event_type_mapping": T.StructType(
        [
            T.StructField("court_event_type", T.StringType(), False),
            T.StructField("grouped_court_event_type", T.StringType(), False),
        ]
    ),
}


@dataclass(frozen=True)
class ColumnSpec:
    source: str
    target: str
    spark_type: str
    nullable: bool


@dataclass(frozen=True)
class SourceSpec:
    name: str
    subfolder: str
    file_format: str
    date_pattern: str
    date_format: str
    natural_key: tuple[str, ...]
    columns: tuple[ColumnSpec, ...]

    @property
    def business_columns(self) -> tuple[str, ...]:
        """Columns the file itself carries."""
        return tuple(c.source for c in self.columns if not c.source.startswith("_"))

    @property
    def target_key(self) -> tuple[str, ...]:
        by_source = {c.source: c.target for c in self.columns}
        return tuple(by_source.get(k, k) for k in self.natural_key)


def seed_rows(name: str) -> list[dict[str, str]]:
    """Rows of a packaged seed."""
    text = resources.files("caselake.seeds").joinpath(f"{name}.csv").read_text("utf-8")
    return list(csv.DictReader(line for line in text.splitlines() if not line.startswith("#")))


def seed(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """A lookup table with its declared types, packaged or from ``path``."""
    schema = SEED_SCHEMAS[name]
    if path is not None:
        return spark.read.csv(path, header=True, schema=schema, comment="#", enforceSchema=False)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    rows = [tuple(r[f.name] for f in schema) for r in seed_rows(name)]
    df = spark.createDataFrame(rows, text)
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])


def control_failures(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """control_table, rule, key: every row of the control tables that breaks a rule of theirs.

    Not null and unique names and folders of sources, known formats and types, and columns
    of known sources only. Every row is one failure; a repeated value is one row.
    """
    found = []

    def add(df: DataFrame, table: str, rule: str, key: str) -> None:
        found.append(df.select(F.lit(table).alias("control_table"), F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key")))

    for table, df, key in (("metadata_tables", tables, "source_name"), ("metadata_columns", columns, "source_column")):
        for f in SEED_SCHEMAS[table]:
            if not f.nullable:
                add(checks.not_null(df, f.name), table, f"not_null {f.name}", key)
    for name in ("source_name", "subfolder"):
        add(checks.unique_column(tables, name), "metadata_tables", f"unique {name}", name)
    add(checks.accepted_values(tables, "file_format", list(FILE_FORMATS)), "metadata_tables", "accepted file_format", "file_format")
    add(checks.accepted_values(columns, "data_type", list(DATA_TYPES)), "metadata_columns", "accepted data_type", "data_type")
    add(checks.relationships(columns, "source_name", tables, "source_name"), "metadata_columns", "source of a column", "source_name")
    return reduce(DataFrame.unionByName, found)


def checked(tables: DataFrame, columns: DataFrame) -> None:
    """Refuse control tables with failing rows, before anything is made from them."""
    failures = control_failures(tables, columns).limit(20).collect()
    if failures:
        raise ValueError("control tables: " + "; ".join(f"{r['control_table']}: {r['rule']}: {r['key']}" for r in failures))


def load_registry(
    spark: SparkSession | None = None, tables_path: str | None = None, columns_path: str | None = None
) -> dict[str, SourceSpec]:
    """Active sources by name, from the packaged seeds or from control files."""
    if tables_path is None and columns_path is None:
        tables, columns = seed_rows("metadata_tables"), seed_rows("metadata_columns")
    else:
        given, its_columns = seed(spark, "metadata_tables", tables_path), seed(spark, "metadata_columns", columns_path)
        checked(given, its_columns)
        tables = [r.asDict() for r in given.where("active").collect()]
        columns = [r.asDict() for r in its_columns.where("active").collect()]
    specs = {}
    for t in tables:
        if not _flag(t["active"]):
            continue
        if t["file_format"] not in FILE_FORMATS:
            raise ValueError(f"{t['source_name']}: unsupported file format {t['file_format']}")
        specs[t["source_name"]] = SourceSpec(
            name=t["source_name"],
            subfolder=t["subfolder"],
            file_format=t["file_format"],
            date_pattern=t["date_pattern"],
            date_format=t.get("date_format") or "yyyyMMddHHmmss",
            natural_key=tuple(k.strip() for k in t["natural_key"].split(",")),
            columns=tuple(
                ColumnSpec(c["source_column"], c["target_column"], DATA_TYPES[c["data_type"]], _flag(c["nullable"]))
                for c in columns
                if c["source_name"] == t["source_name"] and _flag(c["active"])
            ),
        )
    return specs


def _flag(value: object) -> bool:
    return str(value).strip().lower() == "true"
