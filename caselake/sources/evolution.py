"""Schemas that change from file to file: a log of versions, and files read as what they are.

A text file says what its columns are called, a parquet file also what type they have. New
files are therefore grouped by what they say (CSV by header line, parquet by schema; JSON
says it row by row), each group is read as it is, and all are fitted to the newest version
of the source's schema. A column the schema does not know either widens it (a new version,
written before the data) or goes, name and value, into ``_rescued_data``. The type of a known
column never changes: a value that does not fit is rescued as well. Nothing is lost or shifted.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake.operators.merge import committed_versions
from caselake.sources.files import CORRUPT, load_schema, save_schema, text_schema, with_lineage
from caselake.sources.registry import LINEAGE, SourceSpec

RESCUED = "_rescued_data"
RESERVED = frozenset((*LINEAGE, RESCUED, CORRUPT, "_record", "_metadata", "_batch"))
#: Files whose headers are read at the same time.
OPEN_FILES = 16


class SchemaLog:
    """Versions of one source's schema in a folder, a line of JSON each; the newest counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def versions(self) -> list[int]:
        return committed_versions(self.spark, self.path)

    def read(self, version: int | None = None) -> T.StructType | None:
        versions = self.versions()
        if not versions:
            return None
        return load_schema(self.spark, f"{self.path}/v{version or versions[-1]:06d}")

    def start(self, schema: T.StructType) -> T.StructType:
        """The newest version; ``schema`` becomes the first one where there is none."""
        known = self.read()
        return known if known is not None else self._write(schema, 1)

    def widen(self, found: T.StructType) -> T.StructType:
        """The newest version with the columns of ``found`` it does not know, behind the others. Names are compared without case."""
        known = self.read()
        if known is None:
            return self._write(found, 1)
        names = {f.name.lower() for f in known}
        new = [f for f in found if f.name.lower() not in names]
        return self._write(T.StructType([*known.fields, *new]), self.versions()[-1] + 1) if new else known

    def _write(self, schema: T.StructType, version: int) -> T.StructType:
        save_schema(self.spark, schema, f"{self.path}/v{version:06d}")
        return schema


def _free_name(name: str, taken: set[str], place: int) -> str:
    """A column's name; an empty or repeated one is called by its place, one that landing uses itself gets a mark."""
    if not name or name.lower() in taken:
        return f"_c{place}"
    return f"{name}_" if name.lower() in RESERVED else name


def header_names(line: str) -> list[str]:
    """Column names of a header line."""
    names: list[str] = []
    for i, cell in enumerate(next(csv.reader([line.lstrip("\ufeff")]), [])):
        names.append(_free_name(cell.strip(), {n.lower() for n in names}, i))
    return names


def first_line(spark: SparkSession, file: str) -> str | None:
    """A file's first line, through Spark's own file systems and codecs; no more than a buffer is read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream if codec is None else codec.createInputStream(stream), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def headers(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """CSV files by their header: a line of each file, of as many files as a trigger takes. Empty files have none."""
    grouped: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(OPEN_FILES) as pool:
        for file, line in zip(files, pool.map(lambda f: first_line(spark, f), files)):
            if line is not None:
                grouped.setdefault(tuple(header_names(line)), []).append(file)
    return {names: found for names, found in grouped.items() if names}


def like_schemas(spark: SparkSession, files: list[str]) -> Iterator[tuple[T.StructType, list[str]]]:
    """Parquet files in groups whose schemas merge. Footers are read by tasks; a conflict halves the group."""
    try:
        yield spark.read.option("mergeSchema", "true").parquet(*files).schema, files
    except (PySparkException, Py4JJavaError):  # schemas that do not merge come as either, by where Spark notices
        if len(files) == 1:
            raise
        half = len(files) // 2
        yield from like_schemas(spark, files[:half])
        yield from like_schemas(spark, files[half:])


@dataclass
class Group:
    """Files that read alike: their rows with lineage, their own columns, and values to be rescued in any case."""

    rows: DataFrame
    own: T.StructType
    files: list[str]
    extra: list[tuple[str, Column]] = field(default_factory=list)


def read_groups(spark: SparkSession, spec: SourceSpec, files: list[str]) -> list[Group]:
    """Groups of files as they are. Text formats come as text, with malformed lines in ``CORRUPT``."""
    if spec.file_format == "csv":
        groups = []
        for names, found in headers(spark, files).items():
            reader = spark.read.schema(text_schema(list(names))).option("header", "true").option("columnNameOfCorruptRecord", CORRUPT)
            groups.append(Group(with_lineage(reader.csv(found), spec, files=found), _texts(names), found))
        return groups
    if spec.file_format == "json":
        texts, record = spark.read.text(files).where("trim(value) <> ''"), F.from_json("value", "map<string,string>")
        lines = with_lineage(texts, spec, files=files)
        rows = lines.select(record.alias("_record"), F.when(record.isNull(), F.col("value")).alias(CORRUPT), *LINEAGE)
        spellings: dict[str, list[str]] = {}
        shapes = texts.select(F.map_keys(record).alias("names")).distinct()  # records mostly name the same columns
        for r in shapes.select(F.explode("names").alias("name")).distinct().orderBy("name").collect():  # a row per column
            spellings.setdefault(r["name"].lower(), []).append(r["name"])
        columns, extra = {}, []
        for i, found in enumerate(spellings.values()):
            values = [F.try_element_at("_record", F.lit(n)) for n in found]
            columns[_free_name(found[0], {c.lower() for c in columns}, i)] = F.coalesce(*values)
            # a record that spells one name in two ways keeps the first, and the second in what is rescued
            extra += [(n, F.when(F.coalesce(*values[:k]).isNotNull(), v)) for k, (n, v) in enumerate(zip(found, values)) if k]
        kept = rows.select(*[c.alias(n) for n, c in columns.items()], "_record", CORRUPT, *LINEAGE)
        return [Group(kept, _texts(columns), files, extra)]
    groups = []
    for schema, found in like_schemas(spark, files):
        names: list[str] = []
        for i, f in enumerate(schema):
            names.append(_free_name(f.name, {n.lower() for n in names}, i))
        rows = spark.read.schema(schema).parquet(*found)
        given = rows.select(*[F.col(f"`{f.name}`").alias(n) for f, n in zip(schema, names)], "_metadata")
        groups.append(Group(with_lineage(given, spec, files=found).drop("_metadata"), T.StructType([T.StructField(n, f.dataType) for f, n in zip(schema, names)]), found))
    return groups


def _texts(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def inferred(spark: SparkSession, spec: SourceSpec, group: Group) -> T.StructType:
    """A text group's columns with the types its values suggest: one pass over its files, done where new columns come."""
    reader = spark.read.option("header", "true").option("inferSchema", "true")
    seen = reader.csv(group.files).schema if spec.file_format == "csv" else spark.read.json(group.files).schema
    by_name = {f.name.lower(): f.dataType for f in seen}
    types = [f.dataType for f in seen] if spec.file_format == "csv" else [by_name.get(f.name.lower(), T.StringType()) for f in group.own]
    return T.StructType([T.StructField(f.name, t if _castable(t, t) else T.StringType()) for f, t in zip(group.own, types)])


def fitted(group: Group, schema: T.StructType) -> DataFrame:
    """A group's rows with the columns of ``schema``, lineage and ``_rescued_data``.

    Rescued are, as one JSON object by name: values that cannot be cast to their column's
    type, values of columns the schema does not know, and malformed lines.
    """
    mine = {f.name.lower(): f for f in group.own}
    columns, rescued = [], []
    for f in schema:
        held = mine.pop(f.name.lower(), None)
        if held is None:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value = F.col(f"`{held.name}`")
        if held.dataType == f.dataType:
            columns.append(value.alias(f.name))
            continue
        cast = value.try_cast(f.dataType) if _castable(held.dataType, f.dataType) else F.lit(None).cast(f.dataType)
        columns.append(cast.alias(f.name))
        rescued.append((f.name, F.when(value.isNotNull() & cast.isNull(), value)))
    rescued += [(f.name, F.col(f"`{f.name}`")) for f in mine.values()]
    rescued += group.extra
    if CORRUPT in group.rows.columns:
        rescued.append((CORRUPT, F.col(CORRUPT)))
    return group.rows.select(*columns, *LINEAGE, _as_json(rescued).alias(RESCUED))


def _as_json(values: list[tuple[str, Column]]) -> Column:
    """JSON object of the values that are not null; NULL where all are."""
    if not values:
        return F.lit(None).cast("string")
    any_kept = reduce(lambda a, b: a | b, [v.isNotNull() for _, v in values])
    return F.when(any_kept, F.to_json(F.struct(*[v.alias(n) for n, v in values])))


def _castable(held: T.DataType, wanted: T.DataType) -> bool:
    return not any(isinstance(t, (T.StructType, T.ArrayType, T.MapType, T.BinaryType)) for t in (held, wanted))


def land_files(spark: SparkSession, spec: SourceSpec, files: list[str], log: SchemaLog, evolve: bool = True, column_types: bool = False) -> DataFrame:
    """The rows of some files of a source, fitted to its schema, which they widen if ``evolve``."""
    groups = read_groups(spark, spec, files)
    found: list[T.StructField] = []
    known = {f.name.lower() for f in log.read() or ()}
    for group in groups:
        new = {f.name.lower() for f in group.own} - known
        own = inferred(spark, spec, group) if new and column_types and spec.file_format != "parquet" else group.own
        found += [f for f in own if f.name.lower() in new]
        known |= new
    schema = log.widen(T.StructType(found)) if evolve else log.start(T.StructType(found))
    rows = [fitted(group, schema) for group in groups]
    return reduce(DataFrame.unionByName, rows) if rows else spark.createDataFrame([], landed_schema(schema))


def landed_schema(schema: T.StructType) -> T.StructType:
    """A source's columns with those that landing adds."""
    added = [("_source_file", T.StringType()), ("_ingested_at", T.TimestampType()), ("_file_date", T.TimestampType()), (RESCUED, T.StringType())]
    return T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in added]])
