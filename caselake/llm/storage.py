"""Tables and binary files in the folder that driver and executors share.

Binary files are written and read inside tasks through ``pyarrow.fs``, which
takes the same URIs as Spark (file, hdfs, s3, gs). Every attempt of a task
writes files of its own name; a file counts only when the row that names it is
in a table Spark has committed, so a lost executor or a repeated task leaves at
most an orphan that no reader looks at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from caselake.session import run_dir


def fresh(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses, with its file system spelt out."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{run_dir(spark)}/llm/{name}-{uuid.uuid4().hex}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there."""
    spark = df.sparkSession
    path = fresh(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a table made by ``materialized`` once nothing reads it."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else uri.replace(":/", ":///", 1))


@contextmanager
def writing(folder: str, suffix: str) -> Iterator[tuple[str, object]]:
    """A new binary file in ``folder``: (uri, open stream). The name is unique to this attempt."""
    uri = f"{folder}/{uuid.uuid4().hex}{suffix}"
    system, path = _filesystem(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        yield uri, out


@contextmanager
def reading(uri: str) -> Iterator[object]:
    """A file opened for sequential reading."""
    system, path = _filesystem(uri)
    with system.open_input_stream(path, compression=None, buffer_size=1 << 20) as source:
        yield source


def open_file(uri: str) -> object:
    """A file opened for reads at any place; the caller closes it."""
    system, path = _filesystem(uri)
    return system.open_input_file(path)
