"""Whole-document scans: a folder of text files or a table of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_folder(spark: SparkSession, path: str, glob: str = "*.md") -> DataFrame:
    """One row per file: ``doc_id`` is the file stem, ``text`` the whole file."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .text(path, wholetext=True)
        .select(
            F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1).alias("doc_id"),
            F.col("value").alias("text"),
        )
    )


def scan_document(spark: SparkSession, folder: str, stem: str, suffix: str = ".md") -> DataFrame:
    """One named document."""
    return scan_folder(spark, folder, glob=f"{stem}{suffix}")


def sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Reproducible sample of ``n`` rows (all rows when there are fewer).

    Orders by a seeded hash, so the draw does not depend on partitioning; the
    top-n runs per partition before one merge.
    """
    draw = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(draw, F.col(key)).limit(n)
