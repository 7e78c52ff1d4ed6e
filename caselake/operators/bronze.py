"""Landing to bronze: dedup, reject reason, rename and cast, all from metadata."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.operators.dedup import latest_by
from caselake.operators.watermark import newer_than
from caselake.sources.registry import LINEAGE, SourceSpec


def typed_columns(spec: SourceSpec) -> list[Column]:
    """Rename-and-cast list; lineage columns pass through untouched."""
    return [
        (F.col(c.source) if c.spark_type == "string" else F.col(c.source).try_cast(c.spark_type)).alias(c.target)
        for c in spec.columns
        if c.source not in LINEAGE
    ]


def reject_reason(spec: SourceSpec) -> Column:
    """First failing presence check: key columns in key order, then mandatory columns."""
    mandatory = [c.source for c in spec.columns if not c.nullable and c.source not in LINEAGE]
    checks = list(dict.fromkeys([*spec.natural_key, *mandatory]))
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"missing_{c}")) for c in checks])


def to_bronze(
    landing: DataFrame,
    spec: SourceSpec,
    since: dt.datetime | None = None,
    loaded_at: Column | None = None,
) -> DataFrame:
    """Typed bronze rows, one per natural key and file date; rejected rows stay, marked."""
    fresh = newer_than(landing, "_ingested_at", since)
    latest = latest_by(fresh, [*spec.natural_key, "_file_date"], ["_ingested_at"])
    return latest.select(
        *typed_columns(spec),
        "_source_file",
        "_file_date",
        reject_reason(spec).alias("_rejected_reason"),
        "_ingested_at",
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("_bronze_loaded_at"),
    )
