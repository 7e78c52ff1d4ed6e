"""Dimensions of the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.functions.dates import CALENDAR_END, CALENDAR_START, date_skey
from caselake.functions.keys import surrogate_key
from caselake.operators.dedup import latest_by
from caselake.operators.history import observed_versions
from caselake.operators.joins import sentinel_join
from caselake.operators.quality import valid
from caselake.sources.registry import seed

TRACKED_OFFICER = ["full_name", "officer_cluster", "officer_team"]


def dim_date(spark: SparkSession, holidays: DataFrame | None = None) -> DataFrame:
    """One row per day; a workday is Monday to Friday and no public holiday."""
    holidays = holidays if holidays is not None else seed(spark, "public_holidays")
    day = F.col("full_date")
    spine = spark.range(1).select(F.explode(F.sequence(F.lit(CALENDAR_START), F.lit(CALENDAR_END))).alias("full_date"))
    off = holidays.select(F.col("holiday_date").alias("full_date"), F.lit(True).alias("_holiday")).distinct()
    # the holiday seed is a fixed list of a few rows per year
    return spine.join(F.broadcast(off), "full_date", "left").select(
        date_skey(day).alias("date_skey"),
        day,
        F.day(day).alias("day"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.date_format(day, "EEE").alias("day_of_week"),
        (F.weekday(day).between(0, 4) & F.col("_holiday").isNull()).alias("is_workday"),
        F.date_format(day, "yyyy-MM").alias("reporting_month"),
    )


def people(qa_cases: DataFrame, qa_entities: DataFrame) -> DataFrame:
    """Accused of valid cases and extracted people of valid entities (no birth date known)."""
    accused = valid(qa_cases).select(
        F.col("accused_name").alias("full_name"),
        F.col("accused_gender").alias("gender"),
        F.col("accused_dob").alias("date_of_birth"),
        "_file_date",
        "_bronze_loaded_at",
    )
    extracted = valid(qa_entities).select(
        F.col("entity_name").alias("full_name"),
        F.col("entity_gender").alias("gender"),
        F.lit(None).cast("date").alias("date_of_birth"),
        "_file_date",
        "_bronze_loaded_at",
    )
    return accused.unionByName(extracted)


def dim_person(qa_cases: DataFrame, qa_entities: DataFrame, mode: str = "strict") -> DataFrame:
    """One row per person: the latest file date (strict) or one per file date (reference)."""
    identity = ["full_name", "gender", "date_of_birth"]
    rows = people(qa_cases, qa_entities)
    if mode == "strict":
        # grouping is the distinct; both maxima aggregate before the shuffle
        rows = rows.groupBy(*identity).agg(
            F.max("_file_date").alias("_file_date"), F.max("_bronze_loaded_at").alias("_bronze_loaded_at")
        )
    else:
        rows = rows.distinct()
    return rows.select(surrogate_key(*identity).alias("person_skey"), *identity, "_file_date", "_bronze_loaded_at")


def latest_cases(qa_cases: DataFrame) -> DataFrame:
    """Latest valid row per case process.

    The quality table is unique on case and file date, so the file date alone is
    a total order; naming no other column lets the scan skip what a consumer does
    not read.
    """
    rows = valid(qa_cases).select(
        "case_pid",
        "case_no",
        "case_title",
        "directorate",
        "case_status",
        "accused_name",
        "accused_gender",
        "accused_dob",
        "_file_date",
        "_bronze_loaded_at",
    )
    return latest_by(rows, ["case_pid"], ["_file_date"], then=[]).withColumn("case_skey", surrogate_key("case_no", "case_pid"))


def dim_case(qa_cases: DataFrame, persons: DataFrame | None = None, mode: str = "strict") -> DataFrame:
    """Cases with the key of their accused.

    strict: one row per case process, and the accused key computed from the
    case's own name, gender and birth date. Every such person is in the person
    dimension by construction, so the largest join of the schema is not needed.
    reference: distinct rows per file date, joined to ``persons`` with NULL equal
    to the sentinel.
    """
    if mode == "strict":
        return latest_cases(qa_cases).select(
            "case_skey",
            surrogate_key("accused_name", "accused_gender", "accused_dob").alias("accused_skey"),
            "case_no",
            "case_pid",
            "case_title",
            "directorate",
            "_file_date",
            "_bronze_loaded_at",
        )
    cases = (
        valid(qa_cases)
        .select("case_pid", "accused_name", "accused_gender", "accused_dob", "case_no", "case_title", "directorate", "_file_date", "_bronze_loaded_at")
        .distinct()
    )
    who = persons.select("person_skey", "full_name", "gender", "date_of_birth").distinct()
    joined = sentinel_join(
        cases, who, {"accused_name": "full_name", "accused_gender": "gender"}, {"accused_dob": "date_of_birth"}
    )
    return joined.select(
        surrogate_key("case_no", "case_pid").alias("case_skey"),
        F.col("person_skey").alias("accused_skey"),
        "case_no",
        "case_pid",
        "case_title",
        "directorate",
        "_file_date",
        "_bronze_loaded_at",
    ).distinct()


def officer_feed(qa_assignments: DataFrame) -> DataFrame:
    """Officer attributes as the assignment feed states them."""
    return valid(qa_assignments).select(
        "officer_id",
        F.col("officer_name").alias("full_name"),
        F.col("cluster").alias("officer_cluster"),
        F.col("team").alias("officer_team"),
        "_file_date",
    )


def with_officer_key(versions: DataFrame) -> DataFrame:
    return versions.select(
        surrogate_key("officer_id", "row_start_date").alias("officer_skey"),
        "officer_id",
        *TRACKED_OFFICER,
        "row_start_date",
        "row_end_date",
        "_file_date",
    )


def dim_officer(qa_assignments: DataFrame) -> DataFrame:
    """Officer versions: a new one whenever name, cluster or team changed."""
    return with_officer_key(observed_versions(officer_feed(qa_assignments), "officer_id", TRACKED_OFFICER, "_file_date"))


def officer_batch(qa_assignments: DataFrame) -> DataFrame:
    """One row per officer of an incremental load (its latest file)."""
    return latest_by(officer_feed(qa_assignments), ["officer_id"], ["_file_date"])


def officers_as_first_loaded(qa_assignments: DataFrame, as_of: dt.date) -> DataFrame:
    """The officer rows of a first run as written: one per distinct row and file date, all starting at the run date."""
    rows = officer_feed(qa_assignments).distinct()
    return with_officer_key(
        rows.withColumns({"row_start_date": F.lit(as_of), "row_end_date": F.lit(None).cast("date")})
    )
