"""Gold marts, rebuilt in full from the star schema.

A case has one key and one process id; joins inside a mart go by the id, which is a
fraction of the key's length in a shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.functions.dates import skey_date
from caselake.operators.joins import lookup


def last_event_dates(event_fact: DataFrame, case: str = "case_skey") -> DataFrame:
    """Latest event date per case; grouped on the key number, turned into a date once per case."""
    return (
        event_fact.where(F.col("case_skey").isNotNull())
        .groupBy(case)
        .agg(F.max("court_event_date_skey").alias("_last"))
        .select(case, skey_date("_last").alias("last_court_event_date"))
    )


def officer_names(officers: DataFrame) -> DataFrame:
    return officers.select("officer_skey", F.col("full_name").alias("assigned_officer_name"), "officer_cluster")


def case_officer_workload(officer_fact: DataFrame, event_fact: DataFrame, officers: DataFrame, as_of: dt.date) -> DataFrame:
    """Assignments per officer, status, complexity, first mention and disposition.

    A case has one status, so its disposition date is its last event date when
    that status is DISP: no second pass over the assignments is needed.
    """
    base = officer_fact.select(
        "case_pid", "officer_skey", "case_officer_skey", "assigned_to_date_skey", "first_mention_date_skey", "case_status", "case_complexity"
    )
    rows = lookup(base, last_event_dates(event_fact, "case_pid"), "case_pid")
    rows = lookup(rows, officer_names(officers), "officer_skey", spread="case_officer_skey")
    disposed = F.when(F.col("case_status") == "DISP", F.col("last_court_event_date"))
    grouped = (
        rows.withColumns({"case_disposition_date": disposed, "first_mention_date": skey_date("first_mention_date_skey")})
        .groupBy("assigned_officer_name", "officer_cluster", "case_status", "case_complexity", "first_mention_date", "case_disposition_date")
        .agg(
            F.count(F.lit(1)).alias("case_count"),
            F.count_if(F.col("assigned_to_date_skey").isNull()).alias("currently_assigned_count"),
        )
    )
    end = F.coalesce("case_disposition_date", F.lit(as_of))
    return grouped.withColumn("case_processing_days", F.datediff(end, "first_mention_date"))


def case_groups(charge_fact: DataFrame) -> DataFrame:
    return charge_fact.select("case_skey", "offence_group").distinct()


def case_offence_distribution(charge_fact: DataFrame, cases: DataFrame, officer_fact: DataFrame, event_fact: DataFrame, officers: DataFrame) -> DataFrame:
    """Cases per offence group, status, type, officer cluster and first / last date."""
    attributes = officer_fact.select("case_pid", "case_status", "case_type", "officer_skey", "first_mention_date_skey").distinct()
    # the cluster is what counts, so it is looked up on the distinct assignments
    clusters = officers.select("officer_skey", "officer_cluster")
    attributes = lookup(attributes, clusters, "officer_skey", spread="case_pid").drop("officer_skey")
    rows = (
        charge_fact.select("case_pid", "offence_group")
        .distinct()
        .join(cases.select("case_pid", "case_no"), "case_pid", "left")
        .join(attributes, "case_pid", "left")
        .join(last_event_dates(event_fact, "case_pid"), "case_pid", "left")
    )
    keys = ["case_no", "offence_group", "case_status", "case_type", "officer_cluster", "first_mention_date", "last_court_event_date"]
    return (
        rows.withColumn("first_mention_date", skey_date("first_mention_date_skey"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("case_count"))
    )


def event_offence_hearing_days(event_fact: DataFrame, charge_fact: DataFrame, officer_fact: DataFrame, officers: DataFrame) -> DataFrame:
    """Event x officer x offence group, not aggregated.

    Rows repeat per offence group of the case; that is the grain of the mart.
    Group and type attributes are joined to each other per case first, so the
    event side, which may be skewed, is joined once.
    """
    groups = charge_fact.select("case_pid", "offence_group", "case_status").distinct()
    types = officer_fact.select("case_pid", "case_type", "first_mention_date_skey").distinct()
    # a case may have groups but no assignment, or the other way round
    per_case = groups.join(types, "case_pid", "full_outer")
    events = lookup(
        event_fact.select(
            "event_officer_skey",
            "court_event_id",
            F.when(F.col("case_skey").isNotNull(), F.col("case_pid")).alias("case_pid"),
            "officer_skey",
            "officer_id",
            "court_event_type",
            "court_event_date_skey",
            "court_event_hearing_days",
        ),
        officers.select("officer_skey", "officer_cluster"),
        "officer_skey",
        spread="event_officer_skey",
    )
    return lookup(events, per_case, "case_pid", spread="event_officer_skey").select(
        "court_event_id",
        "offence_group",
        F.when(F.col("officer_skey").isNotNull(), F.col("officer_id")).alias("officer_id"),
        "court_event_type",
        "case_type",
        "case_status",
        "officer_cluster",
        skey_date("first_mention_date_skey").alias("first_mention_date"),
        skey_date("court_event_date_skey").alias("last_court_event_date"),
        F.col("court_event_hearing_days").alias("hearing_days"),
    )
