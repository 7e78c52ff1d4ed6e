"""Facts of the star schema.

Surrogate keys are functions of natural keys, so a fact computes a key it needs
and joins only where an attribute or the existence of the other side matters.
The natural keys stay on the facts: later joins reuse them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselake.functions.dates import date_skey, parse_timestamp
from caselake.functions.keys import surrogate_key, total_order
from caselake.functions.text import upper_trim
from caselake.operators.dedup import first_by, latest_by
from caselake.operators.history import observed_history, valid_on
from caselake.operators.joins import lookup
from caselake.operators.quality import valid
from caselake.plans.dims import latest_cases
from caselake.sources.registry import seed

# Court event groups, hearing-day weights, the afternoon start and complexity limits.
TRIAL, PG_MENTION, PTC, OTHER_MENTION = "Trial", "PG Mention", "PTC", "Other Mention"
PTC_WEIGHT = "12.5 / 510.0"
DEFAULT_WEIGHT = "85.0 / 510.0"
TRIAL_HALF_DAY, TRIAL_FULL_DAY = 0.5, 1.0
AFTERNOON_HOUR = 13
UNKNOWN_GROUP = "UNKNOWN"
COMPLEX_CHARGES = 3
WEIGHT_TYPE = "decimal(9,6)"


def event_groups(spark: SparkSession) -> DataFrame:
    """Event type mapping: a fixed list, one row per event type."""
    mapping = seed(spark, "court_event_type_mapping")
    return F.broadcast(mapping.withColumnRenamed("grouped_court_event_type", "event_group"))


def hearing_days(group: Column, start: Column) -> Column:
    """Share of a hearing day an event takes."""
    trial = F.when(F.hour(start) >= AFTERNOON_HOUR, F.lit(TRIAL_HALF_DAY)).otherwise(F.lit(TRIAL_FULL_DAY))
    return (
        F.when(group == PTC, F.expr(PTC_WEIGHT).cast(WEIGHT_TYPE))
        .when(group == TRIAL, trial.cast(WEIGHT_TYPE))
        .otherwise(F.expr(DEFAULT_WEIGHT).cast(WEIGHT_TYPE))
    )


def current_events(qa_events: DataFrame, mode: str = "strict") -> DataFrame:
    """NEW events, one row each.

    strict: the latest delivery of an event decides, so a later VACATED or VOIDED
    delivery removes it, in a rebuild as in a sequence of loads. reference: the
    latest NEW delivery, whatever came after it.
    """
    rows = valid(qa_events)
    is_new = F.col("court_event_status") == "NEW"
    if mode == "reference":
        rows = rows.where(is_new)
    rows = rows.select(
        "court_event_id", "case_pid", "court_event_type", "start_datetime", "court_number", "court_event_status", "_file_date", "_bronze_loaded_at"
    )
    # unique on event, case and file date
    return latest_by(rows, ["court_event_id"], ["_file_date"], then=["case_pid"]).where(is_new)


def current_event_officers(qa_event_officers: DataFrame) -> DataFrame:
    """Officers of an event, one row per pair."""
    return valid(qa_event_officers).select("court_event_id", "officer_id").distinct()


def fact_event_officer(
    qa_events: DataFrame,
    qa_event_officers: DataFrame,
    qa_cases: DataFrame,
    officers: DataFrame,
    mode: str = "strict",
) -> DataFrame:
    """One row per event and officer with its share of a hearing day.

    Both sides are made unique before they meet, so nothing multiplies and no
    dedup follows the joins.
    """
    spark = qa_events.sparkSession
    start = parse_timestamp("start_datetime")
    events = (
        current_events(qa_events, mode)
        .withColumns({"_start": start, "_day": F.to_date(start)})
        .join(event_groups(spark), "court_event_type", "left")
    )
    # md5 text does not compress: the case key is computed behind the joins and not shuffled
    cases = latest_cases(qa_cases).select("case_pid", "case_no", F.lit(True).alias("_known"))
    # officers first: the events already sit by event id
    rows = events.join(current_event_officers(qa_event_officers), "court_event_id").join(cases, "case_pid", "left")
    keyed = with_officer_version(rows, officers, F.col("_day"))
    return keyed.select(
        surrogate_key("court_event_id", "officer_id").alias("event_officer_skey"),
        F.when(F.col("_known"), surrogate_key("case_no", "case_pid")).alias("case_skey"),
        "court_event_id",
        "officer_skey",
        F.col("event_group").alias("court_event_type"),
        date_skey("_day").alias("court_event_date_skey"),
        hearing_days(F.col("event_group"), F.col("_start")).alias("court_event_hearing_days"),
        F.year("_day").alias("court_event_year"),
        "_file_date",
        "_bronze_loaded_at",
        "case_pid",
        "officer_id",
    )


def with_officer_version(rows: DataFrame, officers: DataFrame, day: Column) -> DataFrame:
    """Add the officer version valid on ``day`` (left join, at most one match)."""
    # a handful of versions per officer: one per observed change
    first = F.min("row_start_date").over(Window.partitionBy("officer_id"))
    versions = officers.select(
        F.col("officer_id").alias("_oid"),
        "officer_skey",
        F.col("row_start_date").alias("_from"),
        F.col("row_end_date").alias("_to"),
        (F.col("row_start_date") == first).alias("_is_first"),
    )
    match = (F.col("officer_id") == F.col("_oid")) & valid_on(day, F.col("_from"), F.col("_to"), F.col("_is_first"))
    return rows.join(versions, match, "left").drop("_oid", "_from", "_to", "_is_first")


def voided_events(qa_events: DataFrame) -> DataFrame:
    """Events of a load that are no longer NEW; their fact rows go before the load is written."""
    return valid(qa_events).where(upper_trim("court_event_status") != "NEW").select("court_event_id").distinct()


def charge_victims(qa_entities: DataFrame, persons: DataFrame) -> DataFrame:
    """One victim per charge: latest file, ties by group, relationship and key.

    A victim matches every person of that name and gender; the smallest key wins.
    NULL gender matches nobody.
    """
    by_name = persons.groupBy("full_name", "gender").agg(F.min("person_skey").alias("victim_skey"))
    victims = (
        valid(qa_entities)
        .where(F.col("entity_type") == "Victim")
        .select(
            "case_no",
            "charge_no",
            F.col("entity_name").alias("full_name"),
            F.col("entity_gender").alias("gender"),
            F.col("relationship_to_victim").alias("relation_to_accused"),
            F.coalesce("offence_group", F.lit(UNKNOWN_GROUP)).alias("offence_group"),
            "_file_date",
        )
    )
    named = victims.join(by_name, ["full_name", "gender"], "left")
    order = total_order(["_file_date"], ["offence_group", "relation_to_accused", "victim_skey"])
    return first_by(named, ["case_no", "charge_no"], order).select(
        "case_no", "charge_no", "victim_skey", "relation_to_accused", "offence_group"
    )


def reconciled_cases(qa_cases: DataFrame, qa_charges: DataFrame) -> DataFrame:
    """Live cases with the status their charges imply.

    PEND turns DISP once no charge is pending; in a DISP case no charge counts as
    pending. Charges are pre-aggregated per case, so a case with very many
    charges never sits in one task.
    """
    cases = latest_cases(qa_cases).where(F.col("case_status") != "AMAL")
    pending = (
        valid(qa_charges)
        .groupBy("case_pid")
        .agg(F.bool_or(upper_trim("charge_status") == "PENDING").alias("_pending"))
    )
    done = (F.col("case_status") == "PEND") & ~F.coalesce("_pending", F.lit(False))
    return cases.join(pending, "case_pid").select(
        "case_pid",
        "case_no",
        "case_skey",
        F.col("case_status").alias("_raw_status"),
        F.when(done, "DISP").otherwise(F.col("case_status")).alias("case_status"),
    )


def fact_case_charge(qa_charges: DataFrame, qa_cases: DataFrame, qa_entities: DataFrame, persons: DataFrame) -> DataFrame:
    """One row per case and charge with reconciled statuses and the victim."""
    charges = latest_by(
        valid(qa_charges).select("case_pid", "charge_no", "charge_type", "charge_status", "offence_date", "_file_date", "_bronze_loaded_at"),
        ["case_pid", "charge_no"],
        ["_file_date"],
        then=[],  # unique on case, charge and file date
    )
    rows = charges.join(reconciled_cases(qa_cases, qa_charges), "case_pid").join(
        charge_victims(qa_entities, persons), ["case_no", "charge_no"], "left"
    )
    status = upper_trim("charge_status")
    settled = (F.col("_raw_status") == "DISP") & (status == "PENDING")
    return rows.select(
        surrogate_key("case_pid", "charge_no").alias("case_charge_skey"),
        # md5 text does not compress: computed behind the joins and not shuffled
        surrogate_key("case_no", "case_pid").alias("case_skey"),
        "victim_skey",
        "relation_to_accused",
        "case_status",
        F.when(settled, "SENTENCED").otherwise(status).alias("charge_status"),
        date_skey("offence_date").alias("committed_date_skey"),
        F.col("charge_type").alias("offence_type"),
        F.coalesce("offence_group", F.lit(UNKNOWN_GROUP)).alias("offence_group"),
        "_file_date",
        "_bronze_loaded_at",
        "case_pid",
    )


def assignment_source(qa_assignments: DataFrame) -> DataFrame:
    """Latest assignment per case and officer: what one snapshot run sees."""
    rows = valid(qa_assignments).select("case_pid", "officer_id", "officer_name", "cluster", "team", "_file_date", "_bronze_loaded_at")
    return latest_by(rows, ["case_pid", "officer_id"], ["_file_date"], then=[])


def assignment_history(qa_assignments: DataFrame) -> DataFrame:
    """Assignment intervals from all deliveries, one version per file."""
    rows = valid(qa_assignments).select("case_pid", "officer_id", "officer_name", "cluster", "team", "_file_date", "_bronze_loaded_at")
    return observed_history(rows, ["case_pid", "officer_id"], "_file_date")


def case_events(qa_events: DataFrame) -> DataFrame:
    """Per case: first mention (any status) and case type (NEW events), in one pass."""
    spark = qa_events.sparkSession
    is_new = F.col("court_event_status") == "NEW"
    group = F.col("event_group")
    return (
        valid(qa_events)
        .join(event_groups(spark), "court_event_type", "left")
        .groupBy("case_pid")
        .agg(
            F.min(F.to_date(parse_timestamp("start_datetime"))).alias("first_mention_date"),
            F.coalesce(F.bool_or(is_new), F.lit(False)).alias("_any_new"),
            F.coalesce(F.bool_or(is_new & (group == TRIAL)), F.lit(False)).alias("is_trial"),
            F.coalesce(F.bool_or(is_new & (group == PG_MENTION)), F.lit(False)).alias("_is_pg"),
        )
        .select(
            "case_pid",
            "first_mention_date",
            F.when(F.col("is_trial"), "Trial").when(F.col("_is_pg"), "PG").when(F.col("_any_new"), "TBD").alias("case_type"),
            "is_trial",
        )
    )


def special_cases(qa_entities: DataFrame) -> DataFrame:
    """Cases with at least one special-type entity."""
    return valid(qa_entities).where(F.col("special_type").isNotNull()).select("case_no", F.lit(True).alias("_special")).distinct()


def case_profile(qa_cases: DataFrame, qa_events: DataFrame, qa_entities: DataFrame, charge_fact: DataFrame) -> DataFrame:
    """One row per live case with everything its assignments inherit."""
    cases = latest_cases(qa_cases).where(F.col("case_status") != "AMAL").select("case_pid", "case_no", "case_skey", "case_status")
    counts = charge_fact.groupBy("case_pid").agg(F.count(F.lit(1)).alias("charge_count"))
    rows = cases.join(case_events(qa_events), "case_pid", "left").join(counts, "case_pid", "left")
    rows = lookup(rows, special_cases(qa_entities), "case_no", spread="case_pid")
    is_complex = (
        F.coalesce("_special", F.lit(False))
        | F.coalesce("is_trial", F.lit(False))
        | (F.coalesce("charge_count", F.lit(0)) >= COMPLEX_CHARGES)
    )
    return rows.select(
        "case_pid",
        "case_no",
        "case_skey",
        "case_status",
        "case_type",
        F.when(is_complex, "Complex").otherwise("Simple").alias("case_complexity"),
        "first_mention_date",
        F.coalesce("charge_count", F.lit(0)).alias("charge_count"),
    )


def fact_case_officer(history: DataFrame, profile: DataFrame, officers: DataFrame) -> DataFrame:
    """One row per case, officer and assignment start.

    Assignments without a live case drop out at the end of the written rule, so
    the join to the case profile is an inner join from the start.
    """
    rows = latest_by(
        history.select(
            "case_pid",
            "officer_id",
            F.to_date("valid_from").alias("assigned_from_date"),
            F.to_date("valid_to").alias("assigned_to_date"),
            F.col("updated_at").alias("_officer_snapshot_date"),
            "_file_date",
            "_bronze_loaded_at",
        ),
        ["case_pid", "officer_id", "assigned_from_date"],
        ["_file_date"],
    ).join(profile, "case_pid")
    return with_officer_version(rows, officers, F.col("assigned_from_date")).select(
        surrogate_key("case_pid", "officer_id", "assigned_from_date").alias("case_officer_skey"),
        surrogate_key("case_no", "case_pid").alias("case_skey"),
        "officer_skey",
        date_skey("assigned_from_date").alias("assigned_from_date_skey"),
        date_skey("assigned_to_date").alias("assigned_to_date_skey"),
        date_skey("first_mention_date").alias("first_mention_date_skey"),
        "case_status",
        "case_type",
        "case_complexity",
        F.year("first_mention_date").alias("first_mention_year"),
        "_officer_snapshot_date",
        "_file_date",
        "_bronze_loaded_at",
        "case_pid",
        "officer_id",
        "assigned_from_date",
        "assigned_to_date",
    )


def touched_cases(qa_assignments: DataFrame, qa_events: DataFrame) -> DataFrame:
    """Cases with anything new in either feed (UNION, so each once)."""
    return qa_assignments.select("case_pid").union(qa_events.select("case_pid")).distinct()
