"""Served queries over the marts: filters, labels, trends, pivots, lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.functions.dates import parse_timestamp
from caselake.operators.filters import choose, optional_filters, selected
from caselake.operators.pivots import pivot_all, pivot_sum
from caselake.operators.quality import valid
from caselake.plans.facts import OTHER_MENTION, PG_MENTION, PTC, TRIAL, current_events
from caselake.plans.dims import latest_cases

# Labels, their order, and the processing-time target.
STATUS_LABELS = ["Open", "Ongoing PG", "Ongoing Trial", "Concluded PG", "Concluded Trial", "Concluded Acquittal"]
ACQUITTED = ("DATA", "DNATA")
TRIAL_SEGMENTS = {OTHER_MENTION: "Non-PG Mentions", PTC: "PTCs", TRIAL: "Trial"}
PG_SEGMENTS = {OTHER_MENTION: "Non-PG Mentions", PG_MENTION: "PG Mentions", PTC: "Other Categories"}
EVENT_TYPE_BY_LEGEND = {
    "Non-PG Mentions": OTHER_MENTION,
    "PG Mentions": PG_MENTION,
    "Other Categories": PTC,
    "PTCs": PTC,
    "Trial": TRIAL,
}
CASE_LIST_COLUMNS = ["CaseID", "Cluster", "DPPName", "CourtEventType", "CourtDateTime", "CourtNo"]
TARGET_DAYS = 70


def mention_year() -> Column:
    return F.date_format("first_mention_date", "yyyy")


def _filtered(mart: DataFrame, clusters: Sequence[str] | None, years: Sequence[str] | None) -> DataFrame:
    return optional_filters(mart, {"officer_cluster": clusters, "year": years}, {"year": mention_year()})


def filter_values(distribution: DataFrame) -> DataFrame:
    """Clusters and years to choose from."""
    return (
        distribution.where(F.col("officer_cluster").isNotNull())
        .select(F.col("officer_cluster").alias("cluster"), mention_year().alias("year"))
        .distinct()
        .orderBy("cluster", "year")
    )


def status_label() -> Column:
    """Display label of a status and case type; NULL for combinations that are not shown."""
    status = F.upper(F.coalesce("case_status", F.lit("")))
    kind = F.upper(F.coalesce("case_type", F.lit("")))
    stage = F.when(status == "PEND", "Ongoing").when(status == "DISP", "Concluded")
    return (
        F.when((status == "PEND") & (kind == "TBD"), "Open")
        .when((status == "DISP") & (kind == "TBD"), F.lit(None).cast("string"))
        .when(stage.isNotNull() & (kind == "PG"), F.concat(stage, F.lit(" PG")))
        .when(stage.isNotNull() & (kind == "TRIAL"), F.concat(stage, F.lit(" Trial")))
        .when(status.isin(*ACQUITTED), "Concluded Acquittal")
        .otherwise(F.trim(F.concat_ws(" ", status, kind)))
    )


def offence_status_counts(distribution: DataFrame, clusters=None, years=None, groups=None) -> DataFrame:
    """Cases per offence group, status and type, shown under the status label."""
    rows = optional_filters(_filtered(distribution, clusters, years), {"offence_group": groups})
    sums = rows.groupBy("offence_group", "case_status", "case_type").agg(F.sum("case_count").alias("case_count"))
    labelled = sums.select(F.col("offence_group").alias("offence_type"), status_label().alias("case_status"), "case_count")
    return labelled.where(F.col("case_status").isNotNull())


def offence_status_yearly(distribution: DataFrame, clusters=None, years=None, groups=None) -> DataFrame:
    """The same by first-mention year; rows without a year or group drop out."""
    rows = optional_filters(_filtered(distribution, clusters, years), {"offence_group": groups})
    labelled = rows.select(
        F.col("offence_group").alias("offence_type"), status_label().alias("case_status"), mention_year().alias("year"), "case_count"
    )
    complete = labelled.where(F.col("case_status").isNotNull() & F.col("year").isNotNull() & F.col("offence_type").isNotNull())
    return complete.groupBy("offence_type", "case_status", "year").agg(F.sum("case_count").alias("case_count"))


def segment(case_type: str) -> Column:
    """Chart segment of an event type; NULL when the chart has none."""
    names = TRIAL_SEGMENTS if case_type == "Trial" else PG_SEGMENTS
    label = F.lit(None).cast("string")
    for stored, shown in names.items():
        label = F.when(F.col("court_event_type") == stored, shown).otherwise(label)
    return label


def stored_event_types(legend: Sequence[str] | None) -> list[str]:
    """Legend names to stored event types; unknown names pass through."""
    return [EVENT_TYPE_BY_LEGEND.get(v, v) for v in selected(legend)]


def hearing_days(
    mart: DataFrame,
    case_type: str,
    metric: str = "Hearing Days",
    clusters=None,
    years=None,
    legend=None,
    groups=None,
    by_year: bool = False,
) -> DataFrame:
    """Hearing Days or Man Days per offence group and segment, optionally by year.

    Hearing Days count an event once, whoever sits in it: the maximum per event
    and type, then the sum. Man Days add up the officers.
    """
    rows = _filtered(mart.where(F.col("case_type") == case_type), clusters, years)
    rows = optional_filters(rows, {"court_event_type": stored_event_types(legend), "offence_group": groups})
    year = {"year": mention_year()} if by_year else {}
    rows = rows.withColumns({"segment": segment(case_type), **year})
    keys = ["offence_group", "segment", *year]
    if metric != "Man Days":
        rows = rows.groupBy(*keys, "court_event_id", "court_event_type").agg(F.max("hearing_days").alias("hearing_days"))
    return rows.groupBy(*keys).agg(F.sum("hearing_days").alias("hearing_days")).orderBy(*keys)


def status_pivot(counts: DataFrame) -> DataFrame:
    """Offence groups x status labels, labels in display order, unexpected ones last, each a column of its own."""
    return pivot_all(counts, ["offence_type"], "case_status", STATUS_LABELS, "case_count")


def yearly_status_pivot(yearly: DataFrame, offence_type: str | None = None) -> DataFrame:
    """Years x status labels, for one offence group or all."""
    rows = yearly if offence_type is None else yearly.where(F.col("offence_type") == offence_type)
    return pivot_sum(rows, ["year"], "case_status", STATUS_LABELS, "case_count").orderBy("year")


def segment_pivot(days: DataFrame, case_type: str, index: str = "offence_group") -> DataFrame:
    """Offence groups (descending) or years (ascending) x segments."""
    names = list((TRIAL_SEGMENTS if case_type == "Trial" else PG_SEGMENTS).values())
    wide = pivot_sum(days, [index], "segment", names, "hearing_days")
    return wide.orderBy(F.desc(index) if index == "offence_group" else F.asc(index))


def workload(mart: DataFrame, by: str, clusters=None) -> DataFrame:
    """Open and closed cases, average processing days against the target, and complexity, per cluster or officer."""
    rows = optional_filters(mart, {"officer_cluster": clusters})
    is_open = F.col("case_status") == "PEND"
    known = F.col("case_processing_days").isNotNull()
    weighted = F.col("case_processing_days") * F.col("case_count")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("case_count"))), F.lit(0))

    def average(condition: Column) -> Column:
        days, cases = F.sum(F.when(condition & known, weighted)), F.sum(F.when(condition & known, F.col("case_count")))
        return days.cast("double") / cases.cast("double")

    out = rows.groupBy(by).agg(
        total(is_open).alias("open_cases"),
        total(~is_open).alias("closed_cases"),
        average(is_open).alias("avg_days_open"),
        average(~is_open).alias("avg_days_closed"),
        total(F.col("case_complexity") == "Simple").alias("simple_cases"),
        total(F.col("case_complexity") == "Complex").alias("complex_cases"),
        F.sum("currently_assigned_count").alias("currently_assigned"),
    )
    return out.withColumn("closed_within_target", F.col("avg_days_closed") <= TARGET_DAYS)


def ongoing_case_list(
    qa_cases: DataFrame,
    officer_fact: DataFrame,
    officers: DataFrame,
    qa_events: DataFrame,
    qa_event_officers: DataFrame,
    columns: Sequence[str] | None = None,
    filters: dict[str, Sequence[str] | None] | None = None,
) -> DataFrame:
    """Pending cases, one row per assigned officer and scheduled event the officer attends; without such an event, one row."""
    pending = latest_cases(qa_cases).where(F.col("case_status") == "PEND").select("case_pid", F.col("case_no").alias("CaseID"))
    assigned = officer_fact.where(F.col("assigned_to_date").isNull()).select("case_pid", "officer_id", "officer_skey")
    who = officers.select("officer_skey", F.col("officer_cluster").alias("Cluster"), F.col("full_name").alias("DPPName"))
    seats = valid(qa_event_officers).select("court_event_id", "officer_id").distinct()
    events = current_events(qa_events).join(seats, "court_event_id").select(
        "case_pid",
        "officer_id",
        F.col("court_event_type").alias("CourtEventType"),
        F.date_format(parse_timestamp("start_datetime"), "yyyy-MM-dd HH:mm:ss").alias("CourtDateTime"),
        F.col("court_number").alias("CourtNo"),
    )
    rows = pending.join(assigned, "case_pid").join(who, "officer_skey", "left").join(events, ["case_pid", "officer_id"], "left")
    return choose(rows.select(*CASE_LIST_COLUMNS), columns, filters)


def court_event_list(qa_events: DataFrame, qa_event_officers: DataFrame, qa_cases: DataFrame, columns=None, filters=None) -> DataFrame:
    """Scheduled court events with their officers."""
    officers = valid(qa_event_officers).select("court_event_id", "officer_name").distinct()
    cases = latest_cases(qa_cases).select("case_pid", "case_no")
    rows = current_events(qa_events).join(officers, "court_event_id", "left").join(cases, "case_pid", "left")
    listed = rows.select(
        F.col("case_no").alias("CaseID"),
        "court_event_id",
        F.col("officer_name").alias("DPPName"),
        F.col("court_event_type").alias("CourtEventType"),
        F.date_format(parse_timestamp("start_datetime"), "yyyy-MM-dd HH:mm:ss").alias("CourtDateTime"),
        F.col("court_number").alias("CourtNo"),
        F.col("court_event_status").alias("Status"),
    )
    return choose(listed, columns, filters)
