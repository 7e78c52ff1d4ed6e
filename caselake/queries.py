"""Every registered query: (spark, folder of parquet tables) -> DataFrame.

Load stamps are left out of the results and decimals shown as doubles; all the
rest is what the library returns over the whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake.operators import checks
from caselake.operators.bronze import to_bronze
from caselake.operators.dedup import latest_by
from caselake.operators.history import observed_versions, snapshot_step, version_step
from caselake.operators.joins import touched
from caselake.operators.merge import append_checked, minus_keys, upsert
from caselake.operators.quality import CHARGE_TYPES, KEYS, to_quality, valid
from caselake.operators.watermark import high_water_mark
from caselake.plans import dims, facts, marts, reports, serve
from caselake.plans.comments import COMMENTS
from caselake.plans.nightly import SOURCES_AT_ONCE, Nightly
from caselake.plans.pipeline import SOURCES, CaseLake
from caselake.session import run_dir, side_by_side
from caselake.sources import tables
from caselake.sources.documents import sample
from caselake.sources.files import file_date, rescue
from caselake.sources.fixtures import Landing
from caselake.sources.registry import FILE_FORMATS, SourceSpec, control_failures, seed
from caselake.streaming import landing as stream

AS_OF = dt.date(2026, 1, 1)
# Point between "already loaded" and "new" for the incremental queries.
CUT = dt.datetime(1999, 1, 1)
STAMPS = ("_bronze_loaded_at", "_silver_qa_loaded_at", "_silver_loaded_at")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def lake(spark: SparkSession, folder: str) -> CaseLake:
    """The lake over a folder; changed input files give it a namespace of its own."""
    return CaseLake(spark, Landing(spark, folder), AS_OF, namespace=f"{folder}|{fingerprint(spark, folder)}")


def fingerprint(spark: SparkSession, folder: str) -> str:
    """Names, sizes and times of the input files (a directory listing, no data)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return str(sorted(found))


def register(name: str):
    def keep(fn: Callable[[CaseLake], DataFrame]) -> Callable[[CaseLake], DataFrame]:
        QUERIES[name] = lambda spark, folder: presented(fn(lake(spark, folder)))
        return fn

    return keep


def presented(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`")
            for f in df.schema
            if f.name not in STAMPS
        ]
    )


def _built(table: str) -> None:
    register(table)(lambda c: c.build(table))


for _source in SOURCES:
    _built(f"bronze_{_source}")
    _built(f"qa_{_source}")
for _table in (
    "dim_person dim_officer dim_case assignment_history fact_event_officer fact_case_charge fact_case_officer "
    "case_officer_workload case_offence_distribution event_offence_hearing_days report_fields"
).split():
    _built(_table)


def _cut(df: DataFrame, after: bool, column: str = "_ingested_at") -> DataFrame:
    mark = F.lit(CUT.isoformat(sep=" ")).cast("timestamp_ntz")
    return df.where(F.col(column) >= mark if after else F.col(column) < mark)


# --- bronze and quality -------------------------------------------------------


@register("reject_reason_counts")
def reject_reason_counts(c: CaseLake) -> DataFrame:
    parts = [c.build(f"bronze_{s}").select(F.lit(s).alias("source"), "_rejected_reason") for s in SOURCES]
    return reduce(DataFrame.unionByName, parts).groupBy("source", "_rejected_reason").agg(F.count(F.lit(1)).alias("cnt"))


@register("incremental_charges")
def incremental_charges(c: CaseLake) -> DataFrame:
    loaded = _cut(c.landing("charges"), after=False)
    return to_bronze(c.landing("charges"), c.registry["charges"], since=high_water_mark(loaded, "_ingested_at"))


@register("qa_cases_reference")
def qa_cases_reference(c: CaseLake) -> DataFrame:
    return to_quality(c.build("bronze_cases"), "cases", c.as_of, mode="reference").drop("is_clean_row")


# --- dimensions and history ---------------------------------------------------


@register("dim_person_reference")
def dim_person_reference(c: CaseLake) -> DataFrame:
    return dims.dim_person(c.table("qa_cases"), c.table("qa_entities"), mode="reference")


@register("dim_case_reference")
def dim_case_reference(c: CaseLake) -> DataFrame:
    return dims.dim_case(c.table("qa_cases"), c.table("dim_person"), mode="reference")


@register("dim_officer_first_load")
def dim_officer_first_load(c: CaseLake) -> DataFrame:
    return dims.officers_as_first_loaded(c.table("qa_assignments"), c.as_of)


@register("dim_date")
def dim_date(c: CaseLake) -> DataFrame:
    """The calendar with the events and orders of each day, summed per day before the join."""
    days = c.build("dim_date")
    for table, column, name in (("events", "ts", "events"), ("orders", "o_orderdate", "orders")):
        counts = c.landing.base(table).groupBy(F.to_date(column).alias("full_date")).agg(F.count(F.lit(1)).alias(name))
        days = days.join(counts, "full_date", "left").fillna(0, [name])
    return days


@register("workday_activity")
def workday_activity(c: CaseLake) -> DataFrame:
    """Events per reporting month, on workdays and other days."""
    days = c.build("dim_date").select("full_date", "reporting_month", "is_workday")
    events = c.landing.base("events").groupBy(F.to_date("ts").alias("full_date")).agg(F.count(F.lit(1)).alias("n"))
    return events.join(days, "full_date").groupBy("reporting_month", "is_workday").agg(F.sum("n").alias("events"))


@register("people_union")
def people_union(c: CaseLake) -> DataFrame:
    return dims.people(c.table("qa_cases"), c.table("qa_entities")).select("full_name", "gender", "date_of_birth").distinct()


@register("officer_history")
def officer_history(c: CaseLake) -> DataFrame:
    """Versions known before the cut, then one incremental run with everything after it."""
    feed = dims.officer_feed(c.table("qa_assignments"))
    before = observed_versions(_cut(feed, False, "_file_date"), "officer_id", dims.TRACKED_OFFICER, "_file_date")
    batch = latest_by(_cut(feed, True, "_file_date"), ["officer_id"], ["_file_date"])
    return dims.with_officer_key(version_step(before, batch, "officer_id", dims.TRACKED_OFFICER, c.as_of))


@register("assignment_snapshot")
def assignment_snapshot(c: CaseLake) -> DataFrame:
    """One snapshot run on the history before the cut; keys the new deliveries lack are closed."""
    qa = c.table("qa_assignments")
    history = facts.assignment_history(_cut(qa, False, "_file_date")).drop("_bronze_loaded_at")
    source = facts.assignment_source(_cut(qa, True, "_file_date")).drop("_bronze_loaded_at")
    as_of = F.lit(c.as_of).cast("timestamp_ntz")
    return snapshot_step(history, source, ["case_pid", "officer_id"], "_file_date", as_of)


@register("latest_assignment")
def latest_assignment(c: CaseLake) -> DataFrame:
    return facts.assignment_source(c.table("qa_assignments"))


@register("latest_charge")
def latest_charge(c: CaseLake) -> DataFrame:
    rows = valid(c.table("qa_charges")).select("case_pid", "charge_no", "charge_type", "charge_status", "offence_date", "_file_date")
    return latest_by(rows, ["case_pid", "charge_no"], ["_file_date"])


# --- facts and their parts ----------------------------------------------------


@register("fact_event_officer_reference")
def fact_event_officer_reference(c: CaseLake) -> DataFrame:
    return facts.fact_event_officer(
        c.table("qa_events"), c.table("qa_event_officers"), c.table("qa_cases"), c.table("dim_officer"), mode="reference"
    )


@register("case_type")
def case_type(c: CaseLake) -> DataFrame:
    return facts.case_events(c.table("qa_events")).where(F.col("case_type").isNotNull()).select("case_pid", "case_type", "is_trial")


@register("first_mention")
def first_mention(c: CaseLake) -> DataFrame:
    return facts.case_events(c.table("qa_events")).select("case_pid", "first_mention_date")


@register("case_complexity")
def case_complexity(c: CaseLake) -> DataFrame:
    return c.build("case_profile").select("case_pid", "case_complexity", "charge_count")


@register("case_status_reconciled")
def case_status_reconciled(c: CaseLake) -> DataFrame:
    return facts.reconciled_cases(c.table("qa_cases"), c.table("qa_charges")).select("case_pid", "case_status")


@register("case_status_max")
def case_status_max(c: CaseLake) -> DataFrame:
    """Largest status per directorate with a conditional count."""
    return (
        valid(c.table("qa_cases"))
        .groupBy("directorate")
        .agg(F.max("case_status").alias("max_status"), F.count_if(F.col("case_status") == "PEND").alias("pending"), F.count(F.lit(1)).alias("cnt"))
    )


@register("distinct_case_group")
def distinct_case_group(c: CaseLake) -> DataFrame:
    return marts.case_groups(c.table("fact_case_charge"))


@register("first_last_event")
def first_last_event(c: CaseLake) -> DataFrame:
    return marts.last_event_dates(c.table("fact_event_officer"))


@register("officer_current_count")
def officer_current_count(c: CaseLake) -> DataFrame:
    return c.table("fact_case_officer").groupBy("officer_id").agg(
        F.count(F.lit(1)).alias("case_count"), F.count_if(F.col("assigned_to_date_skey").isNull()).alias("currently_assigned_count")
    )


@register("touched_cases")
def touched_cases(c: CaseLake) -> DataFrame:
    return facts.touched_cases(_cut(c.table("qa_assignments"), True), _cut(c.table("qa_events"), True))


# --- write strategies ---------------------------------------------------------


@register("upsert_charges")
def upsert_charges(c: CaseLake) -> DataFrame:
    """A first load, then an incremental one past its watermark, merged by key."""
    landed, spec = c.landing("charges"), c.registry["charges"]
    first = _cut(landed, after=False)
    mark = high_water_mark(first, "_ingested_at")
    target = to_quality(to_bronze(first, spec, loaded_at=c.loaded_at), "charges", c.as_of, loaded_at=c.loaded_at)
    source = to_quality(to_bronze(landed, spec, since=mark, loaded_at=c.loaded_at), "charges", c.as_of, loaded_at=c.loaded_at)
    return upsert(target, source, KEYS["charges"])


@register("delete_voided_events")
def delete_voided_events(c: CaseLake) -> DataFrame:
    """The fact of the first delivery, minus events the second one no longer has as NEW."""

    def delivery(file: str) -> DataFrame:
        landed = c.landing("events").where(F.col("_source_file") == file)
        return to_quality(to_bronze(landed, c.registry["events"], loaded_at=c.loaded_at), "events", c.as_of)

    fact = facts.fact_event_officer(delivery("events_0.csv"), c.table("qa_event_officers"), c.table("qa_cases"), c.table("dim_officer"))
    return minus_keys(fact, facts.voided_events(delivery("events_1.csv")), ["court_event_id"])


@register("recompute_touched_cases")
def recompute_touched_cases(c: CaseLake) -> DataFrame:
    """The officer fact before the cut with every touched case recomputed whole."""
    qa, profile, officers = c.table("qa_assignments"), c.table("case_profile"), c.table("dim_officer")
    before = facts.fact_case_officer(facts.assignment_history(_cut(qa, False, "_file_date")), profile, officers)
    changed = facts.touched_cases(_cut(qa, True, "_file_date"), _cut(c.table("qa_events"), True))
    again = facts.fact_case_officer(touched(facts.assignment_history(qa), changed, "case_pid"), profile, officers)
    return upsert(before, again, ["case_officer_skey"])


# --- served queries -----------------------------------------------------------


def _distribution(c: CaseLake) -> DataFrame:
    return c.table("case_offence_distribution")


def _both_types(c: CaseLake, **options) -> DataFrame:
    mart = c.table("event_offence_hearing_days")
    parts = [serve.hearing_days(mart, t, **options).withColumn("case_type", F.lit(t)) for t in ("PG", "Trial")]
    return parts[0].unionByName(parts[1])


register("filter_values")(lambda c: serve.filter_values(_distribution(c)))
register("offence_status_counts")(lambda c: serve.offence_status_counts(_distribution(c)))
register("offence_status_filtered")(
    lambda c: serve.offence_status_counts(_distribution(c), clusters=["ASIA", "EUROPE", "All Saints"], years=["2024"], groups=["Hurt", "UNKNOWN"])
)
register("offence_status_yearly")(lambda c: serve.offence_status_yearly(_distribution(c)))
register("offence_status_pivot")(lambda c: serve.status_pivot(serve.offence_status_counts(_distribution(c))))
register("yearly_status_pivot")(lambda c: serve.yearly_status_pivot(serve.offence_status_yearly(_distribution(c))))
register("hearing_days")(lambda c: _both_types(c))
register("man_days")(lambda c: _both_types(c, metric="Man Days"))
register("hearing_days_yearly")(lambda c: _both_types(c, by_year=True))
register("man_days_yearly")(lambda c: _both_types(c, metric="Man Days", by_year=True))
register("hearing_days_filtered")(
    lambda c: _both_types(c, clusters=["ASIA", "AFRICA"], years=["All Years"], legend=["PTCs", "Trial", "Non-PG Mentions"])
)
register("segment_pivot")(lambda c: serve.segment_pivot(serve.hearing_days(c.table("event_offence_hearing_days"), "PG"), "PG"))
register("segment_pivot_trial")(lambda c: serve.segment_pivot(serve.hearing_days(c.table("event_offence_hearing_days"), "Trial"), "Trial"))
register("segment_pivot_yearly")(
    lambda c: serve.segment_pivot(serve.hearing_days(c.table("event_offence_hearing_days"), "PG", by_year=True), "PG", index="year")
)
register("workload_by_cluster")(lambda c: serve.workload(c.table("case_officer_workload"), "officer_cluster"))
register("workload_by_officer")(lambda c: serve.workload(c.table("case_officer_workload"), "assigned_officer_name"))


def _ongoing(c: CaseLake, **options) -> DataFrame:
    return serve.ongoing_case_list(c.table("qa_cases"), c.table("fact_case_officer"), c.table("dim_officer"), c.table("qa_events"), c.table("qa_event_officers"), **options)


register("ongoing_case_list")(lambda c: _ongoing(c))
register("ongoing_case_choice")(lambda c: _ongoing(c, columns=["CaseID", "DPPName", "CourtDateTime"], filters={"Cluster": ["ASIA"], "CourtNo": ["All"]}))
register("court_event_list")(lambda c: serve.court_event_list(c.table("qa_events"), c.table("qa_event_officers"), c.table("qa_cases")))


@register("status_yearly_sum")
def status_yearly_sum(c: CaseLake) -> DataFrame:
    yearly = serve.offence_status_yearly(_distribution(c))
    return yearly.groupBy("case_status", "year").agg(F.sum("case_count").alias("case_count"))


@register("parameterised_query")
def parameterised_query(c: CaseLake) -> DataFrame:
    text = (
        "SELECT officer_cluster, case_status, sum(case_count) AS case_count FROM {mart} "
        "WHERE officer_cluster IN (:first, :second) AND case_status <> :skipped GROUP BY officer_cluster, case_status ORDER BY 1, 2"
    )
    return tables.query(c.spark, text, {"first": "ASIA", "second": "EUROPE", "skipped": "DNATA"}, mart=_distribution(c))


@register("table_limit")
def table_limit(c: CaseLake) -> DataFrame:
    """The first 25 rows of the workload mart in a total order."""
    mart = c.table("case_officer_workload")
    keys = ["assigned_officer_name", "officer_cluster", "case_status", "case_complexity", "first_mention_date", "case_disposition_date"]
    return mart.orderBy(*[F.asc_nulls_last(k) for k in keys]).limit(25)


# --- report documents ---------------------------------------------------------


register("report_entities")(lambda c: reports.entity_rows(c.table("report_fields")))
register("report_issues")(lambda c: reports.report_issues(c.table("report_fields")))
register("report_issue_summary")(lambda c: reports.issue_summary(reports.report_issues(c.table("report_fields"))))
register("issue_counts")(lambda c: reports.issue_counts(reports.report_issues(c.table("report_fields"))))
register("report_gate")(lambda c: reports.gate(reports.report_issues(c.table("report_fields"))))
register("report_offence_group")(lambda c: c.table("report_fields").groupBy("offence_group").agg(F.count(F.lit(1)).alias("cnt")))


@register("report_totals")
def report_totals(c: CaseLake) -> DataFrame:
    fields = c.table("report_fields")
    return reports.report_totals(fields, reports.report_issues(fields), reports.entity_rows(fields))


register("model_answer_entities")(lambda c: reports.answer_entities(reports.model_answers(c.landing("model_answers"))))
register("model_answer_failures")(lambda c: reports.answer_failures(reports.model_answers(c.landing("model_answers"))))


@register("documents_scan")
def documents_scan(c: CaseLake) -> DataFrame:
    """Whole texts with their length and fingerprint."""
    return c.landing.base("documents").select("doc_id", F.length("text").cast("bigint").alias("chars"), F.md5("text").alias("text_md5"))


@register("report_sample")
def report_sample(c: CaseLake) -> DataFrame:
    """The reproducible draw of 200 reports."""
    return sample(c.table("report_fields"), "charge", 200)


# --- data tests ---------------------------------------------------------------


register("check_unique")(lambda c: checks.unique(c.build("bronze_cases"), ["case_no", "_file_date"]))
register("check_relationships")(lambda c: checks.relationships(c.table("qa_events"), "case_pid", c.table("dim_case"), "case_pid").select("case_pid", "court_event_id"))
register("check_not_null")(lambda c: checks.not_null(c.build("bronze_cases"), "case_pid").select("case_no", "_file_date"))
register("check_accepted_values")(lambda c: checks.accepted_values(c.table("qa_charges"), "charge_type", list(CHARGE_TYPES)))


# --- sources and sinks --------------------------------------------------------


@register("rescued_rows")
def rescued_rows(c: CaseLake) -> DataFrame:
    """Birth dates that are no dates, kept as JSON."""
    rows = c.landing("cases").select("casepid", "dob", "_source_file")
    return rescue(rows, {"dob": "date"}).where(F.col("_rescued_data").isNotNull())


@register("file_date_from_name")
def file_date_from_name(c: CaseLake) -> DataFrame:
    """Dates read back from file names; the names of one feed do not fit the pattern."""
    charges = c.landing("charges").select(F.concat(F.lit("drop/charges_"), F.date_format("_file_date", "yyyyMMddHHmmss"), F.lit(".csv")).alias("file"))
    entities = c.landing("entities").select(F.concat(F.lit("drop/Info_"), F.date_format("_file_date", "yyyyMMdd_HHmm"), F.lit(".csv")).alias("file"))
    dated = charges.unionByName(entities).withColumn("file_date", file_date("file", c.registry["charges"].date_pattern).cast("timestamp_ntz"))
    return dated.groupBy("file", "file_date").agg(F.count(F.lit(1)).alias("cnt"))


def _fresh(c: CaseLake, name: str) -> str:
    import uuid

    return f"{run_dir(c.spark)}/{name}-{uuid.uuid4().hex[:8]}"


@register("csv_roundtrip")
def csv_roundtrip(c: CaseLake) -> DataFrame:
    entities = reports.entity_rows(c.table("report_fields"))
    path = _fresh(c, "csv")
    tables.write_csv(entities, path)
    return c.spark.read.schema(entities.schema).csv(path, header=True, nullValue="", emptyValue='""')


@register("partitioned_roundtrip")
def partitioned_roundtrip(c: CaseLake) -> DataFrame:
    fact = c.table("fact_case_charge")
    path = _fresh(c, "partitioned")
    tables.write_partitioned(fact, path, ["offence_group"])
    return c.spark.read.schema(fact.schema).parquet(path)


@register("stream_landing")
def stream_landing(c: CaseLake) -> DataFrame:
    """Charges written as monthly CSV drops and drained by the landing stream."""
    landed, spec = _landed_charges(c)
    return landed.select(*spec.business_columns, "_rescued_data", F.col("_file_date").cast("timestamp_ntz").alias("_file_date"))


def _landed_charges(c: CaseLake) -> tuple[DataFrame, SourceSpec]:
    spec, root = c.registry["charges"], _fresh(c, "drops")
    stream.write_drops(c.landing("charges"), spec, root)
    stream.land(c.spark, spec, root, f"{root}-landed", f"{root}-state").awaitTermination()
    return stream.read_table(c.spark, f"{root}-landed"), spec


@register("landing_lineage")
def landing_lineage(c: CaseLake) -> DataFrame:
    """Rows of each landed drop by the lineage columns."""
    landed, _ = _landed_charges(c)
    file = F.regexp_extract("_source_file", r"charges_\d{14}\.csv", 0).alias("file")
    rows = landed.select(file, F.col("_file_date").cast("timestamp_ntz").alias("file_date"), "_ingested_at")
    return rows.groupBy("file", "file_date").agg(F.count("_ingested_at").alias("rows"))


@register("land_all_sources")
def land_all_sources(c: CaseLake) -> DataFrame:
    """Every source dropped as CSV and landed side by side: rows, drops and rescued rows of each."""
    root = _fresh(c, "sources")
    drops = [partial(stream.write_drops, c.landing(spec.name), spec, root) for spec in c.registry.values()]
    side_by_side(*drops, at_once=SOURCES_AT_ONCE)
    stream.land_all(c.spark, c.registry.values(), root, f"{root}-landed", f"{root}-state")
    # counted per file first: a drop is read from a path once a file, not once a row
    rows, rescued = F.count(F.lit(1)).alias("rows"), F.count("_rescued_data").alias("rescued")
    parts = [stream.read_table(c.spark, f"{root}-landed/{s}").select(F.lit(s).alias("source"), "_source_file", "_rescued_data") for s in c.registry]
    files = reduce(DataFrame.unionByName, parts).groupBy("source", "_source_file").agg(rows, rescued)
    drop = F.regexp_extract("_source_file", "drop=([^/]+)/", 1)
    return files.groupBy("source").agg(F.sum("rows").alias("rows"), F.countDistinct(drop).alias("drops"), F.sum("rescued").alias("rescued"))


def _drifting(c: CaseLake, first: list, later: list, **options) -> DataFrame:
    """Charges of even cases, then those of odd ones with other columns, landed in every format."""
    root, even = _fresh(c, "drift"), F.col("pid").cast("long") % 2 == 0
    base = c.registry["charges"]

    def landed(fmt: str) -> DataFrame:
        spec = replace(base, name=f"charges_{fmt}", subfolder=fmt, file_format=fmt)
        for name, rows, columns in (("first", c.landing("charges").where(even), first), ("later", c.landing("charges").where(~even), later)):
            writer = rows.select(*columns).write.options(header=True, emptyValue='""', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
            writer.format(fmt).save(f"{root}/{fmt}/{name}")
            stream.land(c.spark, spec, root, f"{root}-landed/{fmt}", f"{root}-state", **options).awaitTermination()
        return stream.read_table(c.spark, f"{root}-landed/{fmt}").withColumn("format", F.lit(fmt))

    parts = side_by_side(*[partial(landed, fmt) for fmt in FILE_FORMATS])
    return reduce(lambda a, b: a.unionByName(b.select(*[F.col(f.name).cast(f.dataType) for f in a.schema])), parts)


def _plea() -> Column:
    return F.concat(F.lit("P"), (F.col("pid").cast("long") % 3).cast("string")).alias("plea")


@register("stream_landing_drift")
def stream_landing_drift(c: CaseLake) -> DataFrame:
    """A column appears in the middle of later files: the schema widens, nothing is lost or shifted."""
    names = list(c.registry["charges"].business_columns)
    landed = _drifting(c, names, [*names[:2], _plea(), *names[2:]])
    return landed.select("format", *names, "plea", "_rescued_data")


@register("stream_landing_rescued")
def stream_landing_rescued(c: CaseLake) -> DataFrame:
    """With a schema that stays: values that do not fit and columns it does not know are kept as JSON."""
    number = F.col("pid").cast("int").alias("pid")
    misfit = F.when(F.col("pid").cast("long") % 5 == 0, F.concat(F.lit("x"), "pid")).otherwise(F.col("pid")).alias("pid")
    landed = _drifting(c, [number, "chargetype", "chargestatus"], [misfit, _plea(), "chargetype", "chargestatus"], evolve=False, column_types=True)
    return landed.select("format", F.col("pid").cast("long").alias("pid"), "chargetype", "chargestatus", "_rescued_data")


# --- the incremental build -----------------------------------------------------

_LAKES: dict[str, Nightly] = {}


def _nightly(c: CaseLake) -> Nightly:
    """The lake after two loads, cut where the incremental queries cut, and a third one with late rows.

    What the first load holds back arrives last, under older file and ingest times.
    """
    if c.namespace not in _LAKES:
        lake = Nightly(c.spark, _fresh(c, "nightly"))
        late = F.col("_file_date") < F.lit("1992-06-01").cast("timestamp_ntz")

        def upto(source: str) -> DataFrame:
            rows = c.landing(source)
            return rows if source in ("events", "event_officers") else _cut(rows, False, "_file_date").where(~late)

        def punctual(source: str) -> DataFrame:
            rows = c.landing(source)
            return rows if source in ("events", "event_officers") else rows.where(~late)

        for n, landing in enumerate((upto, punctual, c.landing)):
            lake.run(landing, c.as_of, dt.datetime(2026, 1, 1 + n))
        _LAKES[c.namespace] = lake
    return _LAKES[c.namespace]


def _loaded(table: str) -> None:
    """A table as three loads leave it, which is what one rebuild gives, column by column."""
    register(f"nightly_{table}")(lambda c: _nightly(c).read("silver", table))


for _table in ("dim_person", "dim_officer", "dim_case", "fact_event_officer", "fact_case_charge", "fact_case_officer"):
    _loaded(_table)


@register("nightly_rows_taken")
def nightly_rows_taken(c: CaseLake) -> DataFrame:
    """Rows each layer holds per source, by the audit stamp of the load that brought them."""
    lake = _nightly(c)
    parts = [lake.read("bronze", s).select(F.lit(s).alias("source"), F.dayofmonth("_bronze_loaded_at").alias("load")) for s in SOURCES]
    return reduce(DataFrame.unionByName, parts).groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("load").alias("loads"))


@register("checked_append")
def checked_append(c: CaseLake) -> DataFrame:
    """Bronze charges appended in two loads to one partitioned table; a changed schema would be refused."""
    path, spec = _fresh(c, "append"), c.registry["charges"]
    for after in (False, True):
        rows = to_bronze(_cut(c.landing("charges"), after, "_file_date"), spec, loaded_at=c.loaded_at)
        append_checked(rows.withColumn("year", F.year("_file_date")), path, ["year"])
    return c.spark.read.parquet(path).drop("year")


# --- catalog tables and control tables ------------------------------------------


def _saved(c: CaseLake) -> str:
    """The workload mart as a catalog table with comments, its files in the shared folder."""
    name = f"caselake_workload_{c.namespace}"
    tables.execute(c.spark, f"DROP TABLE IF EXISTS {name}")
    tables.save_table(c.table("case_officer_workload"), name, COMMENTS["case_officer_workload"], path=_fresh(c, "catalog"))
    return name


register("catalog_scan")(lambda c: tables.scan_table(c.spark, _saved(c)))


@register("catalog_statement")
def catalog_statement(c: CaseLake) -> DataFrame:
    """A statement without result (a view over a catalog table), then a scan of what it made."""
    name = _saved(c)
    tables.execute(c.spark, f"CREATE OR REPLACE TEMPORARY VIEW {name}_open AS SELECT * FROM {name} WHERE case_status <> 'DISP'")
    return tables.scan_table(c.spark, f"{name}_open").groupBy("case_status").agg(F.sum("case_count").alias("case_count"))


@register("control_table_failures")
def control_table_failures(c: CaseLake) -> DataFrame:
    """Failing rows of the control tables, over the packaged ones with a source that was landed twice added."""
    rows = [seed(c.spark, n) for n in ("metadata_tables", "metadata_columns")]
    landed = c.landing("cases").groupBy("directorate").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "directorate").limit(1)
    doubled = landed.select(F.lit("cases").alias("source_name"), F.col("directorate").alias("subfolder"), F.lit("xml").alias("file_format"), F.lit("x").alias("date_pattern"), F.lit(None).cast("string").alias("date_format"), F.lit(None).cast("string").alias("natural_key"), F.lit(True).alias("active"))
    orphans = landed.select(F.col("directorate").alias("source_name"), F.lit("a").alias("source_column"), F.lit("a").alias("target_column"), F.lit("MONEY").alias("data_type"), F.lit(True).alias("nullable"), F.lit(None).cast("boolean").alias("active"))
    return control_failures(rows[0].unionByName(doubled), rows[1].unionByName(orphans))
