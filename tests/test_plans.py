"""Star schema, marts, served queries and reports on small cases."""

from __future__ import annotations

import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from caselake.plans import dims, facts, reports, serve
from caselake.plans.pipeline import CaseLake
from caselake.session import configure
from caselake.sources.fixtures import Landing
from tests.conftest import as_rows

DAY = dt.datetime(2024, 1, 1)
STAMPS = "_file_date timestamp, _bronze_loaded_at timestamp, is_valid_row boolean"


def qa(spark, schema, rows, day=DAY):
    return spark.createDataFrame([(*r, day, day, True) for r in rows], f"{schema}, {STAMPS}")


def cases(spark, rows):
    """(pid, status) rows."""
    full = [(p, f"SC-{p}", "t", "d", s, "Ann", "F", dt.date(1990, 1, 1)) for p, s in rows]
    return qa(spark, "case_pid string, case_no string, case_title string, directorate string, case_status string, accused_name string, accused_gender string, accused_dob date", full)


def charges(spark, rows):
    return qa(spark, "case_pid string, charge_no string, charge_type string, charge_status string, offence_date date", [(p, n, "DAC", s, dt.date(2023, 5, 1)) for p, n, s in rows])


def entities(spark, rows=()):
    return qa(spark, "case_no string, charge_no string, entity_name string, entity_gender string, entity_type string, relationship_to_victim string, offence_group string, special_type string", rows)


def events(spark, rows, day=DAY):
    """(id, pid, type, start, status) rows."""
    return qa(spark, "court_event_id string, case_pid string, court_event_type string, start_datetime string, court_event_status string, court_number string", [(*r, "C1") for r in rows], day)


def charge_fact(spark, case_rows, charge_rows, entity_rows=()):
    c, e = cases(spark, case_rows), entities(spark, entity_rows)
    return facts.fact_case_charge(charges(spark, charge_rows), c, e, dims.dim_person(c, e))


def test_status_reconciliation_both_ways(spark):
    rows = charge_fact(
        spark,
        [("1", "PEND"), ("2", "PEND"), ("3", "DISP"), ("4", "AMAL"), ("5", "PEND")],
        [("1", "a", "SENTENCED"), ("1", "b", " sentenced "), ("2", "a", "pending"), ("2", "b", "SENTENCED"), ("3", "a", "PENDING"), ("4", "a", "PENDING"), ("5", "a", None)],
    )
    got = sorted((r.case_pid, str(r.charge_status), r.case_status) for r in rows.collect())
    assert got == [("1", "SENTENCED", "DISP"), ("1", "SENTENCED", "DISP"), ("2", "PENDING", "PEND"), ("2", "SENTENCED", "PEND"), ("3", "SENTENCED", "DISP"), ("5", "None", "DISP")]


def test_victims_match_by_name_and_gender(spark):
    got = charge_fact(
        spark,
        [("1", "PEND")],
        [("1", "a", "x"), ("1", "b", "x"), ("1", "c", "x")],
        [("SC-1", "a", "Vi", "F", "Victim", "Self", "Hurt", None), ("SC-1", "b", "Vi", None, "Victim", "Self", None, None)],
    )
    by_group = sorted((r.offence_group, r.victim_skey is not None, str(r.relation_to_accused)) for r in got.collect())
    assert by_group == [("Hurt", True, "Self"), ("UNKNOWN", False, "None"), ("UNKNOWN", False, "Self")]


def test_people_who_differ_only_by_null_gender_stay_apart(spark):
    c = cases(spark, [("1", "PEND")])
    e = entities(spark, [("SC-1", "a", "Ann", None, "Victim", None, None, None), ("SC-1", "b", "Ann", "F", "Victim", None, None, None)])
    assert dims.dim_person(c, e).count() == 3


@pytest.mark.parametrize(
    "kind,start,weight",
    [("PTC", "2024-01-01 09:00:00", "0.024510"), ("TRIAL", "2024-01-01 13:00:00", "0.500000"), ("TRIAL", "2024-01-01 12:59:00", "1.000000"), ("PG", "2024-01-01 09:00:00", "0.166667"), ("ODD", None, "0.166667")],
)
def test_hearing_day_weights(spark, kind, start, weight):
    officers = dims.with_officer_key(spark.createDataFrame([("7", "A", "C", "T", dt.date(2024, 1, 1), None, DAY)], "officer_id string, full_name string, officer_cluster string, officer_team string, row_start_date date, row_end_date date, _file_date timestamp"))
    pairs = qa(spark, "court_event_id string, officer_id string", [("1", "7")])
    fact = facts.fact_event_officer(events(spark, [("1", "1", kind, start, "NEW")]), pairs, cases(spark, [("1", "PEND")]), officers).collect()
    assert len(fact) == 1 and str(fact[0].court_event_hearing_days) == weight and fact[0].officer_skey is not None


def test_redelivered_event_goes_when_voided(spark):
    both = events(spark, [("1", "1", "PG", None, "NEW")]).unionByName(events(spark, [("1", "1", "PG", None, "VACATED")], DAY + dt.timedelta(days=1)))
    assert facts.current_events(both).count() == 0
    assert facts.current_events(both, mode="reference").count() == 1
    assert as_rows(facts.voided_events(both)) == [("1",)]


def test_case_type_priority_and_first_mention(spark):
    got = facts.case_events(
        events(
            spark,
            [("1", "a", "PG", "2024-02-01 10:00:00", "NEW"), ("2", "a", "TRIAL", "2024-03-01 10:00:00", "NEW"), ("3", "b", "FM_PG", "2024-03-02 10:00:00", "NEW"), ("4", "b", "PG", "2024-01-02 10:00:00", "VOIDED"), ("5", "c", "FM", None, "NEW"), ("6", "d", "PG", "2024-03-01 10:00:00", "VOIDED")],
        )
    ).collect()
    assert sorted((r.case_pid, r.case_type, str(r.first_mention_date)) for r in got if r.case_type) == [("a", "Trial", "2024-02-01"), ("b", "PG", "2024-01-02"), ("c", "TBD", "None")]
    assert [r.case_type for r in got if r.case_pid == "d"] == [None]


def test_complexity(spark):
    c = cases(spark, [(str(i), "PEND") for i in range(4)])
    fact = charge_fact(spark, [(str(i), "PEND") for i in range(4)], [("1", n, "x") for n in "abc"] + [("2", "a", "x")])
    e = entities(spark, [("SC-3", "a", "V", "F", "Victim", None, None, "Family Violence")])
    got = {r.case_pid: r.case_complexity for r in facts.case_profile(c, events(spark, [("1", "2", "PH", None, "NEW")]), e, fact).collect()}
    assert got == {"0": "Simple", "1": "Complex", "2": "Complex", "3": "Complex"}


def test_officer_version_by_day(spark):
    schema = "officer_id string, full_name string, officer_cluster string, officer_team string, row_start_date date, row_end_date date, _file_date timestamp"
    officers = dims.with_officer_key(spark.createDataFrame([("7", "A", "old", "T", dt.date(2024, 1, 1), dt.date(2024, 1, 31), DAY), ("7", "A", "new", "T", dt.date(2024, 2, 1), None, DAY)], schema))
    rows = spark.createDataFrame([("7", dt.date(2020, 1, 1)), ("7", dt.date(2024, 1, 31)), ("7", dt.date(2024, 2, 1)), ("7", None), ("8", dt.date(2024, 1, 1))], "officer_id string, day date")
    got = facts.with_officer_version(rows, officers, F.col("day")).join(officers.select("officer_skey", "officer_cluster"), "officer_skey", "left").collect()
    assert sorted((r.officer_id, str(r.day), str(r.officer_cluster)) for r in got) == [("7", "2020-01-01", "old"), ("7", "2024-01-31", "old"), ("7", "2024-02-01", "new"), ("7", "None", "new"), ("8", "2024-01-01", "None")]


@pytest.mark.parametrize(
    "status,kind,label",
    [("PEND", "TBD", "Open"), ("pend", "PG", "Ongoing PG"), ("PEND", "Trial", "Ongoing Trial"), ("DISP", "PG", "Concluded PG"), ("DISP", "Trial", "Concluded Trial"), ("DISP", "TBD", None), ("DATA", "PG", "Concluded Acquittal"), ("DNATA", None, "Concluded Acquittal"), ("AMAL", "PG", "AMAL PG"), ("PEND", None, "PEND"), (None, None, ""), (None, "PG", "PG")],
)
def test_status_labels(spark, status, kind, label):
    assert spark.createDataFrame([(status, kind)], "case_status string, case_type string").select(serve.status_label()).first()[0] == label


def test_hearing_days_count_an_event_once_and_man_days_each_officer(spark):
    rows = [("1", "Hurt", "PTC", "PG", dt.date(2024, 1, 1), "C", 0.5), ("1", "Hurt", "PTC", "PG", dt.date(2024, 1, 1), "C", 0.5), ("2", "Hurt", "Trial", "PG", dt.date(2024, 1, 1), "C", 1.0)]
    mart = spark.createDataFrame(rows, "court_event_id string, offence_group string, court_event_type string, case_type string, first_mention_date date, officer_cluster string, hearing_days double")
    assert as_rows(serve.hearing_days(mart, "PG")) == [("0.5", "Hurt", "Other Categories"), ("1.0", "Hurt", "None")]
    assert as_rows(serve.hearing_days(mart, "PG", "Man Days")) == [("1.0", "Hurt", "None"), ("1.0", "Hurt", "Other Categories")]
    assert serve.hearing_days(mart, "PG", legend=["PTCs"]).count() == 1
    assert serve.stored_event_types(["All"]) == [] and serve.stored_event_types(["PTCs", "odd"]) == ["PTC", "odd"]


REPORT = """# Report
**Charge Details** of the case (SC-000123-2023 / DAC-000001-2023)
* **Name:**   MARY-JANE O'BRIEN
* **Gender/Age:** FEMALE / 35 YEARS
* **Statute:** Women's Charter 1961
* **Offence:** Section 146(1)
### **Statement of Offence**
First line of a massage
outlet.
* **Offence:** again
* **Special Type:** Family Violence
### **Victim Particulars**
* **Name:** JOHN d'ARC
* **Gender/Age:** MALE / 130 YEARS
* **Relationship to Accused:** Neighbour
### Next
* **Name:** nobody
"""


def test_report_fields(spark):
    got = reports.report_fields(spark.createDataFrame([("DAC-000001-2023", REPORT), ("x", "nothing here")], "doc_id string, text string")).collect()
    full = got[0].asDict()
    assert full == {
        "charge": "DAC-000001-2023", "case": "SC-000123-2023", "accused_name": "MARY-JANE O'BRIEN", "accused_age": 35, "accused_gender": "F", "victim_name": "JOHN d'ARC",
        "victim_age": 130, "victim_gender": "M", "victim_relationship": "Neighbour", "special_type": "Family Violence", "statute": "Women's Charter 1961", "offence_section": "146(1)",
        "offence_group": "Vice Activities in Massage Parlours",
    }
    assert [v for k, v in got[1].asDict().items() if k != "charge"] == [None] * 12


def test_report_rows_issues_and_gate(spark):
    fields = reports.report_fields(spark.createDataFrame([("DAC-000001-2023", REPORT), ("x", "nothing here")], "doc_id string, text string"))
    rows = {(r.charge_no, r.entity_type): r for r in reports.entity_rows(fields).collect()}
    assert len(rows) == 3
    assert rows["DAC-000001-2023", "Accused Person"].entity_name == "Mary-Jane O'Brien"
    assert rows["DAC-000001-2023", "Victim"].entity_name == "John D'Arc" and rows["DAC-000001-2023", "Victim"].relationship_to_victim == "Neighbour"
    issues = reports.report_issues(fields)
    got = sorted((r.charge, r.field, r.severity) for r in issues.collect())
    assert got == [("DAC-000001-2023", "victim_age", "WARNING")] + [("x", f, "ERROR") for f in ("accused_age", "accused_gender", "accused_name", "case")] + [("x", "charge", "WARNING"), ("x", "offence_group", "ERROR")]
    assert reports.gate(issues).first().passed is False
    assert reports.gate(issues.where("severity = 'WARNING'")).first().passed is True
    failures = spark.createDataFrame([("d", "e")], "doc_id string, error string")
    assert reports.gate(issues.where("false"), failures).first().passed is False
    assert reports.report_totals(fields, issues, reports.entity_rows(fields), failures).first().asDict() == {"reports": 2, "failures": 1, "entity_rows": 3, "charges_with_issues": 2, "errors": 5, "warnings": 2}


def test_report_rules_are_computed_once(spark):
    """No interpreted filter inside the array, no second computation of it to check its size, no pattern shared for every row."""
    fields = reports.report_fields(spark.createDataFrame([("x", REPORT)], "doc_id string, text string"))
    issues = reports.report_issues(fields.withColumn("charge", F.concat("charge", F.lit("-"))))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in issues and "size(array(" not in issues
    names = "charge string, case string, accused_name string, accused_age int, accused_gender string, offence_group string, victim_name string, victim_age int, victim_gender string"
    rows = [("DAC-000001-2023", "SC-000123-2023", " \u3000\t", 200, "M", "Hurt", None, None, None), (None, None, None, None, None, None, "\x85", None, " ")]
    got = reports.report_issues(spark.createDataFrame(rows, names)).collect()
    assert sorted(r.field for r in got if r.charge) == ["accused_age", "accused_name"]
    assert sorted(r.field for r in got if not r.charge) == ["accused_age", "accused_gender", "accused_name", "case", "charge", "charge", "offence_group", "victim_age", "victim_gender", "victim_gender", "victim_name"]


def test_report_fields_of_odd_texts(spark):
    """The search for the victim's block in front of its pattern changes nothing: no text, its words without the heading, an empty statement."""
    texts = [("a", None), ("b", "Victim Particulars\n* **Name:** x"), ("c", REPORT.replace("Statement of Offence", "Statement")), ("d", REPORT.upper())]
    got = {r.charge: r for r in reports.report_fields(spark.createDataFrame(texts, "doc_id string, text string")).collect()}
    assert [v for k, v in got["a"].asDict().items() if k != "charge"] == [None] * 12
    assert got["b"].accused_name == "x" and got["b"].victim_name is None
    assert got["c"].offence_group == "Vice Activities" and got["c"].victim_gender == "M"
    assert got["d"].victim_name is None


@pytest.mark.parametrize(
    "statute,section,group",
    [("Road Traffic Act and Films Act", "1", "Traffic Offences"), ("PENAL CODE 1871", "377BB(7)", "Voyeurism/Sexual Exposure"), ("Penal Code", "304A", "Hurt"), ("Penal Code", "999", None), ("Other", "379", None), ("Films Act", "1", "Vice Activities"), (None, "379", None)],
)
def test_offence_groups(spark, statute, section, group):
    df = spark.createDataFrame([(statute, section, "quiet")], "statute string, section string, text string")
    assert reports.with_offence_group(df, "statute", "section", F.col("text")).first().offence_group == group


def test_model_answers_and_captured_failures(spark):
    answers = [
        ("d1", 'Sure:\n```json\n{"case": "SC-1", "accused_name": "ann lee", "accused_age": 40, "victim_name": null}\n```\nbye'),
        ("d2", '```\n{"case": null, "charge": null, "accused_name": "bo"}\n```'),
        ("d3", '{"charge": "DAC-1", "accused_name": "cy", "victim_name": "di", "victim_relationship_to_accused": ""}'),
        ("d4", "no json"),
        ("d5", "[1, 2]"),
        ("d6", None),
    ]
    parsed = reports.model_answers(spark.createDataFrame(answers, "doc_id string, answer string"))
    got = {r.doc_id: r for r in parsed.collect()}
    assert (got["d1"].charge, got["d1"].accused_age) == ("d1", "40") and got["d2"].charge is None
    rows = sorted((r.charge_no or "", r.entity_name, r.relationship_to_victim) for r in reports.answer_entities(parsed).collect())
    assert rows == [("", "Bo", None), ("DAC-1", "Cy", None), ("DAC-1", "Di", None), ("d1", "Ann Lee", None)]
    assert sorted(r.doc_id for r in reports.answer_failures(parsed).collect()) == ["d4", "d5", "d6"]
    assert reports.first_failures(reports.answer_failures(parsed), 2).count() == 2


def test_hot_case_keeps_results_whole(spark):
    """A third of all charges in one case: same counts, and nothing but per-key rows is windowed."""
    hot = [("1", f"c{i}", "SENTENCED") for i in range(300)] + [(str(2 + i % 100), f"d{i}", "PENDING") for i in range(600)]
    fact = charge_fact(spark, [(str(i), "PEND") for i in range(1, 102)], hot)
    got = {r.case_pid: (r.n, r.s) for r in fact.groupBy("case_pid").agg(F.count("*").alias("n"), F.max("case_status").alias("s")).collect()}
    assert got["1"] == (300, "DISP") and sum(n for n, _ in got.values()) == 900 and got["2"][1] == "PEND"


def test_shared_tables_are_written_once_and_small(spark, folder):
    lake = CaseLake(spark, Landing(spark, folder), dt.date(2026, 1, 1), namespace="written small")
    files = lake.table("dim_case").inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert lake.table("dim_case").inputFiles() == files
    assert as_rows(lake.table("dim_case")) == as_rows(lake.build("dim_case"))


def test_a_tasks_share_is_bounded(spark):
    """Scans are cut and shuffles dealt finely enough; a session that cuts finer keeps its values."""
    share, first = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    coarse, fine = spark.newSession(), spark.newSession()
    for session, size, parts in ((coarse, "128m", "12"), (fine, "1m", "500")):
        session.conf.set(share, size)
        session.conf.set("spark.sql.shuffle.partitions", parts)
        configure(session)
    assert coarse.conf.get(share) == "16m" and fine.conf.get(share) == "1m"
    assert coarse.conf.get(first) == "200" and fine.conf.get(first, None) is None
    assert coarse.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def shuffled_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {str(f) for d in folders for f in Path(str(d)).rglob("shuffle_*")}


def test_shuffle_files_go_with_their_query(spark, folder):
    """What a query shuffled does not stay while the next ones run, whoever still holds its frame, which can be read again."""
    lake = CaseLake(spark, Landing(spark, folder), dt.date(2026, 1, 1), namespace="shuffle files")
    held = serve.status_pivot(serve.offence_status_counts(lake.table("case_offence_distribution"))).orderBy("offence_type")
    before = shuffled_files(spark)
    first = held.collect()
    until = time.monotonic() + 20  # files are removed beside the next work
    while (left := shuffled_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    assert first and not left
    assert held.collect() == first
