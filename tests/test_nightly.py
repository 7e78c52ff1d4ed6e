"""Loads in sequence must leave what one rebuild computes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caselake import queries
from caselake.operators import checks
from caselake.plans import dims, pipeline
from caselake.plans.nightly import Nightly
from caselake.plans.pipeline import CaseLake
from caselake.sources.fixtures import Landing
from caselake.sources.registry import load_registry
from tests.conftest import as_rows

AS_OF = dt.date(2026, 1, 1)
CUT = "1998-01-01 00:00:00"  # before officers move, so that the second load changes their versions
TABLES = ["dim_person", "dim_case", "dim_officer", "fact_event_officer", "fact_case_charge", "fact_case_officer"]
MARTS = ["case_officer_workload", "case_offence_distribution", "event_offence_hearing_days"]


def upto(landing, cut, event_cut):
    def table(source):
        limit = event_cut if source in ("events", "event_officers") else cut
        return landing(source).where(F.col("_file_date") < F.lit(limit).cast("timestamp_ntz"))

    return table


@pytest.fixture(scope="module")
def lakes(spark, folder, tmp_path_factory):
    landing = Landing(spark, folder)
    lake = Nightly(spark, str(tmp_path_factory.mktemp("lake")))
    lake.run(upto(landing, CUT, "2024-01-15 00:00:00"), AS_OF, dt.datetime(2026, 1, 1, 1))
    lake.run(landing, AS_OF, dt.datetime(2026, 1, 2, 1))
    full = CaseLake(spark, landing, AS_OF, namespace="rebuild")
    return lake, full


def comparable(df, names):
    return as_rows(df.select(*[c for c in names if c not in ("_bronze_loaded_at", "_silver_qa_loaded_at")]))


@pytest.mark.parametrize("table", TABLES)
def test_two_loads_equal_one_rebuild(lakes, table):
    lake, full = lakes
    expected = full.build(table)
    assert comparable(lake.read("silver", table), expected.columns) == comparable(expected, expected.columns)


@pytest.mark.parametrize("mart", MARTS)
def test_marts_equal_one_rebuild(lakes, mart):
    lake, full = lakes
    expected = full.build(mart)
    assert comparable(lake.read("gold", mart), expected.columns) == comparable(expected, expected.columns)


def test_rerun_without_news_changes_nothing(lakes, spark, folder):
    lake, _ = lakes
    before = {t: as_rows(lake.read("silver", t)) for t in ("fact_case_charge", "fact_event_officer")}
    lake.run(Landing(spark, folder), AS_OF, dt.datetime(2026, 1, 3, 1))
    for t, rows in before.items():
        assert as_rows(lake.read("silver", t)) == rows


KEYS = {"dim_person": "person_skey", "dim_case": "case_skey", "dim_officer": "officer_skey", "fact_event_officer": "event_officer_skey", "fact_case_charge": "case_charge_skey", "fact_case_officer": "case_officer_skey"}
REFERENCES = [
    ("dim_case", "accused_skey", "dim_person", "person_skey"),
    ("fact_case_charge", "case_skey", "dim_case", "case_skey"),
    ("fact_case_charge", "victim_skey", "dim_person", "person_skey"),
    ("fact_case_officer", "case_skey", "dim_case", "case_skey"),
    ("fact_case_officer", "officer_skey", "dim_officer", "officer_skey"),
    ("fact_event_officer", "case_skey", "dim_case", "case_skey"),
    ("fact_event_officer", "officer_skey", "dim_officer", "officer_skey"),
]


@pytest.mark.parametrize("table,key", KEYS.items())
def test_keys_are_present_and_unique(lakes, table, key):
    df = lakes[0].read("silver", table)
    assert checks.passes(checks.not_null(df, key)) and checks.passes(checks.unique_column(df, key))


@pytest.mark.parametrize("child,column,parent,field", REFERENCES)
def test_computed_keys_have_their_parent_row(lakes, child, column, parent, field):
    lake = lakes[0]
    assert checks.passes(checks.relationships(lake.read("silver", child), column, lake.read("silver", parent), field))


@pytest.mark.parametrize("column", ["assigned_from_date_skey", "assigned_to_date_skey", "first_mention_date_skey"])
def test_computed_date_keys_are_in_the_calendar(lakes, column):
    lake, full = lakes
    assert checks.passes(checks.relationships(lake.read("silver", "fact_case_officer"), column, full.build("dim_date"), "date_skey"))


def test_history_intervals_do_not_overlap(lakes):
    history = lakes[1].build("assignment_history")
    assert history.where("valid_to <= valid_from").isEmpty()
    assert checks.passes(checks.unique(history.where("valid_to IS NULL"), ["case_pid", "officer_id"]))


def test_comments_are_written(lakes):
    assert lakes[0].read("silver", "fact_case_charge").schema["charge_status"].metadata["comment"]
    assert lakes[0].read("gold", "case_officer_workload").schema["case_count"].metadata["comment"]


def test_registered_tables_read_the_lake_without_a_rebuild(spark, folder, lakes, monkeypatch):
    """The columns of the rebuild come from its plan: no shared table is written for them."""
    lake, _ = lakes
    c = queries.lake(spark, folder)
    monkeypatch.setitem(queries._LAKES, c.namespace, lake)
    monkeypatch.setattr(pipeline, "_WRITTEN", {})
    for table in TABLES:
        found = queries.QUERIES[f"nightly_{table}"](spark, folder)
        assert found.columns == [n for n in lake.read("silver", table).columns if n not in queries.STAMPS]
    assert not pipeline._WRITTEN


def test_a_version_is_listed_once(spark, lakes, tmp_path):
    lake = Nightly(spark, str(tmp_path))
    lake.table("gold", "t").overwrite(spark.range(2))
    first = lake.read("gold", "t")
    assert lake.read("gold", "t") is first
    lake.table("gold", "t").append(spark.range(3))
    assert first.count() == 2 and lake.read("gold", "t").count() == 5


def test_registered_tables_plan_no_rebuild_and_have_its_columns(spark, folder, lakes, monkeypatch):
    c = queries.lake(spark, folder)
    rebuilt = pipeline.CaseLake(c.spark, c.landing, c.as_of, share=False, registry=c.registry)
    columns = {table: queries.presented(rebuilt.build(table)).columns for table in TABLES}
    monkeypatch.setitem(queries._LAKES, c.namespace, lakes[0])
    monkeypatch.setattr(pipeline.CaseLake, "build", lambda self, name: pytest.fail(f"{name} is built a second time"))
    for table in TABLES:
        assert queries.QUERIES[f"nightly_{table}"](spark, folder).columns == columns[table]


STRUCTURE = "_rescued_data string, _source_file string, _file_date timestamp_ntz, _ingested_at timestamp_ntz"


def landed(spark, source, given):
    """Landing rows of a source: given columns, a file day and an hour of ingest; all else is NULL."""
    names = load_registry()[source].business_columns
    rows = []
    for values, day, hour in given:
        at = dt.datetime(2024, 1, day)
        rows.append((*[values.get(n) for n in names], None, f"{source}_{day}.csv", at, at + dt.timedelta(hours=hour)))
    return spark.createDataFrame(rows, ", ".join([*[f"{n} string" for n in names], STRUCTURE]))


def case(pid, status, day, hour=0):
    return {"casepid": pid, "caseno": f"SC-{pid}", "casestatus": status, "accusedname": f"Name {pid}", "gender": "F"}, day, hour


@pytest.fixture
def small(spark, tmp_path, monkeypatch):
    """A lake, what it keeps for a step, and a function that lands cases and returns the new rows of quality."""
    lake, kept, seen = Nightly(spark, str(tmp_path)), [], []
    keep = Nightly._keep
    monkeypatch.setattr(Nightly, "_keep", lambda self, name, df: (kept.append(name), keep(self, name, df))[1])

    def load(*given, source="cases"):
        stamp = dt.datetime(2026, 1, 1 + len(seen))
        seen.append(stamp)
        lake.load_bronze(source, landed(spark, source, given), stamp)
        lake.load_quality(source, AS_OF, stamp)
        return lake.read("qa", source).where(F.col("_bronze_loaded_at") == F.lit(stamp))

    return lake, kept, load


def test_only_days_both_layers_hold_are_compared(small):
    lake, kept, load = small
    first = [case("1", "PEND", 1), case("2", "PEND", 1), case("2", "PEND", 1, 1)]
    load(*first)
    load(*first, case("3", "PEND", 2), case("3", "DISP", 2, 1))
    assert not {"checked_cases", "known_cases"} & set(kept)
    load(*first, case("3", "PEND", 2), case("3", "DISP", 2, 1), case("1", "DISP", 1, 3), case("2", "AMAL", 1, -3), case("4", "PEND", 3))
    assert {"checked_cases", "known_cases"} <= set(kept)
    found = lake.read("qa", "cases").select("case_pid", "case_status").collect()
    assert sorted(map(tuple, found)) == [("1", "DISP"), ("2", "PEND"), ("3", "DISP"), ("4", "PEND")]


def test_a_key_that_waits_in_two_loads_of_bronze_comes_once(spark, small):
    """A run that died after bronze leaves its rows to the next one."""
    lake, _, _ = small
    rows = [case("1", "PEND", 1), case("1", "DISP", 1, 2)]
    for n in (1, 2):
        lake.load_bronze("cases", landed(spark, "cases", rows[:n]), dt.datetime(2026, 1, n))
    lake.load_quality("cases", AS_OF, dt.datetime(2026, 1, 2))
    assert as_rows(lake.read("qa", "cases").select("case_pid", "case_status")) == [("1", "DISP")]


def test_names_that_are_new_are_added_to_the_index(small, tmp_path):
    """The buckets are not rewritten, unless a run that died may have added the same rows."""
    lake, kept, load = small
    none = load(source="entities")
    rows = [case("1", "PEND", 1), case("2", "PEND", 1)]
    assert lake.load_persons({"cases": load(*rows), "entities": none}, False).count() == 2
    before = set((tmp_path / "index/person_names/data").rglob("*.parquet"))
    fresh = {"cases": load(*rows, case("2", "DISP", 2), case("3", "PEND", 2)), "entities": none}
    assert as_rows(lake.load_persons(fresh, False)) == [("Name 3",)]
    after = set((tmp_path / "index/person_names/data").rglob("*.parquet"))
    assert before < after and "mentions" not in kept
    lake.load_persons(fresh, True)
    named = lake.read("index", "person_names").groupBy("full_name").count()
    assert as_rows(named) == [("1", "Name 1"), ("1", "Name 3"), ("2", "Name 2")]
    expected = dims.dim_person(lake.read("qa", "cases"), lake.read("qa", "entities"))
    assert as_rows(lake.read("silver", "dim_person")) == as_rows(expected)


def test_the_first_run_lists_no_keys_and_a_died_one_is_built_over(spark, folder, tmp_path, monkeypatch):
    landing = upto(Landing(spark, folder), "1996-01-01", "2024-01-05 00:00:00")
    kept, keep, build = [], Nightly._keep, Nightly.build_marts
    monkeypatch.setattr(Nightly, "_keep", lambda self, name, df: (kept.append(name), keep(self, name, df))[1])
    monkeypatch.setattr(Nightly, "build_marts", lambda self, as_of: (_ for _ in ()).throw(RuntimeError("dies")))
    lake = Nightly(spark, str(tmp_path))
    with pytest.raises(RuntimeError):
        lake.run(landing, AS_OF, dt.datetime(2026, 1, 1, 1))
    monkeypatch.setattr(Nightly, "build_marts", build)
    lake.run(landing, AS_OF, dt.datetime(2026, 1, 2, 1))
    assert all(name.startswith("deliveries_") for name in kept)
    full = CaseLake(spark, landing, AS_OF, namespace="rebuild of a first run")
    for table in TABLES:
        expected = full.build(table)
        assert comparable(lake.read("silver", table), expected.columns) == comparable(expected, expected.columns)
    persons = lake.read("index", "person_names")
    assert persons.count() == dims.people(lake.read("qa", "cases"), lake.read("qa", "entities")).count()
