"""Operators on small hand-written cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caselake.functions.dates import date_skey, parse_date, parse_timestamp, skey_date
from caselake.functions.keys import KEY_NULL, surrogate_key
from caselake.functions.text import strip, title_case
from caselake.operators import checks
from caselake.operators.bronze import reject_reason, to_bronze
from caselake.operators.dedup import latest_by
from caselake.operators.filters import choose, optional_filters, selected
from caselake.operators.history import empty_history, observed_history, observed_versions, snapshot_step, version_step
from caselake.operators.joins import lookup, sentinel_join
from caselake.operators.merge import append_checked, upsert
from caselake.operators.pivots import pivot_all, pivot_sum
from caselake.operators.quality import add_flags, to_quality
from caselake.operators.watermark import high_water_mark, newer_than
from caselake.sources.registry import load_registry
from tests.conftest import as_rows

D = dt.date
T = dt.datetime


def one(df):
    return df.first()[0]


def test_key_is_null_safe(spark):
    import hashlib

    got = one(spark.sql("select 'a' x, cast(null as string) y").select(surrogate_key("x", "y")))
    assert got == hashlib.md5(f"a-{KEY_NULL}".encode()).hexdigest()


@pytest.mark.parametrize("text", ["MARY-JANE O'BRIEN", "d'souza 2nd smith", "", "ÉMILE zola", "a  b", "x1y", "中a b"])
def test_title_case_equals_python(spark, text):
    assert one(spark.createDataFrame([(text,)], "n string").select(title_case("n"))) == text.title()


def test_strip_equals_python(spark):
    texts = ["\t a  ", "　x y\r\n", "", "   ", "plain"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(strip("t")).collect()]
    assert got == [t.strip() for t in texts]


@pytest.mark.parametrize(
    "text,day",
    [("2023-01-05", D(2023, 1, 5)), ("20230105", D(2023, 1, 5)), ("20230105 09:30", D(2023, 1, 5)), ("n/a", None), ("20239999", None), (None, None)],
)
def test_parse_date(spark, text, day):
    assert one(spark.createDataFrame([(text,)], "t string").select(parse_date("t"))) == day


def test_parse_timestamp(spark):
    rows = spark.createDataFrame([("20230105 09:30",), ("2023-01-05 09:30:00",), ("bad",)], "t string").select(parse_timestamp("t")).collect()
    assert [r[0] for r in rows] == [T(2023, 1, 5, 9, 30), T(2023, 1, 5, 9, 30), None]


def test_date_keys_end_with_the_calendar(spark):
    df = spark.createDataFrame([(D(2024, 2, 29),), (D(1999, 12, 31),), (D(2030, 12, 31),), (None,)], "d date")
    rows = df.select(date_skey("d").alias("k")).select("k", skey_date("k")).collect()
    assert [tuple(r) for r in rows] == [(20240229, D(2024, 2, 29)), (None, None), (20301231, D(2030, 12, 31)), (None, None)]


def test_latest_by_has_a_total_order(spark):
    df = spark.createDataFrame([("k", 2, "b", None), ("k", 2, "a", "z"), ("k", 2, "a", "y"), ("k", 1, "0", "0"), (None, 1, "q", "q")], "k string, t int, a string, b string")
    assert as_rows(latest_by(df, ["k"], ["t"])) == sorted([("a", "y", "k", "2"), ("q", "q", "None", "1")])


def test_dedup_cuts_keys_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = latest_by(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    before = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_reject_reason_takes_the_first_failing_check(spark):
    spec = load_registry()["charges"]
    df = spark.createDataFrame([(None, None), ("1", None), ("1", "2")], "pid string, chargeno string")
    assert [r[0] for r in df.select(reject_reason(spec)).collect()] == ["missing_pid", "missing_chargeno", None]


def test_bronze_keeps_rejected_rows_and_one_per_key(spark):
    spec = load_registry()["event_officers"]
    cols = "courteventid string, officerid string, name string, division string, _rescued_data string, _source_file string, _file_date timestamp, _ingested_at timestamp"
    day = T(2024, 1, 1)
    rows = [("1", "7", "old", "d", None, "f", day, T(2024, 1, 2)), ("1", "7", "new", "d", None, "f", day, T(2024, 1, 3)), (None, "7", "x", "d", None, "f", day, day)]
    got = to_bronze(spark.createDataFrame(rows, cols), spec).select("court_event_id", "officer_name", "_rejected_reason").collect()
    assert sorted(map(tuple, got), key=str) == [("1", "new", None), (None, "x", "missing_courteventid")]


def test_watermark_of_empty_target_and_late_rows(spark):
    df = spark.createDataFrame([(T(2024, 1, 1),), (T(2024, 1, 3),)], "t timestamp")
    assert high_water_mark(df.where("false"), "t") == T(1900, 1, 1)
    assert newer_than(df, "t", high_water_mark(df.where("t < '2024-01-02'"), "t")).count() == 1
    assert newer_than(df, "t", high_water_mark(df, "t")).count() == 0


def test_unknown_comparison_passes_a_flag(spark):
    df = spark.createDataFrame([(None,), ("M",), ("X",)], "g string")
    got = add_flags(df, {"bad": ~F.col("g").isin("M", "F")}, [F.col("g")]).collect()
    assert [(r.g, r._dq_bad, r.is_valid_row, r.is_clean_row) for r in got] == [(None, True, True, True), ("M", True, True, True), ("X", False, False, False)]


def test_quality_parses_compact_dates(spark):
    cols = "case_pid string, charge_no string, charge_type string, charge_status string, offence_date string, filing_date string, _rescued_data string, _source_file string, _file_date timestamp, _ingested_at timestamp, _bronze_loaded_at timestamp, _rejected_reason string"
    day = T(2024, 1, 1)
    rows = [("1", "a", "DAC", "s", "20990101", "20230101", None, "f", day, day, day, None), ("2", "a", "DAC", "s", "x", None, None, "f", day, day, day, "missing_pid")]
    got = to_quality(spark.createDataFrame(rows, cols), "charges", D(2026, 1, 1)).collect()
    assert len(got) == 1
    assert (got[0]._dq_future_offence_date, got[0]._dq_future_filing_date, got[0]._dq_filing_before_offence, got[0].is_clean_row) == (False, True, False, False)


def test_sentinels_make_null_and_default_equal(spark):
    left = spark.createDataFrame([(1, None, "M", None), (2, "", "M", D(1900, 1, 1))], "id int, n string, g string, d date")
    right = spark.createDataFrame([("p", None, "M", None), ("q", "x", "M", None)], "k string, n2 string, g2 string, d2 date")
    got = sentinel_join(left, right, {"n": "n2", "g": "g2"}, {"d": "d2"}).select("id", "k")
    assert as_rows(got) == [("1", "p"), ("2", "p")]


def test_lookup_deals_out_null_keys(spark):
    left = spark.range(100).select("id", F.when(F.col("id") < 10, F.col("id").cast("string")).alias("key"))
    right = spark.createDataFrame([("3", "three")], "key string, name string")
    got = lookup(left, right, "key", spread="id")
    assert got.columns == ["id", "key", "name"]
    assert got.count() == 100 and got.where("name = 'three'").count() == 1
    assert as_rows(got) == as_rows(lookup(left, right, "key"))


def feed(spark, rows):
    return spark.createDataFrame(rows, "officer_id string, name string, team string, _file_date timestamp")


def test_officer_with_three_versions(spark):
    rows = [("1", "A", "x", T(2024, 1, 1)), ("1", "A", "x", T(2024, 1, 5)), ("1", "A", "y", T(2024, 2, 1)), ("1", "A", None, T(2024, 3, 1)), ("2", "B", "x", T(2024, 1, 1))]
    got = observed_versions(feed(spark, rows), "officer_id", ["name", "team"], "_file_date").collect()
    spans = sorted((r.officer_id, r.team or "", r.row_start_date, r.row_end_date) for r in got)
    assert spans == [("1", "", D(2024, 3, 1), None), ("1", "x", D(2024, 1, 1), D(2024, 1, 31)), ("1", "y", D(2024, 2, 1), D(2024, 2, 29)), ("2", "x", D(2024, 1, 1), None)]


def test_version_steps_equal_observed_history(spark):
    loads = [[("1", "A", "x"), ("2", "B", "x")], [("1", "A", "y")], [("1", "A", "y"), ("2", "C", "x"), ("3", "D", None)], [("1", "A", "x"), ("3", "D", None)]]
    days = [D(2024, m, 1) for m in range(1, 5)]
    rows = [(*r, T(d.year, d.month, 1)) for d, load in zip(days, loads) for r in load]
    tracked = ["name", "team"]
    state = observed_versions(feed(spark, rows).where("false"), "officer_id", tracked, "_file_date").select("officer_id", *tracked, "_file_date", "row_start_date", "row_end_date")
    for d, load in zip(days, loads):
        batch = feed(spark, [(*r, T(d.year, d.month, 1)) for r in load])
        state = version_step(state, batch, "officer_id", tracked, d)
    expected = observed_versions(feed(spark, rows), "officer_id", tracked, "_file_date")
    assert as_rows(state.drop("_file_date")) == as_rows(expected.drop("_file_date"))


def assigned(spark, rows):
    return spark.createDataFrame(rows, "case_pid string, officer_id string, team string, _file_date timestamp")


def test_snapshot_steps_open_close_and_drop(spark):
    keys = ["case_pid", "officer_id"]
    jan, feb, mar = T(2024, 1, 1), T(2024, 2, 1), T(2024, 3, 1)
    first = assigned(spark, [("1", "a", "x", jan), ("1", "b", "x", jan)])
    history = snapshot_step(empty_history(first, "_file_date"), first, keys, "_file_date", jan)
    history = snapshot_step(history, assigned(spark, [("1", "a", "y", feb), ("2", "c", "z", feb)]), keys, "_file_date", feb)
    history = snapshot_step(history, assigned(spark, [("1", "a", "y", feb), ("2", "c", "w", mar)]), keys, "_file_date", mar)
    got = sorted((r.case_pid, r.officer_id, r.team, r.valid_from, r.valid_to) for r in history.collect())
    assert [g[:4] for g in got] == [("1", "a", "x", jan), ("1", "a", "y", feb), ("1", "b", "x", jan), ("2", "c", "w", mar), ("2", "c", "z", feb)]
    assert [g[4] for g in got] == [feb, None, feb, None, mar]


def test_snapshot_steps_equal_observed_history(spark):
    keys = ["case_pid", "officer_id"]
    loads = [assigned(spark, [("1", "a", t, T(2024, m, 1)), ("2", "a", t, T(2024, m, 1))]) for m, t in enumerate("xyz", 1)]
    history = empty_history(loads[0], "_file_date")
    for load in loads:
        history = snapshot_step(history, load, keys, "_file_date", T(2024, 9, 1))
    expected = observed_history(loads[0].union(loads[1]).union(loads[2]), keys, "_file_date")
    assert as_rows(history) == as_rows(expected)


def test_upsert_is_null_safe_and_idempotent(spark):
    target = spark.createDataFrame([(1, None, "old"), (2, "x", "keep")], "a int, b string, v string")
    source = spark.createDataFrame([(1, None, "new"), (3, "y", "add")], "a int, b string, v string")
    once = upsert(target, source, ["a", "b"])
    assert as_rows(once.select("a", "v")) == [("1", "new"), ("2", "keep"), ("3", "add")]
    assert as_rows(upsert(once, source, ["a", "b"])) == as_rows(once)


def test_append_refuses_another_schema(spark, tmp_path):
    path = str(tmp_path / "b")
    append_checked(spark.createDataFrame([(1, "x")], "a int, p string"), path, ["p"])
    append_checked(spark.createDataFrame([(2, "x")], "a int, p string"), path, ["p"])
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        append_checked(spark.createDataFrame([("2", "x")], "a string, p string"), path, ["p"])
    with pytest.raises(ValueError):
        append_checked(spark.createDataFrame([(2, 3, "x")], "a int, c int, p string"), path, ["p"])


def test_filters_and_choice(spark):
    df = spark.createDataFrame([("a", "2024"), ("b", "2025"), (None, "2025")], "c string, y string")
    assert selected(["All Saints"]) == ["All Saints"]
    assert selected(["All Clusters", "a"]) == [] and selected(None) == [] and selected(["a"]) == ["a"]
    assert optional_filters(df, {"c": ["All Clusters"], "y": []}).count() == 3
    assert as_rows(optional_filters(df, {"c": ["a", "b"], "y": ["2025"]})) == [("b", "2025")]
    assert choose(df, ["y"], {"c": ["a"]}).columns == ["y"]


def test_pivots(spark):
    df = spark.createDataFrame([("g", "A", 1), ("g", "B", 2), ("g", "A", 3), ("h", None, 9), ("h", "Z", 4), (None, "A", 7)], "i string, c string, n int")
    got = {r.i: (r.A, r.B, r.Rest) for r in pivot_sum(df, ["i"], "c", ["A", "B"], "n", other="Rest").collect()}
    assert got == {"g": (4, 2, 0), "h": (0, 0, 4)}
    wide = pivot_all(df, ["i"], "c", ["B", "A"], "n")
    assert wide.columns == ["i", "B", "A", "Z"]
    assert {r.i: (r.B, r.A, r.Z) for r in wide.collect()} == {"g": (2, 4, 0), "h": (0, 0, 4)}


def test_checks_return_failing_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("c", 3)], "k string, n int")
    assert checks.not_null(df, "k").count() == 1
    assert as_rows(checks.unique(df, ["k", "n"])) == [("2", "a", "1")]
    assert checks.passes(checks.unique_column(df.where("n > 1"), "k"))
    assert as_rows(checks.relationships(df, "k", spark.createDataFrame([("a",)], "id string"), "id")) == [("c", "3")]
    assert as_rows(checks.accepted_values(df, "k", ["c"])) == [("2", "a")]
