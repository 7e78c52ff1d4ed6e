"""Registered queries against their SQL on a second engine, and the shape of their plans."""

from __future__ import annotations

import datetime as dt

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from caselake.operators.watermark import newer_than
from caselake.queries import QUERIES
from caselake.sources.fixtures import Landing
from oracle.queries import ORACLE
from tools.check import compare, connect

CHECKED = (
    "bronze_cases qa_events dim_date dim_officer dim_case_reference officer_history assignment_snapshot fact_event_officer fact_case_charge fact_case_officer "
    "case_officer_workload case_offence_distribution event_offence_hearing_days hearing_days man_days_yearly offence_status_pivot workload_by_officer "
    "ongoing_case_choice report_fields report_issues model_answer_entities upsert_charges delete_voided_events rescued_rows csv_roundtrip"
).split()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, folder, name):
    verdict, note = compare(spark, con, folder, name, queries()[name], oracle_sql()[name])
    assert verdict == "ok", note


def test_every_query_has_sql_and_the_other_way_round():
    assert set(QUERIES) == set(ORACLE)
    assert set(oracle_sql()) <= set(queries()) and set(QUERIES) <= set(queries())


def test_entry_runs(spark):
    assert entry(spark).columns == ["offence_group", "case_status", "charge_status", "charges"]
    assert entry(spark).count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_watermark_is_pushed_into_the_scan(spark, folder, tmp_path):
    path = str(tmp_path / "charges")
    Landing(spark, folder)("charges").write.parquet(path)
    text = plan(newer_than(spark.read.parquet(path), "_ingested_at", dt.datetime(1999, 1, 1)).select("pid"))
    assert "GreaterThan(_ingested_at,1999-01-01T00:00)" in text
    assert "ReadSchema: struct<pid:string,_ingested_at:timestamp_ntz>" in text


def test_no_plan_multiplies_rows_or_runs_python(spark, folder):
    for name in ("fact_case_charge", "fact_case_officer", "fact_event_officer", "case_offence_distribution", "event_offence_hearing_days", "report_issues"):
        text = plan(queries()[name](spark, folder))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "Python" not in text and "Pandas" not in text, name


def test_only_fixed_lists_are_broadcast_by_hint(spark, folder):
    """With automatic broadcasts off, what is still broadcast is the event-type mapping."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, expected in (("fact_case_charge", 0), ("fact_event_officer", 1), ("case_offence_distribution", 0), ("event_offence_hearing_days", 0)):
            assert plan(queries()[name](spark, folder)).count("BroadcastHashJoin") == expected, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
