"""Files, streams, documents, tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caselake.sources import documents, files, tables
from caselake.sources.fixtures import Landing
from caselake.sources.registry import FILE_FORMATS, load_registry, seed
from caselake.streaming import landing
from tests.conftest import as_rows


def test_registry_from_control_files_keeps_active_sources(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "source_name,subfolder,file_format,date_pattern,date_format,natural_key,active\n"
        'a,fa,csv,(\\d{14})\\.csv,,"k1, k2",true\nb,fb,json,x,yyyy,k,false\n'
    )
    (tmp_path / "c.csv").write_text(
        "source_name,source_column,target_column,data_type,nullable,active\n"
        "a,k1,key_one,STRING,false,true\na,n,amount,INTEGER,true,true\na,old,old,STRING,true,false\na,at,at,DATETIME,true,true\n"
    )
    specs = load_registry(spark, str(tmp_path / "t.csv"), str(tmp_path / "c.csv"))
    assert list(specs) == ["a"]
    spec = specs["a"]
    assert spec.natural_key == ("k1", "k2") and spec.date_format == "yyyyMMddHHmmss" and spec.target_key == ("key_one", "k2")
    assert [(c.target, c.spark_type, c.nullable) for c in spec.columns] == [("key_one", "string", False), ("amount", "int", True), ("at", "timestamp", True)]


def test_packaged_seeds(spark):
    specs = load_registry()
    assert len(specs) == 7 and all(s.file_format in FILE_FORMATS for s in specs.values())
    assert sum(len(s.columns) for s in specs.values()) == 75
    assert seed(spark, "public_holidays").count() == 135
    assert seed(spark, "court_event_type_mapping").count() == 9


@pytest.mark.parametrize(
    "name,pattern,fmt,expected",
    [
        ("x_20230105093000.csv", r"(\d{14})\.csv", "yyyyMMddHHmmss", dt.datetime(2023, 1, 5, 9, 30)),
        ("Info_Extracted_20260101_0930.csv", r"(\d{14})\.csv", "yyyyMMddHHmmss", None),
        ("Info_Extracted_20260101_0930.csv", r"(\d{8}_\d{4})\.csv", "yyyyMMdd_HHmm", dt.datetime(2026, 1, 1, 9, 30)),
        ("x_99999999999999.csv", r"(\d{14})\.csv", "yyyyMMddHHmmss", None),
    ],
)
def test_file_date(spark, name, pattern, fmt, expected):
    assert spark.createDataFrame([(name,)], "f string").select(files.file_date("f", pattern, fmt)).first()[0] == expected


def test_rescue_keeps_what_does_not_fit(spark):
    df = spark.createDataFrame([("1", "2024-01-01", None), ("x", "n/a", None), (None, None, "1,2,3,4")], "n string, d string, bad string")
    got = files.rescue(df, {"n": "int", "d": "date"}, "bad").collect()
    assert [(r.n, r.d, r._rescued_data) for r in got] == [
        (1, dt.date(2024, 1, 1), None),
        (None, None, '{"n":"x","d":"n/a"}'),
        (None, None, '{"bad":"1,2,3,4"}'),
    ]


def drop(root, name, lines):
    folder = root / "event_officers"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


HEADER = "courteventid,officerid,name,division"


def test_stream_takes_each_file_once_and_keeps_bad_lines(spark, tmp_path):
    spec, root = load_registry()["event_officers"], tmp_path / "drops"
    table, state = str(tmp_path / "landed"), str(tmp_path / "state")
    drop(root, "eo_20240101000000.csv", [HEADER, "1,7,Ann,D1", "2,8,,D1"])
    landing.land(spark, spec, str(root), table, state).awaitTermination()
    landing.land(spark, spec, str(root), table, state).awaitTermination()
    assert spark.read.parquet(table).count() == 2
    drop(root, "eo_20240102000000.csv", [HEADER, "3,9,Bo,D2,extra"])
    landing.land(spark, spec, str(root), table, state).awaitTermination()
    got = {r.courteventid: r for r in landing.read_table(spark, table).collect()}
    assert set(got) == {"1", "2", "3"}
    assert got["1"]._file_date == dt.datetime(2024, 1, 1) and got["1"]._source_file.endswith("eo_20240101000000.csv")
    assert got["2"].name is None and got["1"]._rescued_data is None
    assert "3,9,Bo,D2,extra" in got["3"]._rescued_data


def test_streams_of_all_formats_run_side_by_side(spark, tmp_path):
    import dataclasses

    base = load_registry()["event_officers"]
    rows = spark.createDataFrame([("1", "7", "Ann", "D1")], "courteventid string, officerid string, name string, division string")
    specs = [dataclasses.replace(base, name=f"s_{f}", subfolder=f, file_format=f) for f in FILE_FORMATS]
    rows.write.csv(str(tmp_path / "in/csv"), header=True)
    rows.write.json(str(tmp_path / "in/json"))
    rows.write.parquet(str(tmp_path / "in/parquet"))
    landing.land_all(spark, specs, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"))
    for s in specs:
        assert as_rows(spark.read.parquet(str(tmp_path / "out" / s.name)).select("courteventid", "division")) == [("1", "D1")]


def test_schema_is_inferred_once(spark, tmp_path):
    spec, root = load_registry()["event_officers"], tmp_path / "drops"
    drop(root, "eo_20240101000000.csv", [HEADER, "1,7,Ann,D1"])
    path = str(tmp_path / "schema")
    first = landing.landing_schema(spark, spec, str(root / "event_officers"), path, column_types=True)
    assert first["courteventid"].dataType.simpleString() == "int"
    drop(root, "eo_20240102000000.csv", [HEADER, "x,7,Ann,D1"])
    assert landing.landing_schema(spark, spec, str(root / "event_officers"), path, column_types=True) == first


def test_batch_landing_equals_stream(spark, tmp_path):
    spec, root = load_registry()["event_officers"], tmp_path / "drops"
    drop(root, "eo_20240101000000.csv", [HEADER, "1,7,Ann,D1", "2,8,,D1"])
    landing.land(spark, spec, str(root), str(tmp_path / "t"), str(tmp_path / "s")).awaitTermination()
    batch = files.read_landing(spark, spec, str(root / spec.subfolder))
    columns = ["courteventid", "name", "_rescued_data", "_source_file", "_file_date"]
    assert as_rows(batch.select(*columns)) == as_rows(spark.read.parquet(str(tmp_path / "t")).select(*columns))


def test_document_folder(spark, tmp_path):
    (tmp_path / "DAC-000001-2023.md").write_text("line one\nline two")
    (tmp_path / "MAC-000002-2023.md").write_text("other")
    (tmp_path / "notes.txt").write_text("skip")
    got = documents.scan_folder(spark, str(tmp_path))
    assert as_rows(got) == [("DAC-000001-2023", "line one\nline two"), ("MAC-000002-2023", "other")]
    assert as_rows(documents.scan_document(spark, str(tmp_path), "MAC-000002-2023")) == [("MAC-000002-2023", "other")]


def test_sample_is_reproducible_and_capped(spark):
    df = spark.range(50)
    first = as_rows(documents.sample(df, "id", 10))
    assert first == as_rows(documents.sample(df.repartition(7), "id", 10)) and len(first) == 10
    assert documents.sample(df, "id", 10, seed=1).exceptAll(documents.sample(df, "id", 10)).count() > 0
    assert documents.sample(df, "id", 500).count() == 50


def test_csv_keeps_nulls_apart_from_empty_text(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("", "b,c"), (None, 'q"x')], "x string, y string")
    tables.write_csv(df, str(tmp_path / "c"), single_file=True)
    back = spark.read.schema(df.schema).csv(str(tmp_path / "c"), header=True, nullValue="", emptyValue='""')
    assert back.count() == 3 and as_rows(back.where("y = 'b,c'").select("y")) == [("b,c",)]


def test_statements_parameters_and_scans(spark):
    tables.execute(spark, "CREATE OR REPLACE TEMP VIEW nums AS SELECT id FROM range(10)")
    assert tables.scan_table(spark, "nums").count() == 10
    assert tables.scan_table(spark, "nums", limit=3).count() == 3
    got = tables.query(spark, "SELECT id FROM {n} WHERE id BETWEEN :lo AND :hi", {"lo": 2, "hi": 4}, n=spark.table("nums"))
    assert as_rows(got) == [("2",), ("3",), ("4",)]


def test_comments_survive_parquet(spark, tmp_path):
    df = tables.with_comments(spark.range(1), {"id": "the key"})
    df.write.parquet(str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).schema["id"].metadata["comment"] == "the key"


def test_partitioned_write_cuts_a_dominant_value(spark, tmp_path):
    df = spark.range(1000).select(F.when(F.col("id") < 900, "hot").otherwise("cold").alias("p"), "id")
    tables.write_partitioned(df, str(tmp_path / "t"), ["p"])
    assert as_rows(spark.read.parquet(str(tmp_path / "t")).groupBy("p").count()) == [("100", "cold"), ("900", "hot")]


def test_long_charge_numbers_stay_apart(spark):
    """At this size charge numbers have seven digits; none may be cut to six."""
    charges = Landing(spark, "/root/testdata/sf0.1").charges()
    assert charges.select("pid", "chargeno").distinct().count() == 546_208
