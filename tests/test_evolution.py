"""Landing of files whose columns change, in every format."""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake import queries
from caselake.plans.pipeline import CaseLake
from caselake.sources.evolution import SchemaLog, header_names
from caselake.sources.files import with_lineage
from caselake.sources.registry import FILE_FORMATS, load_registry
from caselake.streaming import landing
from tests.conftest import as_rows


class Feed:
    """One source in one format, dropped and landed file by file."""

    def __init__(self, spark, tmp_path, fmt, **options):
        self.spark, self.fmt, self.options = spark, fmt, options
        self.spec = dataclasses.replace(load_registry()["event_officers"], name=f"s_{fmt}", subfolder="in put", file_format=fmt)
        self.root, self.table, self.state = str(tmp_path / "drop"), str(tmp_path / "landed"), str(tmp_path / "state")

    def drop(self, name, rows, schema):
        writer = self.spark.createDataFrame(rows, schema).coalesce(1).write.option("header", "true").option("ignoreNullFields", "true")
        writer.format(self.fmt).save(f"{self.root}/{self.spec.subfolder}/{name}")

    def land(self):
        landing.land(self.spark, self.spec, self.root, self.table, self.state, **self.options).awaitTermination()
        return landing.read_table(self.spark, self.table)


@pytest.mark.parametrize("fmt", FILE_FORMATS)
def test_a_new_column_in_the_middle_widens_the_schema(spark, tmp_path, fmt):
    feed = Feed(spark, tmp_path, fmt)
    feed.drop("one", [("1", "Ann")], "id string, name string")
    assert as_rows(feed.land().select("id", "name")) == [("1", "Ann")]
    feed.drop("two", [("2", "x", "Bo"), ("3", None, "Cy")], "id string, extra string, name string")
    feed.drop("three", [("Di", "4")], "NAME string, id string")
    got = feed.land()
    assert as_rows(got.select("extra", "id", "name")) == [("None", "1", "Ann"), ("None", "3", "Cy"), ("None", "4", "Di"), ("x", "2", "Bo")]
    assert as_rows(got.select("_rescued_data").distinct()) == [("None",)]
    log = SchemaLog(spark, f"{feed.table}/{landing.SCHEMAS}")
    assert log.versions() == [1, 2] and "extra" not in log.read(1).names and log.read().names[-1] == "extra"
    assert as_rows(feed.land()) == as_rows(got)  # nothing new, nothing twice


@pytest.mark.parametrize("fmt", FILE_FORMATS)
def test_unknown_columns_and_misfits_are_rescued(spark, tmp_path, fmt):
    feed = Feed(spark, tmp_path, fmt, evolve=False, column_types=True)
    feed.drop("one", [(1, "Ann")], "id int, name string")
    assert feed.land().schema["id"].dataType in (T.IntegerType(), T.LongType())
    feed.drop("two", [("7", "a", "Bo"), ("x8", "b", "Cy"), ("9", None, "Di")], "id string, extra string, name string")
    got = {r["name"]: (r["id"], r["_rescued_data"] and json.loads(r["_rescued_data"])) for r in feed.land().collect()}
    assert got == {"Ann": (1, None), "Bo": (7, {"extra": "a"}), "Cy": (None, {"id": "x8", "extra": "b"}), "Di": (9, None)}
    assert "extra" not in feed.land().columns


def test_a_type_never_changes(spark, tmp_path):
    feed = Feed(spark, tmp_path, "parquet")
    feed.drop("one", [(1, 2.5)], "id int, n double")
    feed.land()
    feed.drop("two", [(2**40, "n/a"), (3, "4.5")], "id long, n string")
    feed.drop("three", [(4, [1, 2])], "id int, n array<int>")
    got = feed.land()
    assert [f.dataType for f in got.schema][:2] == [T.IntegerType(), T.DoubleType()]
    assert as_rows(got.select("id", "n", "_rescued_data")) == sorted(
        [("{\"id\":1099511627776,\"n\":\"n/a\"}", "None", "None"), ("None", "1", "2.5"), ("None", "3", "4.5"), ("{\"n\":[1,2]}", "4", "None")]
    )


def test_json_lines_of_any_shape(spark, tmp_path):
    feed = Feed(spark, tmp_path, "json")
    folder = tmp_path / "drop" / "in put"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('{"id":1,"at":{"x":[1,2]}}\n\nnot json\n{"ID":"2","id":"3"}\n{"_source_file":"mine","a.b":true}\n')
    landed = feed.land().withColumnRenamed("ID", "id")  # one column for both spellings
    got = {r["id"]: r.asDict() for r in landed.collect()}
    assert got["1"]["at"] == '{"x":[1,2]}'
    both = next(r for r in got.values() if r["_rescued_data"] and "ID" in r["_rescued_data"] or r["_rescued_data"] and '"id"' in r["_rescued_data"])
    assert {both["ID"] if "ID" in both else both["id"], *json.loads(both["_rescued_data"]).values()} == {"2", "3"}
    rest = landed.where("id IS NULL").collect()
    assert {(r["_source_file_"], r["a.b"], r["_rescued_data"]) for r in rest} == {("mine", "true", None), (None, None, '{"_corrupt_record":"not json"}')}


def test_headers(spark, tmp_path):
    assert header_names("\ufeffa,,A,b,_source_file") == ["a", "_c1", "_c2", "b", "_source_file_"]
    feed = Feed(spark, tmp_path, "csv")
    folder = tmp_path / "drop" / "in put"
    folder.mkdir(parents=True)
    (folder / "empty.csv").write_text("")
    (folder / "header only.csv").write_text("id,name\n")
    assert feed.land().count() == 0
    (folder / "per%20cent.csv").write_text('id,name\n1,"a,b"\n2,x,too many\n')
    got = feed.land()
    assert as_rows(got.select("id", "name")) == [("1", "a,b"), ("2", "x")]
    assert as_rows(got.where("id = 2").select("_rescued_data")) == [('{"_corrupt_record":"2,x,too many"}',)]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    import shutil

    feed = Feed(spark, tmp_path, "csv")
    feed.drop("one", [("1", "Ann")], "id string, name string")
    feed.land()
    shutil.move(tmp_path / "state" / "s_csv" / "checkpoint" / "commits", tmp_path / "commits")  # as if it had died before the commit
    feed.drop("two", [("2", "Bo")], "id string, name string")
    got = feed.land()
    assert as_rows(got.select("id", "name", F.col(landing.BATCH).alias("zbatch"))) == [("1", "Ann", "0"), ("2", "Bo", "1")]


@pytest.mark.parametrize("name", ["plain", "per%20cent and blank"])
def test_dates_are_parsed_once_a_file(spark, tmp_path, name):
    """The listed paths are those the rows carry, but for marks that Spark writes otherwise; every row gets its date either way."""
    spec, folder = load_registry()["charges"], tmp_path / name
    for stamp in ("20240102030405", "20240203040506", "nodate"):
        (folder / f"drop=charges_{stamp}.csv").mkdir(parents=True)
        (folder / f"drop=charges_{stamp}.csv" / "part.csv").write_text("pid\n1\n2\n")
    rows = spark.read.schema("pid string").option("header", "true").option("recursiveFileLookup", "true").csv(str(folder))
    spec = dataclasses.replace(spec, date_pattern=r"charges_(\d{14})\.csv")
    paths = sorted(r["path"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(folder)).select("path").collect())
    own = with_lineage(rows, spec).drop("_ingested_at")
    assert (paths == sorted(r["_source_file"] for r in own.select("_source_file").distinct().collect())) == (name == "plain")
    for listed in (paths, paths[:1], [*paths, paths[0]]):
        found = with_lineage(rows, spec, files=listed).drop("_ingested_at")
        assert found.columns == own.columns and as_rows(found) == as_rows(own)
    assert own.select("_file_date").distinct().count() == 3


@pytest.fixture
def together(monkeypatch):
    """Makes steps wait until as many of them run at the same time; one after the other, they fail."""

    def hold(name, count):
        meet, real = threading.Barrier(count, timeout=60), getattr(landing, name)

        def step(*args, **options):
            if len(seen) < count:
                seen.append(args)
                meet.wait()
            return real(*args, **options)

        seen: list = []
        monkeypatch.setattr(landing, name, step)

    return hold


def test_sources_are_dropped_side_by_side(spark, tmp_path, together):
    def rows(source):
        names = lake.registry[source].business_columns
        full = [(*["a"] * len(names), d) for d in (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1))]
        return spark.createDataFrame(full, ", ".join(f"`{n}` string" for n in names) + ", _file_date timestamp")

    lake = CaseLake(spark, rows, dt.date(2026, 1, 1))
    together("write_drops", len(lake.registry))
    got = queries.land_all_sources(lake)
    assert as_rows(got) == sorted(("2", "0", "3", s) for s in lake.registry)


def test_formats_are_landed_side_by_side(spark, together):
    def rows(source):
        names = lake.registry[source].business_columns
        return spark.createDataFrame([(str(k), *["a"] * (len(names) - 1)) for k in range(4)], ", ".join(f"`{n}` string" for n in ("pid", *[n for n in names if n != "pid"])))

    lake = CaseLake(spark, rows, dt.date(2026, 1, 1))
    together("land", len(FILE_FORMATS))
    got = queries.stream_landing_drift(lake).select("format", "pid", "plea")
    pleas = {"0": "None", "1": "P1", "2": "None", "3": "P0"}
    assert as_rows(got) == sorted((f, p, plea) for f in FILE_FORMATS for p, plea in pleas.items())
