"""Tables behind a manifest: what a load rewrites, and what readers see when one dies."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from caselake.operators import versioned
from caselake.operators.versioned import PLACE, VersionedTable, hashed, valued
from tests.conftest import as_rows

SCHEMA = "k int, v string, p string"


def rows(spark, *given):
    return spark.createDataFrame(list(given), SCHEMA)


def files(path) -> set[str]:
    return {str(f.relative_to(path)) for f in Path(path).rglob("*.parquet")}


def test_rows_move_between_places_and_places_empty(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), valued("p"), keep=1)
    table.replace(rows(spark, (1, "a", "x"), (2, "b", "y/z"), (3, "c", "w"), (5, "n", None)), ["k"])
    assert set(table.manifest().places) == {"x", "y/z", "w", "none"}
    before = files(tmp_path)
    stale = rows(spark, (2, "", "y/z"), (2, "", "x"), (4, "", "q"))
    table.replace(rows(spark, (2, "B", "x"), (4, "d", "q")), ["k"], stale)
    assert as_rows(table.read()) == [("1", "x", "a"), ("2", "x", "B"), ("3", "w", "c"), ("4", "q", "d"), ("5", "None", "n")]
    assert set(table.manifest().places) == {"x", "w", "q", "none"}
    assert {f for f in before if f"{PLACE}=w" in f or f"{PLACE}=none" in f} <= files(tmp_path)
    table.delete(rows(spark, (1, "", "x"), (5, "", None)), ["k"])
    assert as_rows(table.read().select("k")) == [("2",), ("3",), ("4",)]


def test_a_load_of_one_key_writes_its_bucket_only(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), hashed(["k"], 16), keep=1)
    table.overwrite(spark.range(4000).select(F.col("id").cast("int").alias("k"), F.lit("v").alias("v"), F.lit("p").alias("p")))
    before = files(tmp_path)
    table.replace(rows(spark, (77, "new", "p")), ["k"])
    new, gone = files(tmp_path) - before, before - files(tmp_path)
    assert len({f.split(PLACE)[1].split("/")[0] for f in new}) == len({f.split(PLACE)[1].split("/")[0] for f in gone}) == 1
    assert table.read().count() == 4000 and as_rows(table.read().where("k = 77").select("v")) == [("new",)]
    # reading by key opens that bucket only
    assert len(table.read_keys(rows(spark, (77, "", ""))).inputFiles()) < len(table.read().inputFiles()) / 8


def test_two_thousand_places(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), valued("p"), keep=1)
    many = spark.range(4000).select(F.col("id").cast("int").alias("k"), F.lit("v").alias("v"), (F.col("id") % 2000).cast("string").alias("p"))
    table.overwrite(many)
    table.replace(many.withColumn("v", F.lit("w")).where("k % 2 = 0"), ["k"])
    assert len(table.manifest().places) == 2000
    assert as_rows(table.read().groupBy("v").count()) == [("2000", "v"), ("2000", "w")]


@pytest.mark.parametrize("dies_at", ["_write", "_save"])
def test_a_load_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch, dies_at):
    table = VersionedTable(spark, str(tmp_path / "t"), hashed(["k"], 4))
    table.overwrite(rows(spark, (1, "a", "x"), (2, "b", "x")), {"taken": [1]})
    real, calls = getattr(VersionedTable, dies_at), []

    def dying(self, *args):
        calls.append(args)
        out = real(self, *args) if dies_at == "_write" else None
        if len(calls) == (2 if dies_at == "_write" else 1):
            raise RuntimeError("lost")
        return out

    monkeypatch.setattr(VersionedTable, dies_at, dying)
    with pytest.raises(RuntimeError):
        table.replace(rows(spark, (1, "A", "x"), (3, "c", "x")), ["k"], meta={"taken": [1, 2]})
    monkeypatch.undo()
    assert as_rows(table.read().select("k", "v")) == [("1", "a"), ("2", "b")] and table.manifest().meta == {"taken": [1]}
    # the next load takes away what the dead one left
    table.replace(rows(spark, (1, "A", "x")), ["k"], meta={"taken": [1, 2]})
    assert as_rows(table.read().select("k", "v")) == [("1", "A"), ("2", "b")] and table.manifest().meta == {"taken": [1, 2]}
    named = {f.split("/")[0] for v in table.versions() for held in table.manifest(v).places.values() for f in held}
    assert {p.name for p in (tmp_path / "t" / "data").iterdir()} == named


def test_kept_versions_stay_readable_and_others_go(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), hashed(["k"], 2), keep=2)
    for n in range(4):
        table.replace(rows(spark, (1, f"v{n}", "x")), ["k"])
    assert table.versions() == [3, 4]
    assert [as_rows(table.read(v).select("v")) for v in (3, 4)] == [[("v2",)], [("v3",)]]
    assert len(files(tmp_path)) == 2


def test_a_table_can_be_rebuilt_from_itself(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "v"), F.lit("all"))
    table.overwrite(spark.range(3).toDF("a"))
    table.overwrite(table.read().selectExpr("a + 1 AS a"))
    assert as_rows(table.read()) == [("1",), ("2",), ("3",)]


def test_columns_may_come_later_but_not_change(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), hashed(["k"], 2))
    table.append(spark.createDataFrame([(1, "a")], "k int, v string"))
    table.append(spark.createDataFrame([(2, "b", 5)], "k int, v string, n int"), {"seen": 2})
    assert as_rows(table.read()) == [("1", "None", "a"), ("2", "5", "b")] and table.manifest().meta == {"seen": 2}
    with pytest.raises(ValueError):
        table.append(spark.createDataFrame([(3, 4)], "k int, v int"))
    table.replace(spark.createDataFrame([(1, "c")], "k int, v string"), ["k"])
    assert as_rows(table.read()) == [("1", "None", "c"), ("2", "5", "b")]
    loads = table.loads()
    table.append(spark.createDataFrame([(9, "z")], "k int, v string"))
    assert as_rows(table.read_new(loads).select("k")) == [("9",)]


def test_null_keys_have_a_place_and_an_empty_table_reads_as_empty(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), hashed(["k"], 3))
    table.replace(rows(spark).limit(0), ["k"])
    assert table.read().count() == 0 and table.read().columns == ["k", "v", "p"]
    for v in "ab":
        table.replace(rows(spark, (None, v, "x")), ["k"])
    assert as_rows(table.read().select("k", "v")) == [("None", "b")]
    assert versioned.KEEP >= 1
