"""The incremental build: what arrived since the last run flows through every layer.

Each run finds the keys its new rows touch, recomputes those keys whole from the
quality layer and replaces them in the star schema, so that a run of loads gives
the tables a full rebuild would give. The first run touches every key and builds the
star schema whole. Marts are rebuilt.

All tables are versioned (``operators.versioned``): facts and dimensions lie in hash
buckets of the key they are replaced by, so a load rewrites the buckets it touches, and
readers change over to a load at once. What a layer has taken from the layer before is
kept with its data: bronze remembers the deliveries of landing, the quality layer the
loads of bronze. No mark is found by scanning history, and a row that arrives late is
loaded whatever its ingest time.

Persons follow from an index of who names them, kept in buckets of the name: a load looks
into the buckets of the names it brings or takes away, a person nobody names any more goes,
and only names whose persons changed re-open charges. What a run learns by comparing with
tables it then replaces is written to its open folder first; a run that dies is run again
and finds it there.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.functions.dates import EPOCH_WATERMARK
from caselake.functions.keys import surrogate_key
from caselake.operators.bronze import to_bronze
from caselake.operators.dedup import latest_by
from caselake.operators.joins import touched
from caselake.operators.merge import minus_keys, path_exists
from caselake.operators.quality import KEYS, to_quality
from caselake.operators.versioned import BUCKETS, VersionedTable, hashed, valued
from caselake.operators.watermark import newer_than
from caselake.plans import dims, facts, marts
from caselake.plans.comments import COMMENTS
from caselake.plans.pipeline import SOURCES
from caselake.session import configure, side_by_side
from caselake.sources.registry import SourceSpec, load_registry
from caselake.sources.tables import with_comments
from caselake.streaming.landing import BATCH

FILE_DAY = "_file_day"
# Loads a bucket of the index holds side by side before it is rewritten.
LOADS_SIDE_BY_SIDE = 8
SOURCES_AT_ONCE = len(SOURCES)
STAMP = "_bronze_loaded_at"
DELIVERY = ["_source_file", "_ingested_at"]
PERSON = ["full_name", "gender", "date_of_birth"]
#: What the rows of each table are replaced by, and so placed by.
REPLACED_BY = {
    "dim_case": "case_pid",
    "dim_officer": "officer_id",
    "dim_person": "full_name",
    "fact_event_officer": "court_event_id",
    "fact_case_charge": "case_pid",
    "fact_case_officer": "case_pid",
}


class Nightly:
    """One lake root; ``run`` loads whatever is new. ``buckets`` holds for the life of the lake."""

    def __init__(self, spark: SparkSession, root: str, registry: dict[str, SourceSpec] | None = None, buckets: int = BUCKETS):
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.registry = registry or load_registry()
        self.buckets = buckets
        self.opened = uuid.uuid4().hex[:12]
        self._listed: dict[tuple[str, str], tuple[int, DataFrame]] = {}

    def table(self, layer: str, name: str) -> VersionedTable:
        place: Column
        if layer == "silver":
            place = hashed([REPLACED_BY[name]], self.buckets)
        elif layer == "index":
            place = hashed(["full_name"], self.buckets)
        elif layer in ("bronze", "qa"):
            place = valued(FILE_DAY)
        else:
            place = F.lit("all")
        return VersionedTable(self.spark, f"{self.root}/{layer}/{name}", place)

    def read(self, layer: str, name: str) -> DataFrame:
        """The newest version; its folders are listed once, whoever reads it."""
        table = self.table(layer, name)
        newest = max(table.versions(), default=0)
        if self._listed.get((layer, name), (0,))[0] != newest or not newest:
            self._listed[layer, name] = newest, table.read(newest or None)
        return self._listed[layer, name][1]

    def run(self, landing: Callable[[str], DataFrame], as_of: dt.date, loaded_at: dt.datetime) -> None:
        """Load all landing rows no earlier run has taken. ``loaded_at`` must grow from run to run."""
        done, died = self.last_run(), bool(self._runs_open())

        def load(source: str) -> None:
            self.load_bronze(source, landing(source), loaded_at)
            self.load_quality(source, as_of, loaded_at)

        side_by_side(*[partial(load, s) for s in SOURCES], at_once=SOURCES_AT_ONCE)  # the sources are independent Spark jobs
        # rows that are new lie in files the last run has not seen; the mark tells them from rows rewritten with them
        fresh = {s: newer_than(self.table("qa", s).read_new(done["loads"].get(s, [])), STAMP, done["mark"]) for s in SOURCES}
        if all(side_by_side(*[rows.isEmpty for rows in fresh.values()])):
            self._remove("_open")
            return
        if done["loads"]:
            cases = self._keep("touched_cases", self.touched_cases(fresh))
            changed, names = side_by_side(lambda: self.load_dims(fresh, cases), lambda: self.load_persons(fresh, died))
            self.load_facts(fresh, cases, changed, names)
        else:
            self.load_whole()
        self.build_marts(as_of)
        record = {"mark": loaded_at.isoformat(), "loads": {s: self.table("qa", s).loads() for s in SOURCES}}
        self.table("runs", "done").append(self.spark.createDataFrame([(loaded_at.isoformat(),)], "mark string"), record)
        self._remove("_open")

    def last_run(self) -> dict:
        """Mark of the last completed run, and the loads of each quality table it has seen."""
        runs = self.table("runs", "done")
        meta = runs.manifest().meta if runs.exists() else {}
        return {"mark": dt.datetime.fromisoformat(meta["mark"]) if meta else EPOCH_WATERMARK, "loads": meta.get("loads", {})}

    # --- bronze and quality

    def load_bronze(self, source: str, landing: DataFrame, loaded_at: dt.datetime) -> None:
        """Append the deliveries bronze has not taken.

        A landing table that numbers its batches is read batch by batch. Otherwise a
        delivery is a file and its ingest time; those taken are rows of a ledger, which
        count once bronze names their load.
        """
        bronze = self.table("bronze", source)
        meta = bronze.manifest().meta if bronze.exists() else {}
        if BATCH in landing.columns:
            taken = set(meta.get("batches", []))
            new = sorted({r[BATCH] for r in landing.select(BATCH).distinct().collect()} - taken)
            if new or not meta:
                self._append_bronze(source, landing.where(F.col(BATCH).isin(new)), loaded_at, {"batches": sorted(taken | set(new))})
            return
        ledger = self.table("ledger", source)
        fresh = landing
        if meta.get("ledger"):
            known = ledger.read().where(F.col("load").isin(meta["ledger"]))
            fresh = minus_keys(landing, known, DELIVERY)
        load = uuid.uuid4().hex[:12]
        deliveries = self._keep(f"deliveries_{source}", fresh.select(*DELIVERY).distinct().withColumn("load", F.lit(load)))
        if meta and deliveries.isEmpty():
            return
        ledger.append(deliveries)
        self._append_bronze(source, fresh, loaded_at, {"ledger": [*meta.get("ledger", []), load]})

    def _append_bronze(self, source: str, rows: DataFrame, loaded_at: dt.datetime, meta: dict) -> None:
        typed = to_bronze(rows, self.registry[source], None, _literal(loaded_at))
        self.table("bronze", source).append(typed.withColumn(FILE_DAY, F.to_date("_file_date")), meta)

    def load_quality(self, source: str, as_of: dt.date, loaded_at: dt.datetime) -> None:
        """Check the loads of bronze that are new and replace rows by key; of rows of one key the last ingested stays."""
        bronze, quality = self.table("bronze", source), self.table("qa", source)
        loads, held = bronze.loads(), quality.manifest()
        taken = set(held.meta["taken"]) if held else set()
        if held and taken.issuperset(loads):
            return
        # a run that died after bronze leaves its rows to the next one: a key may then come twice
        once = len(set(loads) - taken) < 2 and self._unique_in_bronze(source)

        def rows(places: set[str]) -> DataFrame:
            checked = to_quality(bronze.read_new(taken, places).drop(FILE_DAY), source, as_of, loaded_at=_literal(loaded_at))
            latest = checked if once else latest_by(checked, KEYS[source], ["_ingested_at"])
            return latest.withColumn(FILE_DAY, F.to_date("_file_date"))

        # the file date is part of every key, so a key never leaves its day: only days both layers hold are compared
        new = bronze.places_new(taken) if loads else set()
        met = new & set(held.places if held else ())
        if not met:
            quality.append(rows(new), {"taken": loads}, dealt=once)
            return
        again = self._keep(f"checked_{source}", rows(met))
        known = self._keep(f"known_{source}", touched_null_safe(quality.read(places=met), again, KEYS[source]))
        again = latest_by(again.unionByName(known.select(*again.columns)), KEYS[source], ["_ingested_at"])
        quality.replace(again.unionByName(rows(new - met)) if new - met else again, KEYS[source], meta={"taken": loads})

    def _unique_in_bronze(self, source: str) -> bool:
        """Whether a load of bronze, which holds a natural key once a file date, holds a key of the quality layer once."""
        spec = self.registry[source]
        kept = {c.source: c.target for c in spec.columns if c.spark_type == "string"}  # a cast may make one of two keys
        return all(kept.get(k) in KEYS[source] for k in spec.natural_key)

    # --- keys a load touches

    def touched_cases(self, fresh: dict[str, DataFrame]) -> DataFrame:
        """Cases with anything new in any feed; extracted entities name the case by number."""
        by_pid = [fresh[s].select("case_pid") for s in ("cases", "assignments", "charges", "events")]
        numbered = fresh["entities"].select("case_no").distinct()
        by_number = touched(self.read("qa", "cases").select("case_no", "case_pid"), numbered, "case_no").select("case_pid")
        return reduce(DataFrame.union, [*by_pid, by_number]).distinct()

    # --- star schema

    def load_whole(self) -> None:
        """Until a run has completed, every key is touched: the star schema is built from the whole quality layer."""
        qa = {s: self.read("qa", s) for s in SOURCES}
        of_case = {s: qa[s].where(F.col("case_pid").isNotNull()) for s in ("cases", "assignments", "charges", "events")}
        named = reduce(DataFrame.unionByName, [mentions(qa[s], s) for s in ("cases", "entities")])
        seen = qa["assignments"].where(F.col("officer_id").isNotNull())
        side_by_side(
            lambda: self._replace("dim_officer", dims.dim_officer(seen)),
            lambda: self._replace("dim_case", dims.dim_case(of_case["cases"])),
            lambda: self._replace("dim_person", dims.dim_person(qa["cases"], qa["entities"])),
            lambda: self.table("index", "person_names").overwrite(named.where("is_valid_row").drop("is_valid_row")),
        )
        events, seats = (qa[s].where(F.col("court_event_id").isNotNull()) for s in ("events", "event_officers"))
        side_by_side(lambda: self.load_assigned(of_case, qa["entities"]), lambda: self.load_events(events, seats))

    def load_dims(self, fresh: dict[str, DataFrame], cases: DataFrame) -> DataFrame:
        """Replace cases and officers; returns the officers whose versions changed."""

        def load_officers() -> DataFrame:
            officers = fresh["assignments"].select("officer_id").distinct()
            seen = touched(self.read("qa", "assignments"), officers, "officer_id")
            versions = self._keep("officer_versions", dims.dim_officer(seen))
            changed = self._learn("changed_officers", self._changed(versions, officers))
            self._replace("dim_officer", versions, officers)
            return changed

        def load_cases() -> None:
            self._replace("dim_case", dims.dim_case(touched(self.read("qa", "cases"), cases, "case_pid")), cases)

        return side_by_side(load_officers, load_cases)[0]

    def _changed(self, versions: DataFrame, officers: DataFrame) -> DataFrame:
        """Officers whose versions, and so the keys facts point to, are not those of the last load."""
        columns = ["officer_skey", "officer_id", *dims.TRACKED_OFFICER]
        new = versions.select(*columns)
        known = self.table("silver", "dim_officer")
        if not known.exists():
            return new.select("officer_id").distinct()
        old = touched(known.read_keys(officers), officers, "officer_id").select(*columns)
        return new.exceptAll(old).union(old.exceptAll(new)).select("officer_id").distinct()

    def load_persons(self, fresh: dict[str, DataFrame], died: bool) -> DataFrame:
        """Bring the index of names and the person dimension up to date; returns the names whose persons changed.

        Rows leave the index when a load met their key again, or when a run that ``died`` may
        have put there what this one brings. Else the load is only added.
        """
        index, persons = self.table("index", "person_names"), self.table("silver", "dim_person")
        now, before = [], []
        for s in ("cases", "entities"):
            now.append(mentions(fresh[s], s))
            known = self._learned(f"known_{s}")
            if known is not None and not known.isEmpty():  # rows a load met under the same key: what they said goes, what stands there now is said again
                before.append(mentions(known, s).select("full_name", "row_key"))
                now.append(mentions(touched_null_safe(self.table("qa", s).read_keys(known), known, KEYS[s]), s))
        arrived, added = reduce(DataFrame.unionByName, now), not (before or died) and index.depth() < LOADS_SIDE_BY_SIDE
        if added:
            names = self._learn("names", arrived.select("full_name").distinct())
            index.append(arrived.where("is_valid_row").drop("is_valid_row"))
        else:
            arrived = self._keep("mentions", arrived.distinct())
            stale = self._keep("stale_mentions", reduce(DataFrame.union, [arrived.select("full_name", "row_key"), *before]).distinct())
            names = self._learn("names", stale.select("full_name").distinct())
            index.replace(arrived.where("is_valid_row").drop("is_valid_row"), ["full_name", "row_key"], stale)
        held = index.read_keys(names).join(names.select(F.col("full_name").alias("_name")), F.col("full_name").eqNullSafe(F.col("_name")), "left_semi")
        new = held.groupBy(*PERSON).agg(F.max("_file_date").alias("_file_date"), F.max(STAMP).alias(STAMP))
        new = self._keep("persons", new.select(surrogate_key(*PERSON).alias("person_skey"), *PERSON, "_file_date", STAMP))
        identity = ["full_name", "person_skey"]
        old = persons.read_keys(names) if persons.exists() else new.limit(0)
        old = old.join(names.select(F.col("full_name").alias("_name")), F.col("full_name").eqNullSafe(F.col("_name")), "left_semi").select(*identity)
        differ = new.select(*identity).exceptAll(old).union(old.exceptAll(new.select(*identity)))
        changed = self._learn("changed_names", differ.select("full_name").distinct())
        self._replace("dim_person", new, names)
        return changed

    def spread(self, cases: DataFrame, changed: DataFrame, names: DataFrame) -> DataFrame:
        """Touched cases, those of changed officers, and those that name a person of a name whose persons changed."""
        of_officers = touched(self.read("qa", "assignments"), changed, "officer_id").select("case_pid")
        named = touched(self.table("index", "person_names").read_keys(names), names, "full_name")
        numbers = named.select("case_no").distinct()
        of_names = touched(self.read("qa", "cases").select("case_no", "case_pid"), numbers, "case_no").select("case_pid")
        return self._keep("spread_cases", cases.select("case_pid").union(of_officers).union(of_names).distinct())

    def load_facts(self, fresh: dict[str, DataFrame], cases: DataFrame, changed: DataFrame, names: DataFrame) -> None:
        cases = self.spread(cases, changed, names)
        qa = {s: self.read("qa", s) for s in SOURCES}
        of_case = {s: touched(qa[s], cases, "case_pid") for s in ("cases", "assignments", "charges", "events")}
        numbers = of_case["cases"].select("case_no").distinct()
        entities = touched(qa["entities"], numbers, "case_no")
        # an event is recomputed when it, its officers or its case arrived, or an officer's versions changed
        attended = touched(qa["event_officers"], changed, "officer_id")
        ids = [fresh["events"], fresh["event_officers"], of_case["events"], attended]

        def load_events() -> None:
            events = self._keep("touched_events", reduce(DataFrame.union, [d.select("court_event_id") for d in ids]).distinct())
            self.load_events(touched(qa["events"], events, "court_event_id"), touched(qa["event_officers"], events, "court_event_id"), events)

        side_by_side(lambda: self.load_assigned(of_case, entities, cases), load_events)

    def load_events(self, events: DataFrame, seats: DataFrame, stale: DataFrame | None = None) -> None:
        """Replace the events in ``stale`` (by default, all) by those given and their officers."""
        rows = facts.fact_event_officer(events, seats, self.read("qa", "cases"), self.read("silver", "dim_officer"))
        self._replace("fact_event_officer", rows, stale)

    def load_assigned(self, of_case: dict[str, DataFrame], entities: DataFrame, stale: DataFrame | None = None) -> None:
        """Replace the charges, then the assignments, of the cases in ``stale`` (by default, of all)."""
        charges = facts.fact_case_charge(of_case["charges"], of_case["cases"], entities, self.read("silver", "dim_person"))
        self._replace("fact_case_charge", charges, stale)
        written = self.table("silver", "fact_case_charge")
        counted = written.read() if stale is None else touched(written.read_keys(stale), stale, "case_pid")
        profile = facts.case_profile(of_case["cases"], of_case["events"], entities, counted)
        history = facts.assignment_history(of_case["assignments"])
        self._replace("fact_case_officer", facts.fact_case_officer(history, profile, self.read("silver", "dim_officer")), stale)

    def build_marts(self, as_of: dt.date) -> None:
        t = {n: self.read("silver", n) for n in ("fact_case_charge", "fact_event_officer", "fact_case_officer", "dim_case", "dim_officer")}
        charge, event, officer = t["fact_case_charge"], t["fact_event_officer"], t["fact_case_officer"]
        built = {
            "case_officer_workload": marts.case_officer_workload(officer, event, t["dim_officer"], as_of),
            "case_offence_distribution": marts.case_offence_distribution(charge, t["dim_case"], officer, event, t["dim_officer"]),
            "event_offence_hearing_days": marts.event_offence_hearing_days(event, charge, officer, t["dim_officer"]),
        }
        side_by_side(*[partial(self.table("gold", n).overwrite, with_comments(df, COMMENTS[n])) for n, df in built.items()])

    # --- writing

    def _replace(self, name: str, rows: DataFrame, stale: DataFrame | None = None) -> None:
        """Put ``rows`` in the place of those whose key is in ``stale``, by default of all."""
        table, rows = self.table("silver", name), with_comments(rows, COMMENTS.get(name, {}))
        table.overwrite(rows) if stale is None else table.replace(rows, [REPLACED_BY[name]], stale)

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        """Write rows that several steps read into this run's open folder."""
        path = f"{self.root}/_open/{self.opened}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _learn(self, name: str, df: DataFrame) -> DataFrame:
        """Keep what comparing with a table shows before that table is replaced, and add what runs that died had learnt."""
        self._keep(name, df)
        return self._learned(name).distinct()

    def _learned(self, name: str) -> DataFrame | None:
        """What this run and unfinished runs before it kept under a name."""
        paths = [f"{self.root}/_open/{run}/{name}" for run in self._runs_open()]
        paths = [p for p in paths if path_exists(self.spark, f"{p}/_SUCCESS")]
        return reduce(DataFrame.unionByName, [self.spark.read.parquet(p) for p in paths]) if paths else None

    def _runs_open(self) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_open")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _remove(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def mentions(rows: DataFrame, source: str) -> DataFrame:
    """Who a quality row names: the row's key, the person, the case, and whether the row is valid."""
    key = F.to_json(F.struct(F.lit(source).alias("source"), *KEYS[source]))
    if source == "cases":
        who = [F.col("accused_name"), F.col("accused_gender"), F.col("accused_dob"), F.col("case_pid")]
    else:
        who = [F.col("entity_name"), F.col("entity_gender"), F.lit(None).cast("date"), F.lit(None).cast("string")]
    person = [c.alias(n) for c, n in zip(who, [*PERSON, "case_pid"])]
    return rows.select(key.alias("row_key"), *person, "case_no", "_file_date", STAMP, "is_valid_row")


def touched_null_safe(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key, NULLs included, occurs in ``keys``."""
    wanted = keys.select(*[F.col(k).alias(f"_key_{k}") for k in on])
    return rows.join(wanted, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in on]), "left_semi")


def _literal(stamp: dt.datetime):
    return F.lit(stamp.isoformat(sep=" ")).cast("timestamp_ntz")
