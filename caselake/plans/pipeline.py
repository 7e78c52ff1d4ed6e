"""The whole lake as named tables over a landing zone.

Each table is a DataFrame built from the tables before it. Tables with several
consumers are written once per run to the shared folder and read back, as the
nightly build does: that cuts the lineage, lets readers prune columns and gives
the planner real sizes to decide broadcasts with.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.operators.bronze import to_bronze
from caselake.operators.quality import to_quality
from caselake.plans import dims, facts, marts, reports
from caselake.session import configure, run_dir
from caselake.sources.registry import SourceSpec, load_registry

SOURCES = ("cases", "assignments", "charges", "offences", "events", "event_officers", "entities")

# Tables more than one other table or query reads.
SHARED = frozenset(
    [f"qa_{s}" for s in ("cases", "charges", "entities", "events", "event_officers", "assignments")]
    + ["dim_person", "dim_officer", "dim_case", "fact_event_officer", "fact_case_charge", "case_profile", "fact_case_officer"]
    + ["case_officer_workload", "case_offence_distribution", "event_offence_hearing_days", "report_fields"]
)

_WRITTEN: dict[str, object] = {}


class CaseLake:
    """Tables of one landing zone at one ``as_of`` date.

    ``landing`` returns a landing table by source name. ``loaded_at`` stamps the
    load; ``share=False`` keeps every table lazy.
    """

    def __init__(
        self,
        spark: SparkSession,
        landing: Callable[[str], DataFrame],
        as_of: dt.date,
        loaded_at: dt.datetime | None = None,
        mode: str = "strict",
        namespace: str | None = None,
        share: bool = True,
        registry: dict[str, SourceSpec] | None = None,
    ):
        self.spark = configure(spark)
        self.landing = landing
        self.as_of = as_of
        self.mode = mode
        self.share = share and namespace is not None
        self.registry = registry or load_registry()
        stamp = loaded_at or dt.datetime.combine(as_of, dt.time())
        self.loaded_at = F.lit(stamp.isoformat(sep=" ")).cast("timestamp_ntz")
        key = f"{namespace}|{as_of}|{mode}|{stamp}"
        self.namespace = hashlib.md5(key.encode()).hexdigest()[:12]

    def table(self, name: str) -> DataFrame:
        """A table as its consumers read it: from the shared folder when it is shared."""
        if not (self.share and name in SHARED):
            return self.build(name)
        path = f"{run_dir(self.spark)}/{self.namespace}/{name}"
        if path not in _WRITTEN:
            df = self.build(name)
            # half of a star table is md5 text, which snappy cannot shorten
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
            _WRITTEN[path] = df.schema
        return self.spark.read.schema(_WRITTEN[path]).parquet(path)

    def build(self, name: str) -> DataFrame:
        """The plan that computes a table from its inputs."""
        prefix, _, source = name.partition("_")
        if prefix == "bronze":
            return to_bronze(self.landing(source), self.registry[source], loaded_at=self.loaded_at)
        if prefix == "qa":
            return to_quality(self.build(f"bronze_{source}"), source, self.as_of, self.mode, self.loaded_at)
        return getattr(self, f"_{name}")()

    def _dim_date(self) -> DataFrame:
        return dims.dim_date(self.spark)

    def _dim_person(self) -> DataFrame:
        return dims.dim_person(self.table("qa_cases"), self.table("qa_entities"), self.mode)

    def _dim_case(self) -> DataFrame:
        persons = None if self.mode == "strict" else self.table("dim_person")
        return dims.dim_case(self.table("qa_cases"), persons, self.mode)

    def _dim_officer(self) -> DataFrame:
        return dims.dim_officer(self.table("qa_assignments"))

    def _assignment_history(self) -> DataFrame:
        return facts.assignment_history(self.table("qa_assignments"))

    def _fact_event_officer(self) -> DataFrame:
        return facts.fact_event_officer(
            self.table("qa_events"), self.table("qa_event_officers"), self.table("qa_cases"), self.table("dim_officer"), self.mode
        )

    def _fact_case_charge(self) -> DataFrame:
        return facts.fact_case_charge(
            self.table("qa_charges"), self.table("qa_cases"), self.table("qa_entities"), self.table("dim_person")
        )

    def _case_profile(self) -> DataFrame:
        return facts.case_profile(
            self.table("qa_cases"), self.table("qa_events"), self.table("qa_entities"), self.table("fact_case_charge")
        )

    def _fact_case_officer(self) -> DataFrame:
        return facts.fact_case_officer(self.build("assignment_history"), self.table("case_profile"), self.table("dim_officer"))

    def _case_officer_workload(self) -> DataFrame:
        return marts.case_officer_workload(
            self.table("fact_case_officer"), self.table("fact_event_officer"), self.table("dim_officer"), self.as_of
        )

    def _case_offence_distribution(self) -> DataFrame:
        return marts.case_offence_distribution(
            self.table("fact_case_charge"),
            self.table("dim_case"),
            self.table("fact_case_officer"),
            self.table("fact_event_officer"),
            self.table("dim_officer"),
        )

    def _event_offence_hearing_days(self) -> DataFrame:
        return marts.event_offence_hearing_days(
            self.table("fact_event_officer"), self.table("fact_case_charge"), self.table("fact_case_officer"), self.table("dim_officer")
        )

    def _report_fields(self) -> DataFrame:
        texts = self.landing("charge_reports")
        return reports.report_fields(texts.select(F.col("charge").alias("doc_id"), "text"))
