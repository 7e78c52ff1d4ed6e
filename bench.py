"""Wall time of the lake's builds and queries; prints one JSON line.

Shared tables are timed while they are written (``build_*``), in dependency
order; the other entries run over those tables into a sink that discards the
rows but computes every column.
"""

from __future__ import annotations

import json
import os
import sys
import time

from caselake.plans.pipeline import SHARED
from caselake.queries import QUERIES, lake
from caselake.session import local_session

BUILDS = (
    "qa_cases qa_assignments qa_charges qa_events qa_event_officers qa_entities dim_person dim_officer dim_case "
    "fact_event_officer fact_case_charge case_profile fact_case_officer case_officer_workload case_offence_distribution "
    "event_offence_hearing_days report_fields"
).split()
HEADLINE = (
    "bronze_charges bronze_entities qa_charges qa_events qa_offences reject_reason_counts incremental_charges dim_date dim_person dim_officer "
    "dim_case assignment_history fact_event_officer fact_case_charge fact_case_officer case_complexity case_status_reconciled "
    "upsert_charges delete_voided_events recompute_touched_cases case_officer_workload case_offence_distribution "
    "event_offence_hearing_days filter_values offence_status_counts offence_status_yearly offence_status_pivot hearing_days man_days "
    "hearing_days_yearly segment_pivot workload_by_cluster workload_by_officer ongoing_case_list court_event_list report_fields "
    "report_entities report_issues report_issue_summary model_answer_entities check_unique check_relationships stream_landing"
).split()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=cpus)
    spark.range(1000).groupBy("id").count().write.format("noop").mode("overwrite").save()
    assert set(BUILDS) == SHARED
    times = {}
    for name in BUILDS:
        times[f"build_{name}"] = timed(lambda: lake(spark, folder).table(name))
        print(f"build_{name} {times[f'build_{name}']}", file=sys.stderr, flush=True)
    for name in HEADLINE:
        times[name] = timed(lambda: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save())
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "caselake_total_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
