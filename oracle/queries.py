"""One statement per registered query, with the same column names."""

from __future__ import annotations

import csv
from pathlib import Path

from oracle.parts import BRONZE, CUT, QUALITY, TODAY, bronze, entities, event_fact, newest, officer_versions, order, quality, skey, statement, to_date

HOLIDAYS = Path(__file__).resolve().parent.parent / "caselake" / "seeds" / "public_holidays.csv"

ORACLE: dict[str, str] = {}


def add(name: str, sql: str, **extra: str) -> None:
    ORACLE[name] = statement(sql, **extra)


for _s in BRONZE:
    add(f"bronze_{_s}", f"SELECT * FROM bronze_{_s}")
for _s in QUALITY:
    add(f"qa_{_s}", f"SELECT * FROM qa_{_s}")
for _t in (
    "dim_person dim_officer dim_case assignment_history fact_case_charge fact_case_officer case_officer_workload case_offence_distribution report_fields report_entities report_issues"
).split():
    add(_t, f"SELECT * FROM {_t}")

_days = ", ".join(
    f"(DATE '{r[0]}')" for r in csv.reader(line for line in HOLIDAYS.read_text().splitlines() if line[:1].isdigit())
)
add(
    "dim_date",
    f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_skey, d AS full_date, CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(year(d) AS INTEGER) AS year, strftime(d, '%a') AS day_of_week, isodow(d) <= 5 AND h.holiday_date IS NULL AS is_workday, strftime(d, '%Y-%m') AS reporting_month, coalesce(e.n, 0) AS events, coalesce(o.n, 0) AS orders
FROM (SELECT CAST(unnest(generate_series(DATE '2000-01-01', DATE '2030-12-31', INTERVAL '1' DAY)) AS DATE) AS d)
LEFT JOIN (SELECT DISTINCT holiday_date FROM (VALUES {_days}) AS v(holiday_date)) h ON h.holiday_date = d
LEFT JOIN (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1) e ON e.day = d LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1) o ON o.day = d""",
)
add(
    "workday_activity",
    f"""
SELECT strftime(ts, '%Y-%m') AS reporting_month, isodow(ts) <= 5 AND CAST(ts AS DATE) NOT IN (SELECT holiday_date FROM (VALUES {_days}) AS v(holiday_date)) AS is_workday, count(*) AS events
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2000-01-01' AND DATE '2030-12-31' GROUP BY 1, 2""",
)

EVENT_FACT = "SELECT * EXCLUDE (court_event_hearing_days), CAST(court_event_hearing_days AS DOUBLE) AS court_event_hearing_days FROM"
add("fact_event_officer", f"{EVENT_FACT} fact_event_officer")
add("fact_event_officer_reference", f"{EVENT_FACT} ({event_fact(new_first=True)})")
add("event_offence_hearing_days", "SELECT * EXCLUDE (hearing_days), CAST(hearing_days AS DOUBLE) AS hearing_days FROM event_offence_hearing_days")

# --- bronze and quality
add(
    "reject_reason_counts",
    "SELECT source, _rejected_reason, count(*) AS cnt FROM ("
    + " UNION ALL ".join(f"SELECT '{s}' AS source, _rejected_reason FROM bronze_{s}" for s in BRONZE)
    + ") GROUP BY source, _rejected_reason",
)
LATER = f"_ingested_at > (SELECT max(_ingested_at) FROM landing_charges WHERE _ingested_at < {CUT})"
add("incremental_charges", bronze("charges", LATER))
RAW_DOB = "try_cast(accused_dob AS DATE)"
_cols, _rules = QUALITY["cases"]
add(
    "qa_cases_reference",
    "SELECT * EXCLUDE (is_clean_row) FROM ("
    + quality(
        "cases",
        columns=_cols.replace(to_date("accused_dob"), RAW_DOB),
        rules=[f"future_accused_dob: accused_dob IS NULL OR {RAW_DOB} > {TODAY}" if r.startswith("future") else r for r in _rules],
    )
    + ")",
)

# --- dimensions and history
add(
    "dim_person_reference",
    f"SELECT {skey('full_name', 'gender', 'date_of_birth')} AS person_skey, full_name, gender, date_of_birth, _file_date FROM person_rows",
)
add(
    "dim_case_reference",
    f"""
SELECT DISTINCT {skey('c.case_no', 'c.case_pid')} AS case_skey, p.person_skey AS accused_skey, c.case_no, c.case_pid, c.case_title, c.directorate, c._file_date
FROM (SELECT * FROM qa_cases WHERE is_valid_row) c
LEFT JOIN dim_person p ON coalesce(c.accused_name, '') = coalesce(p.full_name, '') AND coalesce(c.accused_gender, '') = coalesce(p.gender, '')
 AND coalesce(c.accused_dob, DATE '1900-01-01') = coalesce(p.date_of_birth, DATE '1900-01-01')""",
)
add(
    "dim_officer_first_load",
    f"SELECT {skey('officer_id', TODAY)} AS officer_skey, officer_id, full_name, officer_cluster, officer_team, {TODAY} AS row_start_date, CAST(NULL AS DATE) AS row_end_date, _file_date FROM officer_feed",
)
add("people_union", "SELECT DISTINCT full_name, gender, date_of_birth FROM person_rows")
add(
    "officer_history",
    f"""
SELECT {skey('officer_id', 'row_start_date')} AS officer_skey, * FROM (
  SELECT b.officer_id, b.full_name, b.officer_cluster, b.officer_team, b.row_start_date,
         CASE WHEN b.row_end_date IS NOT NULL THEN b.row_end_date WHEN n.officer_id IS NOT NULL AND {{0}} THEN {TODAY} - 1 END AS row_end_date,
         CASE WHEN b.row_end_date IS NULL AND n.officer_id IS NOT NULL AND NOT ({{0}}) THEN n._file_date ELSE b._file_date END AS _file_date
  FROM known b LEFT JOIN incoming n ON b.officer_id = n.officer_id
  UNION ALL
  SELECT n.officer_id, n.full_name, n.officer_cluster, n.officer_team, {TODAY}, NULL, n._file_date
  FROM incoming n LEFT JOIN known b ON b.officer_id = n.officer_id AND b.row_end_date IS NULL WHERE b.officer_id IS NULL OR {{0}})""".format(
        "(b.full_name IS DISTINCT FROM n.full_name OR b.officer_cluster IS DISTINCT FROM n.officer_cluster OR b.officer_team IS DISTINCT FROM n.officer_team)"
    ),
    known=officer_versions(f"_file_date < {CUT}"),
    incoming=f"SELECT * FROM officer_feed WHERE _file_date >= {CUT} {newest('officer_id', ['_file_date'], 'full_name officer_cluster officer_team')}",
)
add(
    "assignment_snapshot",
    f"""
SELECT h.case_pid, h.officer_id, h.officer_name, h.cluster, h.team, h._file_date, h.valid_from,
       CASE WHEN h.valid_to IS NOT NULL THEN h.valid_to WHEN s.case_pid IS NULL THEN CAST({TODAY} AS TIMESTAMP) WHEN s._file_date > h.updated_at THEN s._file_date END AS valid_to, h.updated_at
FROM old_rows h LEFT JOIN fresh s ON h.case_pid = s.case_pid AND h.officer_id = s.officer_id
UNION ALL
SELECT s.case_pid, s.officer_id, s.officer_name, s.cluster, s.team, s._file_date, s._file_date, NULL, s._file_date
FROM fresh s LEFT JOIN old_rows h ON h.case_pid = s.case_pid AND h.officer_id = s.officer_id AND h.valid_to IS NULL WHERE h.case_pid IS NULL OR s._file_date > h.updated_at""",
    old_rows=f"""SELECT case_pid, officer_id, officer_name, cluster, team, _file_date, _file_date AS valid_from,
       lead(_file_date) OVER (PARTITION BY case_pid, officer_id ORDER BY _file_date) AS valid_to, _file_date AS updated_at FROM qa_assignments WHERE is_valid_row AND _file_date < {CUT}""",
    fresh=f"SELECT case_pid, officer_id, officer_name, cluster, team, _file_date FROM qa_assignments WHERE is_valid_row AND _file_date >= {CUT} {newest('case_pid, officer_id', ['_file_date'], 'officer_name cluster team')}",
)
add(
    "latest_assignment",
    f"SELECT case_pid, officer_id, officer_name, cluster, team, _file_date FROM qa_assignments WHERE is_valid_row {newest('case_pid, officer_id', ['_file_date'], 'officer_name cluster team')}",
)
add("latest_charge", "SELECT * FROM charge_now")

# --- facts and their parts
add("case_type", "SELECT case_pid, case_type, is_trial FROM event_summary WHERE case_type IS NOT NULL")
add("first_mention", "SELECT case_pid, first_mention_date FROM event_summary")
add("case_complexity", "SELECT case_pid, case_complexity, charge_count FROM case_profile")
add("case_status_reconciled", "SELECT case_pid, case_status FROM case_reconciled")
add(
    "case_status_max",
    "SELECT directorate, max(case_status) AS max_status, count(*) FILTER (WHERE case_status = 'PEND') AS pending, count(*) AS cnt FROM qa_cases WHERE is_valid_row GROUP BY directorate",
)
add("distinct_case_group", "SELECT DISTINCT case_skey, offence_group FROM fact_case_charge")
add("first_last_event", "SELECT * FROM last_events")
add(
    "officer_current_count",
    "SELECT officer_id, count(*) AS case_count, count(*) FILTER (WHERE assigned_to_date_skey IS NULL) AS currently_assigned_count FROM fact_case_officer GROUP BY officer_id",
)
add(
    "touched_cases",
    f"SELECT case_pid FROM qa_assignments WHERE _ingested_at >= {CUT} UNION SELECT case_pid FROM qa_events WHERE _ingested_at >= {CUT}",
)

# --- write strategies
add(
    "upsert_charges",
    "SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.case_pid = t.case_pid AND s.charge_no = t.charge_no AND s._file_date = t._file_date) UNION ALL SELECT * FROM source",
    target_bronze=bronze("charges", f"_ingested_at < {CUT}"),
    source_bronze=bronze("charges", LATER),
    target=quality("charges", "target_bronze"),
    source=quality("charges", "source_bronze"),
)
add(
    "delete_voided_events",
    f"""{EVENT_FACT} ({event_fact(new_first=False, source='first_events')}) f
WHERE NOT EXISTS (SELECT 1 FROM second_events v WHERE v.is_valid_row AND v.court_event_status <> 'NEW' AND v.court_event_id = f.court_event_id)""",
    first_bronze=bronze("events", "_source_file = 'events_0.csv'"),
    second_bronze=bronze("events", "_source_file = 'events_1.csv'"),
    first_events=quality("events", "first_bronze"),
    second_events=quality("events", "second_bronze"),
)
add("recompute_touched_cases", "SELECT * FROM fact_case_officer")

# --- served queries
YEARLY = "SELECT offence_group AS offence_type, label AS case_status, year, CAST(sum(case_count) AS BIGINT) AS case_count FROM labelled WHERE label IS NOT NULL AND year IS NOT NULL AND offence_group IS NOT NULL GROUP BY 1, 2, 3"
# grouping by the mart's own status and type first, as the query does before it labels
COUNTS = "SELECT offence_type, case_status, case_count FROM (SELECT offence_group AS offence_type, s, t, label AS case_status, CAST(sum(case_count) AS BIGINT) AS case_count FROM labelled WHERE label IS NOT NULL {0} GROUP BY offence_group, s, t, label)"
STATUSES = ["Open", "Ongoing PG", "Ongoing Trial", "Concluded PG", "Concluded Trial", "Concluded Acquittal"]


def pivot(index: str, column: str, values: list[str], measure: str, kind: str) -> str:
    return f"{index}, " + ", ".join(f"CAST(coalesce(sum({measure}) FILTER (WHERE {column} = '{v}'), 0) AS {kind}) AS \"{v}\"" for v in values)


add("filter_values", "SELECT DISTINCT officer_cluster AS cluster, strftime(first_mention_date, '%Y') AS year FROM case_offence_distribution WHERE officer_cluster IS NOT NULL")
add("offence_status_counts", COUNTS.format(""))
add("offence_status_filtered", COUNTS.format("AND officer_cluster IN ('ASIA', 'EUROPE') AND year IN ('2024') AND offence_group IN ('Hurt', 'UNKNOWN')"))
add("offence_status_yearly", YEARLY)
add(
    "offence_status_pivot",
    # labels beyond the known ones are the raw statuses the fixture leaves without a type
    f"SELECT {pivot('offence_type', 'case_status', [*STATUSES, 'DISP', 'PEND'], 'case_count', 'BIGINT')} FROM ({COUNTS.format('')}) WHERE offence_type IS NOT NULL GROUP BY offence_type",
)
add("yearly_status_pivot", f"SELECT {pivot('year', 'case_status', STATUSES, 'case_count', 'BIGINT')} FROM ({YEARLY}) GROUP BY year")
add("status_yearly_sum", f"SELECT case_status, year, CAST(sum(case_count) AS BIGINT) AS case_count FROM ({YEARLY}) GROUP BY case_status, year")


def days(metric: str, keys: str = "case_type, offence_group, segment", where: str = "TRUE", cast: str = "DOUBLE") -> str:
    if metric == "man":
        return f"SELECT {keys}, CAST(sum(hearing_days) AS {cast}) AS hearing_days FROM segmented WHERE {where} GROUP BY {keys}"
    return (
        f"SELECT {keys}, CAST(sum(per_event) AS {cast}) AS hearing_days FROM (SELECT {keys}, court_event_id, court_event_type, max(hearing_days) AS per_event FROM segmented WHERE {where} "
        f"GROUP BY {keys}, court_event_id, court_event_type) GROUP BY {keys}"
    )


BY_YEAR = "case_type, offence_group, segment, year"
add("hearing_days", days("hearing"))
add("man_days", days("man"))
add("hearing_days_yearly", days("hearing", BY_YEAR))
add("man_days_yearly", days("man", BY_YEAR))
add("hearing_days_filtered", days("hearing", where="officer_cluster IN ('ASIA', 'AFRICA') AND court_event_type IN ('PTC', 'Trial', 'Other Mention')"))
PG, TRIAL = ["Non-PG Mentions", "PG Mentions", "Other Categories"], ["Non-PG Mentions", "PTCs", "Trial"]
for _name, _type, _values, _index, _keys in (
    ("segment_pivot", "PG", PG, "offence_group", "case_type, offence_group, segment"),
    ("segment_pivot_trial", "Trial", TRIAL, "offence_group", "case_type, offence_group, segment"),
    ("segment_pivot_yearly", "PG", PG, "year", BY_YEAR),
):
    add(
        _name,
        f"SELECT {pivot(_index, 'segment', _values, 'hearing_days', 'DOUBLE')} FROM ({days('hearing', _keys, cast='DECIMAL(38, 6)')}) WHERE case_type = '{_type}' AND segment IS NOT NULL AND {_index} IS NOT NULL GROUP BY {_index}",
    )


def workload(by: str) -> str:
    def total(condition: str) -> str:
        return f"CAST(coalesce(sum(case_count) FILTER (WHERE {condition}), 0) AS BIGINT)"

    def average(condition: str) -> str:
        known = f"FILTER (WHERE {condition} AND case_processing_days IS NOT NULL)"
        return f"CAST(sum(case_processing_days * case_count) {known} AS DOUBLE) / CAST(sum(case_count) {known} AS DOUBLE)"

    return f"""SELECT *, avg_days_closed <= 70 AS closed_within_target FROM (
SELECT {by}, {total("case_status = 'PEND'")} AS open_cases, {total("case_status <> 'PEND'")} AS closed_cases, {average("case_status = 'PEND'")} AS avg_days_open, {average("case_status <> 'PEND'")} AS avg_days_closed,
       {total("case_complexity = 'Simple'")} AS simple_cases, {total("case_complexity = 'Complex'")} AS complex_cases, CAST(sum(currently_assigned_count) AS BIGINT) AS currently_assigned
FROM case_officer_workload GROUP BY {by})"""


add("workload_by_cluster", workload("officer_cluster"))
add("workload_by_officer", workload("assigned_officer_name"))

LIVE_EVENTS = f"""SELECT court_event_id, case_pid, court_event_type AS "CourtEventType", strftime(try_cast(start_datetime AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS "CourtDateTime", court_number AS "CourtNo", court_event_status AS "Status"
FROM (SELECT court_event_id, case_pid, court_event_type, start_datetime, court_number, court_event_status, _file_date FROM qa_events WHERE is_valid_row
      {newest('court_event_id', ['_file_date'], 'case_pid court_event_type start_datetime court_number court_event_status')}) WHERE court_event_status = 'NEW'"""
ONGOING = """SELECT k.case_no AS "CaseID", o.officer_cluster AS "Cluster", o.full_name AS "DPPName", e."CourtEventType", e."CourtDateTime", e."CourtNo"
FROM case_now k JOIN fact_case_officer f ON k.case_pid = f.case_pid AND f.assigned_to_date IS NULL LEFT JOIN dim_officer o ON f.officer_skey = o.officer_skey
LEFT JOIN (SELECT l.*, p.officer_id FROM live_events l JOIN (SELECT DISTINCT court_event_id, officer_id FROM qa_event_officers WHERE is_valid_row) p ON l.court_event_id = p.court_event_id) e
  ON k.case_pid = e.case_pid AND f.officer_id = e.officer_id WHERE k.case_status = 'PEND'"""
add("ongoing_case_list", ONGOING, live_events=LIVE_EVENTS)
add("ongoing_case_choice", f"""SELECT "CaseID", "DPPName", "CourtDateTime" FROM ({ONGOING}) WHERE "Cluster" = 'ASIA'""", live_events=LIVE_EVENTS)
add(
    "court_event_list",
    """SELECT k.case_no AS "CaseID", e.court_event_id, p.officer_name AS "DPPName", e."CourtEventType", e."CourtDateTime", e."CourtNo", e."Status"
FROM live_events e LEFT JOIN (SELECT DISTINCT court_event_id, officer_name FROM qa_event_officers WHERE is_valid_row) p ON e.court_event_id = p.court_event_id LEFT JOIN case_now k ON e.case_pid = k.case_pid""",
    live_events=LIVE_EVENTS,
)
add(
    "parameterised_query",
    "SELECT officer_cluster, case_status, CAST(sum(case_count) AS BIGINT) AS case_count FROM case_offence_distribution WHERE officer_cluster IN ('ASIA', 'EUROPE') AND case_status <> 'DNATA' GROUP BY 1, 2",
)
add(
    "table_limit",
    f"SELECT * FROM case_officer_workload ORDER BY {order([], 'assigned_officer_name officer_cluster case_status case_complexity first_mention_date case_disposition_date'.split())} LIMIT 25",
)

# --- report documents
SUMMARY = "SELECT field, count(*) FILTER (WHERE severity = 'ERROR') AS errors, count(*) FILTER (WHERE severity = 'WARNING') AS warnings, {0} FROM report_issues GROUP BY field"
add("report_issue_summary", SUMMARY.format("count(*) AS total"))
add("issue_counts", SUMMARY.format("count(DISTINCT charge) AS charges"))
add("report_gate", "SELECT count(*) = 0 AS passed FROM report_issues WHERE severity = 'ERROR'")
add("report_offence_group", "SELECT offence_group, count(*) AS cnt FROM report_fields GROUP BY offence_group")
add(
    "report_totals",
    """SELECT (SELECT count(*) FROM report_fields) AS reports, CAST(0 AS BIGINT) AS failures, (SELECT count(*) FROM report_entities) AS entity_rows, count(DISTINCT charge) AS charges_with_issues,
       count(*) FILTER (WHERE severity = 'ERROR') AS errors, count(*) FILTER (WHERE severity = 'WARNING') AS warnings FROM report_issues""",
)
add("report_sample", "SELECT * FROM report_fields ORDER BY md5(concat_ws(':', charge, '42')), charge LIMIT 200")
add("model_answer_entities", entities("answer_fields", "accused_relationship_to_victim", "victim_relationship_to_accused"))
add("model_answer_failures", "SELECT doc_id, 'answer is not a JSON object' AS error FROM answer_json WHERE j IS NULL")
add("documents_scan", "SELECT doc_id, CAST(length(text) AS BIGINT) AS chars, md5(text) AS text_md5 FROM documents")

# --- data tests
add("check_unique", "SELECT case_no, _file_date, count(*) AS cnt FROM bronze_cases GROUP BY case_no, _file_date HAVING count(*) > 1")
add("check_relationships", "SELECT case_pid, court_event_id FROM qa_events WHERE case_pid NOT IN (SELECT case_pid FROM dim_case)")
add("check_not_null", "SELECT case_no, _file_date FROM bronze_cases WHERE case_pid IS NULL")
add("check_accepted_values", "SELECT charge_type, count(*) AS cnt FROM qa_charges WHERE charge_type NOT IN ('DAC', 'MAC', 'MCN') GROUP BY charge_type")

# --- sources and sinks
add(
    "rescued_rows",
    """SELECT casepid, CAST(NULL AS DATE) AS dob, _source_file, '{"dob":"' || dob || '"}' AS _rescued_data FROM landing_cases WHERE dob IS NOT NULL AND try_cast(dob AS DATE) IS NULL""",
)
add(
    "file_date_from_name",
    r"""SELECT file, try_strptime(nullif(regexp_extract(file, '(\d{14})\.csv', 1), ''), '%Y%m%d%H%M%S') AS file_date, count(*) AS cnt
FROM (SELECT 'drop/charges_' || strftime(_file_date, '%Y%m%d%H%M%S') || '.csv' AS file FROM landing_charges UNION ALL SELECT 'drop/Info_' || strftime(_file_date, '%Y%m%d_%H%M') || '.csv' FROM landing_entities)
GROUP BY 1, 2""",
)
add("csv_roundtrip", "SELECT * FROM report_entities")
add("partitioned_roundtrip", "SELECT * FROM fact_case_charge")
add("stream_landing", "SELECT pid, chargeno, chargetype, chargestatus, offencedt, filingdt, _rescued_data, _file_date FROM landing_charges")
LATE = "TIMESTAMP '1992-06-01 00:00:00'"
FORMATS = "(VALUES ('csv'), ('json'), ('parquet')) f(format)"
ODD = "CAST(pid AS BIGINT) % 2 = 1"
PLEA = "'P' || CAST(CAST(pid AS BIGINT) % 3 AS VARCHAR)"
add(
    "stream_landing_drift",
    f"SELECT format, pid, chargeno, chargetype, chargestatus, offencedt, filingdt, CASE WHEN {ODD} THEN {PLEA} END AS plea, CAST(NULL AS VARCHAR) AS _rescued_data FROM landing_charges, {FORMATS}",
)
add(
    "stream_landing_rescued",
    f"""
SELECT format, CASE WHEN {ODD} AND CAST(pid AS BIGINT) % 5 = 0 THEN NULL ELSE CAST(pid AS BIGINT) END AS pid, chargetype, chargestatus,
  CASE WHEN {ODD} THEN '{{' || CASE WHEN CAST(pid AS BIGINT) % 5 = 0 THEN '"pid":"x' || pid || '",' ELSE '' END || '"plea":"' || {PLEA} || '"}}' END AS _rescued_data
FROM landing_charges, {FORMATS}""",
)
add("landing_lineage", "SELECT 'charges_' || strftime(_file_date, '%Y%m%d%H%M%S') || '.csv' AS file, _file_date AS file_date, count(*) AS rows FROM landing_charges GROUP BY 1, 2")
add(
    "land_all_sources",
    " UNION ALL ".join(f"SELECT '{s}' AS source, count(*) AS rows, count(DISTINCT _file_date) AS drops, CAST(0 AS BIGINT) AS rescued FROM landing_{s}" for s in BRONZE),
)

# --- the incremental build: what loads in any order leave is what one rebuild gives
for _t in ("dim_person", "dim_officer", "dim_case", "fact_case_charge", "fact_case_officer"):
    add(f"nightly_{_t}", f"SELECT * FROM {_t}")
add("nightly_fact_event_officer", f"{EVENT_FACT} fact_event_officer")
add(
    "nightly_rows_taken",
    " UNION ALL ".join(
        f"SELECT '{s}' AS source, count(*) AS rows, count(DISTINCT {'1' if s in ('events', 'event_officers') else f'CASE WHEN _file_date < {LATE} THEN 3 WHEN _file_date < {CUT} THEN 1 ELSE 2 END'}) AS loads FROM bronze_{s}"
        for s in BRONZE
    ),
)
add("checked_append", "SELECT * FROM bronze_charges")

# --- catalog tables and control tables
add("catalog_scan", "SELECT * FROM case_officer_workload")
add("catalog_statement", "SELECT case_status, CAST(sum(case_count) AS BIGINT) AS case_count FROM case_officer_workload WHERE case_status <> 'DISP' GROUP BY case_status")
add(
    "control_table_failures",
    """
SELECT control_table, rule, coalesce(key, directorate) AS key FROM largest, (VALUES
  ('metadata_tables', 'not_null natural_key', 'cases'), ('metadata_tables', 'unique source_name', 'cases'), ('metadata_tables', 'accepted file_format', 'xml'),
  ('metadata_columns', 'not_null active', 'a'), ('metadata_columns', 'accepted data_type', 'MONEY'), ('metadata_columns', 'source of a column', NULL)) v(control_table, rule, key)""",
    largest="SELECT directorate FROM landing_cases GROUP BY 1 ORDER BY count(*) DESC, directorate LIMIT 1",
)
