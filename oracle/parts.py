"""Named SQL parts. A statement pulls in the parts it names, in this order."""

from __future__ import annotations

from caselake.sources.registry import seed_rows

import re

TODAY = "DATE '2026-01-01'"
CUT = "TIMESTAMP '1999-01-01 00:00:00'"
NULL_KEY = "_dbt_utils_surrogate_key_null_"


def skey(*columns: str) -> str:
    inner = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{NULL_KEY}')" for c in columns)
    return f"md5(concat_ws('-', {inner}))"


def order(newest: list[str], then: list[str]) -> str:
    return ", ".join([f"{c} DESC NULLS LAST" for c in newest] + [f"{c} ASC NULLS LAST" for c in then])


def newest(keys: str, first: list[str], then: str) -> str:
    return f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order(first, then.split())}) = 1"


def day_key(day: str) -> str:
    return f"CASE WHEN {day} BETWEEN DATE '2000-01-01' AND DATE '2030-12-31' THEN CAST(strftime({day}, '%Y%m%d') AS INTEGER) END"


def key_day(key: str) -> str:
    return f"CAST(strptime(CAST({key} AS VARCHAR), '%Y%m%d') AS DATE)"


def to_date(text: str) -> str:
    return (
        f"coalesce(try_cast({text} AS DATE), CAST(try_strptime({text}, '%Y%m%d %H:%M') AS DATE), "
        f"CAST(try_strptime({text}, '%Y%m%d') AS DATE))"
    )


SHIPPED = "CAST(NULL AS VARCHAR) AS _rescued_data, '{0}' AS _source_file, date_trunc('month', l_shipdate)::TIMESTAMP AS _file_date, l_shipdate AS _ingested_at"
CHARGE_NO = (
    "CASE WHEN l_returnflag = 'N' THEN 'DAC' WHEN l_returnflag = 'A' THEN 'MAC' ELSE 'MCN' END || '-' || "
    "lpad(CAST(l_orderkey * 8 + l_linenumber AS VARCHAR), CAST(greatest(6, length(CAST(l_orderkey * 8 + l_linenumber AS VARCHAR))) AS INTEGER), '0') || '-2023'"
)
CASE_NO = "'SC-' || lpad(CAST(o.o_orderkey AS VARCHAR), CAST(greatest(6, length(CAST(o.o_orderkey AS VARCHAR))) AS INTEGER), '0') || '-' || CAST(year(o.o_orderdate) AS VARCHAR)"

PARTS: dict[str, str] = {}

PARTS["landing_cases"] = f"""
SELECT c.c_name AS accusedname,
       CASE WHEN o.o_orderkey % 53 = 0 THEN NULL ELSE {CASE_NO} END AS caseno,
       CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE CAST(o.o_orderkey AS VARCHAR) END AS casepid,
       CASE WHEN o.o_orderstatus = 'F' THEN ' disp ' WHEN o.o_orderstatus = 'O' THEN 'PEND' WHEN o.o_orderkey % 2 = 0 THEN 'AMAL' ELSE 'DNATA' END AS casestatus,
       o.o_orderpriority || ' v' || CAST(w.wave AS VARCHAR) AS casetitle, n.n_name AS directorate, r.r_name AS division,
       CASE WHEN c.c_custkey % 29 = 0 THEN '2999-01-01' WHEN c.c_custkey % 31 = 0 THEN 'n/a' ELSE CAST(CAST(DATE '1990-01-01' - CAST(c.c_custkey % 15000 AS INT) AS DATE) AS VARCHAR) END AS dob,
       CASE WHEN c.c_custkey % 37 = 0 THEN 'X' WHEN c.c_custkey % 41 = 0 THEN NULL WHEN c.c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
       '{{"priority":"' || o.o_orderpriority || '"}}' AS Q_IODETAILS,
       CASE WHEN o.o_orderkey % 59 = 0 THEN '{{"bad":"1"}}' ELSE NULL END AS _rescued_data,
       'cases_' || CAST(w.wave AS VARCHAR) || '.csv' AS _source_file,
       date_trunc('month', o.o_orderdate)::TIMESTAMP AS _file_date, o.o_orderdate + w.wave * INTERVAL '1' HOUR AS _ingested_at
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN (SELECT 0 AS wave UNION ALL SELECT 1 AS wave) w ON w.wave = 0 OR o.o_orderkey % 10 = 0"""

PARTS["landing_assignments"] = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS pid, r.r_name AS cluster, CASE WHEN l_suppkey % 43 = 0 THEN NULL ELSE s.s_name END AS name,
       CAST(l_suppkey AS VARCHAR) AS officerid,
       CASE WHEN l_suppkey % 5 = 0 AND l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' THEN n.n_name || ' B' ELSE n.n_name END AS team,
       {SHIPPED.format('assigned.csv')}
FROM lineitem JOIN supplier s ON l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""

PARTS["landing_charges"] = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS pid, {CHARGE_NO} AS chargeno,
       CASE WHEN l_returnflag = 'N' THEN 'DAC' WHEN l_returnflag = 'A' THEN 'MAC' ELSE 'XXX' END AS chargetype,
       CASE WHEN l_linestatus = 'O' THEN ' Pending' ELSE 'SENTENCED' END AS chargestatus,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS offencedt, CAST(CAST(l_shipdate AS DATE) + (CAST(l_quantity AS INT) - 5) AS VARCHAR) AS filingdt,
       {SHIPPED.format('charges.csv')}
FROM lineitem"""

PARTS["landing_offences"] = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS pid, CAST(l_linenumber AS VARCHAR) AS chargeno, p.p_type AS acttitle, p.p_brand AS reference,
       CASE WHEN l_returnflag = 'N' THEN 'M' WHEN l_returnflag = 'A' THEN 'P' WHEN l_linestatus = 'O' THEN 'R' ELSE 'Z' END AS rwpubase, p.p_name AS description_ntext,
       {SHIPPED.format('offence.csv')}
FROM lineitem JOIN part p ON l_partkey = p.p_partkey"""

PARTS["landing_events"] = """
SELECT CAST(CASE WHEN e.event_id % 61 = 0 THEN NULL ELSE e.ts END AS VARCHAR) AS startdtstr,
       CAST(CASE WHEN e.event_id % 23 = 0 THEN e.ts - INTERVAL '1' HOUR ELSE e.ts + INTERVAL '1' HOUR END AS VARCHAR) AS enddtstr,
       CAST(e.event_id % ((SELECT count(*) FROM supplier) * 10) AS VARCHAR) AS pid, CAST(e.event_id AS VARCHAR) AS id,
       CASE WHEN e.event_id % 67 = 0 THEN NULL ELSE 'Court ' || CAST(e.user_id % 40 AS VARCHAR) END AS courtnumber,
       CASE WHEN e.event_type = 'signup' AND e.event_id % 2 = 0 THEN 'FM' WHEN e.event_type = 'signup' THEN 'FM_PG' WHEN e.event_type = 'click' THEN 'PG'
            WHEN e.event_type = 'view' AND e.event_id % 2 = 0 THEN 'PTC' WHEN e.event_type = 'view' THEN 'CC'
            WHEN e.event_type = 'purchase' AND e.event_id % 7 = 0 THEN 'TRIAL' WHEN e.event_type = 'purchase' AND e.event_id % 7 = 1 THEN 'PH'
            WHEN e.event_type = 'purchase' THEN 'MITIGATION' WHEN e.event_id % 2 = 0 THEN 'SENTENCING' ELSE 'OTHER' END AS courteventtype,
       CASE WHEN w.wave = 1 THEN 'VOIDED' WHEN e.event_id % 17 = 0 THEN 'VACATED' WHEN e.event_id % 19 = 0 THEN 'VOIDED' ELSE 'NEW' END AS courteventstatus,
       CAST(NULL AS VARCHAR) AS _rescued_data, 'events_' || CAST(w.wave AS VARCHAR) || '.csv' AS _source_file,
       CAST(date_trunc('day', e.ts) + w.wave * INTERVAL '1' DAY AS TIMESTAMP) AS _file_date, e.ts + w.wave * INTERVAL '1' DAY AS _ingested_at
FROM events e JOIN (SELECT 0 AS wave UNION ALL SELECT 1 AS wave) w ON w.wave = 0 OR e.event_id % 50 = 0"""

PARTS["landing_event_officers"] = """
SELECT CAST(e.event_id AS VARCHAR) AS courteventid, CAST(s.s_suppkey AS VARCHAR) AS officerid, CASE WHEN e.event_id % 71 = 0 THEN NULL ELSE s.s_name END AS name,
       n.n_name AS division, CAST(NULL AS VARCHAR) AS _rescued_data, 'event_off.csv' AS _source_file,
       CAST(date_trunc('day', e.ts) AS TIMESTAMP) AS _file_date, e.ts AS _ingested_at
FROM events e JOIN (SELECT 0 AS seat UNION ALL SELECT 1 AS seat) k ON k.seat = 0 OR e.event_id % 3 = 0
JOIN supplier s ON s.s_suppkey = (e.user_id + k.seat * 7) % (SELECT count(*) FROM supplier) JOIN nation n ON s.s_nationkey = n.n_nationkey"""


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# Statute keyword and its offence group.
KEYWORDS = [
    ('Road Traffic Act', 'Traffic Offences'),
    ('Misuse of Drugs Act', 'Drug Offences'),
    ('Prevention of Corruption Act', 'Corruption'),
    ("Women's Charter", 'Vice Activities'),
    ('Arms Offences Act', 'Weapons Offences'),
    ('Corrosive and Explosive Substances', 'Weapons Offences'),
    ('Moneylenders Act', 'Moneylending Offences'),
    ('Immigration Act', 'Immigration Offences'),
    ('Computer Misuse Act', 'Computer Crimes'),
    ('Protection from Harassment Act', 'Harassment'),
    ('Massage Establishments Act', 'Vice Activities in Massage Parlours'),
    ('Employment of Foreign Manpower Act', 'Immigration Offences'),
    ('Miscellaneous Offences', 'Public Order Offences'),
    ('Public Order Act', 'Public Order Offences'),
    ('Societies Act', 'Public Order Offences'),
    ('Vandalism Act', 'Mischief'),
    ('Films Act', 'Vice Activities'),
]
KEYWORD_CASE = " ".join(f"WHEN contains(lower(statute), lower({quoted(k)})) THEN '{g}'" for k, g in KEYWORDS)

SECTIONS = [(r["section"], r["offence_group"]) for r in seed_rows("penal_code_sections")]
SECTION_CASE = " ".join(f"WHEN '{k}' THEN '{g}'" for k, g in SECTIONS)
STATUTE_OF = f"[{', '.join(quoted(k) for k, _ in KEYWORDS)}][o.o_orderkey // 4 % {len(KEYWORDS)} + 1] || ' 1961'"
SECTION_OF = f"[{', '.join(quoted(k) for k, _ in SECTIONS)}][o.o_orderkey // 4 % {len(SECTIONS)} + 1]"

PARTS["landing_reports"] = f"""
SELECT c.chargeno AS charge, '**Charge Details** (' || {CASE_NO} || ' / ' || c.chargeno || ')' || chr(10)
       || '* **Name:** ' || lower(cu.c_name) || chr(10) || '* **Gender/Age:** ' || CASE WHEN cu.c_custkey % 2 = 0 THEN 'MALE' ELSE 'FEMALE' END || ' / ' || CAST(cu.c_custkey % 130 AS VARCHAR) || ' YEARS' || chr(10)
       || '* **Statute:** ' || CASE WHEN o.o_orderkey % 4 < 2 THEN {STATUTE_OF} WHEN o.o_orderkey % 4 = 2 THEN 'Penal Code 1871' ELSE 'Unmapped Act' END || chr(10)
       || '* **Offence:** Section ' || CASE WHEN o.o_orderkey % 8 = 2 THEN {SECTION_OF} || '(7)' WHEN o.o_orderkey % 8 = 6 THEN {SECTION_OF} ELSE '64(1)' END || chr(10)
       || '### **Statement of Offence**' || chr(10) || 'At a ' || CASE WHEN o.o_orderkey % 3 = 0 THEN 'massage' ELSE 'retail' END || ' outlet.' || chr(10)
       || CASE WHEN o.o_orderkey % 7 = 0 THEN '* **Special Type:** Family Violence' || chr(10) ELSE '' END
       || CASE WHEN o.o_orderkey % 5 = 0 THEN '### **Victim Particulars**' || chr(10) || '* **Name:** victim ' || CAST(o.o_custkey AS VARCHAR) || chr(10) || '* **Gender/Age:** FEMALE / 30 YEARS' || chr(10) || '* **Relationship to Accused:** Self' || chr(10) ELSE '' END AS text
FROM (SELECT DISTINCT pid, chargeno FROM landing_charges) c JOIN orders o ON c.pid = CAST(o.o_orderkey AS VARCHAR) JOIN customer cu ON o.o_custkey = cu.c_custkey"""

PARTS["landing_entities"] = """
SELECT x.caseno AS case_no, x.chargeno AS charge_no, x.entity_name, x.entity_type, CAST(x.age AS VARCHAR) AS entity_age, x.gender AS entity_gender,
       CASE WHEN x.entity_type = 'Victim' THEN 'Self' ELSE NULL END AS relationship_to_victim,
       CASE WHEN x.ok % 4 = 0 THEN 'Traffic Offences' WHEN x.ok % 4 = 1 THEN 'Hurt' WHEN x.ok % 4 = 2 THEN 'Theft' ELSE NULL END AS offence_group,
       CASE WHEN x.ok % 7 = 0 THEN 'Family Violence' ELSE NULL END AS special_type,
       CAST(NULL AS VARCHAR) AS _rescued_data, 'info.csv' AS _source_file, x._file_date, x._ingested_at
FROM (SELECT k.caseno, c.chargeno, k.accusedname AS entity_name, 'Accused Person' AS entity_type, 40 AS age, k.gender, CAST(c.pid AS BIGINT) AS ok, c._file_date, c._ingested_at
      FROM landing_charges c JOIN landing_cases k ON c.pid = k.casepid AND k._source_file = 'cases_0.csv'
      UNION ALL
      SELECT k.caseno, c.chargeno, 'Victim ' || c.pid, 'Victim', 150, 'F', CAST(c.pid AS BIGINT), c._file_date, c._ingested_at
      FROM landing_charges c JOIN landing_cases k ON c.pid = k.casepid AND k._source_file = 'cases_0.csv' WHERE CAST(c.pid AS BIGINT) % 5 = 0) x"""

PARTS["landing_answers"] = f"""
SELECT doc_id, CASE WHEN k % 17 = 0 THEN 'Sorry, no answer.' WHEN k % 3 = 0 THEN 'Here:' || chr(10) || '```json' || chr(10) || body || chr(10) || '```' || chr(10) || 'done'
                    WHEN k % 3 = 1 THEN '```' || chr(10) || body || chr(10) || '```' ELSE body END AS answer
FROM (SELECT o.o_orderkey AS k, 'DOC-' || CAST(o.o_orderkey AS VARCHAR) AS doc_id,
             '{{"case":"' || {CASE_NO} || '"' || CASE WHEN o.o_orderkey % 11 = 0 THEN '' ELSE ',"charge":"DAC-' || lpad(CAST(o.o_orderkey AS VARCHAR), CAST(greatest(6, length(CAST(o.o_orderkey AS VARCHAR))) AS INTEGER), '0') || '-2023"' END
             || ',"accused_name":"' || lower(c.c_name) || '","accused_age":' || CASE WHEN o.o_orderkey % 13 = 0 THEN 'null' ELSE CAST(o.o_orderkey % 80 + 7 AS VARCHAR) END
             || ',"accused_gender":"M","offence_group":"Hurt","special_type":""'
             || CASE WHEN o.o_orderkey % 5 = 0 THEN ',"victim_name":"jane o''neil","victim_age":30,"victim_gender":"F","victim_relationship_to_accused":"Neighbour"' ELSE '' END || '}}' AS body
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

# source -> (natural key, "source:target" columns)
BRONZE = {
    "cases": ("casepid", "accusedname:accused_name caseno:case_no casepid:case_pid casestatus:case_status casetitle:case_title directorate division dob:accused_dob gender:accused_gender Q_IODETAILS"),
    "assignments": ("pid officerid", "pid:case_pid cluster name:officer_name officerid:officer_id team"),
    "charges": ("pid chargeno", "pid:case_pid chargeno:charge_no chargetype:charge_type chargestatus:charge_status offencedt:offence_date filingdt:filing_date"),
    "offences": ("pid chargeno acttitle reference rwpubase", "pid:case_pid chargeno:charge_no acttitle:act_title reference rwpubase:rwpu_base description_ntext:description"),
    "events": ("pid id", "startdtstr:start_datetime enddtstr:end_datetime pid:case_pid id:court_event_id courtnumber:court_number courteventtype:court_event_type courteventstatus:court_event_status"),
    "event_officers": ("courteventid officerid", "courteventid:court_event_id officerid:officer_id name:officer_name division:officer_division"),
    "entities": ("case_no charge_no entity_name", "case_no charge_no entity_name entity_type entity_age entity_gender relationship_to_victim offence_group special_type"),
}


def bronze(source: str, where: str = "TRUE") -> str:
    key, columns = BRONZE[source]
    pairs = [(c.split(":") * 2)[:2] for c in columns.split()]
    keys = key.split()
    rest = [s for s, _ in pairs if s not in keys] + ["_rescued_data", "_source_file"]
    reason = " ".join(f"WHEN {k} IS NULL THEN 'missing_{k}'" for k in keys)
    chosen = ", ".join(f"{s} AS {t}" for s, t in pairs)
    return (
        f"SELECT {chosen}, _rescued_data, _source_file, _file_date, CASE {reason} END AS _rejected_reason, _ingested_at "
        f"FROM landing_{source} WHERE {where} {newest(', '.join([*keys, '_file_date']), ['_ingested_at'], ' '.join(rest))}"
    )


for _s in BRONZE:
    PARTS[f"bronze_{_s}"] = bronze(_s)

AUDIT = "_rescued_data, _source_file, _file_date, _ingested_at"
RESCUED = "rescued_data: _rescued_data IS NOT NULL"
OUT_OF_HOURS = "extract(hour FROM try_cast(start_datetime AS TIMESTAMP)) NOT BETWEEN 8 AND 18"

QUALITY = {
    "cases": (
        f"accused_name, case_no, case_pid, upper(trim(case_status)) AS case_status, case_title, upper(trim(directorate)) AS directorate, {to_date('accused_dob')} AS accused_dob, accused_gender",
        ["missing_case_no: case_no IS NULL", f"future_accused_dob: {to_date('accused_dob')} IS NULL OR {to_date('accused_dob')} > {TODAY}", "invalid_gender: accused_gender NOT IN ('M', 'F')", RESCUED],
    ),
    "assignments": ("case_pid, cluster, officer_name, officer_id, team", ["missing_officer_name: officer_name IS NULL", RESCUED]),
    "charges": (
        f"case_pid, charge_no, charge_type, charge_status, {to_date('offence_date')} AS offence_date, {to_date('filing_date')} AS filing_date",
        [
            "invalid_charge_type: charge_type NOT IN ('DAC', 'MAC', 'MCN')",
            f"future_offence_date: {to_date('offence_date')} > {TODAY}",
            f"future_filing_date: {to_date('filing_date')} > {TODAY}",
            f"filing_before_offence: {to_date('offence_date')} > {to_date('filing_date')}",
            RESCUED,
        ],
    ),
    "offences": ("case_pid, charge_no, act_title, reference, rwpu_base, description", ["invalid_rwpu: rwpu_base NOT IN ('M', 'P', 'R')", RESCUED]),
    "events": (
        "start_datetime, end_datetime, case_pid, court_event_id, court_number, court_event_type, upper(trim(court_event_status)) AS court_event_status",
        [
            "missing_start_datetime: start_datetime IS NULL",
            "missing_end_datetime: end_datetime IS NULL",
            f"early_start_datetime: {OUT_OF_HOURS}",
            "end_before_start: try_cast(end_datetime AS TIMESTAMP) < try_cast(start_datetime AS TIMESTAMP)",
            "missing_court_number: court_number IS NULL",
            "invalid_court_event_type: court_event_type NOT IN ('FM', 'FM_PG', 'PG', 'CC', 'PTC', 'PH', 'SENTENCING', 'TRIAL', 'MITIGATION')",
            "invalid_court_event_status: upper(trim(court_event_status)) NOT IN ('NEW', 'VACATED', 'VOIDED')",
        ],
    ),
    "event_officers": ("court_event_id, officer_id, officer_name, officer_division", ["missing_officer_name: officer_name IS NULL", RESCUED]),
    "entities": (
        "case_no, charge_no, entity_name, entity_type, entity_age, entity_gender, relationship_to_victim, offence_group, nullif(trim(special_type), '') AS special_type",
        [
            "missing_case_no: case_no IS NULL",
            "missing_charge_no: charge_no IS NULL",
            "missing_entity_name: entity_name IS NULL",
            "missing_entity_type: entity_type IS NULL",
            "invalid_entity_type: entity_type NOT IN ('Accused Person', 'Victim')",
            "invalid_entity_age: try_cast(entity_age AS BIGINT) NOT BETWEEN 0 AND 120",
            "invalid_entity_gender: entity_gender NOT IN ('M', 'F')",
            "missing_offence_group: offence_group IS NULL",
        ],
    ),
}


def quality(source: str, origin: str | None = None, rules: list[str] | None = None, columns: str | None = None) -> str:
    chosen, flags = QUALITY[source]
    pairs = [f.split(": ", 1) for f in (rules or flags)]
    flag_sql = ", ".join(f"CASE WHEN {bad} THEN FALSE ELSE TRUE END AS _dq_{name}" for name, bad in pairs)
    names = [f"_dq_{name}" for name, _ in pairs]
    return (
        f"SELECT *, {' OR '.join(names)} AS is_valid_row, {' AND '.join(names)} AS is_clean_row FROM "
        f"(SELECT {columns or chosen}, {AUDIT}, {flag_sql} FROM {origin or 'bronze_' + source} WHERE _rejected_reason IS NULL)"
    )


for _s in QUALITY:
    PARTS[f"qa_{_s}"] = quality(_s)

PARTS["mapping"] = (
    "SELECT * FROM (VALUES ('FM', 'Other Mention'), ('FM_PG', 'PG Mention'), ('PG', 'PG Mention'), ('CC', 'PTC'), ('PTC', 'PTC'), "
    "('PH', 'Trial'), ('SENTENCING', 'Other Mention'), ('TRIAL', 'Trial'), ('MITIGATION', 'Other Mention')) AS t(event_type, event_group)"
)

PARTS["person_rows"] = """
SELECT accused_name AS full_name, accused_gender AS gender, accused_dob AS date_of_birth, _file_date FROM qa_cases WHERE is_valid_row
UNION
SELECT entity_name, entity_gender, CAST(NULL AS DATE), _file_date FROM qa_entities WHERE is_valid_row"""

PARTS["dim_person"] = f"""
SELECT {skey('full_name', 'gender', 'date_of_birth')} AS person_skey, full_name, gender, date_of_birth, max(_file_date) AS _file_date
FROM person_rows GROUP BY full_name, gender, date_of_birth"""

PARTS["case_now"] = f"""
SELECT case_pid, case_no, case_title, directorate, case_status, accused_name, accused_gender, accused_dob, _file_date, {skey('case_no', 'case_pid')} AS case_skey
FROM qa_cases WHERE is_valid_row
{newest('case_pid', ['_file_date'], 'case_no case_title directorate case_status accused_name accused_gender accused_dob')}"""

PARTS["dim_case"] = f"""
SELECT case_skey, {skey('accused_name', 'accused_gender', 'accused_dob')} AS accused_skey, case_no, case_pid, case_title, directorate, _file_date FROM case_now"""

PARTS["officer_feed"] = """
SELECT DISTINCT officer_id, officer_name AS full_name, cluster AS officer_cluster, team AS officer_team, _file_date FROM qa_assignments WHERE is_valid_row"""


def officer_versions(where: str = "TRUE") -> str:
    state = "(full_name, officer_cluster, officer_team)"
    return f"""
SELECT officer_id, full_name, officer_cluster, officer_team, row_start_date, lead(row_start_date) OVER (PARTITION BY officer_id ORDER BY row_start_date) - 1 AS row_end_date, _file_date
FROM (SELECT officer_id, run, min(seen) AS row_start_date, max(full_name) AS full_name, max(officer_cluster) AS officer_cluster, max(officer_team) AS officer_team, max(_file_date) AS _file_date
      FROM (SELECT *, sum(changed) OVER (PARTITION BY officer_id ORDER BY seen) AS run
            FROM (SELECT *, CASE WHEN lag(seen) OVER w IS NULL OR lag(full_name) OVER w IS DISTINCT FROM full_name OR lag(officer_cluster) OVER w IS DISTINCT FROM officer_cluster
                                   OR lag(officer_team) OVER w IS DISTINCT FROM officer_team THEN 1 ELSE 0 END AS changed
                  FROM (SELECT *, CAST(_file_date AS DATE) AS seen FROM officer_feed WHERE {where}
                        {newest('officer_id, CAST(_file_date AS DATE)', ['_file_date'], 'full_name officer_cluster officer_team')})
                  WINDOW w AS (PARTITION BY officer_id ORDER BY seen)))
      GROUP BY officer_id, run)"""


PARTS["dim_officer"] = f"""
SELECT {skey('officer_id', 'row_start_date')} AS officer_skey, officer_id, full_name, officer_cluster, officer_team, row_start_date, row_end_date, _file_date FROM ({officer_versions()})"""

PARTS["officer_spans"] = """
SELECT officer_id, officer_skey, CASE WHEN row_start_date = min(row_start_date) OVER (PARTITION BY officer_id) THEN DATE '0001-01-01' ELSE row_start_date END AS from_day,
       coalesce(row_end_date, DATE '9999-12-31') AS to_day
FROM dim_officer"""

PARTS["assignment_history"] = """
SELECT case_pid, officer_id, officer_name, cluster, team, _file_date, _file_date AS valid_from,
       lead(_file_date) OVER (PARTITION BY case_pid, officer_id ORDER BY _file_date) AS valid_to, _file_date AS updated_at
FROM qa_assignments WHERE is_valid_row"""


def event_fact(new_first: bool, source: str = "qa_events") -> str:
    latest = newest("court_event_id", ["_file_date"], "case_pid court_event_type start_datetime court_number court_event_status")
    chosen = "court_event_id, case_pid, court_event_type, start_datetime, court_number, court_event_status, _file_date"
    if new_first:
        events = f"SELECT {chosen} FROM {source} WHERE is_valid_row AND court_event_status = 'NEW' {latest}"
    else:
        events = f"SELECT * FROM (SELECT {chosen} FROM {source} WHERE is_valid_row {latest}) WHERE court_event_status = 'NEW'"
    return f"""
SELECT {skey('e.court_event_id', 'p.officer_id')} AS event_officer_skey, k.case_skey, e.court_event_id, o.officer_skey, m.event_group AS court_event_type,
       {day_key('e.event_day')} AS court_event_date_skey,
       CAST(CASE WHEN m.event_group = 'PTC' THEN 12.5 / 510.0 WHEN m.event_group = 'Trial' THEN CASE WHEN hour(e.start_ts) >= 13 THEN 0.5 ELSE 1.0 END ELSE 85.0 / 510.0 END AS DECIMAL(9, 6)) AS court_event_hearing_days,
       CAST(year(e.event_day) AS INTEGER) AS court_event_year, e._file_date, e.case_pid, p.officer_id
FROM (SELECT *, try_cast(start_datetime AS TIMESTAMP) AS start_ts, CAST(try_cast(start_datetime AS TIMESTAMP) AS DATE) AS event_day FROM ({events})) e
JOIN (SELECT DISTINCT court_event_id, officer_id FROM qa_event_officers WHERE is_valid_row) p ON e.court_event_id = p.court_event_id
LEFT JOIN mapping m ON e.court_event_type = m.event_type
LEFT JOIN case_now k ON e.case_pid = k.case_pid
LEFT JOIN officer_spans o ON p.officer_id = o.officer_id AND coalesce(e.event_day, DATE '9999-12-31') BETWEEN o.from_day AND o.to_day"""


PARTS["fact_event_officer"] = event_fact(new_first=False)

PARTS["case_reconciled"] = """
SELECT k.case_pid, k.case_no, k.case_skey, k.case_status AS raw_status, CASE WHEN k.case_status = 'PEND' AND NOT p.pending THEN 'DISP' ELSE k.case_status END AS case_status
FROM case_now k JOIN (SELECT case_pid, coalesce(bool_or(upper(trim(charge_status)) = 'PENDING'), FALSE) AS pending FROM qa_charges WHERE is_valid_row GROUP BY case_pid) p ON k.case_pid = p.case_pid
WHERE k.case_status <> 'AMAL'"""

PARTS["victim_now"] = f"""
SELECT case_no, charge_no, victim_skey, relation_to_accused, offence_group
FROM (SELECT v.case_no, v.charge_no, v.relationship_to_victim AS relation_to_accused, coalesce(v.offence_group, 'UNKNOWN') AS offence_group, v._file_date,
             (SELECT min(person_skey) FROM dim_person d WHERE d.full_name = v.entity_name AND d.gender = v.entity_gender) AS victim_skey
      FROM qa_entities v WHERE v.is_valid_row AND v.entity_type = 'Victim')
{newest('case_no, charge_no', ['_file_date'], 'offence_group relation_to_accused victim_skey')}"""

PARTS["charge_now"] = f"""
SELECT case_pid, charge_no, charge_type, charge_status, offence_date, _file_date FROM qa_charges WHERE is_valid_row
{newest('case_pid, charge_no', ['_file_date'], 'charge_type charge_status offence_date')}"""

PARTS["fact_case_charge"] = f"""
SELECT {skey('c.case_pid', 'c.charge_no')} AS case_charge_skey, k.case_skey, v.victim_skey, v.relation_to_accused, k.case_status,
       CASE WHEN k.raw_status = 'DISP' AND upper(trim(c.charge_status)) = 'PENDING' THEN 'SENTENCED' ELSE upper(trim(c.charge_status)) END AS charge_status,
       {day_key('c.offence_date')} AS committed_date_skey, c.charge_type AS offence_type, coalesce(v.offence_group, 'UNKNOWN') AS offence_group, c._file_date, c.case_pid
FROM charge_now c JOIN case_reconciled k ON c.case_pid = k.case_pid LEFT JOIN victim_now v ON k.case_no = v.case_no AND c.charge_no = v.charge_no"""

PARTS["event_summary"] = """
SELECT e.case_pid, min(CAST(try_cast(e.start_datetime AS TIMESTAMP) AS DATE)) AS first_mention_date,
       coalesce(bool_or(e.court_event_status = 'NEW' AND m.event_group = 'Trial'), FALSE) AS is_trial,
       CASE WHEN bool_or(e.court_event_status = 'NEW' AND m.event_group = 'Trial') THEN 'Trial' WHEN bool_or(e.court_event_status = 'NEW' AND m.event_group = 'PG Mention') THEN 'PG'
            WHEN bool_or(e.court_event_status = 'NEW') THEN 'TBD' END AS case_type
FROM qa_events e LEFT JOIN mapping m ON e.court_event_type = m.event_type WHERE e.is_valid_row GROUP BY e.case_pid"""

PARTS["case_profile"] = """
SELECT k.case_pid, k.case_no, k.case_skey, k.case_status, e.case_type, e.first_mention_date, coalesce(n.charge_count, 0) AS charge_count,
       CASE WHEN s.case_no IS NOT NULL OR e.is_trial OR n.charge_count >= 3 THEN 'Complex' ELSE 'Simple' END AS case_complexity
FROM case_now k LEFT JOIN event_summary e ON k.case_pid = e.case_pid
LEFT JOIN (SELECT case_skey, count(*) AS charge_count FROM fact_case_charge GROUP BY case_skey) n ON k.case_skey = n.case_skey
LEFT JOIN (SELECT DISTINCT case_no FROM qa_entities WHERE is_valid_row AND special_type IS NOT NULL) s ON k.case_no = s.case_no
WHERE k.case_status <> 'AMAL'"""

PARTS["fact_case_officer"] = f"""
SELECT {skey('a.case_pid', 'a.officer_id', 'a.assigned_from_date')} AS case_officer_skey, k.case_skey, o.officer_skey, {day_key('a.assigned_from_date')} AS assigned_from_date_skey,
       {day_key('a.assigned_to_date')} AS assigned_to_date_skey, {day_key('k.first_mention_date')} AS first_mention_date_skey, k.case_status, k.case_type, k.case_complexity,
       CAST(year(k.first_mention_date) AS INTEGER) AS first_mention_year, a.updated_at AS _officer_snapshot_date, a._file_date, a.case_pid, a.officer_id, a.assigned_from_date, a.assigned_to_date
FROM (SELECT case_pid, officer_id, CAST(valid_from AS DATE) AS assigned_from_date, CAST(valid_to AS DATE) AS assigned_to_date, updated_at, _file_date FROM assignment_history
      {newest('case_pid, officer_id, CAST(valid_from AS DATE)', ['_file_date'], 'assigned_to_date updated_at')}) a
JOIN case_profile k ON a.case_pid = k.case_pid
LEFT JOIN officer_spans o ON a.officer_id = o.officer_id AND a.assigned_from_date BETWEEN o.from_day AND o.to_day"""

PARTS["last_events"] = f"""
SELECT case_skey, max({key_day('court_event_date_skey')}) AS last_court_event_date FROM fact_event_officer WHERE case_skey IS NOT NULL GROUP BY case_skey"""

PARTS["case_officer_workload"] = f"""
SELECT assigned_officer_name, officer_cluster, case_status, case_complexity, first_mention_date, case_disposition_date, count(*) AS case_count,
       CAST(sum(CASE WHEN assigned_to_date_skey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS currently_assigned_count,
       CAST(coalesce(case_disposition_date, {TODAY}) - first_mention_date AS INTEGER) AS case_processing_days
FROM (SELECT o.full_name AS assigned_officer_name, o.officer_cluster, b.case_status, b.case_complexity, {key_day('b.first_mention_date_skey')} AS first_mention_date,
             CASE WHEN b.case_status = 'DISP' THEN l.last_court_event_date END AS case_disposition_date, b.assigned_to_date_skey
      FROM fact_case_officer b LEFT JOIN dim_officer o ON b.officer_skey = o.officer_skey LEFT JOIN last_events l ON b.case_skey = l.case_skey)
GROUP BY assigned_officer_name, officer_cluster, case_status, case_complexity, first_mention_date, case_disposition_date"""

PARTS["case_offence_distribution"] = f"""
SELECT k.case_no, g.offence_group, a.case_status, a.case_type, o.officer_cluster, {key_day('a.first_mention_date_skey')} AS first_mention_date, l.last_court_event_date, count(*) AS case_count
FROM (SELECT DISTINCT case_skey, offence_group FROM fact_case_charge) g LEFT JOIN dim_case k ON g.case_skey = k.case_skey
LEFT JOIN (SELECT DISTINCT case_skey, case_status, case_type, officer_skey, first_mention_date_skey FROM fact_case_officer) a ON g.case_skey = a.case_skey
LEFT JOIN dim_officer o ON a.officer_skey = o.officer_skey LEFT JOIN last_events l ON g.case_skey = l.case_skey
GROUP BY ALL"""

PARTS["event_offence_hearing_days"] = f"""
SELECT e.court_event_id, g.offence_group, o.officer_id, e.court_event_type, t.case_type, g.case_status, o.officer_cluster, {key_day('t.first_mention_date_skey')} AS first_mention_date,
       {key_day('e.court_event_date_skey')} AS last_court_event_date, e.court_event_hearing_days AS hearing_days
FROM fact_event_officer e LEFT JOIN dim_officer o ON e.officer_skey = o.officer_skey
LEFT JOIN (SELECT DISTINCT case_skey, offence_group, case_status FROM fact_case_charge) g ON e.case_skey = g.case_skey
LEFT JOIN (SELECT DISTINCT case_skey, case_type, first_mention_date_skey FROM fact_case_officer) t ON e.case_skey = t.case_skey"""

PARTS["labelled"] = """
SELECT *, strftime(first_mention_date, '%Y') AS year,
       CASE WHEN s = 'PEND' AND t = 'TBD' THEN 'Open' WHEN s = 'PEND' AND t = 'PG' THEN 'Ongoing PG' WHEN s = 'PEND' AND t = 'TRIAL' THEN 'Ongoing Trial' WHEN s = 'DISP' AND t = 'PG' THEN 'Concluded PG'
            WHEN s = 'DISP' AND t = 'TRIAL' THEN 'Concluded Trial' WHEN s = 'DISP' AND t = 'TBD' THEN NULL WHEN s IN ('DATA', 'DNATA') THEN 'Concluded Acquittal' ELSE trim(s || ' ' || t) END AS label
FROM (SELECT *, upper(coalesce(case_status, '')) AS s, upper(coalesce(case_type, '')) AS t FROM case_offence_distribution)"""

PARTS["segmented"] = """
SELECT *, strftime(first_mention_date, '%Y') AS year,
       CASE WHEN case_type = 'Trial' THEN CASE court_event_type WHEN 'Other Mention' THEN 'Non-PG Mentions' WHEN 'PTC' THEN 'PTCs' WHEN 'Trial' THEN 'Trial' END
            ELSE CASE court_event_type WHEN 'Other Mention' THEN 'Non-PG Mentions' WHEN 'PG Mention' THEN 'PG Mentions' WHEN 'PTC' THEN 'Other Categories' END END AS segment
FROM event_offence_hearing_days WHERE case_type IN ('PG', 'Trial')"""

VICTIM_BLOCK = "split_part(split_part(text, '### **Victim Particulars**', 2), '###', 1)"
STATEMENT = "split_part(text, '### **Statement of Offence**', 2)"

PARTS["report_parts"] = rf"""
SELECT charge, nullif(regexp_extract(text, 'Charge Details.*?\((SC-\d+-\d+)\s*/\s*(\S+)\)', 1), '') AS "case",
       nullif(trim(regexp_extract(text, '\*\*Name:\*\*\s*(.+)', 1)), '') AS accused_name,
       try_cast(regexp_extract(text, '\*\*Gender/Age:\*\*\s*(MALE|FEMALE)\s*/\s*(\d+)\s*YEARS', 2) AS INTEGER) AS accused_age,
       CASE regexp_extract(text, '\*\*Gender/Age:\*\*\s*(MALE|FEMALE)\s*/\s*(\d+)\s*YEARS', 1) WHEN 'MALE' THEN 'M' WHEN 'FEMALE' THEN 'F' END AS accused_gender,
       nullif(trim(regexp_extract({VICTIM_BLOCK}, '\*\*Name:\*\*\s*(.+)', 1)), '') AS victim_name,
       try_cast(regexp_extract({VICTIM_BLOCK}, '\*\*Gender/Age:\*\*\s*(MALE|FEMALE)\s*/\s*(\d+)\s*YEARS', 2) AS INTEGER) AS victim_age,
       CASE regexp_extract({VICTIM_BLOCK}, '\*\*Gender/Age:\*\*\s*(MALE|FEMALE)\s*/\s*(\d+)\s*YEARS', 1) WHEN 'MALE' THEN 'M' WHEN 'FEMALE' THEN 'F' END AS victim_gender,
       nullif(trim(regexp_extract({VICTIM_BLOCK}, '\*\*Relationship to Accused:\*\*\s*(.+)', 1)), '') AS victim_relationship,
       nullif(trim(regexp_extract(text, '\*\*Special Type:\*\*\s*(.+)', 1)), '') AS special_type,
       nullif(trim(regexp_extract(text, '\*\*Statute:\*\*\s*(.+)', 1)), '') AS statute,
       nullif(regexp_extract(text, '\*\*Offence:\*\*\s*Section\s+([\w()]+)', 1), '') AS offence_section,
       lower({STATEMENT}) AS statement
FROM landing_reports"""

PARTS["report_fields"] = rf"""
SELECT * EXCLUDE (statement, by_keyword), CASE WHEN by_keyword = 'Vice Activities' AND contains(statement, 'massage') THEN 'Vice Activities in Massage Parlours'
       WHEN by_keyword IS NOT NULL THEN by_keyword
       WHEN contains(lower(statute), 'penal code') THEN CASE regexp_replace(offence_section, '\(.*\)', '') {SECTION_CASE} END END AS offence_group
FROM (SELECT *, CASE {KEYWORD_CASE} END AS by_keyword FROM report_parts)"""

TITLE = "array_to_string(list_transform(regexp_extract_all(lower({0}), '([\\p{{Ll}}]+|[^\\p{{Ll}}]+)', 1), lambda x: upper(x[1]) || x[2:]), '')"


def entities(source: str, relation: str, victim_relation: str) -> str:
    accused = TITLE.format("coalesce(accused_name, '')")
    victim = TITLE.format("victim_name")
    return f"""
SELECT "case" AS case_no, charge AS charge_no, {accused} AS entity_name, 'Accused Person' AS entity_type, CAST(accused_age AS VARCHAR) AS entity_age, accused_gender AS entity_gender,
       {relation} AS relationship_to_victim, offence_group, special_type FROM {source}
UNION ALL
SELECT "case", charge, {victim}, 'Victim', CAST(victim_age AS VARCHAR), victim_gender, {victim_relation}, offence_group, special_type FROM {source} WHERE victim_name <> ''"""


PARTS["report_entities"] = entities("report_fields", "CAST(NULL AS VARCHAR)", "coalesce(victim_relationship, 'Self')")

_required = " UNION ALL ".join(
    f"SELECT charge, '{f}' AS field, 'ERROR' AS severity, 'Missing required field: {f}' AS message FROM report_fields WHERE coalesce(trim(CAST(\"{f}\" AS VARCHAR)), '') = ''"
    for f in ["case", "charge", "accused_name", "accused_age", "accused_gender", "offence_group"]
)
_victim = " UNION ALL ".join(
    f"SELECT charge, '{f}', 'ERROR', 'Victim exists but missing field: {f}' FROM report_fields WHERE victim_name IS NOT NULL AND coalesce(trim(CAST({f} AS VARCHAR)), '') = ''"
    for f in ["victim_name", "victim_age", "victim_gender"]
)
PARTS["report_issues"] = rf"""
{_required} UNION ALL {_victim}
UNION ALL SELECT charge, 'case', 'WARNING', 'Case number format unexpected: ' || "case" FROM report_fields WHERE "case" <> '' AND NOT regexp_full_match("case", 'SC-\d{{6,7}}-\d{{4}}')
UNION ALL SELECT charge, 'charge', 'WARNING', 'Charge number format unexpected: ' || coalesce(charge, '') FROM report_fields WHERE NOT regexp_full_match(coalesce(charge, ''), '(DAC|MAC|MCN)-\d{{6}}-\d{{4}}')
UNION ALL SELECT charge, 'accused_age', 'WARNING', 'Accused age looks unusual: ' || CAST(accused_age AS VARCHAR) FROM report_fields WHERE accused_age NOT BETWEEN 7 AND 120
UNION ALL SELECT charge, 'accused_gender', 'ERROR', 'Invalid gender value: ' || accused_gender FROM report_fields WHERE accused_gender <> '' AND accused_gender NOT IN ('M', 'F')
UNION ALL SELECT charge, 'victim_age', 'WARNING', 'Victim age looks unusual: ' || CAST(victim_age AS VARCHAR) FROM report_fields WHERE victim_name IS NOT NULL AND victim_age NOT BETWEEN 0 AND 120
UNION ALL SELECT charge, 'victim_gender', 'ERROR', 'Invalid victim gender value: ' || victim_gender FROM report_fields WHERE victim_name IS NOT NULL AND victim_gender <> '' AND victim_gender NOT IN ('M', 'F')"""

PARTS["answer_json"] = """
SELECT doc_id, CASE WHEN json_valid(body) THEN CASE WHEN json_type(body) = 'OBJECT' THEN body END END AS j
FROM (SELECT doc_id, trim(CASE WHEN contains(answer, '```json') THEN split_part(split_part(answer, '```json', 2), '```', 1) WHEN contains(answer, '```') THEN split_part(split_part(answer, '```', 2), '```', 1) ELSE answer END, ' ' || chr(10)) AS body
      FROM landing_answers)"""


def _json(field: str) -> str:
    return f"nullif(json_extract_string(j, '$.{field}'), '')"


PARTS["answer_fields"] = (
    f"SELECT doc_id, {_json('case')} AS \"case\", CASE WHEN json_exists(j, '$.charge') THEN {_json('charge')} ELSE doc_id END AS charge, "
    + ", ".join(
        f"{_json(f)} AS {f}"
        for f in "accused_name accused_age accused_gender accused_relationship_to_victim victim_name victim_age victim_gender victim_relationship_to_accused offence_group special_type".split()
    )
    + " FROM answer_json WHERE j IS NOT NULL"
)


def statement(sql: str, **extra: str) -> str:
    """Prefix ``sql`` with the parts it needs; ``extra`` adds parts of its own."""
    parts = {**PARTS, **extra}
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in parts:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(parts[name])

    visit(sql)
    names: list[str] = []

    def place(name: str) -> None:
        if name in names:
            return
        for other in needed:
            if other != name and re.search(rf"\b{other}\b", parts[name]):
                place(other)
        names.append(name)

    for name in parts:
        if name in needed:
            place(name)
    head = ",\n".join(f"{n} AS ({parts[n].strip()})" for n in names)
    return f"WITH {head}\n{sql}" if head else sql
