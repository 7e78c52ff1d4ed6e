"""Row-level quality flags as a declarative rule table.

A rule names the rows that are *bad*; a flag is false only where the predicate
is TRUE, so an unknown comparison passes. ``is_valid_row`` holds when any flag
passes (the contract of the layer); ``is_clean_row`` when all do.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.functions.dates import parse_date, parse_timestamp
from caselake.functions.text import blank_to_null, upper_trim

# The domains the flags check.
CHARGE_TYPES = ("DAC", "MAC", "MCN")
RWPU_CODES = ("M", "P", "R")
GENDERS = ("M", "F")
ENTITY_TYPES = ("Accused Person", "Victim")
ENTITY_AGES = (0, 120)
COURT_EVENT_TYPES = ("FM", "FM_PG", "PG", "CC", "PTC", "PH", "SENTENCING", "TRIAL", "MITIGATION")
COURT_EVENT_STATUSES = ("NEW", "VACATED", "VOIDED")
OUT_OF_HOURS = ((0, 7), (19, 23))

AUDIT = ("_rescued_data", "_source_file", "_file_date", "_ingested_at", "_bronze_loaded_at")

# Upsert key of each table.
KEYS = {
    "assignments": ["case_pid", "officer_id", "_file_date"],
    "charges": ["case_pid", "charge_no", "_file_date"],
    "offences": ["case_pid", "charge_no", "act_title", "reference", "rwpu_base", "description", "_file_date"],
    "cases": ["case_pid", "_file_date"],
    "entities": ["case_no", "charge_no", "entity_name", "_file_date"],
    "event_officers": ["court_event_id", "officer_id", "_file_date"],
    "events": ["case_pid", "court_event_id", "_file_date"],
}

# Business columns each table keeps, in order.
COLUMNS = {
    "assignments": ["case_pid", "cluster", "officer_name", "officer_id", "team"],
    "charges": ["case_pid", "charge_no", "charge_type", "charge_status", "offence_date", "filing_date"],
    "offences": ["case_pid", "charge_no", "act_title", "reference", "rwpu_base", "description"],
    "cases": [
        "accused_name",
        "case_no",
        "case_pid",
        "case_status",
        "case_title",
        "directorate",
        "accused_dob",
        "accused_gender",
    ],
    "entities": [
        "case_no",
        "charge_no",
        "entity_name",
        "entity_type",
        "entity_age",
        "entity_gender",
        "relationship_to_victim",
        "offence_group",
        "special_type",
    ],
    "event_officers": ["court_event_id", "officer_id", "officer_name", "officer_division"],
    "events": [
        "start_datetime",
        "end_datetime",
        "case_pid",
        "court_event_id",
        "court_number",
        "court_event_type",
        "court_event_status",
    ],
}


def _cleaned(source: str, mode: str) -> dict[str, Column]:
    """Columns that leave the layer in another form than they entered."""
    to_date = parse_date if mode == "strict" else (lambda c: F.col(c).try_cast("date"))
    cleaned = {
        "charges": {"offence_date": to_date("offence_date"), "filing_date": to_date("filing_date")},
        "cases": {
            "case_status": upper_trim("case_status"),
            "directorate": upper_trim("directorate"),
            "accused_dob": to_date("accused_dob"),
        },
    }
    if mode == "strict":
        cleaned["entities"] = {"special_type": blank_to_null("special_type")}
        cleaned["events"] = {"court_event_status": upper_trim("court_event_status")}
    return cleaned.get(source, {})


def _bad_rows(source: str, as_of: dt.date, mode: str, cleaned: dict[str, Column]) -> dict[str, Column]:
    """Flag name -> predicate for rows that fail it."""
    today = F.lit(as_of)

    def col(name: str) -> Column:
        return cleaned.get(name, F.col(name))

    def missing(name: str) -> Column:
        return F.col(name).isNull()

    def outside(name: str, domain: tuple[str, ...]) -> Column:
        return ~col(name).isin(*domain)

    rescued = {"rescued_data": F.col("_rescued_data").isNotNull()}
    if source == "assignments":
        return {"missing_officer_name": missing("officer_name"), **rescued}
    if source == "charges":
        return {
            "invalid_charge_type": outside("charge_type", CHARGE_TYPES),
            "future_offence_date": col("offence_date") > today,
            "future_filing_date": col("filing_date") > today,
            "filing_before_offence": col("filing_date") < col("offence_date"),
            **rescued,
        }
    if source == "offences":
        return {"invalid_rwpu": outside("rwpu_base", RWPU_CODES), **rescued}
    if source == "cases":
        # the written rule looks at the raw text for presence, the strict one at the parsed date
        absent = col("accused_dob").isNull() if mode == "strict" else missing("accused_dob")
        return {
            "missing_case_no": missing("case_no"),
            "future_accused_dob": absent | (col("accused_dob") > today),
            "invalid_gender": outside("accused_gender", GENDERS),
            **rescued,
        }
    if source == "entities":
        low, high = ENTITY_AGES
        age = F.col("entity_age").try_cast("bigint")
        return {
            "missing_case_no": missing("case_no"),
            "missing_charge_no": missing("charge_no"),
            "missing_entity_name": missing("entity_name"),
            "missing_entity_type": missing("entity_type"),
            "invalid_entity_type": outside("entity_type", ENTITY_TYPES),
            "invalid_entity_age": ~age.between(low, high),
            "invalid_entity_gender": outside("entity_gender", GENDERS),
            "missing_offence_group": missing("offence_group"),
        }
    if source == "event_officers":
        return {"missing_officer_name": missing("officer_name"), **rescued}
    if source == "events":
        start, end = parse_timestamp("start_datetime"), parse_timestamp("end_datetime")
        out_of_hours = reduce(lambda a, b: a | b, [F.hour(start).between(lo, hi) for lo, hi in OUT_OF_HOURS])
        return {
            "missing_start_datetime": missing("start_datetime"),
            "missing_end_datetime": missing("end_datetime"),
            "early_start_datetime": out_of_hours,
            "end_before_start": end < start,
            "missing_court_number": missing("court_number"),
            "invalid_court_event_type": outside("court_event_type", COURT_EVENT_TYPES),
            "invalid_court_event_status": outside("court_event_status", COURT_EVENT_STATUSES),
        }
    raise KeyError(source)


def add_flags(df: DataFrame, bad_rows: dict[str, Column], keep: list[Column]) -> DataFrame:
    """Project ``keep`` plus one ``_dq_`` flag per rule and the two row verdicts."""
    flags = [(~F.coalesce(bad, F.lit(False))).alias(f"_dq_{name}") for name, bad in bad_rows.items()]
    names = [F.col(f"_dq_{name}") for name in bad_rows]
    return df.select(*keep, *flags).select(
        "*",
        reduce(lambda a, b: a | b, names).alias("is_valid_row"),
        reduce(lambda a, b: a & b, names).alias("is_clean_row"),
    )


def to_quality(
    bronze: DataFrame,
    source: str,
    as_of: dt.date,
    mode: str = "strict",
    loaded_at: Column | None = None,
) -> DataFrame:
    """Accepted bronze rows with cleaned columns and quality flags."""
    cleaned = _cleaned(source, mode)
    keep = [cleaned.get(c, F.col(c)).alias(c) for c in COLUMNS[source]] + [F.col(c) for c in AUDIT]
    keep.append((F.current_timestamp() if loaded_at is None else loaded_at).alias("_silver_qa_loaded_at"))
    accepted = bronze.where(F.col("_rejected_reason").isNull())
    return add_flags(accepted, _bad_rows(source, as_of, mode, cleaned), keep)


def valid(df: DataFrame) -> DataFrame:
    return df.where("is_valid_row")
