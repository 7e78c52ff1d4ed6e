"""Column comments written with the tables."""

from __future__ import annotations

_CASE = {"case_skey": "key of the case", "case_pid": "process id of the case", "case_no": "number of the case"}
_OFFICER = {"officer_skey": "key of the officer version", "officer_id": "id of the officer", "officer_cluster": "cluster of the officer"}
_STATUS = {
    "case_status": "status of the case after its charges are considered",
    "case_type": "Trial, PG or TBD, from the scheduled events",
    "first_mention_date": "day of the earliest event of the case",
}

COMMENTS: dict[str, dict[str, str]] = {
    "dim_case": {**_CASE, "accused_skey": "key of the accused person", "case_title": "title of the case", "directorate": "directorate in charge"},
    "dim_officer": {
        **_OFFICER,
        "full_name": "name of the officer",
        "officer_team": "team of the officer",
        "row_start_date": "first day of this version",
        "row_end_date": "last day of this version, empty while it is current",
    },
    "fact_event_officer": {
        **_CASE,
        **_OFFICER,
        "event_officer_skey": "key of event and officer",
        "court_event_id": "id of the event",
        "court_event_type": "group of the event type",
        "court_event_date_skey": "day of the event as yyyyMMdd",
        "court_event_hearing_days": "share of a hearing day the event takes",
        "court_event_year": "year of the event",
    },
    "fact_case_charge": {
        **_CASE,
        "case_charge_skey": "key of case and charge",
        "victim_skey": "key of the victim",
        "relation_to_accused": "relationship of the victim",
        "case_status": _STATUS["case_status"],
        "charge_status": "status of the charge; settled with the case",
        "committed_date_skey": "day of the offence as yyyyMMdd",
        "offence_type": "kind of charge",
        "offence_group": "offence group, UNKNOWN without a victim record",
    },
    "fact_case_officer": {
        **_CASE,
        **_OFFICER,
        **_STATUS,
        "case_officer_skey": "key of case, officer and assignment start",
        "assigned_from_date_skey": "first day of the assignment as yyyyMMdd",
        "assigned_to_date_skey": "end of the assignment as yyyyMMdd, empty while it lasts",
        "case_complexity": "Complex or Simple",
        "first_mention_year": "year of the first mention",
    },
    "case_officer_workload": {
        **_OFFICER,
        **_STATUS,
        "case_count": "assignments in this row",
        "currently_assigned_count": "assignments that still last",
        "case_disposition_date": "last event day of a disposed case",
        "case_processing_days": "days from first mention to disposition, or to the build day",
    },
    "case_offence_distribution": {**_CASE, **_OFFICER, **_STATUS, "offence_group": "offence group", "case_count": "rows of this combination"},
    "event_offence_hearing_days": {
        **_OFFICER,
        **_STATUS,
        "offence_group": "offence group; an event repeats per group of its case",
        "hearing_days": "share of a hearing day",
        "last_court_event_date": "day of this event",
    },
}
