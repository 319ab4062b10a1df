"""The declared data-quality rules: 39 on staging models, 38 on marts, and the constraints of the source tables."""

from __future__ import annotations

from clinloom.operators.quality import ACCEPTED, NOT_NULL, RELATIONSHIP, UNIQUE, Rule

# The accepted values of the coded columns.
PROVIDER_TYPES = ("NP", "PA")
CASE_STATUSES = ("open", "closed", "pending_review")
CASE_PRIORITIES = ("low", "normal", "high", "urgent")
REVIEW_STATUSES = ("pending", "completed", "overdue")
APPOINTMENT_STATUSES = ("booked", "fulfilled", "cancelled", "noshow")
ENCOUNTER_STATUSES = ("finished", "in-progress", "planned")
PATIENT_CLASSES = ("I", "E", "O")
ABNORMAL_FLAGS = ("N", "L", "H", "LL", "HH")
ADT_STATUSES = ("admitted", "discharged")
WORKLOADS = ("normal", "high", "warning", "critical")
UTILIZATIONS = ("well_utilized", "moderate", "underutilized", "high_no_show")


def _keys(table: str, *columns: str) -> list[Rule]:
    """Unique and not null."""
    return [Rule(table, column, kind) for column in columns for kind in (UNIQUE, NOT_NULL)]


def _required(table: str, *columns: str) -> list[Rule]:
    return [Rule(table, column, NOT_NULL) for column in columns]


def _accepted(table: str, column: str, values: tuple) -> Rule:
    return Rule(table, column, ACCEPTED, values=values)


def _refers(table: str, column: str, parent: str, parent_column: str) -> Rule:
    return Rule(table, column, RELATIONSHIP, parent=parent, parent_column=parent_column)


STAGING_RULES = [
    *_keys("stg_oltp__physicians", "physician_id", "npi"),
    *_keys("stg_oltp__providers", "provider_id", "npi"),
    _accepted("stg_oltp__providers", "provider_type", PROVIDER_TYPES),
    *_keys("stg_oltp__cases", "case_id"),
    _accepted("stg_oltp__cases", "status", CASE_STATUSES),
    *_keys("stg_oltp__case_reviews", "review_id"),
    _accepted("stg_oltp__case_reviews", "review_status", REVIEW_STATUSES),
    *_keys("stg_oltp__states", "state_id", "state_code"),
    *_required("stg_s3__contacts", "contact_id"),
    _accepted("stg_s3__contacts", "source_type", ("csv",)),
    *_required("stg_hubspot__contacts", "contact_id"),
    _accepted("stg_hubspot__contacts", "source_type", ("api",)),
    *_keys("stg_emr__patients", "patient_id"),
    *_keys("stg_emr__appointments", "appointment_id"),
    _accepted("stg_emr__appointments", "appointment_status", APPOINTMENT_STATUSES),
    *_keys("stg_emr__encounters", "encounter_id"),
    _accepted("stg_emr__encounters", "encounter_status", ENCOUNTER_STATUSES),
    *_keys("stg_hl7__admissions", "message_id"),
    _accepted("stg_hl7__admissions", "patient_class", PATIENT_CLASSES),
    *_keys("stg_hl7__discharges", "message_id"),
    _accepted("stg_hl7__discharges", "patient_class", PATIENT_CLASSES),
    *_required("stg_hl7__lab_results", "message_id"),
    _accepted("stg_hl7__lab_results", "abnormal_flag", ABNORMAL_FLAGS),
]

MART_RULES = [
    *_keys("dim_physician", "physician_key", "physician_id", "npi"),
    *_required("dim_physician", "full_name", "is_current"),
    *_keys("dim_provider", "provider_key", "provider_id"),
    _accepted("dim_provider", "provider_type", PROVIDER_TYPES),
    _refers("dim_provider", "supervising_physician_key", "dim_physician", "physician_key"),
    *_keys("dim_state", "state_key", "state_code"),
    *_required(
        "fact_provider_case_load",
        "physician_key",
        "date_key",
        "cases_reviewed",
        "cases_pending_review",
        "cases_overdue",
    ),
    _refers("fact_provider_case_load", "physician_key", "dim_physician", "physician_key"),
    _accepted("fact_provider_case_load", "workload_status", WORKLOADS),
    *_keys("dim_patient", "patient_key", "patient_id"),
    *_keys("fact_patient_encounters", "visit_number"),
    *_required("fact_patient_encounters", "admit_date_key"),
    _accepted("fact_patient_encounters", "patient_class", PATIENT_CLASSES),
    _accepted("fact_patient_encounters", "adt_status", ADT_STATUSES),
    *_required("fact_patient_utilization", "provider_key", "date_key"),
    _refers("fact_patient_utilization", "provider_key", "dim_provider", "provider_key"),
    _accepted("fact_patient_utilization", "utilization_status", UTILIZATIONS),
]

# Constraints of the relational source, checked on its raw tables.
SOURCE_RULES = [
    *_keys("states", "id", "code"),
    *_required("states", "name"),
    *_keys("physicians", "id", "npi"),
    *_required("physicians", "first_name", "last_name"),
    _refers("physicians", "state_license_id", "states", "id"),
    *_keys("providers", "id", "npi"),
    *_required("providers", "first_name", "last_name", "provider_type"),
    _accepted("providers", "provider_type", PROVIDER_TYPES),
    _refers("providers", "supervising_physician_id", "physicians", "id"),
    _refers("providers", "state_id", "states", "id"),
    *_keys("cases", "id"),
    *_required("cases", "provider_id", "patient_mrn", "case_type"),
    _accepted("cases", "status", CASE_STATUSES),
    _accepted("cases", "priority", CASE_PRIORITIES),
    _refers("cases", "provider_id", "providers", "id"),
    *_keys("case_reviews", "id"),
    *_required("case_reviews", "case_id", "physician_id", "review_date", "review_status", "due_date"),
    _accepted("case_reviews", "review_status", REVIEW_STATUSES),
    _refers("case_reviews", "case_id", "cases", "id"),
    _refers("case_reviews", "physician_id", "physicians", "id"),
]
