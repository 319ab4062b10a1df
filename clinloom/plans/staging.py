"""Staging models: one frame for each raw table, renamed, cast and pulled out of its nested documents.

All are narrow projections: no shuffle, and a reader of a staging frame prunes raw columns down to what it uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.functions import as_text, element, hl7_timestamp, iso_timestamp, parsed
from clinloom.operators.keyed import LOAD_COLUMNS


def _load_columns(raw: DataFrame) -> list[Column]:
    return [F.col(c) for c in LOAD_COLUMNS]


def _texts(**renames: str) -> list[Column]:
    return [as_text(source).alias(name) for name, source in renames.items()]


def stg_states(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_texts(state_id="id"),
        F.col("code").alias("state_code"),
        F.col("name").alias("state_name"),
        "supervision_requirements",
        "review_frequency_days",
        "created_at",
        "updated_at",
        *_load_columns(raw),
    )


def stg_physicians(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_texts(physician_id="id"),
        "npi",
        "first_name",
        "last_name",
        "specialty",
        *_texts(state_license_id="state_license_id"),
        "email",
        "phone",
        "is_active",
        "created_at",
        "updated_at",
        *_load_columns(raw),
    )


def stg_providers(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_texts(provider_id="id"),
        "npi",
        "first_name",
        "last_name",
        "provider_type",
        *_texts(supervising_physician_id="supervising_physician_id", state_id="state_id"),
        "email",
        "phone",
        "hire_date",
        "is_active",
        "created_at",
        "updated_at",
        *_load_columns(raw),
    )


def stg_cases(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_texts(case_id="id", provider_id="provider_id"),
        "patient_mrn",
        "case_type",
        "status",
        "priority",
        "created_at",
        "closed_at",
        "updated_at",
        *_load_columns(raw),
    )


def stg_case_reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_texts(review_id="id", case_id="case_id", physician_id="physician_id"),
        "review_date",
        "review_status",
        "notes",
        "due_date",
        "completed_at",
        "created_at",
        "updated_at",
        *_load_columns(raw),
    )


# Contact property -> column, the same for the CSV drop and the CRM.
CONTACT_COLUMNS = {
    "firstname": "first_name",
    "lastname": "last_name",
    "email": "email",
    "phone": "phone",
    "company": "company",
    "jobtitle": "job_title",
    "lifecyclestage": "lifecycle_stage",
    "hs_lead_status": "lead_status",
}


def stg_contacts_csv(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("contact_id"),
        *[F.col(source).alias(name) for source, name in CONTACT_COLUMNS.items()],
        iso_timestamp("createdate").alias("created_at"),
        iso_timestamp("lastmodifieddate").alias("last_modified_at"),
        *_load_columns(raw),
        F.lit("csv").alias("source_type"),
    )


def stg_contacts_api(raw: DataFrame) -> DataFrame:
    wanted = [*CONTACT_COLUMNS, "createdate", "lastmodifieddate"]
    properties = parsed(raw, "properties", "struct<" + ", ".join(f"{p}: string" for p in wanted) + ">")
    modified = F.coalesce(iso_timestamp(properties["lastmodifieddate"]), iso_timestamp("lastmodifieddate"))
    return raw.select(
        *_texts(contact_id="id"),
        *[properties[source].alias(name) for source, name in CONTACT_COLUMNS.items()],
        iso_timestamp(properties["createdate"]).alias("created_at"),
        modified.alias("updated_at"),
        *_load_columns(raw),
        F.lit("api").alias("source_type"),
    )


def _without_prefix(reference: Column) -> Column:
    return F.replace(reference, F.lit("Patient/"), F.lit(""))


def stg_patients(raw: DataFrame) -> DataFrame:
    """Contact points go by position: phone first, e-mail second."""
    identifier = element(parsed(raw, "identifier", "array<struct<value: string>>"), 0)
    name = element(parsed(raw, "name", "array<struct<family: string, given: array<string>>>"), 0)
    telecom = parsed(raw, "telecom", "array<struct<value: string>>")
    address = element(
        parsed(raw, "address", "array<struct<line: array<string>, city: string, state: string, postalCode: string>>"),
        0,
    )
    extension = element(parsed(raw, "extension", "array<struct<valueString: string>>"), 0)
    return raw.select(
        F.col("id").alias("patient_id"),
        identifier["value"].alias("mrn"),
        element(name["given"], 0).alias("first_name"),
        name["family"].alias("last_name"),
        F.col("birthDate").alias("date_of_birth"),
        "gender",
        element(telecom, 0)["value"].alias("phone"),
        element(telecom, 1)["value"].alias("email"),
        element(address["line"], 0).alias("address_line"),
        address["city"].alias("city"),
        address["state"].alias("state"),
        address["postalCode"].alias("postal_code"),
        extension["valueString"].alias("insurance_type"),
        *_load_columns(raw),
    )


CODED = "array<struct<coding: array<struct<display: string>>>>"


def _display(raw: DataFrame, column: str) -> Column:
    return element(element(parsed(raw, column, CODED), 0)["coding"], 0)["display"]


def stg_appointments(raw: DataFrame) -> DataFrame:
    """The first participant is the patient, the second the practitioner."""
    participant = parsed(
        raw,
        "participant",
        "array<struct<actor: struct<reference: string, identifier: struct<value: string>>>>",
    )
    return raw.select(
        F.col("id").alias("appointment_id"),
        F.col("status").alias("appointment_status"),
        _display(raw, "serviceType").alias("appointment_type"),
        iso_timestamp("start").alias("scheduled_start"),
        iso_timestamp("end").alias("scheduled_end"),
        F.col("minutesDuration").alias("duration_minutes"),
        iso_timestamp("created").alias("created_at"),
        _without_prefix(element(participant, 0)["actor"]["reference"]).alias("patient_id"),
        element(participant, 1)["actor"]["identifier"]["value"].alias("provider_npi"),
        *_load_columns(raw),
    )


def stg_encounters(raw: DataFrame) -> DataFrame:
    """The first participant is the practitioner; the patient is the subject."""
    participant = parsed(raw, "participant", "array<struct<individual: struct<identifier: struct<value: string>>>>")
    reason = parsed(raw, "reasonCode", "array<struct<text: string>>")
    diagnosis = parsed(
        raw,
        "diagnosis",
        "array<struct<condition: struct<display: string, extension: array<struct<valueString: string>>>>>",
    )
    condition = element(diagnosis, 0)["condition"]
    return raw.select(
        F.col("id").alias("encounter_id"),
        F.col("status").alias("encounter_status"),
        F.col("class_code").alias("encounter_class"),
        _display(raw, "type").alias("encounter_type"),
        _without_prefix(F.col("subject_reference")).alias("patient_id"),
        element(participant, 0)["individual"]["identifier"]["value"].alias("provider_npi"),
        iso_timestamp("period_start").alias("encounter_start"),
        iso_timestamp("period_end").alias("encounter_end"),
        element(reason, 0)["text"].alias("chief_complaint"),
        condition["display"].alias("primary_diagnosis_desc"),
        element(condition["extension"], 0)["valueString"].alias("primary_diagnosis_code"),
        F.col("length_value").alias("length_minutes"),
        *_load_columns(raw),
    )


def _with_times(raw: DataFrame, *times: str) -> DataFrame:
    return raw.select(*[hl7_timestamp(c).alias(c) if c in times else F.col(c) for c in raw.columns])


ADMISSION_COLUMNS = [
    "message_id",
    "patient_mrn",
    "patient_last_name",
    "patient_first_name",
    "patient_dob",
    "patient_gender",
    "attending_provider_npi",
    "patient_class",
    "admit_datetime",
    "visit_number",
    "sending_facility",
    "message_datetime",
]
DISCHARGE_COLUMNS = [
    "message_id",
    "patient_mrn",
    "patient_last_name",
    "patient_first_name",
    "attending_provider_npi",
    "patient_class",
    "admit_datetime",
    "discharge_datetime",
    "visit_number",
    "sending_facility",
    "message_datetime",
]
LAB_COLUMNS = [
    "message_id",
    "patient_mrn",
    "patient_last_name",
    "patient_first_name",
    "ordering_provider_npi",
    "order_number",
    "test_code",
    "test_name",
    "result_value",
    "result_units",
    "reference_range",
    "abnormal_flag",
    "observation_datetime",
    "sending_facility",
    "message_datetime",
]


def stg_admissions(raw: DataFrame) -> DataFrame:
    rows = raw.select(*ADMISSION_COLUMNS, *LOAD_COLUMNS)
    return _with_times(rows, "admit_datetime", "message_datetime")


def stg_discharges(raw: DataFrame) -> DataFrame:
    rows = raw.select(*DISCHARGE_COLUMNS, *LOAD_COLUMNS)
    return _with_times(rows, "admit_datetime", "discharge_datetime", "message_datetime")


def stg_lab_results(raw: DataFrame) -> DataFrame:
    rows = raw.select(*LAB_COLUMNS, *LOAD_COLUMNS)
    return _with_times(rows, "observation_datetime", "message_datetime")


# Model name -> (raw table, function).
STAGING = {
    "stg_oltp__states": ("states", stg_states),
    "stg_oltp__physicians": ("physicians", stg_physicians),
    "stg_oltp__providers": ("providers", stg_providers),
    "stg_oltp__cases": ("cases", stg_cases),
    "stg_oltp__case_reviews": ("case_reviews", stg_case_reviews),
    "stg_s3__contacts": ("contacts_csv", stg_contacts_csv),
    "stg_hubspot__contacts": ("contacts", stg_contacts_api),
    "stg_emr__patients": ("fhir_patients", stg_patients),
    "stg_emr__appointments": ("fhir_appointments", stg_appointments),
    "stg_emr__encounters": ("fhir_encounters", stg_encounters),
    "stg_hl7__admissions": ("hl7_admissions", stg_admissions),
    "stg_hl7__discharges": ("hl7_discharges", stg_discharges),
    "stg_hl7__lab_results": ("hl7_lab_results", stg_lab_results),
}
