"""Declared schemas of the source records; no reader infers types."""

from __future__ import annotations

RELATIONAL = {
    "states": (
        "id string, code string, name string, supervision_requirements string, review_frequency_days int, "
        "created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "physicians": (
        "id string, npi string, first_name string, last_name string, specialty string, state_license_id string, "
        "email string, phone string, is_active boolean, created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "providers": (
        "id string, npi string, first_name string, last_name string, provider_type string, "
        "supervising_physician_id string, state_id string, email string, phone string, hire_date date, "
        "is_active boolean, created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "cases": (
        "id string, provider_id string, patient_mrn string, case_type string, status string, priority string, "
        "created_at timestamp_ntz, closed_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "case_reviews": (
        "id string, case_id string, physician_id string, review_date date, review_status string, notes string, "
        "due_date date, completed_at timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
}

# Values a source column takes when it is left out.
RELATIONAL_DEFAULTS = {
    "states": {"review_frequency_days": 30},
    "physicians": {"is_active": True},
    "providers": {"is_active": True},
    "cases": {"status": "open", "priority": "normal"},
    "case_reviews": {},
}

CONTACT_PROPERTIES = (
    "struct<firstname: string, lastname: string, email: string, phone: string, company: string, jobtitle: string, "
    "lifecyclestage: string, hs_lead_status: string, createdate: string, lastmodifieddate: string, "
    "hs_lastmodifieddate: string, hs_object_id: string>"
)
DEAL_PROPERTIES = (
    "struct<dealname: string, amount: string, dealstage: string, pipeline: string, closedate: string, "
    "createdate: string, lastmodifieddate: string, hs_lastmodifieddate: string, hs_object_id: string>"
)
COMPANY_PROPERTIES = (
    "struct<name: string, domain: string, industry: string, numberofemployees: string, city: string, state: string, "
    "createdate: string, lastmodifieddate: string, hs_lastmodifieddate: string, hs_object_id: string>"
)
CRM_ASSOCIATIONS = "struct<contacts: struct<results: array<struct<id: string, type: string>>>>"
CRM = {
    "contacts": f"id: string, properties: {CONTACT_PROPERTIES}, createdAt: string, updatedAt: string, archived: boolean",
    "companies": f"id: string, properties: {COMPANY_PROPERTIES}, createdAt: string, updatedAt: string, archived: boolean",
    "deals": (
        f"id: string, properties: {DEAL_PROPERTIES}, associations: {CRM_ASSOCIATIONS}, createdAt: string, "
        "updatedAt: string, archived: boolean"
    ),
}

IDENTIFIER = (
    "array<struct<use: string, type: struct<coding: array<struct<system: string, code: string>>>, "
    "system: string, value: string>>"
)
EXTENSION = "array<struct<url: string, valueString: string>>"
CODINGS = "array<struct<coding: array<struct<system: string, code: string, display: string>>>>"
HUMAN_NAME = "array<struct<use: string, family: string, given: array<string>>>"
TELECOM = "array<struct<system: string, value: string, use: string>>"
ADDRESS = (
    "array<struct<use: string, line: array<string>, city: string, state: string, postalCode: string, country: string>>"
)
APPOINTMENT_PARTICIPANT = (
    "array<struct<actor: struct<reference: string, display: string, "
    "identifier: struct<system: string, value: string>>, status: string>>"
)
ENCOUNTER_PARTICIPANT = (
    "array<struct<individual: struct<reference: string, identifier: struct<system: string, value: string>>>>"
)
REASON = "array<struct<coding: array<struct<system: string, code: string, display: string>>, text: string>>"
DIAGNOSIS = (
    "array<struct<condition: struct<display: string, extension: array<struct<url: string, valueString: string>>>, "
    "use: struct<coding: array<struct<system: string, code: string>>>, rank: int>>"
)

FHIR = {
    "fhir_patients": (
        f"resourceType: string, id: string, identifier: {IDENTIFIER}, active: boolean, name: {HUMAN_NAME}, "
        f"telecom: {TELECOM}, gender: string, birthDate: string, address: {ADDRESS}, extension: {EXTENSION}"
    ),
    "fhir_appointments": (
        f"resourceType: string, id: string, status: string, serviceType: {CODINGS}, start: string, `end`: string, "
        f"minutesDuration: int, created: string, participant: {APPOINTMENT_PARTICIPANT}"
    ),
    "fhir_encounters": (
        "resourceType: string, id: string, status: string, "
        f"class: struct<system: string, code: string, display: string>, type: {CODINGS}, "
        f"subject: struct<reference: string>, participant: {ENCOUNTER_PARTICIPANT}, "
        f"period: struct<start: string, `end`: string>, reasonCode: {REASON}, diagnosis: {DIAGNOSIS}, "
        "length: struct<value: int, unit: string, system: string, code: string>"
    ),
}
