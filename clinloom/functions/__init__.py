"""Column expressions shared by all models; every one is a built-in composition."""

from clinloom.functions.casts import as_text, as_uuid, hl7_timestamp, iso_timestamp, literal_date, null_date, packed_id, unpacked_id
from clinloom.functions.measures import avg_exact, hours_between, labelled, rate_pct, rounded, whole_days
from clinloom.functions.nested import element, json_text, parsed

__all__ = [
    "as_text",
    "as_uuid",
    "avg_exact",
    "element",
    "hl7_timestamp",
    "hours_between",
    "iso_timestamp",
    "json_text",
    "labelled",
    "literal_date",
    "null_date",
    "packed_id",
    "parsed",
    "rate_pct",
    "rounded",
    "unpacked_id",
    "whole_days",
]
