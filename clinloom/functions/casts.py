"""Casts whose rules differ between PostgreSQL and Spark."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

UUID_TEXT = r"^(\{([0-9a-f]{4}-?){7}[0-9a-f]{4}\}|([0-9a-f]{4}-?){7}[0-9a-f]{4})$"
UUID_GROUPS = r"^(.{8})(.{4})(.{4})(.{4})(.{12})$"
CANONICAL_UUID = r"^[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}\z"
UUID_BYTES = 16
# Longer than a UUID, so that no other text is taken for one.
NO_UUID = bytes(UUID_BYTES + 1)
# Leading digits of an HL7 time in one of its precisions, year to second.
HL7_DIGITS = r"^\d{14}|^\d{4}(?:\d{2}){0,4}(?!\d)"
HL7_DEFAULTS = "????0101000000"


def as_text(column: Column | str) -> Column:
    return _col(column).cast("string")


def as_uuid(column: Column | str) -> Column:
    """Text to UUID in its canonical lower-case form; text that is no UUID fails the job, as a cast does."""
    text = F.lower(_col(column))
    digits = F.regexp_replace(text, "[{}-]", "")
    canonical = F.regexp_replace(digits, UUID_GROUPS, "$1-$2-$3-$4-$5")
    bad = F.raise_error(F.concat(F.lit("not a UUID: "), text)).cast("string")
    return F.when(text.isNull(), F.lit(None).cast("string")).when(text.rlike(UUID_TEXT), canonical).otherwise(bad)


def packed_id(column: Column | str) -> Column:
    """An identifier text as bytes, to be joined, grouped and shuffled by: 16 for a canonical UUID, which as text has 36 that
    a shuffle can't compress. Any other text is kept behind a mark; different texts stay different. ``unpacked_id`` reverts it."""
    text = _col(column)
    other = F.concat(F.lit(NO_UUID), text.cast("binary"))
    return F.when(text.rlike(CANONICAL_UUID), F.unhex(F.replace(text, F.lit("-"), F.lit("")))).otherwise(other)


def unpacked_id(column: Column | str) -> Column:
    packed = _col(column)
    # Each byte is turned into digits once.
    uuid = F.lower(F.concat_ws("-", *[F.hex(F.substring(packed, at, size)) for at, size in ((1, 4), (5, 2), (7, 2), (9, 2), (11, 6))]))
    other = F.substring(packed, len(NO_UUID) + 1, 2**31 - 1).cast("string")
    return F.when(F.octet_length(packed) == UUID_BYTES, uuid).otherwise(other)


def iso_timestamp(column: Column | str) -> Column:
    """ISO text to a zone-less timestamp; an offset in the text is dropped, not applied."""
    return _col(column).cast("timestamp_ntz")


def hl7_timestamp(column: Column | str) -> Column:
    """``YYYYMMDDHHMMSS`` text to a zone-less timestamp.

    Shorter precisions (year to minute) take the start of their period, anything after the seconds is ignored, and
    text that holds no valid time (such as the empty text of an absent field) is null.
    """
    filled = F.overlay(F.lit(HL7_DEFAULTS), F.regexp_extract(_col(column), HL7_DIGITS, 0), F.lit(1))
    # By position, which is cheaper than a second pattern; the marks of a missing year fail the cast.
    parts = [F.substring(filled, at, size) for at, size in ((1, 4), (5, 2), (7, 2), (9, 2), (11, 2), (13, 2))]
    marked = [part for pair in zip(parts, map(F.lit, ("-", "-", " ", ":", ":", "")), strict=True) for part in pair]
    return F.concat(*marked[:-1]).try_cast("timestamp_ntz")


def literal_date(value: dt.date | str) -> Column:
    return F.lit(str(value)).cast("date")


def null_date() -> Column:
    return F.lit(None).cast("date")


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
