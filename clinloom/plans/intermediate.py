"""Intermediate models: joins across sources and daily metrics.

Lookups by a unique key (providers, patients) are plain left joins without a hint: Catalyst or AQE broadcasts the lookup
while it is below the session's threshold, shuffles it beyond, and splits hot keys of the left side. Joins to many rows
of one key go through ``left_join_many``, which leaves AQE free to split either side.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.functions import avg_exact, hours_between, labelled, literal_date, packed_id, unpacked_id, whole_days
from clinloom.operators.distinct import distinct_counts
from clinloom.operators.joins import left_join_many
from clinloom.operators.spine import densify

COMPLETED, OVERDUE, PENDING = "completed", "overdue", "pending"


def _case_columns(cases: DataFrame) -> DataFrame:
    return cases.select(
        "case_id",
        "provider_id",
        "patient_mrn",
        "case_type",
        F.col("status").alias("case_status"),
        "priority",
        F.col("created_at").alias("case_created_at"),
        F.col("closed_at").alias("case_closed_at"),
    )


def _review_columns(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        "review_id",
        "case_id",
        "physician_id",
        "review_date",
        "review_status",
        "due_date",
        F.col("completed_at").alias("review_completed_at"),
    )


def _with_review_measures(rows: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Days against the due date, days to complete, and whether the review is overdue on ``as_of``."""
    today = literal_date(as_of)
    status, due, done = F.col("review_status"), F.col("due_date"), F.col("review_completed_at")
    late = (status == OVERDUE) | ((due < today) & (status == PENDING))
    return rows.withColumns(
        {
            "days_from_due_date": F.when(status == COMPLETED, F.datediff(done.cast("date"), due)).when(
                status == OVERDUE, F.datediff(today, due)
            ),
            "days_to_complete_review": F.when(status == COMPLETED, whole_days(F.col("case_created_at"), done)),
            "is_overdue": F.coalesce(late, F.lit(False)),
        }
    )


def int_case_review_status(
    cases: DataFrame, reviews: DataFrame, providers: DataFrame, as_of: dt.date | str
) -> DataFrame:
    """One row for each case and review; a case without review has one row.

    The provider is looked up for the cases, before their reviews multiply them. Ids are packed for both joins.
    """
    own, found = _case_columns(cases), _review_columns(reviews)
    lookup = _packed(providers.select("provider_id", "supervising_physician_id", "provider_type", "state_id"))
    assigned = _packed(own).join(lookup, "provider_id", "left")
    rows = left_join_many(assigned, _packed(found), ["case_id"])
    columns = [
        "case_id",
        "provider_id",
        *[c for c in (*own.columns, *found.columns) if c not in ("case_id", "provider_id")],
        "supervising_physician_id",
        "provider_type",
        "state_id",
    ]
    return _with_review_measures(rows.select(*[unpacked_id(c).alias(c) if c in IDS else c for c in columns]), as_of)


IDS = ("case_id", "provider_id", "review_id", "physician_id", "supervising_physician_id", "state_id")


def _packed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: packed_id(c) for c in rows.columns if c in IDS})


def supervisors(providers: DataFrame) -> DataFrame:
    """Physicians who supervise somebody, with the number of their providers."""
    supervised = providers.where(F.col("supervising_physician_id").isNotNull())
    return supervised.groupBy(F.col("supervising_physician_id").alias("physician_id")).agg(
        F.count_distinct("provider_id").alias("total_providers_supervised")
    )


def daily_reviews(cases: DataFrame, reviews: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Review measures for each physician (``physician``, a packed id) and review date.

    Only dated reviews count, so cases join inner and just lend their creation time; the provider lookup of
    ``int_case_review_status`` is unique by key and adds no measure, so it is left out. Partial aggregation runs
    before the shuffle, so a hot physician does not gather raw rows in one task. Ids are shuffled packed.
    """
    dated = _review_columns(reviews).where(F.col("review_date").isNotNull()).drop("review_id")
    dated = dated.withColumns({"case_id": packed_id("case_id"), "physician": packed_id("physician_id")}).drop("physician_id")
    created = cases.select(packed_id("case_id").alias("case_id"), F.col("created_at").alias("case_created_at"))
    rows = _with_review_measures(dated.join(created, "case_id"), as_of)
    status = F.col("review_status")
    return rows.groupBy("physician", F.col("review_date").alias("date_key")).agg(
        F.count_if(status == COMPLETED).alias("cases_reviewed"),
        F.count_if((status == PENDING) & (F.col("due_date") >= F.col("review_date"))).alias("cases_pending_review"),
        F.count_if("is_overdue").alias("cases_overdue"),
        avg_exact(F.col("days_to_complete_review")).alias("avg_days_to_review"),
    )


def dense_daily(
    entities: DataFrame, daily: DataFrame, key: str, start_date: dt.date | str, as_of: dt.date | str
) -> DataFrame:
    counts = ["cases_reviewed", "cases_pending_review", "cases_overdue"]
    return densify(entities, daily, key, "date_key", start_date, as_of, zero=counts)


def int_physician_daily_metrics(
    cases: DataFrame, reviews: DataFrame, providers: DataFrame, start_date: dt.date | str, as_of: dt.date | str
) -> DataFrame:
    """One row for each supervising physician and day of the period."""
    entities = supervisors(providers).withColumn("physician", packed_id("physician_id"))
    return dense_daily(entities, daily_reviews(cases, reviews, as_of), "physician", start_date, as_of).select(
        "physician_id",
        "date_key",
        "total_providers_supervised",
        "cases_reviewed",
        "cases_pending_review",
        "cases_overdue",
        "avg_days_to_review",
    )


VISIT_DAY = ["patient_id", "provider_npi", "visit_day"]


def appointment_flags() -> dict:
    status = F.col("appointment_status")
    return {
        "is_completed": status == "fulfilled",
        "is_no_show": status == "noshow",
        "is_cancelled": status == "cancelled",
    }


def int_appointment_utilization(appointments: DataFrame, encounters: DataFrame, providers: DataFrame) -> DataFrame:
    """Appointments with every encounter of the same patient, provider and day; several encounters repeat the row."""
    lookup = providers.select(F.col("npi").alias("provider_npi"), "provider_id", "supervising_physician_id")
    same_day = encounters.select(
        "patient_id",
        "provider_npi",
        F.col("encounter_start").cast("date").alias("visit_day"),
        "encounter_id",
        "encounter_class",
        "primary_diagnosis_code",
        "primary_diagnosis_desc",
    )
    days = appointments.withColumn("visit_day", F.col("scheduled_start").cast("date"))
    rows = left_join_many(days, same_day, VISIT_DAY).join(lookup, "provider_npi", "left")
    return rows.select(
        "appointment_id",
        "appointment_status",
        "appointment_type",
        "scheduled_start",
        "scheduled_end",
        "duration_minutes",
        "created_at",
        "patient_id",
        "provider_npi",
        "provider_id",
        "supervising_physician_id",
        *[flag.alias(name) for name, flag in appointment_flags().items()],
        F.col("encounter_id").isNotNull().alias("has_encounter"),
        "encounter_id",
        "encounter_class",
        "primary_diagnosis_code",
        "primary_diagnosis_desc",
    )


def int_provider_panel_metrics(encounters: DataFrame, providers: DataFrame) -> DataFrame:
    """One row for each provider and patient.

    Encounters are aggregated first, so the provider lookup joins one row for each pair instead of each encounter.
    """
    pairs = distinct_counts(
        encounters,
        ["provider_npi", "patient_id"],
        {"distinct_encounter_classes": "encounter_class", "distinct_diagnoses": "primary_diagnosis_code"},
        {
            "encounter_count": (F.count("*"), "sum"),
            "first_encounter_date": (F.min("encounter_start"), "min"),
            "last_encounter_date": (F.max("encounter_start"), "max"),
        },
    )
    lookup = providers.select(F.col("npi").alias("provider_npi"), "provider_id", "supervising_physician_id")
    return pairs.join(lookup, "provider_npi", "left").select(
        "provider_npi",
        "provider_id",
        "supervising_physician_id",
        "patient_id",
        "encounter_count",
        "first_encounter_date",
        "last_encounter_date",
        "distinct_encounter_classes",
        "distinct_diagnoses",
    )


def paired_stays(admissions: DataFrame, discharges: DataFrame) -> DataFrame:
    """Admissions with their discharge, by visit number."""
    left = discharges.select(
        "visit_number",
        F.col("message_id").alias("discharge_message_id"),
        "discharge_datetime",
    )
    stays = admissions.select(
        F.col("message_id").alias("admit_message_id"),
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
    )
    admitted, discharged = F.col("admit_datetime"), F.col("discharge_datetime")
    return left_join_many(stays, left, ["visit_number"]).withColumns(
        {
            "adt_status": labelled([(discharged.isNotNull(), "discharged")], "admitted"),
            "length_of_stay_hours": hours_between(admitted, discharged),
        }
    )


def with_patient(stays: DataFrame, patients: DataFrame) -> DataFrame:
    known = patients.select(F.col("mrn").alias("patient_mrn"), F.col("patient_id").alias("emr_patient_id"))
    return stays.join(known, "patient_mrn", "left")


def with_encounter(stays: DataFrame, encounters: DataFrame) -> DataFrame:
    """Every encounter of the same patient and provider on the day of admission."""
    same_day = encounters.select(
        F.col("patient_id").alias("emr_patient_id"),
        F.col("provider_npi").alias("attending_provider_npi"),
        F.col("encounter_start").cast("date").alias("visit_day"),
        F.col("encounter_id").alias("emr_encounter_id"),
        "encounter_type",
        "chief_complaint",
        "primary_diagnosis_desc",
        "primary_diagnosis_code",
    )
    days = stays.withColumn("visit_day", F.col("admit_datetime").cast("date"))
    return left_join_many(days, same_day, ["emr_patient_id", "attending_provider_npi", "visit_day"]).drop("visit_day")


def int_patient_encounters(
    admissions: DataFrame, discharges: DataFrame, patients: DataFrame, encounters: DataFrame
) -> DataFrame:
    """One row for each admission and matching EMR encounter."""
    stays = with_patient(paired_stays(admissions, discharges), patients)
    return with_encounter(stays, encounters).select(
        "admit_message_id",
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
        "discharge_message_id",
        "discharge_datetime",
        "adt_status",
        "length_of_stay_hours",
        "emr_patient_id",
        "emr_encounter_id",
        "encounter_type",
        "chief_complaint",
        "primary_diagnosis_desc",
        "primary_diagnosis_code",
    )
