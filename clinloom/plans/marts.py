"""Mart models: dimensions with surrogate keys, and daily and visit facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clinloom.functions import as_uuid, labelled, null_date, packed_id, rate_pct, rounded
from clinloom.operators.surrogate import surrogate_key
from clinloom.plans.intermediate import (
    VISIT_DAY,
    appointment_flags,
    daily_reviews,
    dense_daily,
    paired_stays,
    supervisors,
    with_encounter,
    with_patient,
)


def _full_name() -> Column:
    return F.concat("first_name", F.lit(" "), "last_name").alias("full_name")


def _current_record() -> list[Column]:
    """Type 1 history columns: valid since creation, open, current."""
    return [
        F.col("created_at").cast("date").alias("effective_from"),
        null_date().alias("effective_to"),
        F.lit(True).alias("is_current"),
        F.col("updated_at").alias("last_updated_at"),
    ]


def dim_state(states: DataFrame) -> DataFrame:
    rows = states.select(
        "state_code",
        "state_name",
        "supervision_requirements",
        "review_frequency_days",
        F.col("created_at").alias("last_updated_at"),
    )
    return surrogate_key(rows, "state_code", "state_key")


def dim_physician(physicians: DataFrame, states: DataFrame) -> DataFrame:
    licensed = states.select(F.col("state_id").alias("state_license_id"), "state_code", "state_name")
    keyed = surrogate_key(physicians, "physician_id", "physician_key")
    return keyed.join(licensed, "state_license_id", "left").select(
        "physician_key",
        as_uuid("physician_id").alias("physician_id"),
        "npi",
        _full_name(),
        "first_name",
        "last_name",
        "specialty",
        "email",
        "phone",
        "is_active",
        "state_code",
        "state_name",
        *_current_record(),
    )


def dim_provider(providers: DataFrame, physicians: DataFrame, states: DataFrame) -> DataFrame:
    """``physicians`` is the finished physician dimension."""
    supervising = physicians.select(
        F.col("physician_id").alias("_supervisor"),
        F.col("physician_key").alias("supervising_physician_key"),
        F.col("full_name").alias("supervising_physician_name"),
    )
    located = states.select("state_id", "state_code", "state_name", "review_frequency_days")
    keyed = surrogate_key(providers, "provider_id", "provider_key")
    return (
        keyed.withColumn("_supervisor", as_uuid("supervising_physician_id"))
        .join(supervising, "_supervisor", "left")
        .join(located, "state_id", "left")
        .select(
            "provider_key",
            as_uuid("provider_id").alias("provider_id"),
            "npi",
            _full_name(),
            "first_name",
            "last_name",
            "provider_type",
            "email",
            "phone",
            "hire_date",
            "is_active",
            "supervising_physician_key",
            "supervising_physician_name",
            "state_code",
            "state_name",
            "review_frequency_days",
            *_current_record(),
        )
    )


def dim_patient(patients: DataFrame, encounters: DataFrame) -> DataFrame:
    seen = encounters.groupBy("patient_id").agg(
        F.count("*").alias("total_encounters"),
        F.count_distinct("provider_npi").alias("provider_count"),
        F.min("encounter_start").alias("first_encounter_date"),
        F.max("encounter_start").alias("last_encounter_date"),
    )
    keyed = surrogate_key(patients, "patient_id", "patient_key")
    return keyed.join(seen, "patient_id", "left").select(
        "patient_key",
        "patient_id",
        "mrn",
        _full_name(),
        "first_name",
        "last_name",
        "date_of_birth",
        "gender",
        "insurance_type",
        "phone",
        "email",
        "city",
        "state",
        "postal_code",
        F.coalesce("total_encounters", F.lit(0)).alias("total_encounters"),
        F.coalesce("provider_count", F.lit(0)).alias("provider_count"),
        "first_encounter_date",
        "last_encounter_date",
    )


def fact_provider_case_load(
    cases: DataFrame,
    reviews: DataFrame,
    providers: DataFrame,
    physicians: DataFrame,
    start_date: dt.date | str,
    as_of: dt.date | str,
) -> DataFrame:
    """One row for each supervising physician and day.

    The physician key is looked up for the supervisors, before the days are filled in, so the dense rows meet no join.
    """
    keys = physicians.select(F.col("physician_id").alias("_uuid"), "physician_key")
    known = supervisors(providers).withColumn("_uuid", as_uuid("physician_id")).join(keys, "_uuid")
    entities = known.withColumn("physician", packed_id("physician_id")).drop("_uuid", "physician_id")
    rows = dense_daily(entities, daily_reviews(cases, reviews, as_of), "physician", start_date, as_of)
    reviewed, pending, overdue = (F.col(c) for c in ("cases_reviewed", "cases_pending_review", "cases_overdue"))
    total = reviewed + pending + overdue
    return rows.select(
        "physician_key",
        "date_key",
        "cases_reviewed",
        "cases_pending_review",
        "cases_overdue",
        "total_providers_supervised",
        rounded(F.col("avg_days_to_review"), 2).alias("avg_days_to_review"),
        total.alias("total_cases"),
        rate_pct(overdue, total).alias("overdue_rate_pct"),
        rate_pct(overdue + pending, total).alias("unfinished_rate_pct"),
        labelled([(overdue > 5, "critical"), (overdue > 2, "warning"), (pending > 10, "high")], "normal").alias(
            "workload_status"
        ),
    )


def fact_patient_encounters(
    admissions: DataFrame,
    discharges: DataFrame,
    patients: DataFrame,
    encounters: DataFrame,
    dim_patient: DataFrame,
    dim_provider: DataFrame,
    dim_physician: DataFrame,
) -> DataFrame:
    """One row for each admission and matching EMR encounter.

    Both lookups by medical-record number come before the encounter join, so they share one shuffle; the physician
    is looked up for the providers rather than for the visits.
    """
    by_mrn = dim_patient.select(F.col("mrn").alias("patient_mrn"), "patient_key")
    supervising = dim_physician.select(F.col("physician_key").alias("supervising_physician_key"))
    by_npi = dim_provider.select(
        F.col("npi").alias("attending_provider_npi"),
        "provider_key",
        F.col("supervising_physician_key").alias("_supervisor"),
    ).join(supervising, F.col("_supervisor") == F.col("supervising_physician_key"), "left")
    known = with_patient(paired_stays(admissions, discharges), patients).join(by_mrn, "patient_mrn", "left")
    return (
        with_encounter(known, encounters)
        .join(by_npi, "attending_provider_npi", "left")
        .select(
            "patient_key",
            "provider_key",
            "supervising_physician_key",
            "visit_number",
            "patient_mrn",
            "attending_provider_npi",
            "admit_datetime",
            "discharge_datetime",
            F.col("admit_datetime").cast("date").alias("admit_date_key"),
            "patient_class",
            "adt_status",
            "encounter_type",
            "chief_complaint",
            "primary_diagnosis_desc",
            "primary_diagnosis_code",
            "length_of_stay_hours",
            F.col("emr_encounter_id").isNotNull().alias("has_emr_encounter"),
            F.col("discharge_datetime").isNotNull().alias("is_discharged"),
        )
    )


def daily_utilization(appointments: DataFrame, encounters: DataFrame) -> DataFrame:
    """Utilization measures for each provider and day, where an appointment counts once for each encounter of its
    patient, provider and day (and once without any).

    Both sides are aggregated before they meet: appointments to one row for each patient, provider and day, encounters
    to one for each diagnosis within that. A row's weight is its number of encounters, so the pairs are counted without
    being built, and a hot patient-day costs one row for each diagnosis. Distinct patients need no distinct count: each
    is one appointment row, counted on its first diagnosis.
    """
    flags = appointment_flags()
    booked = (
        appointments.where(F.col("provider_npi").isNotNull())
        .withColumn("visit_day", F.col("scheduled_start").cast("date"))
        .groupBy(*VISIT_DAY)
        .agg(
            F.count("*").alias("booked"),
            F.count_if(flags["is_completed"]).alias("completed"),
            F.count_if(flags["is_no_show"]).alias("no_show"),
            F.count_if(flags["is_cancelled"]).alias("cancelled"),
            F.sum("duration_minutes").alias("minutes"),
            F.count("duration_minutes").alias("timed"),
        )
    )
    first_code = W.partitionBy(*VISIT_DAY).orderBy("primary_diagnosis_code")
    seen = (
        encounters.withColumn("visit_day", F.col("encounter_start").cast("date"))
        .where(F.col("provider_npi").isNotNull() & F.col("patient_id").isNotNull() & F.col("visit_day").isNotNull())
        .groupBy(*VISIT_DAY, "primary_diagnosis_code")
        .agg(F.count("*").alias("pairs"), F.count("encounter_id").alias("seen"))
        .withColumn("is_first", F.row_number().over(first_code) == 1)
    )
    pairs, met = F.coalesce("pairs", F.lit(1)), F.coalesce("seen", F.lit(0))
    is_first = F.coalesce("is_first", F.lit(True))
    return (
        booked.join(seen, VISIT_DAY, "left")
        .groupBy("provider_npi", F.col("visit_day").alias("date_key"))
        .agg(
            F.sum(F.col("booked") * pairs).alias("total_appointments"),
            F.sum(F.col("completed") * pairs).alias("completed_appointments"),
            F.sum(F.col("no_show") * pairs).alias("no_show_appointments"),
            F.sum(F.col("cancelled") * pairs).alias("cancelled_appointments"),
            F.count_if(is_first & F.col("patient_id").isNotNull()).alias("unique_patients"),
            F.sum(F.col("minutes") * pairs).alias("total_scheduled_minutes"),
            F.sum(F.col("timed") * pairs).alias("timed_appointments"),
            F.sum(F.col("booked") * met).alias("appointments_with_encounter"),
            F.count_distinct(F.when(met > 0, F.col("primary_diagnosis_code"))).alias("unique_diagnoses"),
        )
    )


def fact_patient_utilization(appointments: DataFrame, encounters: DataFrame, dim_provider: DataFrame) -> DataFrame:
    """One row for each known provider and day with appointments."""
    keys = dim_provider.select(F.col("npi").alias("provider_npi"), "provider_key", "supervising_physician_key")
    total = F.col("total_appointments")
    minutes, timed = (F.col(c).cast("decimal(20,0)") for c in ("total_scheduled_minutes", "timed_appointments"))
    completion = rate_pct(F.col("completed_appointments"), total)
    no_show = rate_pct(F.col("no_show_appointments"), total)
    rated = daily_utilization(appointments, encounters).withColumns(
        {
            "avg_duration_minutes": rounded(minutes / F.nullif(timed, F.lit(0).cast("decimal(20,0)")), 1),
            "completion_rate_pct": completion,
            "no_show_rate_pct": no_show,
            "cancellation_rate_pct": rate_pct(F.col("cancelled_appointments"), total),
        }
    )
    status = labelled(
        [
            (F.col("no_show_rate_pct") > 25, "high_no_show"),
            (F.col("completion_rate_pct") >= 75, "well_utilized"),
            (F.col("completion_rate_pct") >= 50, "moderate"),
        ],
        "underutilized",
    )
    return rated.join(keys, "provider_npi").select(
        "provider_key",
        "date_key",
        "supervising_physician_key",
        "total_appointments",
        "completed_appointments",
        "no_show_appointments",
        "cancelled_appointments",
        "unique_patients",
        "avg_duration_minutes",
        "total_scheduled_minutes",
        "appointments_with_encounter",
        "unique_diagnoses",
        "completion_rate_pct",
        "no_show_rate_pct",
        "cancellation_rate_pct",
        status.alias("utilization_status"),
    )
