import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clinloom.plans import intermediate, marts, reports, staging
from clinloom.operators.keyed import LOAD_COLUMNS, with_load_metadata
from clinloom.functions import avg_exact

D, T = dt.date, dt.datetime
LOADED = T(2026, 1, 31)

CASES = "case_id string, provider_id string, patient_mrn string, case_type string, status string, priority string, created_at timestamp_ntz, closed_at timestamp_ntz"
REVIEWS = "review_id string, case_id string, physician_id string, review_date date, review_status string, due_date date, completed_at timestamp_ntz"
PROVIDERS = "provider_id string, npi string, supervising_physician_id string, provider_type string, state_id string"
APPOINTMENTS = "appointment_id string, appointment_status string, appointment_type string, scheduled_start timestamp_ntz, scheduled_end timestamp_ntz, duration_minutes int, created_at timestamp_ntz, patient_id string, provider_npi string"
ENCOUNTERS = "encounter_id string, encounter_class string, patient_id string, provider_npi string, encounter_start timestamp_ntz, primary_diagnosis_code string, primary_diagnosis_desc string"
UUID = "00000000-0000-0000-0000-00000000000{}".format


def case_frames(spark, reviews):
    cases = spark.createDataFrame([("c1", "p1", "M", "t", "open", "low", T(2024, 1, 1, 12), None)], CASES)
    providers = spark.createDataFrame([("p1", "n1", UUID(1), "NP", "s"), ("p2", "n2", UUID(1), "PA", "s")], PROVIDERS)
    return cases, spark.createDataFrame(reviews, REVIEWS), providers


def test_review_measures(spark):
    reviews = [
        ("done", "c1", UUID(1), D(2024, 1, 10), "completed", D(2024, 1, 12), T(2024, 1, 10, 11)),
        ("late", "c1", UUID(1), D(2024, 1, 5), "overdue", D(2024, 1, 5), None),
        ("due", "c1", UUID(1), D(2024, 1, 19), "pending", D(2024, 1, 19), None),
        ("ahead", "c1", UUID(1), D(2024, 1, 20), "pending", D(2024, 1, 20), None),
        ("unset", "c1", UUID(1), None, None, None, None),
    ]
    rows = intermediate.int_case_review_status(*case_frames(spark, reviews), "2024-01-20").collect()
    got = {r.review_id: (r.days_from_due_date, r.days_to_complete_review, r.is_overdue) for r in rows}
    # 8 days and 23 hours are 8 whole days.
    assert got == {
        "done": (-2, 8, False),
        "late": (15, None, True),
        "due": (None, None, True),
        "ahead": (None, None, False),
        "unset": (None, None, False),
    }


def test_case_without_review_stays_once(spark):
    rows = intermediate.int_case_review_status(*case_frames(spark, []), "2024-01-20").collect()
    assert [(r.case_id, r.review_id, r.is_overdue, r.provider_type) for r in rows] == [("c1", None, False, "NP")]


def test_reviews_are_shuffled_for_their_case_alone(spark):
    cases, reviews, providers = case_frames(spark, [("r1", "c1", UUID(1), D(2024, 1, 2), "pending", D(2024, 1, 3), None)])
    rows = intermediate.int_case_review_status(cases, reviews, providers, D(2024, 6, 30))
    assert [(r.review_id, r.provider_type) for r in rows.collect()] == [("r1", "NP")]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    # The outermost join is the one with the reviews.
    outer = next(line for line in plan.splitlines() if "Join LeftOuter" in line)
    assert "case_id" in outer and "provider_id" not in outer


def test_daily_metrics_double_count_and_drop_outsiders(spark):
    day = D(2024, 1, 10)
    reviews = [
        # Pending, past due, and due on its review day: pending as well as overdue.
        ("a", "c1", UUID(1), day, "pending", day, None),
        ("b", "c1", UUID(1), day, "pending", D(2024, 1, 9), None),
        ("c", "c1", UUID(1), D(2024, 2, 1), "pending", D(2024, 2, 1), None),
        ("d", "c1", UUID(9), day, "completed", day, T(2024, 1, 10)),
        ("e", "no such case", UUID(1), day, "overdue", day, None),
    ]
    frames = case_frames(spark, reviews)
    rows = intermediate.int_physician_daily_metrics(*frames, "2024-01-01", "2024-01-20").collect()
    assert len(rows) == 20 and {r.total_providers_supervised for r in rows} == {2}
    busy = [r for r in rows if r.cases_overdue]
    assert [(r.date_key, r.cases_reviewed, r.cases_pending_review, r.cases_overdue) for r in busy] == [(day, 0, 1, 2)]
    assert all(r.avg_days_to_review is None for r in rows)


def test_case_load_rates_and_labels(spark):
    day = D(2024, 1, 10)
    done = [(f"d{i}", "c1", UUID(1), day, "completed", day, T(2024, 1, 2 + i, 12)) for i in range(3)]
    late = [(f"l{i}", "c1", UUID(1), day, "overdue", day, None) for i in range(3)]
    ahead = [(f"p{i}", "c1", UUID(1), D(2024, 1, 11), "pending", D(2024, 3, 1), None) for i in range(11)]
    crisis = [(f"x{i}", "c1", UUID(1), D(2024, 1, 12), "overdue", day, None) for i in range(6)]
    physicians = spark.createDataFrame([(UUID(1), 41), (UUID(2), 42)], "physician_id string, physician_key long")
    frames = case_frames(spark, done + late + ahead + crisis)
    fact = marts.fact_provider_case_load(*frames, physicians, "2024-01-09", "2024-01-12")
    by_day = {r.date_key.day: r for r in fact.collect()}
    assert {r.physician_key for r in by_day.values()} == {41}
    assert [by_day[d].workload_status for d in (9, 10, 11, 12)] == ["normal", "warning", "high", "critical"]
    assert (by_day[10].total_cases, by_day[10].overdue_rate_pct, by_day[10].avg_days_to_review) == (6, Decimal("50.00"), Decimal("2.00"))
    assert (by_day[11].overdue_rate_pct, by_day[11].unfinished_rate_pct) == (0, 100)
    assert (by_day[9].total_cases, by_day[9].overdue_rate_pct, by_day[9].avg_days_to_review) == (0, 0, None)


def test_published_size_of_the_case_load(spark):
    """10 supervising physicians over 2024-01-01 .. 2026-01-31 give 7,620 rows."""
    physicians = spark.range(10).select(F.format_string("00000000-0000-0000-0000-%012d", "id").alias("physician_id"), "id")
    providers = physicians.select(
        F.col("physician_id").alias("provider_id"), F.col("physician_id").alias("supervising_physician_id")
    )
    cases, reviews, _ = case_frames(spark, [])
    keys = physicians.select("physician_id", F.col("id").alias("physician_key"))
    fact = marts.fact_provider_case_load(cases, reviews, providers, keys, "2024-01-01", "2026-01-31")
    assert fact.count() == 7620


def clinic(spark, seed=3, size=400):
    rng = random.Random(seed)
    at = [T(2024, 1, 1, 9), T(2024, 1, 1, 23, 59), T(2024, 1, 2), None]
    pick = rng.choice
    appointments = [
        (f"a{i}", pick(["fulfilled", "noshow", "cancelled", "booked", None]), None, pick(at), None, pick([15, 30, 40, None]), None, pick(["x", "y", "z", None]), pick(["n1", "n2", "n9", None]))
        for i in range(size)
    ]
    encounters = [
        (pick([f"e{i}", f"e{i}", None]), pick(["AMB", "IMP", None]), pick(["x", "y", None]), pick(["n1", "n2", None]), pick(at), pick(["D1", "D2", None]), None)
        for i in range(40)
    ]
    return spark.createDataFrame(appointments, APPOINTMENTS), spark.createDataFrame(encounters, ENCOUNTERS)


@pytest.mark.parametrize("seed", [3, 4])
def test_utilization_equals_counting_the_pairs(spark, rows, seed):
    """The pre-aggregated form against an aggregate over the fanned-out intermediate model."""
    appointments, encounters = clinic(spark, seed)
    _, _, providers = case_frames(spark, [])
    pairs = intermediate.int_appointment_utilization(appointments, encounters, providers)
    expected = (
        pairs.where("provider_npi is not null")
        .groupBy("provider_npi", F.col("scheduled_start").cast("date").alias("date_key"))
        .agg(
            F.count("*").alias("total_appointments"),
            F.count_if("is_completed").alias("completed_appointments"),
            F.count_if("is_no_show").alias("no_show_appointments"),
            F.count_if("is_cancelled").alias("cancelled_appointments"),
            F.count_distinct("patient_id").alias("unique_patients"),
            F.sum("duration_minutes").alias("total_scheduled_minutes"),
            F.count("duration_minutes").alias("timed_appointments"),
            F.count_if("has_encounter").alias("appointments_with_encounter"),
            F.count_distinct(F.when(F.col("has_encounter"), F.col("primary_diagnosis_code"))).alias("unique_diagnoses"),
        )
    )
    got = marts.daily_utilization(appointments, encounters)
    assert got.columns == expected.columns
    assert rows(got) == rows(expected)


def test_utilization_labels_and_unknown_providers(spark):
    def visits(npi, *statuses):
        return [(f"{npi}{i}", s, None, T(2024, 1, 1, 9), None, 15 + 10 * i, None, f"p{i}", npi) for i, s in enumerate(statuses)]

    booked = (
        visits("n1", "fulfilled", "fulfilled", "fulfilled", "noshow")
        + visits("n2", "fulfilled", "noshow")
        + visits("n3", "fulfilled", "booked", "booked")
        + visits("n4", "fulfilled", "booked")
        + visits("n9", "fulfilled")
    )
    dimension = spark.createDataFrame([(f"n{i}", i, None) for i in range(1, 5)], "npi string, provider_key long, supervising_physician_key long")
    fact = marts.fact_patient_utilization(
        spark.createDataFrame(booked, APPOINTMENTS), spark.createDataFrame([], ENCOUNTERS), dimension
    )
    got = {r.provider_key: r for r in fact.collect()}
    # 25.00 % no-shows are not above 25 %.
    assert {k: r.utilization_status for k, r in got.items()} == {1: "well_utilized", 2: "high_no_show", 3: "underutilized", 4: "moderate"}
    assert (got[3].completion_rate_pct, got[3].avg_duration_minutes) == (Decimal("33.33"), Decimal("25.0"))


def test_panel(spark):
    _, encounters = clinic(spark)
    _, _, providers = case_frames(spark, [])
    got = {(r.provider_npi, r.patient_id): r for r in intermediate.int_provider_panel_metrics(encounters, providers).collect()}
    assert sum(r.encounter_count for r in got.values()) == 40
    assert (None, None) in got or any(k[0] is None for k in got)
    assert all(r.provider_id == "p1" for k, r in got.items() if k[0] == "n1")


def adt(spark):
    admissions = spark.createDataFrame(
        [
            ("m1", "M1", "n1", T(2024, 1, 1, 8), "v1"),
            ("m2", "M1", "n1", T(2024, 1, 2, 8), "v2"),
            ("m3", "M9", "n9", None, "v3"),
        ],
        "message_id string, patient_mrn string, attending_provider_npi string, admit_datetime timestamp_ntz, visit_number string",
    )
    for column in ("patient_last_name", "patient_first_name", "patient_dob", "patient_gender", "patient_class", "sending_facility"):
        admissions = admissions.withColumn(column, F.lit("-"))
    discharges = spark.createDataFrame(
        [("d1", T(2024, 1, 2, 9, 3), "v1"), ("d3", None, "v3")],
        "message_id string, discharge_datetime timestamp_ntz, visit_number string",
    )
    patients = spark.createDataFrame([("x", "M1")], "patient_id string, mrn string")
    encounters = spark.createDataFrame(
        [
            ("e1", "AMB", "x", "n1", T(2024, 1, 1, 23), "D1", "d"),
            ("e2", "AMB", "x", "n1", T(2024, 1, 1, 1), "D2", "d"),
            ("e3", "AMB", "x", "n2", T(2024, 1, 2, 1), "D2", "d"),
        ],
        ENCOUNTERS,
    ).withColumns({"encounter_type": F.lit("t"), "chief_complaint": F.lit("c")})
    return admissions, discharges, patients, encounters


def test_stays_fan_out_by_encounter(spark):
    got = intermediate.int_patient_encounters(*adt(spark)).collect()
    stays = sorted((r.visit_number, r.adt_status, r.length_of_stay_hours, r.emr_encounter_id or "") for r in got)
    assert stays == [
        ("v1", "discharged", Decimal("25.1"), "e1"),
        ("v1", "discharged", Decimal("25.1"), "e2"),
        ("v2", "admitted", None, ""),
        ("v3", "admitted", None, ""),
    ]


def test_encounter_facts_look_up_all_keys(spark):
    physicians = spark.createDataFrame([(7,)], "physician_key long")
    providers = spark.createDataFrame([("n1", 3, 7), ("n2", 4, None)], "npi string, provider_key long, supervising_physician_key long")
    people = spark.createDataFrame([("M1", 5)], "mrn string, patient_key long")
    fact = marts.fact_patient_encounters(*adt(spark), people, providers, physicians)
    got = sorted((r.visit_number, r.patient_key, r.provider_key, r.supervising_physician_key, r.has_emr_encounter, r.is_discharged) for r in fact.collect())
    assert got[0] == ("v1", 5, 3, 7, True, True) and got[2] == ("v2", 5, 3, 7, False, False)
    assert got[3] == ("v3", None, None, None, False, False)


def test_dimensions(spark):
    stamp = T(2023, 5, 6, 7)
    states = spark.createDataFrame([("s2", "BB", "B", 14), ("s1", "AA", "A", 7)], "state_id string, state_code string, state_name string, review_frequency_days int")
    states = states.withColumns({"supervision_requirements": F.lit("r"), "created_at": F.lit(stamp), "updated_at": F.lit(stamp)})
    assert [(r.state_key, r.state_code) for r in marts.dim_state(states).orderBy("state_key").collect()] == [(1, "AA"), (2, "BB")]

    doctors = spark.createDataFrame(
        [(UUID(2).upper(), "1", "Ann", "Lee", "s1"), (UUID(1), "2", "Bob", None, None)],
        "physician_id string, npi string, first_name string, last_name string, state_license_id string",
    )
    extra = {"specialty": F.lit("x"), "email": F.lit("e"), "phone": F.lit("p"), "is_active": F.lit(True)}
    times = {"created_at": F.lit(stamp).cast("timestamp_ntz"), "updated_at": F.lit(stamp).cast("timestamp_ntz")}
    physicians = marts.dim_physician(doctors.withColumns({**extra, **times}), states)
    got = {r.physician_key: r for r in physicians.collect()}
    assert (got[1].full_name, got[1].state_code, got[2].full_name, got[2].state_code) == (None, None, "Ann Lee", "AA")
    assert (got[2].effective_from, got[2].effective_to, got[2].is_current) == (D(2023, 5, 6), None, True)

    staff = spark.createDataFrame(
        [(UUID(5), "9", UUID(2), "s2"), (UUID(4), "8", None, None)],
        "provider_id string, npi string, supervising_physician_id string, state_id string",
    )
    names = {"first_name": F.lit("f"), "last_name": F.lit("l"), "provider_type": F.lit("NP"), "hire_date": F.lit(D(2020, 1, 1))}
    providers = marts.dim_provider(staff.withColumns({**extra, **times, **names}), physicians, states)
    rows = [(r.provider_key, r.npi, r.supervising_physician_key, r.supervising_physician_name, r.review_frequency_days) for r in providers.orderBy("provider_key").collect()]
    assert rows == [(1, "8", None, None, None), (2, "9", 2, "Ann Lee", 14)]


def test_patients_without_encounter_count_zero(spark):
    _, _, people, encounters = adt(spark)
    people = people.unionByName(spark.createDataFrame([("w", "M2")], "patient_id string, mrn string"))
    for c in ("first_name", "last_name", "date_of_birth", "gender", "insurance_type", "phone", "email", "city", "state", "postal_code"):
        people = people.withColumn(c, F.lit("-"))
    got = {r.patient_id: (r.patient_key, r.total_encounters, r.provider_count, r.first_encounter_date) for r in marts.dim_patient(people, encounters).collect()}
    assert got == {"w": (1, 0, 0, None), "x": (2, 3, 2, T(2024, 1, 1, 1))}


def test_contact_points_go_by_position(spark):
    raw = spark.createDataFrame(
        [("p", '[{"value":"M"}]', '[{"family":"F","given":["G","H"]}]', '[{"system":"email","value":"first"},{"system":"phone","value":"second"}]', "1980-01-01", "x", '[{"line":["l1","l2"],"city":"c"}]', "[]")],
        "id string, identifier string, name string, telecom string, birthDate string, gender string, address string, extension string",
    )
    row = staging.stg_patients(with_load_metadata(raw, LOADED, 1)).first()
    assert (row.mrn, row.first_name, row.last_name, row.phone, row.email) == ("M", "G", "F", "first", "second")
    assert (row.address_line, row.city, row.state, row.insurance_type, row.date_of_birth) == ("l1", "c", None, None, "1980-01-01")


def test_participants_differ_by_resource(spark):
    appointment = spark.createDataFrame(
        [("a", "booked", '[{"coding":[{"display":"Visit"}]}]', "2024-01-01T09:00:00Z", "2024-01-01T09:30:00+05:00", 30, "2024-01-01T00:00:00Z", '[{"actor":{"reference":"Patient/pat-Patient/1"}},{"actor":{"identifier":{"value":"n1"}}}]')],
        "id string, status string, serviceType string, start string, `end` string, minutesDuration int, created string, participant string",
    )
    row = staging.stg_appointments(with_load_metadata(appointment, LOADED, 1)).first()
    assert (row.patient_id, row.provider_npi, row.appointment_type) == ("pat-1", "n1", "Visit")
    assert row.scheduled_end == T(2024, 1, 1, 9, 30)


def test_api_contacts_fall_back_to_the_record_time(spark):
    raw = spark.createDataFrame(
        [("1", '{"firstname":"A","createdate":"2024-01-01T00:00:00Z"}', T(2024, 5, 5)), ("2", '{"lastmodifieddate":"2024-02-02T00:00:00Z"}', T(2024, 5, 5))],
        "id string, properties string, lastmodifieddate timestamp_ntz",
    )
    got = {r.contact_id: r for r in staging.stg_contacts_api(with_load_metadata(raw, LOADED, 1)).collect()}
    assert (got["1"].updated_at, got["2"].updated_at, got["1"].first_name) == (T(2024, 5, 5), T(2024, 2, 2), "A")
    assert got["1"].source_type == "api"


def test_staging_keeps_load_columns(spark):
    raw = spark.createDataFrame([("1", "AA", "A", None, 7)], "id string, code string, name string, supervision_requirements string, review_frequency_days int")
    raw = raw.withColumns({"created_at": F.lit(LOADED), "updated_at": F.lit(LOADED)})
    assert staging.stg_states(with_load_metadata(raw, LOADED, 1)).columns[-4:] == list(LOAD_COLUMNS)


def test_report_orders_by_overdue(spark):
    load = spark.createDataFrame([(1, D(2024, 1, 1), 0, 0, 2), (2, D(2024, 1, 1), 0, 0, 5), (2, D(2024, 1, 2), 0, 0, 9)], "physician_key long, date_key date, cases_reviewed long, cases_pending_review long, cases_overdue long")
    names = spark.createDataFrame([(1, "A"), (2, "B")], "physician_key long, full_name string")
    assert [r.physician for r in reports.overdue_report(load, names, "2024-01-01").collect()] == ["B", "A"]
    assert reports.row_count(load).first().n_rows == 3


def test_average_of_a_day(spark):
    df = spark.createDataFrame([(10,), (10,), (11,), (None,)], "v int")
    assert round(float(df.agg(avg_exact(F.col("v"))).first()[0]), 4) == 10.3333
