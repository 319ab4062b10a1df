"""What keeps the models small on large tables: packed ids, cheap times, partitions that a task can hold."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clinloom.functions import hl7_timestamp, packed_id, unpacked_id
from clinloom.operators.quality import Rule
from clinloom.operators.quarantine import split, with_reasons
from clinloom.plans import intermediate

UUID = "0123abcd-0123-4567-89ab-0123456789a{}".format
TEXTS = [UUID("b"), UUID("B"), UUID("b").upper(), UUID("b") + "\n", "{" + UUID("b") + "}", UUID("b").replace("-", ""), "", "c1", "\0" * 17, "x" * 16, "Zoë", None]


def test_ids_come_back_from_their_packed_form(spark):
    texts = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = texts.select("t", packed_id("t").alias("p")).select("t", "p", unpacked_id("p").alias("back")).collect()
    assert [r.back for r in got] == TEXTS
    assert len({bytes(r.p) for r in got if r.p is not None}) == len(TEXTS) - 1
    assert [len(r.p) for r in got if r.t == UUID("b")] == [16]


def test_reviews_are_joined_and_grouped_by_packed_ids(spark):
    cases = spark.createDataFrame([(UUID(1), dt.datetime(2024, 1, 1)), ("c2", dt.datetime(2024, 1, 1)), ("c2", dt.datetime(2024, 1, 2)), (None, None)], "case_id string, created_at timestamp_ntz")
    day = dt.date(2024, 1, 3)
    reviews = spark.createDataFrame(
        [("r1", UUID(1), UUID("c"), day, "overdue", day, None), ("r2", "c2", "doc", day, "overdue", day, None), ("r3", "lost", "doc", day, "overdue", day, None), ("r4", None, None, day, "overdue", day, None), ("r5", UUID(1), None, day, "overdue", day, None)],
        "review_id string, case_id string, physician_id string, review_date date, review_status string, due_date date, completed_at timestamp_ntz",
    )
    providers = spark.createDataFrame([("p1", UUID("c")), ("p2", "doc")], "provider_id string, supervising_physician_id string")
    daily = intermediate.daily_reviews(cases, reviews, "2024-01-05")
    assert dict(daily.dtypes)["physician"] == "binary"
    found = intermediate.int_physician_daily_metrics(cases, reviews, providers, "2024-01-02", "2024-01-04").where("cases_overdue > 0")
    assert sorted((r.physician_id, r.date_key, r.cases_overdue) for r in found.collect()) == [(UUID("c"), day, 1), ("doc", day, 2)]


def test_cases_and_reviews_are_joined_by_packed_ids(spark, rows):
    day = dt.date(2024, 1, 3)
    cases = spark.createDataFrame(
        [(UUID(1), UUID(2), "m"), (UUID(1).upper(), "p2", "m"), ("c3", UUID(2).upper(), None), ("c3", None, "twice"), (None, UUID(2), "none"), ("c5", "lost", "m")],
        "case_id string, provider_id string, patient_mrn string",
    ).selectExpr("*", "'x' case_type", "'open' status", "'low' priority", "timestamp_ntz'2024-01-01' created_at", "cast(null as timestamp_ntz) closed_at")
    reviews = spark.createDataFrame(
        [("r1", UUID(1), UUID("c"), day), (UUID("r"), UUID(1), None, day), ("r3", "c3", "doc", None), (None, UUID(1).upper(), "doc", day), ("r5", None, "doc", day), ("r6", "gone", "doc", day)],
        "review_id string, case_id string, physician_id string, review_date date",
    ).selectExpr("*", "'overdue' review_status", "review_date due_date", "cast(null as timestamp_ntz) completed_at")
    providers = spark.createDataFrame([(UUID(2), UUID("d"), "NP", UUID("e")), ("p2", "boss", "PA", None), (None, "none", "NP", "s")], "provider_id string, supervising_physician_id string, provider_type string, state_id string")
    found = intermediate.int_case_review_status(cases, reviews, providers, "2024-01-05")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("unhex(replace(case_id") > 1 and "unhex(replace(review_id" in plan and "unhex(replace(provider_id" in plan
    want = cases.join(providers, "provider_id", "left").join(reviews.select("case_id", "review_id", "physician_id", "review_date", F.lit(True).alias("met")), "case_id", "left")
    columns = ["case_id", "provider_id", "patient_mrn", "review_id", "physician_id", "review_date", "supervising_physician_id", "provider_type", "state_id"]
    assert rows(found.select(columns)) == rows(want.select(columns)) and found.count() == 7
    assert dict(found.dtypes) | {c: "string" for c in intermediate.IDS} == dict(found.dtypes)


RULES = [
    Rule("t", "id", "unique"),
    Rule("t", "boss", "relationships", parent="p", parent_column="key"),
    Rule("t", "kind", "accepted_values", values=("NP",)),
]


def tagged_plan(df, rules, parent):
    return with_reasons(df, rules, ["id"], {"p": parent})._jdf.queryExecution().optimizedPlan().toString()


def test_rows_are_looked_up_by_packed_references(spark, rows):
    df = spark.createDataFrame([(UUID(1), UUID(2), "NP"), ("own", "boss", "NP"), (UUID(3), UUID(4), "NP"), ("x", None, "PA"), (None, "none", "NP")], "id string, boss string, kind string")
    parent = spark.createDataFrame([(UUID(2),), ("boss",), ("boss",), (None,)], "key string")
    assert "unhex" in tagged_plan(df, RULES, parent)
    # Values that are compared as they are stay as they are.
    assert "unhex" not in tagged_plan(df, [*RULES, Rule("t", "kind", "unique"), Rule("t", "boss", "accepted_values", values=("boss",))], parent)
    accepted, others = split(df, "t", RULES, ["id"], {"p": parent})
    assert accepted.schema == df.schema and rows(accepted) == sorted([(UUID(1), UUID(2), "NP"), ("own", "boss", "NP")], key=repr)
    assert rows(others.select("reasons", F.get_json_object("record", "$.id"), F.get_json_object("record", "$.boss"))) == sorted(
        [(["boss relationships"], UUID(3), UUID(4)), (["kind accepted_values"], "x", None), (["id not_null", "boss relationships"], None, "none")], key=repr
    )


def test_a_time_takes_one_pattern(spark):
    plan = spark.range(1).select(F.col("id").cast("string").alias("t")).select(hl7_timestamp("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan


@pytest.mark.parametrize("size", ["advisoryPartitionSizeInBytes", "skewJoin.skewedPartitionThresholdInBytes"])
def test_a_task_reads_some_megabytes_of_a_shuffle(spark, size):
    from clinloom.session import tune

    assert int(tune(spark).conf.get(f"spark.sql.adaptive.{size}")) <= 16 << 20
