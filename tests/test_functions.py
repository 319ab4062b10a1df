import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clinloom.functions import (
    as_text,
    as_uuid,
    avg_exact,
    element,
    hl7_timestamp,
    hours_between,
    iso_timestamp,
    json_text,
    labelled,
    null_date,
    parsed,
    rate_pct,
    rounded,
    whole_days,
)

CANONICAL = "0123abcd-0123-4567-89ab-0123456789ab"


def one(spark, column, **values):
    literals = [F.lit(v).alias(k) for k, v in values.items()]
    return spark.range(1).select(*literals).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, expected",
    [
        ("20240102030405", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("20240102030405.678-0500", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("202401020304", dt.datetime(2024, 1, 2, 3, 4)),
        ("20240102", dt.datetime(2024, 1, 2)),
        ("202402", dt.datetime(2024, 2, 1)),
        ("2024", dt.datetime(2024, 1, 1)),
        ("", None),
        ("20241302", None),
        ("20240", None),
        ("soon", None),
        (None, None),
    ],
)
def test_hl7_timestamp(spark, text, expected):
    assert one(spark, hl7_timestamp("t"), t=text) == expected


def test_iso_timestamp_drops_the_zone(spark):
    assert one(spark, iso_timestamp("t"), t="2024-01-02T03:04:05.250Z") == dt.datetime(2024, 1, 2, 3, 4, 5, 250000)
    assert one(spark, iso_timestamp("t"), t="2024-01-02T03:04:05+02:00") == dt.datetime(2024, 1, 2, 3, 4, 5)


@pytest.mark.parametrize(
    "text", [CANONICAL, CANONICAL.upper(), "{" + CANONICAL + "}", CANONICAL.replace("-", ""), "0123-abcd-01234567-89ab0123456789ab"]
)
def test_as_uuid_spellings(spark, text):
    assert one(spark, as_uuid("t"), t=text) == CANONICAL


def test_as_uuid_rejects_other_text_and_keeps_null(spark):
    assert one(spark, as_uuid("t"), t=None) is None
    for bad in ("17", "{" + CANONICAL, CANONICAL + "0", ""):
        with pytest.raises(PySparkException):
            one(spark, as_uuid("t"), t=bad)


def test_rates_round_half_up_and_guard_zero(spark):
    pairs = spark.createDataFrame([(1, 3), (2, 3), (1, 800), (5, 0), (0, 7)], "a long, b long")
    got = [r[0] for r in pairs.select(rate_pct(F.col("a"), F.col("b"))).collect()]
    assert got == [Decimal("33.33"), Decimal("66.67"), Decimal("0.13"), Decimal("0"), Decimal("0")]


def test_average_is_exact_before_rounding(spark):
    # Sum 667499 over 30000 rows: 22.2499667, which must not become 22.25 and then 22.3.
    total = spark.range(30_000).select((F.lit(22) + (F.col("id") < 7499).cast("int")).alias("v"))
    assert total.agg(rounded(avg_exact(F.col("v")), 1).alias("a")).first().a == Decimal("22.2")
    assert total.agg(avg_exact(F.when(F.lit(False), F.col("v"))).alias("a")).first().a is None


def test_elapsed_time(spark):
    early, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 5)
    a, b = F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")
    assert one(spark, whole_days(a, b), a=early, b=late) == 1
    assert one(spark, whole_days(b, a), a=early, b=late) == -1
    assert one(spark, hours_between(a, b), a=early, b=late) == Decimal("29.0")
    three = early + dt.timedelta(minutes=3)
    assert one(spark, hours_between(a, b), a=early, b=three) == Decimal("0.1")
    assert one(spark, hours_between(a, b), a=early, b=None) is None


def test_labels_take_the_first_rule(spark):
    x = F.col("x")
    label = labelled([(x > 5, "critical"), (x > 2, "warning")], "normal")
    got = spark.createDataFrame([(9,), (3,), (1,), (None,)], "x int").select(label).collect()
    assert [r[0] for r in got] == ["critical", "warning", "normal", "normal"]


def test_small_casts(spark):
    assert one(spark, as_text("n"), n=17) == "17"
    assert one(spark, null_date(), n=1) is None
    assert one(spark, json_text("j", "$[1].v"), j='[{"v": 1}, {"v": "x"}]') == "x"
    assert one(spark, json_text("j", "$[5].v"), j="[]") is None


def test_parsed_reads_text_and_types_alike(spark):
    text = spark.createDataFrame([('[{"v":"a","w":7},{"v":"b"}]',), ("[]",), (None,), ("not json",)], "c string")
    second = element(parsed(text, "c", "array<struct<v: string, w: string>>"), 1)["v"]
    assert [r[0] for r in text.select(second).collect()] == ["b", None, None, None]
    typed = text.limit(1).select(F.from_json("c", "array<struct<v: string>>").alias("c"))
    assert typed.select(element(parsed(typed, "c", "ignored"), 0)["v"]).first()[0] == "a"


def test_one_parse_serves_many_fields(spark):
    df = spark.range(1).select(F.concat(F.lit('{"a":"'), F.col("id"), F.lit('","b":"2"}')).alias("c"))
    fields = parsed(df, "c", "struct<a: string, b: string>")
    plan = df.select(fields["a"], fields["b"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(a,StringType,true), StructField(b,StringType,true)") == 2
