"""Date spine and dense daily series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clinloom.functions import literal_date

ONE_DAY = "interval 1 day"


def days(start: Column, end: Column) -> Column:
    """All days from start to end inclusive; null when end lies before start."""
    return F.sequence(start, F.when(end >= start, end), F.expr(ONE_DAY))


def date_spine(spark: SparkSession, start: dt.date | str, end: dt.date | str, name: str = "date_key") -> DataFrame:
    return spark.range(1).select(F.explode(days(literal_date(start), literal_date(end))).alias(name))


def densify(
    entities: DataFrame,
    daily: DataFrame,
    key: str,
    day: str,
    start: dt.date | str,
    end: dt.date | str,
    zero: list[str],
) -> DataFrame:
    """One row for each entity and day of the period, with the entity's columns and its measures of that day.

    Same rows as entities x spine left-joined to the daily measures, without building that product before a shuffle:
    only the sparse rows and one seed row for each entity are shuffled by the key. Inside a key, a row stands for the
    gap up to the next one and is exploded in place, so the dense rows are never shuffled or sorted. A key holds at
    most one row for each day of the period, which bounds the largest group whatever the skew of the source was.

    ``entities`` must be unique by key, ``daily`` by key and day. Columns in ``zero`` become 0 on empty days,
    the other measures null.
    """
    first, last = literal_date(start), literal_date(end)
    attributes = [c for c in entities.columns if c != key]
    measures = [c for c in daily.columns if c not in (key, day)]

    seeds = entities.select(key, F.struct(*attributes).alias("entity"), first.alias(day))
    sparse = daily.where(F.col(day).between(first, last)).select(key, day, F.struct(*measures).alias("measured"))
    # A set number, so that AQE does not merge partitions by the size of the sparse rows.
    partitions = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The seed sorts before a measured first day; that day then leaves the seed an empty gap.
    by_day = W.partitionBy(key).orderBy(day, "_is_measured")
    gaps = (
        seeds.withColumn("_is_measured", F.lit(False))
        .unionByName(sparse.withColumn("_is_measured", F.lit(True)), allowMissingColumns=True)
        .repartition(partitions, key)
        .withColumn("entity", F.first("entity", ignorenulls=True).over(by_day))
        .withColumn("next_day", F.coalesce(F.lead(day).over(by_day), F.date_add(last, 1)))
        .where(F.col("entity").isNotNull())
    )
    dense = gaps.select(
        key,
        "entity",
        F.col(day).alias("measured_day"),
        "measured",
        F.explode(days(F.col(day), F.date_sub("next_day", 1))).alias(day),
    )
    measured = F.when(F.col(day) == F.col("measured_day"), F.col("measured"))
    return dense.select(
        key,
        day,
        *[F.col(f"entity.{c}").alias(c) for c in attributes],
        *[_or_zero(measured[c], c in zero).alias(c) for c in measures],
    )


def _or_zero(column: Column, fill: bool) -> Column:
    return F.coalesce(column, F.lit(0)) if fill else column
