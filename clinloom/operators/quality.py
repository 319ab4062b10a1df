"""Declarative data-quality rules; each yields the number of failing values or rows."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIQUE, NOT_NULL, ACCEPTED, RELATIONSHIP = "unique", "not_null", "accepted_values", "relationships"
REPORT = ["table_name", "column_name", "rule", "failures"]


@dataclass(frozen=True)
class Rule:
    table: str
    column: str
    kind: str
    values: tuple = field(default=())
    parent: str = ""
    parent_column: str = ""


def duplicated(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    return counted.where(F.col("n_rows") > 1)


def missing(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unaccepted(df: DataFrame, column: str, values: tuple) -> DataFrame:
    """Rows outside the accepted values; null passes."""
    return df.where(~F.col(column).isin(*values))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null reference has no parent."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Null values of the named columns replaced by their defaults."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def evaluate(tables: Mapping[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """One report row for each rule.

    All null and value rules of a table share one pass over it. All unique rules and relationships, of all tables, share one
    aggregation of (rule, key) pairs, which reads of each table only the columns that its rules name: one shuffle for the
    whole report. Keys are compared as text, whole, so the counts are exact; many rows of one key combine before the shuffle.
    """
    reports = [_one_pass(df, own) for table, df in tables.items() if (own := [r for r in rules if r.table == table and r.kind in (NOT_NULL, ACCEPTED)])]
    keyed = [rule for rule in rules if rule.kind in (UNIQUE, RELATIONSHIP)]
    if keyed:
        reports.append(_keyed_rules(tables, keyed))
    report = reports[0]
    for part in reports[1:]:
        report = report.unionByName(part)
    return report


def _keyed_rules(tables: Mapping[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """Unique: keys that more than one row has. Relationship: rows whose key no parent has."""
    read: dict[str, list] = {}
    for number, rule in enumerate(rules):
        read.setdefault(rule.table, []).append(_pair(number, rule.column, rows=1))
        if rule.kind == RELATIONSHIP:
            read.setdefault(rule.parent, []).append(_pair(number, rule.parent_column, rows=0))
    pairs = [tables[table].select(F.inline(F.array(*wanted))) for table, wanted in read.items()]
    every = pairs[0]
    for part in pairs[1:]:
        every = every.unionByName(part)
    groups = every.where("key is not null").groupBy("rule", "key").agg(F.sum("rows").alias("rows"), F.min("rows").alias("least"))
    unique = F.array(*[F.lit(n) for n, rule in enumerate(rules) if rule.kind == UNIQUE]).cast("array<int>")
    # A parent's row counts 0, so a group with a parent has 0 as its least.
    failures = F.when(F.array_contains(unique, F.col("rule")), (F.col("rows") > 1).cast("long")).otherwise(F.when(F.col("least") > 0, F.col("rows")).otherwise(0))
    counted = groups.groupBy("rule").agg(F.sum(failures).alias("found"))
    spark = every.sparkSession
    declared = spark.createDataFrame([(n, r.table, r.column, r.kind) for n, r in enumerate(rules)], "rule int, table_name string, column_name string, kind string")
    # One row for each rule.
    report = declared.join(F.broadcast(counted), "rule", "left")
    return report.select("table_name", "column_name", F.col("kind").alias("rule"), F.coalesce("found", F.lit(0)).cast("long").alias("failures"))


def _pair(number: int, column: str, rows: int):
    return F.struct(F.lit(number).alias("rule"), F.col(column).cast("string").alias("key"), F.lit(rows).cast("long").alias("rows"))


def _one_pass(df: DataFrame, rules: list[Rule]) -> DataFrame:
    counts = []
    for rule in rules:
        column = F.col(rule.column)
        failing = column.isNull() if rule.kind == NOT_NULL else ~column.isin(*rule.values)
        counts.append(F.struct(*_labels(rule), F.count_if(failing).alias("failures")))
    return df.agg(F.array(*counts).alias("_report")).select(F.inline("_report"))


def _labels(rule: Rule) -> list:
    return [
        F.lit(rule.table).alias("table_name"),
        F.lit(rule.column).alias("column_name"),
        F.lit(rule.kind).alias("rule"),
    ]
