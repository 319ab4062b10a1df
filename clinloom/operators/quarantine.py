"""Rows split at ingest into accepted and quarantined ones, by the constraints of their source.

Null and value rules are expressions over the row. A unique rule on a column other than the key finds the values that several
keys share; the row of the smallest key is accepted. A reference is looked up among the parent's keys. Every rule that a row
breaks is a reason, and the tagged rows are written once: both parts are read from there.

References take an exact lookup each. A Bloom filter of the parent's keys would only tell the rows that certainly have no
parent, and in a sound source nearly all rows have one, so nearly all would still have to be looked up.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinloom.functions import packed_id, unpacked_id
from clinloom.operators.quality import ACCEPTED, NOT_NULL, RELATIONSHIP, UNIQUE, Rule
from clinloom.session import passing_shuffles, scratch_dir

REASONS = "_reasons"
QUARANTINE = ["table_name", "reasons", "record", "digest"]


def with_reasons(df: DataFrame, rules: list[Rule], keys: list[str], parents: Mapping[str, DataFrame]) -> DataFrame:
    """``df`` with ``_reasons``: the rules each row breaks, as ``<column> <rule>``; none for a sound row.

    A reference to a table that is not among ``parents`` is not checked; a null refers to nothing. Copies of a key are no
    breach: the load keeps the latest. Keys and references are packed while whole rows are shuffled to the lookups.
    """
    columns, reasons = list(df.columns), []
    packed = _packable(df, rules, keys, parents)
    df = df.withColumns({c: packed_id(c) for c in packed})
    # A key must be there, whether a rule says so or not.
    declared = {(rule.column, rule.kind) for rule in rules}
    needed = [Rule("", key, NOT_NULL) for key in keys if (key, NOT_NULL) not in declared]
    for number, rule in enumerate([*needed, *rules]):
        if rule.kind in (NOT_NULL, ACCEPTED):
            breach = F.col(rule.column).isNull() if rule.kind == NOT_NULL else ~F.col(rule.column).isin(*rule.values)
        elif rule.kind == UNIQUE and [rule.column] != keys:
            df, breach = _shared(df, rule.column, keys, f"_first{number}")
        elif rule.kind == RELATIONSHIP and rule.parent in parents:
            df, breach = _orphaned(df, rule, parents[rule.parent], f"_parent{number}", rule.column in packed)
        else:
            continue
        reasons.append(F.when(breach, F.lit(f"{rule.column} {rule.kind}")))
    found = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    return df.select(*[unpacked_id(c).alias(c) if c in packed else c for c in columns], found.alias(REASONS))


def _packable(df: DataFrame, rules: list[Rule], keys: list[str], parents: Mapping[str, DataFrame]) -> list[str]:
    """Text columns that rows are looked up by and that no rule compares by value or order; none without a lookup."""
    def is_text(frame: DataFrame, column: str) -> bool:
        return frame.schema[column].dataType == T.StringType()

    looked_up = [rule for rule in rules if rule.kind == RELATIONSHIP and rule.parent in parents]
    unique = [rule for rule in rules if rule.kind == UNIQUE and [rule.column] != keys]
    compared = {rule.column for rule in (*unique, *(r for r in rules if r.kind == ACCEPTED))} | set(keys if unique else ())
    compared |= {rule.column for rule in looked_up if not is_text(parents[rule.parent], rule.parent_column)}
    wanted = {*keys, *(rule.column for rule in looked_up)} if looked_up else set()
    return [c for c in df.columns if c in wanted - compared and is_text(df, c)]


def _shared(df: DataFrame, column: str, keys: list[str], mark: str) -> tuple[DataFrame, Column]:
    """Marks the rows of values that several keys share with the smallest key; the others break the rule."""
    key = F.struct(*keys)
    held = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.min(key).alias(mark), F.max(key).alias("_last"))
    several = held.where(F.col(mark) != F.col("_last")).select(column, mark)
    return df.join(several, column, "left"), F.col(mark).isNotNull() & (key != F.col(mark))


def _orphaned(df: DataFrame, rule: Rule, parent: DataFrame, mark: str, packed: bool) -> tuple[DataFrame, Column]:
    value = packed_id(rule.parent_column) if packed else F.col(rule.parent_column)
    known = parent.select(value.alias(rule.column)).distinct().withColumn(mark, F.lit(True))
    return df.join(known, rule.column, "left"), F.col(rule.column).isNotNull() & F.col(mark).isNull()


def split(
    df: DataFrame, table: str, rules: list[Rule], keys: list[str], parents: Mapping[str, DataFrame], place: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The accepted rows as they came, and the others as ``table_name, reasons, record`` (JSON) and ``digest`` of the record.

    Both read the tagged rows from the new folder ``place``, by default one below the shared scratch folder.
    """
    place = place or scratch_dir(df.sparkSession, f"tagged-{table}")
    tagged = with_reasons(df, rules, keys, parents)
    with passing_shuffles(df.sparkSession):
        tagged.write.parquet(place)
    stored = df.sparkSession.read.schema(tagged.schema).parquet(place)
    sound = F.size(REASONS) == 0
    record = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    kept_out = stored.where(~sound).select(F.lit(table).alias("table_name"), F.col(REASONS).alias("reasons"), record.alias("record"))
    return stored.where(sound).drop(REASONS), kept_out.withColumn("digest", F.md5("record"))
