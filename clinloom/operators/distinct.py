"""Several distinct counts in one aggregation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_counts(df: DataFrame, keys: list[str], counted: Mapping[str, str], measures: Mapping[str, tuple[Column, str]] | None = None) -> DataFrame:
    """``keys``, one distinct count for each entry of ``counted`` (name -> column), and ``measures``.

    Several ``count(distinct ...)`` in one aggregation make Spark copy each row once for every counted column. Here rows are
    grouped once by keys and counted columns, which combines before the shuffle, and values are counted from the groups.
    A measure (name -> (partial aggregate, how partial results combine: sum, min or max)) is taken along. What a key gathers
    are its distinct values: columns of codes, not of free texts.
    """
    measures = measures or {}
    columns = list(dict.fromkeys(counted.values()))
    groups = df.groupBy(*keys, *[F.col(c).alias(f"_{c}") for c in columns]).agg(F.lit(1).alias("_one"), *[partial.alias(name) for name, (partial, _) in measures.items()])
    combined = [getattr(F, how)(name).alias(name) for name, (_, how) in measures.items()]
    sizes = [F.size(F.collect_set(f"_{c}")).cast("long").alias(name) for name, c in counted.items()]
    return groups.groupBy(*keys).agg(*combined, *sizes)
