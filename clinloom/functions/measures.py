"""Numeric measures: exact averages, guarded percentages, elapsed time and ordered labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(20,0)"


def avg_exact(column: Column) -> Column:
    """Average of an integer column with 18 decimals; plain ``avg`` of a decimal keeps 4 and so rounds twice."""
    return F.sum(column).cast(EXACT) / F.nullif(F.count(column), F.lit(0)).cast(EXACT)


def rounded(column: Column, digits: int) -> Column:
    return F.round(column, digits)


def rate_pct(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole`` with 2 decimals, 0 where there is no whole."""
    ratio = (part.cast(EXACT) * F.lit(100)) / F.nullif(whole, F.lit(0)).cast(EXACT)
    return F.when(whole > 0, F.round(ratio, 2)).otherwise(F.lit(0).cast("decimal(5,2)"))


def hours_between(start: Column, end: Column, digits: int = 1) -> Column:
    """Hours from start to end. Interval arithmetic on zone-less timestamps, so no session zone is involved."""
    seconds = (end - start).cast("interval second").cast("decimal(18,6)")
    return F.round(seconds / F.lit(3600), digits)


def whole_days(start: Column, end: Column) -> Column:
    """Full days from start to end, truncated towards zero."""
    return F.extract(F.lit("DAY"), end - start)


def labelled(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    """The label of the first rule that holds."""
    (first, label), *rest = rules
    chain = F.when(first, label)
    for condition, name in rest:
        chain = chain.when(condition, name)
    return chain.otherwise(otherwise)
