"""Reports over the finished marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.functions import literal_date


def overdue_report(case_load: DataFrame, physicians: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Physicians by overdue cases on a day; the day's filter reaches the file scan."""
    names = physicians.select("physician_key", F.col("full_name").alias("physician"))
    return (
        case_load.where(F.col("date_key") == literal_date(as_of))
        .join(names, "physician_key")
        .select("physician", "date_key", "cases_reviewed", "cases_pending_review", "cases_overdue")
        .orderBy(F.col("cases_overdue").desc_nulls_first())
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))
