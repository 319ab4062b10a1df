"""Access to nested documents that arrive either typed (struct/array) or as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A non-empty option keeps from_json whole, so all fields taken from one column share a single parse.
PARSE_OPTIONS = {"mode": "PERMISSIVE"}


def parsed(df: DataFrame, column: str, ddl: str) -> Column:
    """The column as the given nested type: untouched if already typed, else one JSON parse of its text."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.from_json(F.col(f"`{column}`"), ddl, PARSE_OPTIONS)
    return F.col(f"`{column}`")


def element(array: Column, index: int) -> Column:
    """Array element by position, null when the array is shorter."""
    return F.get(array, F.lit(index))


def json_text(column: Column | str, path: str) -> Column:
    """One value of a JSON text by path; missing steps give null."""
    return F.get_json_object(column, path)
