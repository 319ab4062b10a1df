"""Flattening of nested records into columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_struct(df: DataFrame, sep: str = "_", arrays_as_json: bool = True) -> DataFrame:
    """Struct fields become ``parent<sep>child`` columns; arrays stay whole, as JSON text or in their own type."""
    return df.select(*_leaves(df.schema, "", "", sep, arrays_as_json))


def _leaves(schema: T.StructType, path: str, prefix: str, sep: str, arrays_as_json: bool) -> list[Column]:
    columns = []
    for field in schema.fields:
        source, name = f"{path}`{field.name}`", f"{prefix}{field.name}"
        if isinstance(field.dataType, T.StructType):
            columns += _leaves(field.dataType, f"{source}.", f"{name}{sep}", sep, arrays_as_json)
        elif isinstance(field.dataType, T.ArrayType) and arrays_as_json:
            columns.append(F.to_json(F.col(source)).alias(name))
        else:
            columns.append(F.col(source).alias(name))
    return columns
