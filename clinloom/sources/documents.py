"""JSON documents in page envelopes: CRM lists, FHIR bundles and parsed-record lists."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinloom.functions import iso_timestamp
from clinloom.operators.flatten import flatten_struct
from clinloom.sources.schemas import CRM, FHIR


def read_records(
    spark: SparkSession, path: str, envelope: str, record: str, inner: str | None = None, multi_line: bool = True
) -> DataFrame:
    """The records of all pages at ``path``: elements of the array ``envelope``, or their field ``inner``.

    ``record`` is the record's schema. A damaged page, or a value of another type, fails the read. Pages are plain files, so more pages mean more parallel tasks; with
    ``multi_line=False`` each line is one page and large files are split as well.
    """
    item = f"struct<{record}>" if inner is None else f"struct<{inner}: struct<{record}>>"
    pages = spark.read.schema(f"{envelope} array<{item}>").json(path, multiLine=multi_line, mode="FAILFAST")
    chosen = "item.*" if inner is None else f"item.{inner}.*"
    return pages.select(F.explode(envelope).alias("item")).select(chosen)


def read_crm(
    spark: SparkSession, path: str, stream: str, since: dt.date | str | None = None, multi_line: bool = True
) -> DataFrame:
    """CRM objects of one stream, updated at or after ``since``."""
    rows = read_records(spark, path, "results", CRM[stream], multi_line=multi_line)
    rows = rows.withColumn("lastmodifieddate", iso_timestamp("updatedAt"))
    if since is None:
        return rows
    return rows.where(F.col("lastmodifieddate") >= iso_timestamp(F.lit(str(since))))


def read_bundles(spark: SparkSession, path: str, stream: str, multi_line: bool = True) -> DataFrame:
    """Resources of FHIR bundles, in their own types."""
    return read_records(spark, path, "entry", FHIR[stream], inner="resource", multi_line=multi_line)


def raw_resources(resources: DataFrame, arrays_as_json: bool = False) -> DataFrame:
    """Resources in raw-table form: nested objects flattened to ``a_b`` columns.

    Arrays keep their type, which Parquet stores in columns; ``arrays_as_json`` turns them into JSON text.
    Staging reads either form.
    """
    return flatten_struct(resources, arrays_as_json=arrays_as_json)


def read_parsed_hl7(spark: SparkSession, path: str, columns: list[str], multi_line: bool = True) -> DataFrame:
    """HL7 rows that another system has parsed already, from its ``records`` lists; all columns are text."""
    record = ", ".join(f"{c}: string" for c in columns)
    return read_records(spark, path, "records", record, multi_line=multi_line)
