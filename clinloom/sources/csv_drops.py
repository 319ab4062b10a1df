"""CSV drops: reading by prefix and name pattern, and writing them from CRM records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinloom.functions import element

QUOTING = {"quote": '"', "escape": '"'}


def read_csv_drop(
    spark: SparkSession,
    base: str,
    prefix: str,
    pattern: str,
    columns: list[str] | None = None,
    delimiter: str = ",",
    modified_after: dt.datetime | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """All files below ``base/prefix`` whose path matches ``pattern``, all columns as text.

    Names come from ``columns`` or from the header of one matching file; a file with another header fails the read.
    The pattern is applied to the file path while files are listed, so other files are not opened. Files changed
    before ``modified_after`` are left out. ``multi_line`` allows line breaks inside quotes, at the price of
    reading each file in one task.
    """
    path = f"{base.rstrip('/')}/{prefix}"
    listing = {"recursiveFileLookup": True}
    if modified_after is not None:
        listing["modifiedAfter"] = _iso(modified_after)
    options = {"header": True, "sep": delimiter, "multiLine": multi_line, **QUOTING}
    names = columns or _header(spark, path, pattern, listing, options)
    schema = ", ".join(f"`{name}` string" for name in names)
    reader = spark.read.options(**listing, **options, enforceSchema=False).schema(schema)
    return reader.csv(path).where(F.col("_metadata.file_path").rlike(pattern))


def _header(spark: SparkSession, path: str, pattern: str, listing: dict, options: dict) -> list[str]:
    """Column names of one matching file; the listing does not read file contents."""
    files = spark.read.format("binaryFile").options(**listing).load(path)
    found = files.select("path").where(F.col("path").rlike(pattern)).first()
    if found is None:
        raise FileNotFoundError(f"no file below {path} matches {pattern}")
    return spark.read.options(**options).csv(found.path).columns


def _iso(moment: dt.datetime | str) -> str:
    if isinstance(moment, str):
        moment = dt.datetime.fromisoformat(moment.replace("Z", "+00:00"))
    return moment.strftime("%Y-%m-%dT%H:%M:%S")


def contact_rows(contacts: DataFrame) -> DataFrame:
    """CRM contacts as flat rows: the id and all properties."""
    return contacts.select("id", "properties.*")


def deal_rows(deals: DataFrame) -> DataFrame:
    """CRM deals as flat rows, with the first associated contact or null."""
    first_contact = element(F.col("associations.contacts.results"), 0)["id"]
    return deals.select("id", "properties.*", first_contact.alias("contact_id"))


def write_csv_drop(rows: DataFrame, path: str) -> None:
    rows.write.options(header=True, **QUOTING).csv(path)
