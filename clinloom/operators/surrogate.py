"""Dense surrogate keys: the rank of each row in key order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clinloom.session import scratch_dir

# ``monotonically_increasing_id`` holds the partition above these bits and the row's number in it below them.
ROW_BITS = 33


def surrogate_key(df: DataFrame, key: str, name: str, partitions: int | None = None) -> DataFrame:
    """``row_number() over (order by key)`` as the first column, nulls last; equal keys by a hash of the row.

    Rows are dealt to ranges of the key, sorted inside each, and written once with their place. A row's rank is its number
    in its partition plus the rows of all partitions before; those counts are one row for each partition. No task orders
    more than a range, and since the hash takes part in the ranges, many equal or null keys are spread like any others.
    The frame reads what was written, so ranks stay the same whatever is computed again.
    """
    order = [F.col(key).asc_nulls_last(), F.xxhash64(*df.columns)]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    place = scratch_dir(df.sparkSession, "ranked")
    ranged.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).write.parquet(place)
    stored = df.sparkSession.read.schema(ranged.select("*", F.lit(0).cast("long").alias("_at")).schema).parquet(place)
    part, number = F.shiftright("_at", ROW_BITS), F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    placed = stored.withColumns({"_part": part, "_number": number})
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    # One row for each written partition.
    ranked = placed.join(F.broadcast(offsets), "_part")
    return ranked.select((F.col("_before") + F.col("_number") + 1).alias(name), *df.columns)
