"""Keyed loading: de-duplication, upsert, insert-ignore, touch on update, soft delete."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXTRACTED, RECEIVED, BATCHED, VERSION = LOAD_COLUMNS = (
    "_sdc_extracted_at",
    "_sdc_received_at",
    "_sdc_batched_at",
    "_sdc_table_version",
)
DELETED = "_sdc_deleted_at"


def with_load_metadata(df: DataFrame, at: dt.datetime, version: int) -> DataFrame:
    """Append the load columns; one batch carries one time, so a re-run of a lost task writes the same values."""
    stamp = F.lit(at).cast("timestamp_ntz")
    return df.withColumns({EXTRACTED: stamp, RECEIVED: stamp, BATCHED: stamp, VERSION: F.lit(version).cast("long")})


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` for each key.

    An aggregate rather than a window: copies of a hot key collapse before the shuffle. A content hash breaks ties,
    so the choice is the same in every run.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*order, F.xxhash64(*rest).alias("_tie"))
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Target rows replaced by the batch's latest row of the same key; all other target rows stay.

    The target is only filtered by the batch's keys: when those fit the broadcast threshold it is not shuffled.
    """
    fresh = latest_per_key(batch, keys, order or [BATCHED])
    kept = target.join(fresh.select(*keys), keys, "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The batch rows to append: the first row of each key that the target does not hold yet."""
    rest = [c for c in batch.columns if c not in keys]
    rank = F.struct(*order, F.xxhash64(*rest).alias("_tie"))
    firsts = batch.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_row"))
    rows = firsts.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in batch.columns])
    return rows.join(target.select(*keys), keys, "left_anti")


def apply_updates(
    target: DataFrame,
    updates: DataFrame,
    keys: list[str],
    now: Column,
    touched: str = "updated_at",
    only_changed: bool = False,
) -> DataFrame:
    """Overwrite the target's columns from ``updates`` (unique by key) and touch the time of each updated row.

    Every row named by an update is touched, as by a trigger before update; with ``only_changed`` a row keeps its
    old time when no value differs.
    """
    changes = [c for c in updates.columns if c not in (*keys, touched)]
    staged = updates.select(*keys, F.struct(*changes).alias("_new"))
    joined = target.join(staged, keys, "left")
    named = F.col("_new").isNotNull()
    touch = named
    if only_changed:
        touch = named & ~F.struct(*changes).eqNullSafe(F.col("_new"))
    values = {c: F.when(named, F.col(f"_new.{c}")).otherwise(F.col(c)) for c in changes}
    values[touched] = F.when(touch, now).otherwise(F.col(touched))
    return joined.select(*[values[c].alias(c) if c in values else F.col(c) for c in target.columns])


def mark_deleted(target: DataFrame, snapshot: DataFrame, keys: list[str], at: Column) -> DataFrame:
    """Keep rows that a full snapshot no longer holds, with the time of their absence; never removes a row."""
    present = snapshot.select(*keys).distinct().withColumn("_present", F.lit(True))
    joined = target.drop(DELETED).join(present, keys, "left")
    return joined.withColumn(DELETED, F.when(F.col("_present").isNull(), at).cast("timestamp_ntz")).drop("_present")
