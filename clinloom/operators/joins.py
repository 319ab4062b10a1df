"""Joins that hold when one key owns a large part of the rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000


def left_join_many(one: DataFrame, many: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``one LEFT JOIN many`` on the keys, where a single key may own a large share of ``many``.

    AQE never splits the right side of a left join. So the hot keys of ``many`` are salted: their rows are spread over
    enough salts by a hash of the row, and each row of ``one`` with such a key meets all salts. A hot key has matches by
    definition, so a salt that finds none is dropped without loss; all other keys keep the one salt 0 and the plain
    left join. Salts depend on row content alone and so survive recomputation.
    """
    known = many.where(reduce(and_, [F.col(key).isNotNull() for key in keys]))
    hot = F.broadcast(hot_keys(known, keys, hot_rows))

    salts = F.when(F.col("_salts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_salts") - 1))
    left = one.join(hot, keys, "left").withColumn("_salt", F.explode(salts))
    own_salt = F.coalesce(F.pmod(F.xxhash64(*many.columns), F.col("_salts")), F.lit(0)).cast("int")
    right = known.join(hot, keys, "left").select(*many.columns, own_salt.alias("_salt"), F.lit(True).alias("_met"))
    met = F.col("_salts").isNull() | F.col("_met").isNotNull()
    return left.join(right, [*keys, "_salt"], "left").where(met).drop("_salt", "_salts", "_met")


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows that also overfill their share of the data, and the salts they need.

    Rows are first counted by a few thousand key-hash buckets, which combines almost fully before the shuffle. Keys are
    counted only inside buckets with more than ``hot_rows`` and twice the mean number of rows; without skew there is no
    such bucket and no key is shuffled. A key that does not overfill its bucket is too small to fill a join task.
    The buckets are bounded by their number, the keys by rows / ``hot_rows`` (a few megabytes for 10^11 rows).
    """
    buckets = max(1024, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = df.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("_bucket"))
    filled = placed.groupBy("_bucket").agg(F.count("*").alias("_rows"))
    mean = F.sum("_rows").over(W.partitionBy()) / F.lit(buckets)
    full = filled.withColumn("_limit", F.greatest(F.lit(float(hot_rows)), 2 * mean)).where("_rows > _limit")
    suspects = placed.join(F.broadcast(full.select("_bucket")), "_bucket", "left_semi")
    counted = suspects.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > hot_rows)
    return counted.select(*keys, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_salts"))
