"""Mixing sources to target weights by a time-varying curriculum (native).

Each source has a weight and a schedule over training time t in [0, 1]: its share of the tokens runs linearly from
``(1 - slope)`` to ``(1 + slope)`` times its mean. The mean is the source's target: all targets add up to ``total`` times
the size of everything, in proportion to the weights, and stop at ``most`` times the source's own size; the excess goes to
the other sources by weight until none is above. Documents of a source follow each other in the order of a keyed hash,
pass after pass; the last pass ends at the document whose middle crosses the target. The cumulative demand
``D(t) = a t + (b - a) t^2 / 2`` is inverted to give every copy its training position.

A source may hold any share of the rows: running sums are built from (source, hash bucket) sums, and only a bucket is
ever sorted in one task.

Defined cases: null text has size 0; a null source is a source of its own, the last; null ids take part; repeated rows are
documents of their own; a source or table of size 0 has target 0 and takes nothing; no rows give no rows. Columns of the
input are carried in one struct, so their names clash with nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinloom.llm.shared import word_count

WEIGHTS = (5.0, 2.0, 1.0)
SLOPES = (-0.5, 0.0, 0.5)
BUCKET_DIGITS = 3


def source_targets(sizes: DataFrame, weights: Sequence[float], slopes: Sequence[float], total: float, most: float) -> DataFrame:
    """``source, source_size`` -> with ``target`` and ``slope``. Weights and slopes repeat over the sources by code point."""
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(ranked) - 1, F.lit(len(weights)))
    of = lambda values: F.get(F.array(*map(F.lit, values)), place)
    weighed = sizes.select("source", "source_size", of(weights).alias("weight"), of(slopes).alias("slope"))
    cap = F.col("source_size") * F.lit(float(most))
    by_ratio = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # If the sources before this one are at their caps, the rest gets this much for each unit of weight.
    before = F.coalesce(F.sum(cap).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    demand = F.sum("source_size").over(everything) * F.lit(float(total))
    level = (demand - before) / rest
    leveled = weighed.withColumn("level", F.when(level <= cap / F.col("weight"), level))
    # The first level that no later source exceeds is the largest of those; rounding may leave none when all are at their caps.
    found = F.max("level").over(everything)
    target = F.coalesce(F.least(cap, found * F.col("weight")), cap)
    return leveled.select("source", "source_size", "slope", target.alias("target"))


def order_digest(identity: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit(""))))


def plan_mix(
    docs: DataFrame,
    identity: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[float] = WEIGHTS,
    slopes: Sequence[float] = SLOPES,
    total: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """One row per document: ``row`` (its columns, or those of ``carry``), ``size, source_size, target, copies, positions``.

    ``positions`` has the training position in [0, 1] of each of its copies.
    """
    if len(weights) != len(slopes) or min(weights) <= 0 or max(map(abs, slopes)) >= 1 or not 0 <= total <= most:
        raise ValueError("weights must be positive, slopes within (-1, 1), both of one length, and 0 <= total <= most")
    digest = order_digest(F.col(identity), seed)
    # One key that is never null: a null-safe join would deal the texts anew after the window has.
    key = F.when(F.col(source).isNull(), "").otherwise(F.concat(F.lit("="), F.col(source).cast("string")))
    placed = [key.alias("key"), F.substring(digest, 1, BUCKET_DIGITS).alias("bucket"), word_count(F.col(text)).alias("size")]
    buckets = docs.select(F.col(source).alias("source"), *placed).groupBy("source", "key", "bucket").agg(F.sum("size").alias("bucket_size"))
    targets = source_targets(
        buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, slopes, total, most
    ).withColumn("key", F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source").cast("string"))))
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("key", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("offset"))
    known = offsets.join(targets.drop("source"), "key")
    row = F.struct(*[F.col(c) for c in (docs.columns if carry is None else carry)]).alias("row")
    within = Window.partitionBy("key", "bucket").orderBy("digest", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = docs.select(row, digest.alias("digest"), *placed).withColumn("upto", F.sum("size").over(within))
    joined = summed.join(known, ["key", "bucket"]).select(
        "row", "size", "source_size", "target", "slope", (F.col("offset") + F.col("upto") - F.col("size") / 2).alias("middle")
    )
    size = F.col("source_size")
    passes = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0)
    copies = F.when(F.col("size") == 0, 0).otherwise(passes + (F.col("middle") <= F.col("target") - passes * size).cast("int"))
    start, end = F.col("target") * (1 - F.col("slope")), F.col("target") * (1 + F.col("slope"))

    def position(k: Column) -> Column:
        demand = F.least(F.col("middle") + (k - 1) * size, F.col("target"))
        return 2 * demand / (start + F.sqrt(start * start + 2 * (end - start) * demand))

    return joined.withColumn("copies", F.least(copies, F.lit(int(most))).cast("int")).select(
        "row",
        "size",
        "source_size",
        "target",
        "copies",
        F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(1), F.col("copies")), position)).otherwise(F.array().cast("array<double>")).alias("positions"),
    )


def training_order(plan: DataFrame) -> DataFrame:
    """The copies of a plan as rows of the input, sorted by training position over range partitions."""
    copies = plan.select("row", F.posexplode("positions").alias("copy", "position"))
    return copies.orderBy("position", "copy").select("row.*")
