"""Hard negatives of anchors, with exact scores from float32 products in a residue number system.

Components are turned into integers by ``floor(scale * x)``; a score is the integer inner product of two rows. Residues of
the components modulo a few primes are multiplied as float32 matrices, STRIP components at a time: the primes are so small
that every partial sum is an integer below 2^24, so float32 is exact. The number of primes follows from the longest vector
(Cauchy-Schwarz): their product exceeds twice the largest score. Scores are put together by Chinese remaindering in balanced
mixed radix, whose digits have signs, so a negative score needs no case of its own.

Anchors are a stated set of rows. They are cut into blocks that meet every block of candidates; a block pair sends, for each
anchor, no more rows than are asked for. A first pass takes each anchor's positives, the best other rows of its label. A
second one takes, for each anchor and positive, the best rows of other labels in a window below the positive's score:
``low * positive <= 100 * negative <= high * positive``. Windows over (anchor) and (anchor, positive) rank what is left.

Defined cases: rows with a null id, label or vector, or with a null, NaN or infinite component, take no part; vectors of
different lengths are an error (``ValueError``), and so are vectors whose scores may exceed 62 bits (``OverflowError``). Rows
with an anchor's id are neither its positives nor its negatives; other rows that repeat an id are rows of their own, and a
repeated positive has negatives each time. Of anchor rows that repeat an id, the smallest (label, vector) is the anchor.
Equal scores go to the smaller id. An anchor without positives, or a positive without negatives, gives no row.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinloom.llm.shared import store
from clinloom.llm.topk import usable

STRIP = 256
ANCHOR_BLOCK = 256
CANDIDATE_BLOCK = 8192
#: Candidates scored at once, so that a block pair's scores stay small.
COLUMNS = 2048
MOST = 2.0**61
_SCHEMA = "anchor_id long, slot int, id long, score long"


def primes_for(dim: int, most: float) -> list[int]:
    """Odd primes, largest first, exact in float32 strips of ``dim`` components; their product exceeds ``2 * most``."""
    largest = 2 * int((2**24 / max(1, min(dim, STRIP))) ** 0.5) + 1
    largest, found, product = min(largest, 4095), [], 1
    for n in range(largest, 2, -1):
        if all(n % d for d in range(2, int(n**0.5) + 1)):
            found.append(n)
            product *= n
            if product > 2 * most + 1:
                return found
    raise OverflowError("scores beyond the range of the primes")


def balanced(values: np.ndarray, prime: int) -> np.ndarray:
    """Residues between ``-(prime - 1) / 2`` and ``(prime - 1) / 2``."""
    half = prime // 2
    return (values + half) % prime - half


def residues(vectors: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    return [balanced(vectors.astype(np.int64), p).astype(np.float32) for p in primes]


def rns_scores(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact signed inner products of rows given by their residues."""
    digits: list[np.ndarray] = []
    for p, a, b in zip(primes, left, right):
        rest = np.zeros((len(a), len(b)), np.int64)
        for at in range(0, a.shape[1], STRIP):
            rest += (a[:, at : at + STRIP] @ b[:, at : at + STRIP].T).astype(np.int64)
        # Garner's step: take the digits known so far off, divide by the primes they stand for.
        for q, digit in zip(primes, digits):
            rest = (rest - digit) % p * pow(q, -1, p)
        digits.append(balanced(rest, p))
    score, place = np.zeros_like(digits[0]), 1
    for p, digit in zip(primes, digits):
        # Modulo 2^64: the score itself is below that.
        score += digit * np.array([place % 2**64], np.uint64).astype(np.int64)
        place *= p
    return score


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k largest allowed scores of each row; equal scores go to the smaller column."""
    floor = np.iinfo(np.int64).min
    masked = np.where(allowed, scores, floor)
    if masked.shape[1] > k:
        kth = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k, None]
        allowed = allowed & (masked >= kth)
    at, column = np.nonzero(allowed)
    order = np.lexsort((column, -masked[at, column], at))
    at, column = at[order], column[order]
    nth = np.arange(len(at)) - np.searchsorted(at, at)
    return at[nth < k], column[nth < k]


def _blocks(size: int):
    """Rows in blocks of ``size``, sorted by id; the same rows make the same blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                part = part.take(pa.array(np.argsort(part["id"].to_numpy(), kind="stable")))
                ids, labels = (part[c].to_numpy().astype("<i8") for c in ("id", "label"))
                vectors = part["vector"].flatten().to_numpy().astype("<i4")
                yield pa.RecordBatch.from_pylist([{"ids": ids.tobytes(), "labels": labels.tobytes(), "vectors": vectors.tobytes()}])

    return run


def _read(ids: bytes, labels: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(ids) // 8
    return np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8"), np.frombuffer(vectors, "<i4").reshape(n, -1)


def _mined(primes: list[int], k: int, low: int | None, high: int | None):
    """The best candidates of every anchor (and slot) of each block pair: positives, or negatives inside the slots' windows."""

    def of_pair(row: dict, sent: list[dict]) -> list[np.ndarray]:
        ids, labels, vectors = _read(row["ids"], row["labels"], row["vectors"])
        anchor = residues(np.array([a["vector"] for a in sent], np.int64), primes)
        anchor_ids, anchor_labels = (np.array([a[c] for a in sent], np.int64)[:, None] for c in ("id", "label"))
        width = 1 if low is None else max(len(a["positives"]) for a in sent)
        out = []
        for start in range(0, len(ids), COLUMNS):
            cut = slice(start, start + COLUMNS)
            scores = rns_scores(anchor, residues(vectors[cut], primes), primes)
            other = anchor_ids != ids[None, cut]
            same = anchor_labels == labels[None, cut]
            for slot in range(width):
                allowed = other & (same if low is None else ~same)
                if low is not None:
                    # Whole bounds of the window; an anchor with fewer positives has an empty one.
                    wanted = [a["positives"][slot]["score"] if slot < len(a["positives"]) else None for a in sent]
                    least = np.array([0 if w is None else -(-low * w // 100) for w in wanted], np.int64)[:, None]
                    most = np.array([-1 if w is None else high * w // 100 for w in wanted], np.int64)[:, None]
                    allowed &= (scores >= least) & (scores <= most)
                at, column = best(scores, allowed, k)
                out.append((anchor_ids[at, 0], np.full(len(at), slot), ids[cut][column], scores[at, column]))
        columns = [np.concatenate(c) for c in zip(*out)]
        # Of the strips' best, the block's best.
        order = np.lexsort((columns[2], -columns[3], columns[1], columns[0]))
        columns = [c[order] for c in columns]
        group = np.stack(columns[:2])
        starts = np.flatnonzero(np.concatenate(([True], (group[:, 1:] != group[:, :-1]).any(axis=0)))) if len(order) else np.empty(0, np.int64)
        nth = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
        return [c[nth < k] for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                found = of_pair(row, row["anchors"])
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, kinds)], names=["anchor_id", "slot", "id", "score"])

    return run


def _pairs(candidates: DataFrame, anchors: DataFrame, blocks: int, lanes: int) -> DataFrame:
    """Every block of candidates beside every block of anchors: the anchors, the small side, are sent to each lane."""
    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    packed = anchors.groupBy(block.alias("block")).agg(F.sort_array(F.collect_list(F.struct(*anchors.columns))).alias("anchors")).drop("block")
    sent = packed.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    return candidates.withColumn("lane", F.pmod(F.xxhash64("ids", "vectors"), F.lit(lanes)).cast("int")).join(sent, "lane").drop("lane")


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for ``anchors``, a stated set of ``rows``.

    Both frames have ``id, label, vector``; ``low`` and ``high`` are percentages of the positive's score.
    """
    spark = rows.sparkSession
    fine = usable(F.col("vector")) & F.col("id").isNotNull() & F.col("label").isNotNull()
    whole = F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("double"))

    def ready(df: DataFrame) -> DataFrame:
        return df.where(fine).select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), whole.alias("vector"))

    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    shape = ready(rows).agg(F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("most"), F.max(squares).alias("square"), F.count("*").alias("n")).first()
    # One row for each id.
    mine_ = ready(anchors).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("first")).select("id", "first.label", F.col("first.vector").cast("array<long>").alias("vector"))
    if shape["n"]:
        if shape["least"] != shape["most"]:
            raise ValueError("vectors of different lengths")
        if shape["square"] >= MOST:
            raise OverflowError("scores may exceed 62 bits")
    stored = store(mine_, "anchors")
    count = stored.count()
    if not count or not shape["n"] or not shape["most"]:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    # The sum of squares is rounded; a thousandth more covers that.
    primes = primes_for(shape["most"], shape["square"] * 1.001 + 1)
    integers = ready(rows).withColumn("vector", F.col("vector").cast("array<int>"))
    candidates = store(integers.mapInArrow(_blocks(CANDIDATE_BLOCK), "ids binary, labels binary, vectors binary"), "candidates")
    blocks = -(-count // ANCHOR_BLOCK)
    lanes = max(spark.sparkContext.defaultParallelism, shape["n"] // (8 * CANDIDATE_BLOCK))
    pairs = functools.partial(_pairs, candidates, blocks=blocks, lanes=lanes)
    first = pairs(stored).mapInArrow(_mined(primes, positives, None, None), _SCHEMA)
    ranked = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "id")
    taken = first.withColumn("place", F.row_number().over(ranked) - 1).where(F.col("place") < positives)
    # At most ``positives`` rows for each anchor.
    listed = store(taken.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("positives")), "positives")
    with_windows = stored.join(listed, stored["id"] == listed["anchor_id"]).select("id", "label", "vector", "positives")
    second = pairs(with_windows).mapInArrow(_mined(primes, negatives, low, high), _SCHEMA)
    ranked = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "id")
    kept = second.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= negatives)
    slots = listed.select("anchor_id", F.explode("positives").alias("p")).select("anchor_id", F.col("p.place").alias("slot"), F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    return kept.join(slots, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
