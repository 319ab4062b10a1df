"""Exact top-k search by distributed selection over score histograms.

Every query is scored against every candidate in blocks. The k-th score of each query is located by refining a histogram of
its scores: a round counts, per query, the scores in each of BINS parts of the range still open, sums the counts of all
blocks, and keeps the part in which the k-th score lies. When every range is one score wide, a last pass takes the scores
above the k-th and, of the scores equal to it, those of the smallest ids.

A block sends only bins at or above its own k-th score: nothing below that can hold the k-th score of all. So a query gets
at most k bins and k rows from a block, whatever the number of candidates or ties. Nothing but the widest open range, one
number, reaches the driver.

Components are turned into integers by ``floor(scale * x)``. Scores are exact: products and sums are kept below 2^53 and
taken in double precision, else in 64-bit integers; where even those could overflow, the search raises ``OverflowError``.

Defined cases: null vectors, and vectors with null, NaN or infinite components, take no part; so do null ids. Vectors of
other than the most common length are an error. Rows with a query's id are never its candidates; rows that repeat an id are
ranked as rows of their own. Of query rows that repeat an id, the smallest vector (by its components in order) is the query, so
an id is one query however often it comes. With fewer than k candidates a query gets all; without candidates it gets no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinloom.llm.shared import store

BINS = 256
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 4096


def usable(vector: Column) -> Column:
    """A vector that is not null and has finite components only."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def blocks_of(rows: DataFrame, size: int, label: str) -> DataFrame:
    """``id, vector`` -> ``block, ids, vectors``: fixed-size blocks; ids and vectors as little-endian binary, sorted by id."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                ids = part["id"].to_numpy().astype("<i8")
                vectors = part["vector"].flatten().to_numpy(zero_copy_only=False).astype("<f8").reshape(len(ids), -1)
                yield pa.RecordBatch.from_pylist([{"ids": ids.tobytes(), "vectors": vectors.tobytes(), "dim": vectors.shape[1]}])

    packed = rows.select("id", "vector").mapInArrow(pack, "ids binary, vectors binary, dim long")
    return store(packed, label)


def numbered(blocks: DataFrame, label: str) -> DataFrame:
    """Blocks with numbers from 0 without gaps; what is sorted in one task are block names, not blocks."""
    named = blocks.withColumn("name", F.md5(F.concat("ids", "vectors")))
    # Ids are unique over all blocks, so no two blocks are equal.
    order = named.select("name").distinct().select("name", (F.row_number().over(Window.orderBy("name")) - 1).alias("block"))
    return store(named.join(order, "name").drop("name"), label)


def _arrays(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<i8")
    return ids, np.frombuffer(row["vectors"], "<f8").reshape(len(ids), -1)


def integer_scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of integer-valued rows, as 64-bit integers."""
    if not queries.size or not candidates.size:
        return np.zeros((len(queries), len(candidates)), np.int64)
    most = float(np.abs(queries).max()) * float(np.abs(candidates).max()) * queries.shape[1]
    if most < 2.0**53:
        return (queries @ candidates.T).astype(np.int64)
    if most < 2.0**61:
        return queries.astype(np.int64) @ candidates.astype(np.int64).T
    raise OverflowError("inner products may exceed 64 bits")


def _kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest score of each row; the smallest where there are fewer."""
    k = min(k, scores.shape[1])
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


MASKED = np.iinfo(np.int64).min


def _scored(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, vectors = _arrays(row)
    query_ids, queries = np.frombuffer(row["query_ids"], "<i8"), np.frombuffer(row["queries"], "<f8")
    scores = integer_scores(queries.reshape(len(query_ids), -1), vectors)
    scores[query_ids[:, None] == ids[None, :]] = MASKED
    return query_ids, ids, scores


def _count_bins(k: int):
    """Counts of the scores in the open range of each query, in bins of ``width``: ``query_id, bin, found``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                query_ids, _, scores = _scored(row)
                low, high, width = (np.frombuffer(row[c], "<i8")[:, None] for c in ("low", "high", "width"))
                real = scores > MASKED
                floor = np.maximum(_kth(scores, k)[:, None], low)
                wanted = real & (scores >= floor) & (scores < high)
                at, _ = np.nonzero(wanted)
                # Bins from the floor of the range; those wholly below the block's k-th score don't matter.
                bins = (scores[wanted] - low[at, 0]) // width[at, 0]
                cells, found = np.unique(np.stack((at, bins)), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[cells[0]]), pa.array(cells[1]), pa.array(found)], names=["query_id", "bin", "found"]
                )

    return run


def _take_best(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                query_ids, ids, scores = _scored(row)
                kth = np.maximum(np.frombuffer(row["low"], "<i8"), MASKED + 1)
                out = [[], [], []]
                for q, bound in enumerate(np.maximum(kth, _kth(scores, k))):
                    above = np.flatnonzero(scores[q] > max(bound, MASKED))
                    level = np.flatnonzero(scores[q] == bound) if bound > MASKED else above[:0]
                    level = level[np.argsort(ids[level], kind="stable")][: max(0, k - len(above))]
                    best = np.concatenate((above, level))
                    out[0].append(np.full(len(best), query_ids[q]))
                    out[1].append(ids[best])
                    out[2].append(scores[q][best])
                columns = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64), pa.int64()) for c in out]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    return run


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int, scale: float = 256.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k candidates of largest integer inner product, ties to smaller ids.

    Both frames have ``id, vector``; queries are a stated set of rows, cut into blocks that meet every candidate block.
    """
    whole = lambda v: F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    ready = lambda df: df.where(usable(F.col("vector")) & F.col("id").isNotNull()).select(F.col("id").cast("long").alias("id"), whole("vector").alias("vector"))
    # One row for each id; by length too, so that a vector of another length is still an error.
    mine = ready(queries).groupBy("id", F.size("vector")).agg(F.min("vector").alias("vector")).select("id", "vector")
    theirs = ready(vectors)
    per_block = lambda df: df.repartition(F.pmod(F.xxhash64("id"), F.lit(4096))).sortWithinPartitions("id")
    query_blocks = numbered(blocks_of(per_block(mine), QUERY_BLOCK, "queries"), "queries").select(
        "block", F.col("ids").alias("query_ids"), F.col("vectors").alias("queries"), "dim"
    )
    candidates = blocks_of(theirs, CANDIDATE_BLOCK, "candidates")
    return _select(candidates, query_blocks, k)


def _select(candidates: DataFrame, query_blocks: DataFrame, k: int) -> DataFrame:
    spark = candidates.sparkSession
    count = query_blocks.count()
    dims = candidates.select("dim").unionByName(query_blocks.select("dim")).distinct().limit(2).collect()
    if len(dims) > 1:
        raise ValueError("vectors of different lengths")
    if not dims or not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # Each candidate block goes to every block of the stated queries.
    sent = candidates.select("ids", "vectors", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("block"))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, vectors in zip(batch["query_ids"], batch["queries"]):
                q = np.frombuffer(ids.as_py(), "<i8")
                norms = np.abs(np.frombuffer(vectors.as_py(), "<f8").reshape(len(q), -1)).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(norms)], names=["query_id", "norm"])

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for vectors in batch["vectors"]:
                yield pa.RecordBatch.from_arrays([pa.array([float(np.abs(np.frombuffer(vectors.as_py(), "<f8")).max(initial=0.0))])], names=["most"])

    most = candidates.select("vectors").mapInArrow(largest, "most double").agg(F.max("most")).first()[0]
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    bound = F.least(F.ceil(F.col("norm") * F.lit(most)), F.lit(2**61)) + 1
    width = lambda low, high: F.greatest(F.lit(1), F.ceil((high - low) / BINS)).cast("long")
    ids = query_blocks.select("query_ids", "queries").mapInArrow(unpack, "query_id long, norm double")
    ranges = ids.groupBy("query_id").agg(F.max("norm").alias("norm")).select(
        "query_id", (-bound).cast("long").alias("low"), bound.cast("long").alias("high"), F.lit(k).cast("long").alias("wanted")
    )
    ranges = store(ranges.withColumn("width", width(F.col("low"), F.col("high"))), "ranges")
    while True:
        located = _with_ranges(query_blocks, ranges)
        bins = sent.join(located, "block").mapInArrow(_count_bins(k), "query_id long, bin long, found long")
        summed = bins.groupBy("query_id", "bin").agg(F.sum("found").alias("found"))
        down = Window.partitionBy("query_id").orderBy(F.col("bin").desc())
        reached = summed.withColumn("upto", F.sum("found").over(down)).join(ranges.select("query_id", "wanted"), "query_id")
        # Of the bins in which the count reaches k, the highest; with fewer than k scores, the lowest bin of all.
        hit = reached.groupBy("query_id").agg(
            F.coalesce(F.max(F.when(F.col("upto") >= F.col("wanted"), F.col("bin"))), F.min("bin")).alias("bin")
        )
        above = reached.alias("r").join(hit.alias("h"), "query_id").where("r.bin > h.bin").groupBy("query_id").agg(F.sum("found").alias("above"))
        low = F.col("low") + F.coalesce(F.col("bin") * F.col("width"), F.lit(0))
        # A query without scores in its range has no candidates at all; its range is closed.
        high = F.when(F.col("bin").isNull(), F.col("low") + 1).otherwise(F.least(F.col("high"), low + F.col("width")))
        narrowed = ranges.join(hit, "query_id", "left").join(above, "query_id", "left").select(
            "query_id", low.alias("low"), high.alias("high"), (F.col("wanted") - F.coalesce("above", F.lit(0))).alias("wanted")
        )
        ranges = store(narrowed.withColumn("width", width(F.col("low"), F.col("high"))), "ranges")
        if ranges.agg(F.max(F.col("high") - F.col("low"))).first()[0] <= 1:
            break
    best = sent.join(_with_ranges(query_blocks, ranges), "block").mapInArrow(_take_best(k), "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _with_ranges(query_blocks: DataFrame, ranges: DataFrame) -> DataFrame:
    """Query blocks with the low ends, high ends and bin widths of their queries, in the order of their ids."""
    ids = query_blocks.select("block", "query_ids").mapInArrow(_list_ids, "block int, at int, query_id long")
    listed = ids.join(ranges, "query_id").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", "low", "high", "width"))).alias("ranges"))
    packed = listed.mapInArrow(_pack_ranges, "block int, low binary, high binary, width binary")
    return query_blocks.join(packed, "block").drop("dim")


def _list_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, ids in zip(batch["block"], batch["query_ids"]):
            q = np.frombuffer(ids.as_py(), "<i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(q), block.as_py()), pa.int32()), pa.array(np.arange(len(q)), pa.int32()), pa.array(q, pa.int64())],
                names=["block", "at", "query_id"],
            )


def _pack_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        columns = [np.array([[r[c] for r in row["ranges"]] for row in rows[i : i + 1]], "<i8").tobytes() for c in ("low", "high", "width") for i, row in enumerate(rows)]
        n = len(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r["block"] for r in rows], pa.int32()), *(pa.array(columns[i * n : (i + 1) * n], pa.binary()) for i in range(3))],
            names=["block", "low", "high", "width"],
        )
