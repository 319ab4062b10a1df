"""Nearest neighbours by inner product over balanced posting lists, completed by a bound until the result is exact.

Vectors get one more component, sqrt(M^2 - |x|^2) with M the largest length, so that the largest inner product is the
smallest distance. Centroids come from balanced k-means on a bounded sample; their number follows the rows up to
``most_lists``. They are joined to a neighbour graph that each task holds in memory (its size is bounded) and walks best
first. Every vector of the table goes to the lists of its nearest centroids, as long as they are within ``boundary`` times the
smallest distance and at most ``replicas``. Lists are stored in blocks of at most BLOCK vectors, so a list that holds a
third of all rows is many blocks. A query searches the lists within ``ratio`` times its smallest centroid distance, at most
``probes``; scores are exact sums over the original components.

That first search only gives each query a floor: its k-th score so far, or none if it found fewer. A vector x of the list
(of its nearest centroid) c scores at most q.c + |q| |x - c|, and the largest |x - c| of each list is known. So the query goes
on to all lists whose bound reaches its floor, and a list is left out only if it can't hold a better one. No parameter changes
the result, only what it costs: clustered vectors leave most lists out, vectors without clusters need nearly all.

Defined cases: null ids and vectors, zero vectors, and vectors with null, NaN or infinite components take no part; vectors of
different lengths are an error; candidate rows that repeat an id are ranked as rows of their own except equal ones, which are
one; of query rows that repeat an id the smallest vector, by its components in order, is the query; no candidates give no rows;
equal scores go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinloom.llm.shared import store
from clinloom.llm.topk import usable

SAMPLE = 20_000
LIST_LENGTH = 128
MOST_LISTS = 4096
BLOCK = 1024
QUERIES = 512
DEGREE = 16
BEAM = 96
SALTED = 16
# Vectors for a task to work on at least, and hits that a task gathers before it keeps the best of each query.
TASK = 8192
GATHERED = 500_000


def _lengthened(vectors: np.ndarray, largest: float) -> np.ndarray:
    rest = np.maximum(0.0, largest**2 - (vectors**2).sum(axis=1))
    return np.concatenate((vectors, np.sqrt(rest)[:, None]), axis=1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T))


def balanced_centroids(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """k-means whose distances grow with the size of a list, so that lists stay near equal."""
    rng = np.random.default_rng(11)
    centroids = sample[rng.choice(len(sample), lists, replace=False)].copy()
    sizes = np.full(lists, len(sample) / lists)
    for _ in range(rounds):
        apart = _distances(sample, centroids)
        mine = (apart * (0.8 + 0.2 * sizes * lists / len(sample))).argmin(axis=1)
        counts = np.bincount(mine, minlength=lists)
        sums = np.zeros_like(centroids)
        np.add.at(sums, mine, sample)
        filled = counts > 0
        centroids[filled] = sums[filled] / counts[filled, None]
        sizes = np.clip(0.5 * sizes + 0.5 * counts, 0.25 * len(sample) / lists, 4 * len(sample) / lists)
    return centroids


def neighbour_graph(centroids: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """For each centroid its nearest others and one far link, so that the graph hangs together."""
    n = len(centroids)
    apart = _distances(centroids, centroids)
    np.fill_diagonal(apart, np.inf)
    near = np.argsort(apart, axis=1)[:, : min(degree, max(1, n - 1))]
    ring = ((np.arange(n) + 1) % n)[:, None]
    far = np.random.default_rng(5).integers(0, n, (n, 2))
    return np.concatenate((near, ring, far), axis=1)


def walk(points: np.ndarray, centroids: np.ndarray, graph: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroids that a best-first walk finds: ``centroid, distance``, nearest first, for each point."""
    n, lists = len(points), len(centroids)
    beam = min(beam, lists)
    seen = np.zeros((n, lists), bool)
    rows = np.arange(n)[:, None]
    starts = np.linspace(0, lists - 1, min(16, lists)).astype(int)
    best = np.tile(starts, (n, 1))
    seen[:, starts] = True
    far = _distances(points, centroids[starts])
    done = np.zeros(best.shape, bool)
    norms, lengths = (centroids**2).sum(axis=1), (points**2).sum(axis=1)
    while True:
        waiting = np.where(done, np.inf, far)
        k = min(4, waiting.shape[1])
        pick = np.argpartition(waiting, k - 1, axis=1)[:, :k]
        going = np.isfinite(waiting[rows, pick])
        if not going.any():
            break
        done[rows, pick] = True
        next_ = graph[best[rows, pick]].reshape(n, -1)
        next_ = np.sort(next_, axis=1)
        fresh = ~seen[rows, next_] & np.repeat(going.any(axis=1)[:, None], next_.shape[1], axis=1)
        fresh[:, 1:] &= next_[:, 1:] != next_[:, :-1]
        at, column = np.nonzero(fresh)
        seen[at, next_[at, column]] = True
        apart = np.full(next_.shape, np.inf)
        c = next_[at, column]
        apart[at, column] = np.sqrt(np.maximum(0.0, lengths[at] + norms[c] - 2 * np.einsum("ij,ij->i", points[at], centroids[c])))
        best, far = np.concatenate((best, next_), axis=1), np.concatenate((far, apart), axis=1)
        done = np.concatenate((done, np.isinf(apart)), axis=1)
        keep = np.argsort(far, axis=1, kind="stable")[:, :beam]
        best, far, done = best[rows, keep], far[rows, keep], done[rows, keep]
    return best, far


def _assign(shared, ratio: float, most: int, query: bool):
    """``id, vector, list, place, far`` for the lists of a vector, nearest first: within ``ratio`` of the smallest distance, at most ``most``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, graph, largest = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                vectors = batch["vector"].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
                points = np.concatenate((vectors, np.zeros((len(vectors), 1))), axis=1) if query else _lengthened(vectors, largest)
                if query:
                    # Only the direction of a query matters; at length M its distances are those of a vector of the table.
                    points *= largest / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-300)
                found, far = walk(points, centroids, graph)
                inside = np.isfinite(far) & (far <= far[:, :1] * ratio + 1e-12)
                inside[:, most:] = False
                inside[:, 0] = True
                rows, columns = np.nonzero(inside)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch[c].take(pa.array(rows)) for c in ("id", "vector")),
                        pa.array(found[rows, columns].astype(np.int64)),
                        pa.array(columns.astype(np.int32)),
                        pa.array(far[rows, columns]),
                    ],
                    names=["id", "vector", "list", "place", "far"],
                )

    return run


def _block(size: int, kind: str):
    """Rows sorted by list -> blocks of at most ``size`` rows of one list; components as they came (``kind``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, ids, vectors = None, [], []

        def finish():
            return pa.RecordBatch.from_pylist([{"list": name, "ids": np.array(ids, "<i8").tobytes(), "vectors": np.array(vectors, kind).tobytes()}])

        for batch in batches:
            matrix = batch["vector"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for i, (list_, id_) in enumerate(zip(batch["list"].to_pylist(), batch["id"].to_pylist())):
                if ids and (list_ != name or len(ids) == size):
                    yield finish()
                    ids, vectors = [], []
                name = list_
                ids.append(id_)
                vectors.append(matrix[i])
        if ids:
            yield finish()

    return run


def _blocks(posted: DataFrame, size: int, kind: str, tasks: int) -> DataFrame:
    """``list, ids, vectors``. Lists of more than SALTED blocks are dealt to several tasks; most are whole in one.

    The sizes are those of at most ``most_lists`` lists.
    """
    sizes = posted.groupBy("list").agg(F.ceil(F.count("*") / (SALTED * size)).alias("salts"))
    salt = F.pmod(F.xxhash64("id"), F.col("salts"))
    dealt = posted.join(F.broadcast(sizes), "list").repartition("list", salt).drop("salts").coalesce(tasks).sortWithinPartitions("list", "id")
    return dealt.mapInArrow(_block(size, kind), "list long, ids binary, vectors binary")


def _best(q: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray, floor_ids: np.ndarray):
    """``row, column, score`` of each query's k best candidates that come before its floor: the larger score, then the smaller id."""
    rough = q @ x.T
    rough[query_ids[:, None] == ids[None, :]] = -np.inf
    # Rough products choose what is summed exactly; the slack is far above their rounding.
    slack = 1e-9 * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max(initial=0.0)
    wanted = (rough >= (floor - slack)[:, None]) & (rough > -np.inf)
    many = np.flatnonzero(wanted.sum(axis=1) > k)
    if len(many):
        kth = np.partition(rough[many], len(ids) - k, axis=1)[:, len(ids) - k]
        wanted[many] &= rough[many] >= (kth - slack[many])[:, None]
    rows, columns = np.nonzero(wanted)
    # Component by component, so that equal vectors get equal scores wherever they stand.
    scores = np.zeros(len(rows))
    for d in range(x.shape[1]):
        scores += q[rows, d] * x[columns, d]
    better = (scores > floor[rows]) | ((scores == floor[rows]) & (ids[columns] < floor_ids[rows]))
    rows, columns, scores = rows[better], columns[better], scores[better]
    order = np.lexsort((ids[columns], -scores, rows))
    rows, columns, scores = rows[order], columns[order], scores[order]
    first = np.searchsorted(rows, rows)
    near = np.arange(len(rows)) - first < k
    return rows[near], columns[near], scores[near]


def _best_of_each(parts: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """Of hits ``query, id, score``, the k best of each query; a hit found in several lists counts once."""
    query_ids, ids, scores = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((ids, -scores, query_ids))
    query_ids, ids, scores = query_ids[order], ids[order], scores[order]
    again = np.zeros(len(order), bool)
    again[1:] = (query_ids[1:] == query_ids[:-1]) & (ids[1:] == ids[:-1]) & (scores[1:] == scores[:-1])
    query_ids, ids, scores = query_ids[~again], ids[~again], scores[~again]
    near = np.arange(len(ids)) - np.searchsorted(query_ids, query_ids) < k
    return query_ids[near], ids[near], scores[near]


def _search(k: int, kind: str):
    """Blocks joined with queries -> the k best of the task's blocks for each query, of those that come before its floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        gathered = 0

        def sent(hits: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in hits], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids, query_ids = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["query_ids"], "<i8")
                x = np.frombuffer(row["vectors"], kind).reshape(len(ids), -1).astype(np.float64)
                q = np.frombuffer(row["queries"], kind).reshape(len(query_ids), -1).astype(np.float64)
                if "floors" in row:
                    floor, floor_ids = np.frombuffer(row["floors"], "<f8"), np.frombuffer(row["floor_ids"], "<i8")
                else:
                    floor, floor_ids = np.full(len(q), -np.inf), np.zeros(len(q), np.int64)
                rows, hit, scores = _best(q, query_ids, x, ids, k, floor, floor_ids)
                parts.append((query_ids[rows], ids[hit], scores))
                gathered += len(rows)
                if gathered > GATHERED:
                    parts = [_best_of_each(parts, k)]
                    gathered = len(parts[0][0])
                    # Too many queries for one task to wait for its end.
                    if gathered > GATHERED // 2:
                        yield sent(parts.pop())
                        gathered = 0
        if parts:
            yield sent(_best_of_each(parts, k))

    return run


def near_order(points: np.ndarray) -> np.ndarray:
    """Numbers of the points in an order in which near ones mostly stand together: halved along a wide direction."""

    def halve(at: np.ndarray) -> list[np.ndarray]:
        if len(at) <= 2:
            return [at]
        own = points[at] - points[at].mean(axis=0)
        along = own[np.abs(own).sum(axis=1).argmax()] @ own.T
        for _ in range(5):
            along = own @ (along / max(1e-300, np.abs(along).max()) @ own)
        at = at[np.argsort(along, kind="stable")]
        return halve(at[: len(at) // 2]) + halve(at[len(at) // 2 :])

    return np.concatenate(halve(np.arange(len(points))))


def _send(shared, kind: str):
    """Queries with floors -> for each block that may hold a better candidate, the queries that go there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, radii, starts, firsts, numbers = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, QUERIES):
                batch = whole.slice(at, QUERIES)
                ids = batch["id"].to_numpy().astype("<i8")
                q = batch["vector"].flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(ids), -1)
                floor, floor_ids = batch["floor"].to_numpy().astype("<f8"), batch["floor_id"].to_numpy().astype("<i8")
                exact = q.astype(np.float64)
                most = exact @ centres.T + np.linalg.norm(exact, axis=1)[:, None] * radii
                needed = np.logical_or.reduceat(most >= floor[:, None], starts, axis=1)
                for group in np.flatnonzero(needed.any(axis=0)):
                    go = needed[:, group]
                    sent = {"query_ids": ids[go].tobytes(), "queries": q[go].tobytes(), "floors": floor[go].tobytes(), "floor_ids": floor_ids[go].tobytes()}
                    yield pa.RecordBatch.from_pylist([{"list": int(firsts[group] + i), **sent} for i in range(numbers[group])])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Queries of one block, in rows sorted by block, joined to at least QUERIES a row where there are as many."""
    name, parts, total = None, [], 0

    def joined():
        return pa.RecordBatch.from_pylist([{"list": name, **{c: b"".join(p[c] for p in parts) for c in parts[0] if c != "list"}}])

    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if parts and (row["list"] != name or total >= QUERIES):
                yield joined()
                parts, total = [], 0
            name = row["list"]
            parts.append(row)
            total += len(row["query_ids"]) // 8
    if parts:
        yield joined()


def _better(home: DataFrame, asked: DataFrame, first: DataFrame, centroids: np.ndarray, largest: float, k: int, kind: str, tasks: int) -> DataFrame:
    """What comes before the k-th found of each query, from all lists that may hold it. ``home``: each vector in one list."""
    spark = home.sparkSession
    known = {r["list"]: r for r in home.groupBy("list").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()}
    lists = [int(c) for c in near_order(centroids) if c in known]
    # Neighbouring lists share blocks up to BLOCK rows; a longer list has several blocks.
    starts, firsts, numbers, rows, blocks = [], [], [], 0, 0
    for at, c in enumerate(lists):
        if not starts or rows + known[c]["n"] > BLOCK:
            starts.append(at)
            rows = 0
        rows += known[c]["n"]
        numbers[len(starts) - 1 :] = [math.ceil(rows / BLOCK)]
    for n in numbers:
        firsts.append(blocks)
        blocks += n
    group_of = np.searchsorted(starts, np.arange(len(lists)), side="right") - 1
    places = spark.createDataFrame([(c, firsts[g], numbers[g]) for c, g in zip(lists, group_of)], "list long, first long, number long")
    placed = home.join(F.broadcast(places), "list").select(
        "id", "vector", (F.col("first") + F.pmod(F.xxhash64("id", "vector"), F.col("number"))).alias("list")
    )
    stored = placed.repartition("list").coalesce(tasks).sortWithinPartitions("list", "id").mapInArrow(_block(2 * BLOCK, kind), "list long, ids binary, vectors binary")
    # Distances of the walk are rounded like differences of squares.
    radii = np.array([known[c]["far"] for c in lists]) + 1e-6 * largest
    shared = spark.sparkContext.broadcast((centroids[lists][:, :-1], radii, np.array(starts), np.array(firsts), np.array(numbers)))
    last = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"), F.col("vec_id").alias("floor_id"))
    floored = asked.join(last, "id", "left").select(
        "id", "vector", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"), F.coalesce("floor_id", F.lit(0)).cast("long").alias("floor_id")
    )
    packed = "list long, query_ids binary, queries binary, floors binary, floor_ids binary"
    sent = floored.coalesce(tasks).mapInArrow(_send(shared, kind), packed)
    merged = sent.repartition("list", F.pmod(F.xxhash64("query_ids"), F.lit(4))).coalesce(tasks).sortWithinPartitions("list").mapInArrow(_merge, packed)
    return stored.join(merged, "list").coalesce(tasks).mapInArrow(_search(k, kind), "query_id long, vec_id long, score double")


def _pack_queries(rows: DataFrame, kind: str, tasks: int, size: int = 256) -> DataFrame:
    return _blocks(rows, size, kind, tasks).select("list", F.col("ids").alias("query_ids"), F.col("vectors").alias("queries"))


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    sample: int = SAMPLE,
    list_length: int = LIST_LENGTH,
    most_lists: int = MOST_LISTS,
    boundary: float = 1.1,
    replicas: int = 4,
    ratio: float = 1.3,
    probes: int = 64,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest, by largest inner product. Frames have ``id, vector``.

    Components are compared as they came, floats or doubles; other types are read as doubles.
    """
    spark = vectors.sparkSession
    single = all(df.schema["vector"].dataType.elementType.typeName() == "float" for df in (vectors, queries))
    kind, type_ = ("<f4", "float") if single else ("<f8", "double")
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    ready = lambda df: df.where(usable(F.col("vector")) & F.col("id").isNotNull()).select(F.col("id").cast("long").alias("id"), F.col("vector").cast(f"array<{type_}>").alias("vector")).where(length > 0)
    base = ready(vectors).distinct()
    facts = base.agg(F.count("*").alias("n"), F.max(F.sqrt(length)).alias("largest"), F.min(F.size("vector")).alias("low"), F.max(F.size("vector")).alias("high")).first()
    if not facts["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if facts["low"] != facts["high"]:
        raise ValueError("vectors of different lengths")
    share = min(1.0, sample / facts["n"])
    # About ``sample`` rows by a hash of the id: bounded, and the same on every run.
    chosen = base.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 20)) < share * (1 << 20)).select("vector").distinct().limit(2 * sample).collect()
    points = np.array([r["vector"] for r in chosen] or [[0.0] * facts["low"]], np.float64)
    lists = max(1, min(most_lists, math.ceil(facts["n"] / list_length), len(points)))
    centroids = balanced_centroids(_lengthened(points, facts["largest"]), lists)
    shared = spark.sparkContext.broadcast((centroids, neighbour_graph(centroids), facts["largest"]))
    # Work for a task is counted in vectors, so a small table doesn't start a worker for each of many partitions.
    tasks = max(spark.sparkContext.defaultParallelism, facts["n"] // TASK)
    posting = f"id long, vector array<{type_}>, list long, place int, far double"
    posted = store(base.coalesce(tasks).mapInArrow(_assign(shared, boundary, replicas, False), posting), "postings")
    blocks = _blocks(posted, BLOCK, kind, tasks)
    asked = store(ready(queries).groupBy("id").agg(F.min("vector").alias("vector")), "queries")
    probed = asked.coalesce(tasks).mapInArrow(_assign(shared, ratio, probes, True), posting)
    found = blocks.join(_pack_queries(probed, kind, tasks), "list").coalesce(tasks).mapInArrow(_search(k, kind), "query_id long, vec_id long, score double")
    first = store(_ranked(found, k), "nearest")
    rest = _better(posted.where("place = 0"), asked, first, centroids, facts["largest"], k, kind, tasks)
    return _ranked(first.drop("rank").unionByName(rest), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
