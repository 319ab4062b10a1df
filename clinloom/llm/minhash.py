"""MinHash near-duplicates: universal hash minima, banding, exact verification, connected components.

1. Every document becomes the set of its word shingles (64-bit hashes); equal sets form one class, so copies are never
   paired. A class has 128 minima of the universal hashes (a x + b mod 2^64) and 32 band keys of 4 minima each; two sets of
   similarity 0.8 share no band with a probability below 1e-7.
2. In every bucket of two classes or more, each member is paired with the bucket's smallest and largest class. Pairs whose
   sizes or 256-bit sketches rule out the similarity are dropped (a linked pair falls to the sketch with a probability below
   1e-8), the rest is confirmed on the full sets from the texts.
3. Components are taken, and buckets that still hold several components go on: the members outside their largest component
   are paired with all members of other components that can match: by a sketch of 2048 cells, and by the shingles that no
   other open class has, which bound the similarity of a pair from above. A pair is made once, in the first band it shares.
   That finds every link the stars left out.
4. Components are taken again over all confirmed links.

Defined cases: null and empty texts, and texts of white space only, have an empty set and are linked with nothing; a null
document id is never the smallest of its component (a component of nulls only has the id null); rows with one id are separate
documents; repeated rows have equal sets and meet in one component. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinloom.llm.components import connected_components
from clinloom.llm.packing import slices
from clinloom.llm.shared import store, text_key

BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
# Differing 2-bit cells of 128 for a pair of similarity s: 96 (1 - s) on average, 19.2 at 0.8 with a deviation of 4.
SKETCH_DEVIATIONS = 6.5
FINE = 2048
CACHED_WORDS = 400_000
COLUMNS_AT_ONCE = 1024
# What a worker makes of a batch is many times as large as its texts, most of all a fine sketch (16 kB a row, several times over
# while it is made). So it takes this much text of it at once (a single text may be longer), and this many rows.
SLICE_BYTES = 1 << 20
SLICE_ROWS = 256

_random = np.random.default_rng(20_240_229)
_A = _random.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 2**63, HASHES, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word -> 64-bit hash; forgets its words when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHED_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_set(text: str | None, width: int, words: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words; of the whole sequence where there are fewer words."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = words.of(found)
    taken = min(width, len(hashes))
    whole = np.full(len(hashes) - taken + 1, taken, np.uint64)
    for i in range(taken):
        whole = mixed(whole * _MIX + hashes[i : len(hashes) - taken + 1 + i])
    return np.unique(whole)


def minima(shingles: np.ndarray, buffer: np.ndarray) -> np.ndarray:
    """The upper halves of the smallest values of the universal hashes over a set."""
    best = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), COLUMNS_AT_ONCE):
        part = shingles[at : at + COLUMNS_AT_ONCE]
        block = buffer[: HASHES * len(part)].reshape(HASHES, len(part))
        np.multiply(_A[:, None], part[None, :], out=block)
        np.add(block, _B[:, None], out=block)
        np.minimum(best, block.min(axis=1), out=best)
    return best >> np.uint64(32)


def band_keys(lows: np.ndarray) -> np.ndarray:
    """One 64-bit key per band for each row of minima."""
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(lows), 1))
    parts = lows.reshape(len(lows), BANDS, ROWS)
    for r in range(ROWS):
        keys = mixed(keys * _MIX + parts[:, :, r])
    return keys.view(np.int64)


def sketches(lows: np.ndarray) -> np.ndarray:
    """Two bits of each minimum as 4 longs: the first bits of all minima, then the second."""
    cells = mixed(lows + np.uint64(1))
    bits = np.concatenate([(cells & np.uint64(1)).astype(np.uint8), ((cells >> np.uint64(1)) & np.uint64(1)).astype(np.uint8)], axis=1)
    return np.packbits(bits, axis=1).view(np.int64)


def _parts(batches: Iterator[pa.RecordBatch], *texts: str) -> Iterator[pa.RecordBatch]:
    """The batches in runs of at most SLICE_ROWS rows, whose texts have at most SLICE_BYTES bytes in each column (or a single row)."""
    for batch in batches:
        runs = iter([batch.slice(at, SLICE_ROWS) for at in range(0, batch.num_rows, SLICE_ROWS)])
        for text in texts:
            runs = itertools.chain.from_iterable(map(lambda b, text=text: slices(b, text, SLICE_BYTES), runs))
        yield from runs
        # What a batch took goes back to the system: the worker shares an executor's memory with the JVM.
        pa.default_memory_pool().release_unused()


SIGNED = pa.schema(
    [("id", pa.int64()), ("text_key", pa.binary()), ("n", pa.int64()), ("class", pa.binary()), ("sketch", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))]
)


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, buffer = WordHashes(), np.empty(HASHES * COLUMNS_AT_ONCE, np.uint64)
        for batch in _parts(batches, "text"):
            sizes, classes, lows = [], [], np.zeros((batch.num_rows, HASHES), np.uint64)
            for i, text in enumerate(batch["text"]):
                shingles = shingle_set(text.as_py(), width, words)
                sizes.append(len(shingles))
                classes.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                if len(shingles):
                    lows[i] = minima(shingles, buffer)
            lists = [
                pa.FixedSizeListArray.from_arrays(pa.array(values.ravel(), pa.int64()), values.shape[1]).cast(pa.list_(pa.int64()))
                for values in (sketches(lows), band_keys(lows))
            ]
            columns = [batch["id"], batch["text_key"].cast(pa.binary()), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), *lists]
            yield pa.RecordBatch.from_arrays(columns, schema=SIGNED)

    return run


def signatures(docs: DataFrame, identity: str, text: str, width: int) -> DataFrame:
    """``id, text_key, n, class, sketch, bands`` of every document; the class stands for its whole shingle set."""
    read = docs.select(F.col(identity).cast("long").alias("id"), text_key(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    return read.mapInArrow(_sign(width), "id long, text_key binary, n long, class binary, sketch array<long>, bands array<long>")


def _confirm(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last, held = WordHashes(), None, None
        for batch in _parts(batches, "text_a", "text_b"):
            kept = []
            for i, (b, text_a, text_b) in enumerate(zip(batch["b"], batch["text_a"], batch["text_b"])):
                key = b.as_py()
                if key != last:
                    last, held = key, shingle_set(text_b.as_py(), width, words)
                mine = shingle_set(text_a.as_py(), width, words)
                places = np.minimum(np.searchsorted(held, mine), len(held) - 1)
                both = int((held[places] == mine).sum())
                if 100 * both >= percent * (len(held) + len(mine) - both):
                    kept.append(i)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs of classes ``a, b`` whose full sets are similar enough, counted from the texts."""
    first = texts.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.select("a", "b").join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(_confirm(width, percent), "a binary, b binary")


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that neither the set sizes nor the sketches rule out."""
    facts = classes.select("class", "n", "sketch")
    a = facts.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    b = facts.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    return pairs.join(a, "a").join(b, "b").where(_may_match("n_a", "n_b", "sketch_a", "sketch_b", percent)).select("a", "b")


def _may_match(n_a: str, n_b: str, sketch_a: str, sketch_b: str, percent: int):
    apart = 0.75 * (1 - percent / 100)
    most = HASHES * apart + SKETCH_DEVIATIONS * (HASHES * apart * (1 - apart)) ** 0.5
    xor = [F.col(sketch_a)[i].bitwiseXOR(F.col(sketch_b)[i]) for i in range(4)]
    differing = F.bit_count(xor[0].bitwiseOR(xor[2])) + F.bit_count(xor[1].bitwiseOR(xor[3]))
    sizes = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    return sizes & (differing <= int(most) + 1)


def _describe(width: int):
    """Shingles and a sketch of FINE cells for each class: too much to carry for every document."""
    a = _random_odd(FINE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in _parts(batches, "text"):
            sets = [shingle_set(t.as_py(), width, words) for t in batch["text"]]
            lows = np.empty((len(sets), FINE), np.uint64)
            for i, shingles in enumerate(sets):
                best = np.full(FINE, np.iinfo(np.uint64).max, np.uint64)
                for at in range(0, len(shingles), 128):
                    np.minimum(best, (a[:, None] * shingles[None, at : at + 128]).min(axis=1), out=best)
                lows[i] = best >> np.uint64(32)
            columns = [
                batch["class"].cast(pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(list(sketches(lows)), pa.list_(pa.int64())),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["class", "n", "fine", "shingles"])

    return run


def _random_odd(count: int) -> np.ndarray:
    return np.random.default_rng(7_919).integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _open_facts(texts: DataFrame, width: int) -> DataFrame:
    """``class, n, fine, own``: set size, fine sketch and the number of shingles that no other of these classes has."""
    described = store(texts.mapInArrow(_describe(width), "class binary, n long, fine array<long>, shingles array<long>"), "described")
    holders = described.select("class", F.explode("shingles").alias("shingle")).groupBy("shingle")
    single = holders.agg(F.min("class").alias("class"), F.count("*").alias("holders")).where("holders = 1")
    own = single.groupBy("class").agg(F.count("*").alias("own"))
    return described.select("class", "n", "fine").join(own, "class", "left").withColumn("own", F.coalesce("own", F.lit(0)))


def _may_match_finely(percent: int):
    """What no other class has can't be in an intersection, and is in every union; the fine sketch rules out more."""
    shared, shared_x = F.col("n") - F.col("own"), F.col("n_x") - F.col("own_x")
    bound = 100 * F.least(shared, shared_x) >= percent * (F.col("own") + F.col("own_x") + F.greatest(shared, shared_x))
    apart = 0.75 * (1 - percent / 100)
    most = FINE * apart + 6 * (FINE * apart * (1 - apart)) ** 0.5
    half = FINE // 64
    cells = [F.col("fine")[i].bitwiseXOR(F.col("fine_x")[i]).bitwiseOR(F.col("fine")[i + half].bitwiseXOR(F.col("fine_x")[i + half])) for i in range(half)]
    differing = F.bit_count(cells[0])
    for cell in cells[1:]:
        differing = differing + F.bit_count(cell)
    return bound & (differing <= int(most) + 1)


def _first_shared_band():
    """Of the bands that two classes share, a pair is made in the first, and there once where both are outside the largest component."""
    same = F.zip_with("bands", "bands_x", lambda p, q: p == q)
    once = (F.col("component") == F.col("top")) | (F.col("class_x") < F.col("class"))
    return once & (F.array_position(same, True) == F.col("band") + 1)


def near_duplicates(docs: DataFrame, identity: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``id, n_shingles, component_id, kept``.

    Documents are linked when 100 * intersection >= percent * union of their shingle sets.
    """
    signed = store(signatures(docs, identity, text, width), "signatures")
    classes = store(
        signed.where("n > 0").groupBy("class").agg(*[F.min(c).alias(c) for c in ("text_key", "n", "sketch", "bands")]), "classes"
    )
    keys = classes.select("class", F.posexplode("bands").alias("band", "key"))
    ends = keys.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high")
    members = store(keys.join(ends, "key"), "members")
    wanted = classes.join(members.select("class").distinct(), "class", "left_semi").select("class", "text_key")
    keyed = docs.where(F.col(text).isNotNull()).select(text_key(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    texts = store(keyed.join(wanted, "text_key").dropDuplicates(["class"]).select("class", "text"), "texts")

    stars = members.select(F.col("class").alias("a"), F.explode(F.array("low", "high")).alias("b")).where("a <> b")
    paired = store(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    links = store(confirmed(_plausible(paired, classes, percent), texts, width, percent), "confirmed")
    first = connected_components(links)

    # Buckets that still hold several components.
    named = members.select("key", "band", "class").join(first.withColumnRenamed("node", "class"), "class", "left")
    named = named.withColumn("component", F.coalesce("component", "class"))
    counts = named.groupBy("key", "component").agg(F.count("*").alias("members"))
    largest = counts.groupBy("key").agg(F.max(F.struct("members", "component")).alias("top"), F.count("*").alias("components"))
    open_ = store(
        named.join(largest.where("components > 1").select("key", F.col("top.component").alias("top")), "key"), "open"
    )
    known = _open_facts(open_.select("class").distinct().join(texts, "class"), width).join(classes.select("class", "bands"), "class")
    open_ = open_.select("key", "band", "class", "component", "top").join(known, "class")
    few = open_.where("component <> top").select("key", *[F.col(c).alias(f"{c}_x") for c in ("class", "component", "n", "own", "fine", "bands")])
    rest = few.join(open_, "key").where((F.col("component_x") != F.col("component")) & _may_match_finely(percent) & _first_shared_band())
    pairs = rest.select(F.least("class_x", "class").alias("a"), F.greatest("class_x", "class").alias("b"))
    untried = pairs.join(paired, ["a", "b"], "left_anti")
    more = store(confirmed(untried, texts, width, percent), "confirmed")
    both = store(connected_components(links.unionByName(more)), "components")

    labelled = signed.select("id", "n", "class").join(both.withColumnRenamed("node", "class"), "class", "left")
    placed = labelled.select("id", "n", F.coalesce("component", "class").alias("component"))
    smallest = placed.where("component is not null").groupBy("component").agg(F.min("id").alias("component_id"))
    # Documents without a set have no component to look up and stand for themselves.
    linked = placed.where("component is not null").join(smallest, "component").select("id", "n", "component_id")
    alone = placed.where("component is null").select("id", "n", F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        "id", F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def keep_one(docs: DataFrame, identity: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one of each near-duplicate group: its row of smallest id.

    Documents without words stay. Of rows that share the kept id, one row per text stays. A null id is smallest only in a group
    of null ids, which stays whole: its rows can't be told apart by id.
    """
    found = near_duplicates(docs, identity, text, width, percent).where("kept").select("id").distinct()
    row = docs.select(F.struct("*").alias("row"), F.col(identity).cast("long").alias("id"), text_key(F.col(text)).alias("text_key"))
    kept = row.join(found, row["id"].eqNullSafe(found["id"]), "left_semi")
    order = Window.partitionBy("id", "text_key").orderBy("text_key")
    single = kept.withColumn("copy", F.row_number().over(order)).where("copy = 1 or id is null")
    return single.select("row.*")
