"""Best-fit packing of tokenised documents by linear grouping.

Documents are tokenised and closed with an end token; longer ones than a sequence are cut into full pieces from their end,
so only the first piece may be shorter. Full pieces fill a sequence each. The others are packed by their lengths alone: the
plan is made from the counts of the at most ``capacity`` lengths, a table whose size does not depend on the data.

1. Lengths above ``capacity / SMALL`` are large. Sorted from the longest, they are cut into GROUPS groups of equal count, and
   every length of a group is rounded up to its longest.
2. Few sizes are left, and a sequence holds fewer than SMALL of them. Configurations (sets of sizes that fit) are generated
   greedily for the counts still open: each is the fullest one for the largest size open, and is used as often as the counts
   allow.
3. Actual pieces take the places of their rounded sizes, longest piece to longest place of its group: they are never longer.
4. Small lengths go, longest first, to the sequences with the least room that still holds them, then to new ones.

Sequences of one make-up are handled as a class with a count, so the plan is a list of (class, first number, count) rows.
Pieces get their places by rank: pieces of a length are numbered by hash buckets, and number and length say class, sequence
and offset.

Defined cases: null text is empty and becomes the end token alone; repeated rows and ids are documents of their own; no rows
give no rows. Columns of the input are carried in one struct.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import os
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinloom.llm.shared import store

CAPACITY = 2048
GROUPS = 4096
SMALL = 16
# Some 30 bytes each, once per Python worker.
CACHED_WORDS = 500_000
LONGEST_CACHED = 64
# Words of one text that is tokenised for them all.
JOINED = 8192
# Bytes of text tokenised at once (a single text may be longer).
SLICE_BYTES = 4 << 20
_WHITE = r"\pZ\x09-\x0D\x1C-\x1F\x{85}"
# Stands between the units of a text while it is cut; a text that holds it is tokenised whole, like one with white space before a space.
_CUT = "\x00"
_WHOLE = rf"[{_WHITE}] |\x00"
_SPACED = rf"(?:^|[{_WHITE}])$"
# A new line that ends a word, and one in a run of white space.
_LINE, _INSIDE = rf"([^{_WHITE}])\n", rf"[{_WHITE}]\n"
# Marks that end a word of Latin letters or digits.
_MARK = r"([0-9A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}])([.,;:!?#$%&*])"


class Tokens:
    """Token ids of texts by a byte-level BPE file.

    The vocabulary's pattern starts a new piece at every space and new line that follows another character than white space,
    and at a mark after a letter or digit. So texts are cut there and each distinct unit (a word with the space or new line
    before it, or marks) is tokenised once; texts with white space before a space are tokenised whole. New units are tokenised
    as one text: the ids of a unit begin where a token begins with that space or new line.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_file(path)
        self.plain = self.model.normalizer is None and isinstance(self.model.pre_tokenizer, pre_tokenizers.ByteLevel)
        vocabulary = self.model.get_vocab()
        self.opens, self.opens_line = (np.zeros(max(vocabulary.values(), default=0) + 1, bool) for _ in range(2))
        for opens, mark in ((self.opens, "\u0120"), (self.opens_line, "\u010a")):
            opens[[number for token, number in vocabulary.items() if token.startswith(mark)]] = True
        # Units met before, how many ids each has, and these ids one after the other.
        self.words, self.sizes, self.ids = pa.array([], pa.string()), np.empty(0, np.int64), np.empty(0, np.uint32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each text has, and all ids one after the other."""
        found = [np.array(e.ids, np.uint32) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([len(f) for f in found], np.int64), np.concatenate([np.empty(0, np.uint32), *found])

    def encode_joined(self, units: pa.Array, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Like ``encode`` of units that each begin with the one space, or the one new line, they hold, and don't end in white space."""
        edges = [*range(0, len(units), JOINED), len(units)]
        sizes, ids = [np.empty(0, np.int64)], [np.empty(0, np.uint32)]
        for text, (start, stop) in zip(pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), units), ""), itertools.pairwise(edges)):
            _, found = self.encode([text.as_py()])
            begins = np.flatnonzero(opens[found])
            if len(begins) == stop - start and begins[0] == 0:
                counts = np.diff(begins, append=len(found))
            else:
                counts, found = self.encode(units[start:stop].to_pylist())
            sizes.append(counts)
            ids.append(found)
        return np.concatenate(sizes), np.concatenate(ids)

    def places(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each unit stands in a table of distinct units, and the table's sizes and ids."""
        met = len(self.words)
        coded = pa.concat_arrays([self.words, units.cast(pa.string())]).dictionary_encode()
        fresh = coded.dictionary[met:]

        def these(test: pa.Array) -> np.ndarray:
            return test.to_numpy(zero_copy_only=False)

        together = ~these(pc.match_substring_regex(fresh, _SPACED)) & self.plain
        spaced = together & these(pc.starts_with(fresh, " "))
        lines = together & these(pc.starts_with(fresh, "\n")) & (these(pc.count_substring(fresh, "\n")) == 1)
        spaced, lines, alone = (np.flatnonzero(m) for m in (spaced, lines, ~(spaced | lines)))
        parts = (
            (self.sizes, self.ids),
            self.encode_joined(fresh.take(pa.array(spaced)), self.opens),
            self.encode_joined(fresh.take(pa.array(lines)), self.opens_line),
            self.encode(fresh.take(pa.array(alone)).to_pylist()),
        )
        sizes, ids = (np.concatenate(column) for column in zip(*parts))
        order = np.concatenate((spaced, lines, alone))
        at = np.arange(len(coded.dictionary))
        at[met + order] = np.arange(met, len(at))
        places = at[coded.indices.to_numpy()[met:]]
        self._keep(pa.concat_arrays([self.words, fresh.take(pa.array(order))]), sizes, ids, places)
        return places, sizes, ids

    def _keep(self, words: pa.Array, sizes: np.ndarray, ids: np.ndarray, used: np.ndarray) -> None:
        """Short units stay for later slices: all, or those of the last slice once they are too many."""
        short = pc.less_equal(pc.utf8_length(words), LONGEST_CACHED).to_numpy(zero_copy_only=False)
        if len(words) > CACHED_WORDS:
            last = np.zeros(len(words), bool)
            last[used] = True
            short &= last
        self.words, self.sizes, self.ids = words.filter(pa.array(short)), sizes[short], ids[np.repeat(short, sizes)]

    def cut(self, texts: pa.Array) -> pa.ListArray:
        """The units of texts that need not be tokenised whole."""
        marked = pc.replace_substring(texts, " ", f"{_CUT} ")
        if self.plain:
            inside = pc.match_substring_regex(texts, _INSIDE)
            lines = pc.replace_substring(pc.if_else(inside, "", marked), "\n", f"{_CUT}\n")
            if pc.any(inside).as_py():
                lines = pc.if_else(inside, pc.replace_substring_regex(pc.if_else(inside, marked, ""), _LINE, f"\\1{_CUT}\n"), lines)
            marked = pc.replace_substring_regex(lines, _MARK, f"\\1{_CUT}\\2")
        return pc.split_pattern(marked, _CUT)

    def of(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text as unsigned 32-bit integers; none for null."""
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring_regex(texts, _WHOLE)
        split = self.cut(pc.if_else(whole, "", texts))
        edges = np.concatenate(([0], np.cumsum(pc.list_value_length(split).to_numpy())))
        codes, sizes, ids = self.places(pc.list_flatten(split))
        starts = np.cumsum(sizes) - sizes
        counts = sizes[codes]
        ends = np.concatenate(([0], np.cumsum(counts)))
        flat = ids[np.repeat(starts[codes] - ends[:-1], counts) + np.arange(ends[-1])]
        for i, alone in enumerate(whole.to_pylist()):
            yield self.encode([texts[i].as_py()])[1] if alone else flat[ends[edges[i]] : ends[edges[i + 1]]]


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have at most ``most`` bytes, or of a single row."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


@functools.cache
def tokens_of(path: str) -> Tokens:
    """One for all tasks of a Python worker, so that words known from earlier tasks are not tokenised again."""
    return Tokens(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


PIECE = "piece int, start long, length int, ids_crc32 long"


def _cut(path: str, capacity: int, end_token: int, with_ids: bool):
    end = np.array([end_token], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(path)
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            at, columns = [], [[] for _ in range(4 + with_ids)]
            for i, found in enumerate(tokens.of(batch["text"])):
                ids = found.astype("<u4", copy=False).tobytes() + end
                n = len(ids) // 4
                edges = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for piece, (start, stop) in enumerate(itertools.pairwise(edges)):
                    part = ids[4 * start : 4 * stop]
                    at.append(i)
                    for column, value in zip(columns, (piece, start, stop - start, zlib.crc32(part), part)):
                        column.append(value)
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            names = ["row", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids]
            arrays = [batch["row"].take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
            # What a slice took goes back to the system: the worker shares an executor's memory with the JVM.
            pa.default_memory_pool().release_unused()

    return run


def pieces(docs: DataFrame, text: str, carry: list[str], capacity: int, path: str | None, end_token: int, with_ids: bool) -> DataFrame:
    """``row, piece, start, length, ids_crc32`` (and ``ids``: little-endian unsigned 32-bit) of every piece."""
    read = docs.select(F.struct(*map(F.col, carry)).alias("row"), F.col(text).alias("text"))
    kind = read.schema["row"].dataType.simpleString()
    schema = f"row {kind}, {PIECE}" + (", ids binary" if with_ids else "")
    return read.mapInArrow(_cut(path or default_vocabulary(), capacity, end_token, with_ids), schema)


def plan_classes(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[tuple[int, ...], int]]:
    """How to pack ``counts`` pieces of each length: classes ``(lengths in order, number of such sequences)``.

    Works on counts only; its effort depends on the capacity, not on how many pieces there are.
    """
    large = sorted((n for n in counts if n * SMALL > capacity and counts[n]), reverse=True)
    total = sum(counts[n] for n in large)
    share = -(-total // groups) if total else 1
    # Groups of equal count, longest first: for each rounded size, the actual lengths it stands for.
    members: dict[int, list[list[int]]] = defaultdict(list)
    size, room = 0, 0
    for length in large:
        left = counts[length]
        while left:
            if not room:
                size, room = length, share
            took = min(left, room)
            members[size].append([length, took])
            left, room = left - took, room - took
    open_ = {size: sum(c for _, c in listed) for size, listed in members.items()}
    sequences: dict[tuple[int, ...], int] = defaultdict(int)
    while open_:
        sizes = sorted(open_, reverse=True)
        config = _fullest(sizes, open_, capacity)
        need = {s: config.count(s) for s in set(config)}
        times = min(open_[s] // k for s, k in need.items())
        for s, k in need.items():
            open_[s] -= k * times
            if not open_[s]:
                del open_[s]
        # Actual lengths, longest first, in runs of equal sequences.
        while times:
            heads = {s: [] for s in need}
            run = times
            for s, k in need.items():
                run = min(run, max(1, members[s][0][1] // k))
            for s, k in need.items():
                for _ in range(k):
                    heads[s].append(_draw(members[s], run))
            # A draw may end a length: the run is then what all draws have in common.
            actual = [length for s in config for length in [heads[s].pop(0)]]
            sequences[tuple(sorted(actual, reverse=True))] += run
            times -= run
    return _add_small(sequences, {n: counts[n] for n in counts if counts[n] and n * SMALL <= capacity}, capacity)


def _draw(listed: list[list[int]], run: int) -> int:
    """Takes ``run`` pieces of one length from a group; the longest that has as many, else single ones are asked for."""
    for i, (length, left) in enumerate(listed):
        if left >= run:
            if left == run:
                listed.pop(i)
            else:
                listed[i][1] -= run
            return length
    raise AssertionError("a run is never longer than the count of a length")


def _fullest(sizes: list[int], open_: dict[int, int], capacity: int) -> list[int]:
    """The set of open sizes with the largest one whose sum is closest to the capacity: reachable sums, size by size."""
    first = sizes[0]
    target = capacity - first
    reached: dict[int, tuple[int, int, int]] = {0: (0, 0, 0)}  # sum -> (size, times, sum before)
    for size in sizes:
        most = min(open_[size] - (size == first), target // size)
        if most <= 0:
            continue
        for base in list(reached):
            for k in range(1, most + 1):
                total = base + k * size
                if total > target:
                    break
                if total not in reached:
                    reached[total] = (size, k, base)
        if target in reached:
            break
    at, config = max(reached), [first]
    while at:
        size, k, at = reached[at]
        config += [size] * k
    return config


def _add_small(sequences: dict[tuple[int, ...], int], small: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit of the small lengths, longest first, a class of sequences at a time."""
    by_room: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    for lengths, n in sequences.items():
        by_room[capacity - sum(lengths)][lengths] = n
    rooms = sorted(by_room)

    def put(lengths: tuple[int, ...], n: int) -> None:
        room = capacity - sum(lengths)
        if room not in by_room or not by_room[room]:
            by_room[room] = {}
            if room not in rooms:
                bisect.insort(rooms, room)
        by_room[room][lengths] = by_room[room].get(lengths, 0) + n

    for length in sorted(small, reverse=True):
        left = small[length]
        while left:
            i = bisect.bisect_left(rooms, length)
            if i == len(rooms):
                fit = capacity // length
                full, rest = divmod(left, fit)
                if full:
                    put((length,) * fit, full)
                if rest:
                    put((length,) * rest, 1)
                left = 0
                continue
            room = rooms[i]
            lengths, n = next(iter(by_room[room].items()))
            k = min(room // length, left)
            took = min(n, left // k)
            if took == n:
                del by_room[room][lengths]
            else:
                by_room[room][lengths] = n - took
            if not by_room[room]:
                del by_room[room]
                rooms.pop(i)
            put(lengths + (length,) * k, took)
            left -= took * k
    return [(lengths, n) for room in sorted(by_room) for lengths, n in sorted(by_room[room].items())]


def _places(spark: SparkSession, classes: list[tuple[tuple[int, ...], int]], first: int) -> DataFrame:
    """``length, rank_from, rank_to, sequence_from, offset``: ranks of a length are dealt to the classes that use it."""
    rows, used, sequence = [], defaultdict(int), first
    for lengths, n in classes:
        offset = 0
        for length in lengths:
            rows.append((length, used[length], used[length] + n, sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    return spark.createDataFrame(rows, "length int, rank_from long, rank_to long, sequence_from long, offset long")


def pack(
    docs: DataFrame,
    identity: str = "doc_id",
    text: str = "text",
    carry: list[str] | None = None,
    capacity: int = CAPACITY,
    path: str | None = None,
    end_token: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``row`` (the columns of ``carry``), ``piece, start, length, ids_crc32, sequence_id, offset``."""
    spark = docs.sparkSession
    cut = store(pieces(docs, text, [identity] if carry is None else carry, capacity, path, end_token, with_ids), "pieces")
    keyed = cut.withColumn("bucket", F.pmod(F.xxhash64("row", "piece", "ids_crc32"), F.lit(1024)).cast("int"))
    buckets = store(keyed.groupBy("length", "bucket").agg(F.count("*").alias("pieces")), "buckets")
    counts = {r["length"]: r["n"] for r in buckets.groupBy("length").agg(F.sum("pieces").alias("n")).collect()}  # at most ``capacity`` rows
    full = counts.pop(capacity, 0)
    places = _places(spark, plan_classes(counts, capacity), full)
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("length", "bucket", F.coalesce(F.sum("pieces").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("row", "piece", "start", "ids_crc32")
    numbered = keyed.withColumn("nth", F.row_number().over(within) - 1).join(offsets, ["length", "bucket"])
    ranked = numbered.withColumn("rank", F.col("before") + F.col("nth")).drop("bucket", "nth", "before")
    alone = ranked.where(F.col("length") == capacity).withColumn("sequence_id", F.col("rank")).withColumn("offset", F.lit(0).cast("long"))
    # The plan: at most ``capacity`` lengths and one row per length and class, however many pieces there are.
    p = F.broadcast(places.withColumnRenamed("length", "of"))
    inside = (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    shared = ranked.where(F.col("length") < capacity).join(p, inside)
    shared = shared.withColumn("sequence_id", F.col("sequence_from") + F.col("rank") - F.col("rank_from"))
    names = ["row", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []), "sequence_id", "offset"]
    return alone.select(*names).unionByName(shared.select(*names))
