"""Periodic runs of words: stretches that repeat a period at least EXPONENT times and can't be extended.

All documents of a slice are searched together, as one array of word codes in which no window crosses a document's end.

1. Periods below SMALLEST are found directly: places where a word equals the word q places on, in maximal stretches.
2. For each scale t = SMALLEST, 2 * SMALLEST, ... the string synchronising set holds the places i at which the smallest hash
   of the windows of t words at i .. i + t is the one at i or at i + t. Whether a place is in the set depends on the 2t words
   from it alone (its context), so equal stretches choose equal places. Windows inside a run of period t / 4 or less are left
   out: there all places would be chosen. Such runs are found by the smaller scales, so nothing is lost, and the set has a
   place in each t places of what remains.
3. Places with equal contexts are brought together by hash. Neighbours among them, d apart with t <= d < 2t, propose the
   period d: a run of period d has 4 * d words, which holds a chosen place and the next one with its context, and inside it
   a context recurs only every d words.
4. Each proposal is extended to both sides as far as words d apart are equal, by hashes of windows of 1, 2, 4, ... words.
   What is long enough is a run; proposals of one stretch are one run, with the smallest period. Runs are compared word by
   word before they are returned.

Hashes are 64 bits wide: a place of another context with the same hash, or a run prolonged by equal hashes of unequal words
(which the comparison would report), is not to be expected at any input size.

Defined cases: null and empty texts have no words and no runs; very long texts are searched whole; repeated rows are
documents of their own; no rows give no rows. Columns of the input are carried in one struct.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.packing import slices

EXPONENT = 4
LEAST = 6
SMALLEST = 8
SLICE_BYTES = 2 << 20
SCHEMA = "runs array<struct<start: long, length: long, period: long>>, collapsed string"
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _ODD[1]
    return (values ^ (values >> np.uint64(29))) * _ODD[2]


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mix(left * _ODD[0] + _mix(right + _ODD[2]))


class Windows:
    """Hashes of the windows of 1, 2, 4, ... words at each place; a window that leaves its document is marked by ``fits``."""

    def __init__(self, codes: np.ndarray, left: np.ndarray) -> None:
        #: Words from each place to the end of its document.
        self.left = left
        self.levels = [_mix(codes.astype(np.uint64) + _ODD[0])]

    def level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            grown = last.copy()
            if step < len(last):
                grown[:-step] = _pair(last[:-step], last[step:])
            self.levels.append(grown)
        return self.levels[k]

    def _steps(self, matches) -> None:
        """Windows twice as long while any match, then down to one word: each size is tried twice at most."""
        k = 0
        while matches(k):
            k += 1
        for smaller in range(k - 1, -1, -1):
            matches(smaller)

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i and from j > i on are equal, inside the document."""
        done, room = np.zeros_like(i), self.left[j]

        def matches(k: int) -> bool:
            at = np.flatnonzero(room - done >= 1 << k)
            if len(at):
                level = self.level(k)
                at = at[level[i[at] + done[at]] == level[j[at] + done[at]]]
                done[at] += 1 << k
            return len(at) > 0

        self._steps(matches)
        return done

    def backward(self, i: np.ndarray, j: np.ndarray, before: np.ndarray) -> np.ndarray:
        """How many words before i and before j > i are equal; ``before``: words of the document before each place."""
        done, room = np.zeros_like(i), before[i]

        def matches(k: int) -> bool:
            size = 1 << k
            at = np.flatnonzero(room - done >= size)
            if len(at):
                level = self.level(k)
                at = at[level[i[at] - done[at] - size] == level[j[at] - done[at] - size]]
                done[at] += size
            return len(at) > 0

        self._steps(matches)
        return done


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of ``values[i : i + width]`` for each i; what lies beyond the end counts as largest."""
    held, size = values, 1
    while 2 * size <= width:
        held = np.minimum(held, np.concatenate((held[size:], np.full(min(size, len(held)), np.iinfo(np.uint64).max, np.uint64))))
        size *= 2
    rest = width - size
    return np.minimum(held, np.concatenate((held[rest:], np.full(min(rest, len(held)), np.iinfo(np.uint64).max, np.uint64)))) if rest else held


def find_runs(codes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Runs of all documents as rows ``start, end, period`` of places in ``codes``; document d is edges[d] .. edges[d + 1]."""
    n, sizes = len(codes), np.diff(edges)
    ends = np.repeat(edges[1:], sizes)
    place = np.arange(n)
    left, before = ends - place, place - np.repeat(edges[:-1], sizes)
    found = [_small_periods(codes, left)]
    windows, t = Windows(codes, left), SMALLEST
    while EXPONENT * t <= int(sizes.max(initial=0)):
        found.append(_of_scale(windows, before, t, _distinct(np.concatenate(found))))
        t *= 2
    runs = _distinct(np.concatenate(found))
    lengths = runs[:, 1] - runs[:, 0] - runs[:, 2]
    inside = np.repeat(runs[:, 0] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    if not (codes[inside] == codes[inside + np.repeat(runs[:, 2], lengths)]).all():
        raise ArithmeticError("unequal words with equal hashes")
    return runs


def _distinct(runs: np.ndarray) -> np.ndarray:
    """One row for each stretch, with the smallest period, by place."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    return runs[np.concatenate(([True], (runs[1:, :2] != runs[:-1, :2]).any(axis=1)))] if len(runs) else runs


def _long_enough(runs: np.ndarray) -> np.ndarray:
    return runs[runs[:, 1] - runs[:, 0] >= np.maximum(LEAST, EXPONENT * runs[:, 2])]


def _small_periods(codes: np.ndarray, left: np.ndarray) -> np.ndarray:
    found = [np.empty((0, 3), np.int64)]
    for q in range(1, min(SMALLEST, len(codes))):
        equal = np.concatenate(([False], (codes[q:] == codes[:-q]) & (left[:-q] > q), [False]))
        change = np.flatnonzero(equal[1:] != equal[:-1])
        start, stop = change[::2], change[1::2]
        found.append(_long_enough(np.stack((start, stop + q, np.full(len(start), q)), axis=1)))
    return np.concatenate(found)


def _of_scale(windows: Windows, before: np.ndarray, t: int, known: np.ndarray) -> np.ndarray:
    """Runs of periods t .. 2t - 1 (and their multiples' stretches) from the synchronising set of scale t."""
    left, k = windows.left, t.bit_length() - 1
    n = len(left)
    # Windows inside a run of small period: differences of +1 and -1, summed.
    inside = known[(known[:, 2] <= t // 4) & (known[:, 1] - known[:, 0] >= t)]
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, inside[:, 0], 1)
    np.add.at(marks, inside[:, 1] - t + 1, -1)
    hashes = np.where((np.cumsum(marks[:-1]) > 0) | (left < t), np.iinfo(np.uint64).max, windows.level(k))
    # Only documents with room for such a run are looked at.
    fits = np.flatnonzero((left >= 2 * t) & (left + before >= EXPONENT * t))
    least = window_minimum(hashes, t + 1)[fits]
    chosen = fits[(least != np.iinfo(np.uint64).max) & ((least == hashes[fits]) | (least == hashes[fits + t]))]
    context = windows.level(k + 1)[chosen]
    order = np.argsort(context, kind="stable")
    i, j = chosen[order[:-1]], chosen[order[1:]]
    gap = j - i
    proposed = (context[order[:-1]] == context[order[1:]]) & (gap >= t) & (gap < 2 * t) & (left[i] > gap)
    i, j = i[proposed], j[proposed]
    # Proposals that the last one of the same period covers add nothing: one for each stretch and period is extended.
    gap = j - i
    by = np.lexsort((i, gap))
    i, j, gap = i[by], j[by], gap[by]
    again = np.concatenate(([False], (gap[1:] == gap[:-1]) & (i[1:] == j[:-1]))) if len(i) else np.zeros(0, bool)
    i, j = i[~again], j[~again]
    start = i - windows.backward(i, j, before)
    return _long_enough(np.stack((start, j + windows.forward(i, j), j - i), axis=1))


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and where each text's words begin and end."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, edges = pc.list_flatten(split), np.concatenate(([0], np.cumsum(pc.list_value_length(split).to_numpy())))
    # White space at a text's ends leaves empty words there.
    real = pc.greater(pc.binary_length(words), 0)
    kept = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False))))
    return words.filter(real), kept[edges]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in itertools.chain.from_iterable(slices(b, most=SLICE_BYTES) for b in batches):
        words, edges = _words(batch["text"])
        coded = words.dictionary_encode()
        runs = find_runs(coded.indices.to_numpy().astype(np.int64), edges)
        document = np.searchsorted(edges, runs[:, 0], side="right") - 1
        # Dropped: what a run holds after its first period.
        marks = np.zeros(len(words) + 1, np.int64)
        np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
        np.add.at(marks, runs[:, 1], -1)
        kept = np.cumsum(marks[:-1]) == 0
        places = np.concatenate(([0], np.cumsum(kept)))[edges]
        collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(places, pa.int32()), words.filter(pa.array(kept, pa.bool_()))), " ")
        columns = (runs[:, 0] - edges[document], runs[:, 1] - runs[:, 0], runs[:, 2])
        structs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["start", "length", "period"])
        offsets = np.searchsorted(document, np.arange(batch.num_rows + 1))
        listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)
        yield pa.RecordBatch.from_arrays([batch["row"], listed, collapsed], names=["row", "runs", "collapsed"])
        # What a slice took goes back to the system: the worker shares an executor's memory with the JVM.
        pa.default_memory_pool().release_unused()


def periodic_runs(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per document: ``row`` (the columns of ``carry``, all by default), ``runs`` by start and period, ``collapsed``.

    A run is a maximal stretch of words with smallest period q and at least ``max(LEAST, EXPONENT * q)`` words. ``collapsed``
    are the words that no run holds after its first q words, joined by one space.
    """
    read = docs.select(F.struct(*map(F.col, docs.columns if carry is None else carry)).alias("row"), F.col(text).alias("text"))
    return read.mapInArrow(_runs, f"row {read.schema['row'].dataType.simpleString()}, {SCHEMA}")


def with_stuttered_words(docs: DataFrame, identity: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text`` with planted repetitions: of every tenth document, by the checksum of its id, a tail repeats a period.

    With h the checksum and g = floor(h / 10), each word i >= a becomes word ``a + (i - a) % p`` where ``a = g % n`` and
    ``p = 1 + floor((n - a) / (3 + g % 8))``. Null ids have no checksum: their documents stay as they are.
    """
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(F.col(identity).cast("string"))
    g, n = F.floor(F.col("h") / 10), F.size("words")
    planted = F.array_join(
        F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.element_at("words", (F.col("a") + (i - F.col("a")) % F.col("p") + 1).cast("int")))), " "
    )
    chosen = F.coalesce(F.col("h") % 10 == 0, F.lit(False))
    # Only chosen documents are cut into words here.
    read = docs.select(F.col(identity).alias("doc_id"), F.col(text).alias("text"), h.alias("h")).withColumn("words", F.when(chosen, words))
    placed = read.withColumn("a", F.when(n > 0, g % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    return placed.select("doc_id", F.when(chosen & (n > 0), planted).otherwise(F.col("text")).alias("text"))
