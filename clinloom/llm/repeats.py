"""Removal of repeated byte strings by column-wise construction of collection Burrows-Wheeler transforms.

A byte is removed when a string of ``length`` bytes that covers it also starts anywhere else. One transform over a whole
corpus would take as many rounds as the longest document has bytes, each over everything, so the corpus is dealt into small
collections first, and equal strings always meet in one of them:

1. A window of ``length`` bytes is anchored at the leftmost of the smallest hashes of its 64-byte strings. Windows with one anchor
   position form a piece (below 2 * length bytes). Equal windows have equal anchors, and anchors found once can't repeat.
2. Pieces of anchors found once are left out. Equal pieces of one anchor are counted, not compared: all windows of a piece found twice repeat. One of each is kept.
3. Where an anchor has several different pieces, they are cut into blocks of BLOCK windows that are aligned at the anchor.
   The ``length - BLOCK + 1`` bytes that all windows of a block share are its core; blocks meet only if their cores are
   equal, so the core enters the transform as one symbol. A block is thus a short string: left bytes, core, right bytes.
4. A group of more than ``most_blocks`` different blocks is halved: both halves have larger cores, and what is equal in a
   half is counted instead of compared. At one window a block is its core, so no group stays large.
5. The blocks of a collection are inserted column-wise: each round inserts one symbol of every string, last symbol first,
   and updates the transform, the common prefixes and the owners of the suffixes, which are kept in files that a round reads
   and writes in order. Neighbours with a common prefix of ``length`` bytes are repeated windows.

Defined cases: null is empty; documents shorter than ``length`` keep everything unless they are part of nothing longer;
repeated rows and repeated ids are documents of their own; an empty table gives no rows. Other columns are carried in one
struct and clash with nothing.
"""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.llm.minhash import mixed
from clinloom.llm.shared import WORDS, Scratch, store, text_key

BLOCK = 32
CODE = 8
WORD_BYTES = re.compile(WORDS.encode())
MOST_BLOCKS = 4096
COLLECTION = 2048
CHUNK_BYTES = 4 << 20
# The same for every chunk, so that equal windows rank their hashes alike.
PLACE_BITS = np.uint64(23)

_ODD = np.uint64(0x9E3779B97F4A7C15)


def anchor_bytes(length: int) -> int:
    """8 times a power of two, about a sixth of the window: long enough that unrelated texts rarely share an anchor."""
    return 8 << max(0, (length // 48).bit_length() - 1)


def _anchor_hashes(data: np.ndarray, anchor: int) -> np.ndarray:
    """A 64-bit hash of the ``anchor`` bytes that start at each place: a polynomial of their 8-byte words."""
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    hashes, step, factor = np.ascontiguousarray(words).view("<u8").ravel(), 8, int(_ODD)
    while step < anchor:
        hashes = hashes[: len(hashes) - step] * np.uint64(factor) + hashes[step:]
        step, factor = 2 * step, factor * factor % 2**64
    return mixed(hashes)


def _leftmost_smallest(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes, the place of the leftmost smallest one."""
    n = len(hashes)
    ranked = ((hashes >> PLACE_BITS) << PLACE_BITS) | np.arange(n, dtype=np.uint64)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = ranked
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    lowest = np.minimum(behind[: n - width + 1], ahead[width - 1 : n])
    return (lowest & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)


def pieces_of(data: bytes, length: int) -> Iterator[tuple[int, int, int, int]]:
    """``first window, windows, anchor place, anchor hash`` of each piece of a text, chunk by chunk."""
    windows, anchor = len(data) - length + 1, anchor_bytes(length)
    whole, step = np.frombuffer(data, np.uint8), CHUNK_BYTES
    open_piece = None
    for at in range(0, windows, step):
        part = whole[at : min(at + step, windows) + length - 1]
        hashes = _anchor_hashes(part, anchor)
        anchors = _leftmost_smallest(hashes, length - anchor + 1)
        cuts = np.flatnonzero(np.diff(anchors)) + 1
        starts = np.concatenate(([0], cuts))
        ends = np.concatenate((cuts, [len(anchors)]))
        for s, e, a in zip(starts.tolist(), ends.tolist(), anchors[starts].tolist()):
            piece = (at + s, e - s, at + a, int(hashes[a]))
            if open_piece and open_piece[2] == piece[2]:  # goes on over the edge of a chunk
                open_piece = (open_piece[0], open_piece[1] + piece[1], *open_piece[2:])
                continue
            if open_piece:
                yield open_piece
            open_piece = piece
    if open_piece:
        yield open_piece


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


PIECES = "text_key binary, first int, windows int, place int, anchor long, content long"
PIECES_ARROW = pa.schema([("text_key", pa.binary()), ("first", pa.int32()), ("windows", pa.int32()), ("place", pa.int32()), ("anchor", pa.int64()), ("content", pa.int64())])


def _emit(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _cut_pieces(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch["text_key"], batch["text"]):
                data, name = text.as_py().encode(), key.as_py()
                for first, windows, place, anchor in pieces_of(data, length):
                    digest = hashlib.blake2b(data[first : first + windows + length - 1], digest_size=8).digest()
                    rows.append((name, first, windows, place - first, _signed(anchor), int.from_bytes(digest, "little", signed=True)))
                if len(rows) > 20_000:
                    yield _emit(rows, PIECES_ARROW)
                    rows = []
            yield _emit(rows, PIECES_ARROW)

    return run


BLOCKS = "piece binary, first int, span int, core binary, left binary, right binary"
BLOCKS_ARROW = pa.schema(
    [("piece", pa.binary()), ("first", pa.int32()), ("span", pa.int32()), ("core", pa.binary()), ("left", pa.binary()), ("right", pa.binary())]
)


def blocks_of(part: bytes, windows: int, place: int, length: int) -> Iterator[tuple[int, int, bytes, bytes, bytes]]:
    """``first window, span, core digest, left bytes, right bytes`` of each block of a piece.

    A block has ``span`` places for windows, counted from the anchor; the piece may lack some at either end. The core are
    the bytes that windows at all these places share; left and right of it is what the piece's own windows have beyond.
    """
    start = (place - length) % BLOCK - BLOCK
    while start < windows:
        low, high, last = max(start, 0), min(start + BLOCK, windows) - 1, start + BLOCK - 1
        if low <= high:
            core = hashlib.blake2b(part[last : start + length], digest_size=16).digest()
            yield low, BLOCK, core, part[low:last], part[start + length : high + length]
        start += BLOCK


def halves_of(first: int, span: int, core: bytes, left: bytes, right: bytes) -> Iterator[tuple[int, int, bytes, bytes, bytes]]:
    """A block as two blocks of half its span, whose cores are larger by the bytes that the other half doesn't share."""
    half = span // 2
    # The last place of the earlier half is ``half`` bytes left of the core; the later half ends as far to the right of it.
    if len(left) >= half:
        cut = len(left) - half
        core_a = hashlib.blake2b(b"<" + left[cut:] + core, digest_size=16).digest()
        yield first, half, core_a, left[:cut], right[: half - 1]
    if len(right) >= half:
        core_b = hashlib.blake2b(b">" + core + right[:half], digest_size=16).digest()
        skipped = max(0, len(left) - (half - 1))
        yield first + skipped, half, core_b, left[skipped:], right[half:]


def _cut_blocks(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, listed in zip(batch["text"], batch["pieces"]):
                data = text.as_py().encode()
                for p in listed.as_py():
                    part = data[p["first"] : p["first"] + p["windows"] + length - 1]
                    rows += [(p["content"], *block) for block in blocks_of(part, p["windows"], p["place"], length)]
                if len(rows) > 20_000:
                    yield _emit(rows, BLOCKS_ARROW)
                    rows = []
            yield _emit(rows, BLOCKS_ARROW)

    return run


def _halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = ("piece", "first", "span", "core", "left", "right")
        yield _emit([(r[0], *half) for r in zip(*(batch[n].to_pylist() for n in names)) for half in halves_of(*r[1:])], BLOCKS_ARROW)


class Column:
    """A column of the growing transform as a file: a round reads it in order and writes its successor."""

    def __init__(self, folder: str, name: str, kind: type) -> None:
        self.paths, self.kind, self.size = (f"{folder}/{name}.0", f"{folder}/{name}.1"), kind, 0

    def read(self) -> np.ndarray:
        return np.fromfile(self.paths[0], self.kind, self.size)

    def write(self, values: np.ndarray) -> None:
        # Written over what is there: cutting a file to nothing first makes some file systems flush it to disk.
        with open(os.open(self.paths[1], os.O_WRONLY | os.O_CREAT), "wb") as file:
            file.write(np.ascontiguousarray(values, self.kind).data)
        self.paths, self.size = self.paths[::-1], len(values)


def repeated_windows(strings: list[tuple[int, int, bytes, bytes]], length: int, folder: str) -> np.ndarray:
    """For strings ``(group, span, left, right)``, a bit per window that is equal to a window of another string.

    Symbols: 0 ends a string, 1..256 are bytes, 257 + group is the core of a group. The string is left, core, right.
    """
    n = len(strings)
    widths = np.array([length - span + 1 for _, span, _, _ in strings], np.int32)
    groups = np.array([group for group, *_ in strings], np.int64)
    symbols = [
        np.concatenate((np.frombuffer(left, np.uint8) + np.uint16(1), [np.uint16(257 + group)], np.frombuffer(right, np.uint8) + np.uint16(1))).astype(np.uint16)
        for group, _, left, right in strings
    ]
    sizes = np.array([len(s) for s in symbols])
    ends = np.cumsum(sizes)
    flat = np.concatenate(symbols)
    width_of = np.ones(257 + int(groups.max()) + 1, np.int32)
    width_of[257 + groups] = widths

    transform, prefixes, owners = Column(folder, "bwt", np.uint16), Column(folder, "lcp", np.int32), Column(folder, "owner", np.int64)
    transform.write(flat[ends - 1])
    prefixes.write(np.zeros(n, np.int32))
    owners.write(np.arange(n, dtype=np.int64) << 8)
    at, active = np.arange(n), np.arange(n)
    for size in range(1, int(sizes.max()) + 1):
        at, active = at[sizes[active] >= size], active[sizes[active] >= size]
        bwt, lcp = transform.read(), prefixes.read()
        order = np.argsort(bwt, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        placed = rank[at] - np.count_nonzero(bwt == 0)
        new, mine = placed + n, bwt[at]
        before, after = order[np.maximum(rank[at] - 1, 0)], order[np.minimum(rank[at] + 1, len(order) - 1)]
        has_before, has_after = (before < at) & (bwt[before] == mine), (after > at) & (bwt[after] == mine)

        grown = len(bwt) + len(at)
        added = np.zeros(grown, bool)
        added[new] = True

        def spliced(old: np.ndarray, values: np.ndarray) -> np.ndarray:
            out = np.empty(grown, old.dtype)
            out[~added] = old
            out[new] = values
            return out

        down = np.where(has_before, width_of[mine] + _range_minima(lcp, before, at, has_before), 0)
        up = np.where(has_after, width_of[mine] + _range_minima(lcp, at, after, has_after), 0)
        longer = spliced(lcp, down.astype(lcp.dtype))
        follows = new + 1 < grown
        longer[new[follows] + 1] = up[follows]
        prefixes.write(longer)
        place = ends[active] - size - 1
        transform.write(spliced(bwt, np.where(sizes[active] > size, flat[np.maximum(place, 0)], 0).astype(np.uint16)))
        owners.write(spliced(owners.read(), (active.astype(np.int64) << 8) | size))
        at = new

    lcp, owner = prefixes.read(), owners.read()
    repeats = lcp >= length
    repeats[:-1] |= repeats[1:].copy()
    found = owner[repeats]
    masks = np.zeros(n, np.int64)
    string = found >> 8
    np.bitwise_or.at(masks, string, np.int64(1) << (sizes[string] - (found & 255)))
    return masks


def _range_minima(values: np.ndarray, start: np.ndarray, stop: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Smallest of ``values[start + 1 .. stop]`` where ``wanted``, else 0."""
    out = np.zeros(len(start), np.int64)
    if not wanted.any():
        return out
    chosen = np.flatnonzero(wanted)
    chosen = chosen[np.argsort(start[chosen], kind="stable")]
    edges = np.stack((start[chosen] + 1, stop[chosen] + 1), axis=1).ravel()
    out[chosen] = np.minimum.reduceat(np.append(values, 0), edges)[::2]
    return out


MASKS = "core binary, span int, left binary, right binary, mask long"
MASKS_ARROW = pa.schema([("core", pa.binary()), ("span", pa.int32()), ("left", pa.binary()), ("right", pa.binary()), ("mask", pa.int64())])


def _compare(length: int):
    """Distinct blocks, sorted by core and span -> their masks. Groups are whole; collections hold whole groups."""

    def finish(rows: list[tuple], folder: str) -> Iterator[pa.RecordBatch]:
        number: dict[tuple, int] = {}
        for core, span, *_ in rows:
            number[core, span] = number.get((core, span), 0) + 1
        several = [r for r in rows if number[r[0], r[1]] > 1]
        names = {key: i for i, key in enumerate(k for k, v in number.items() if v > 1)}
        masks = repeated_windows([(names[r[0], r[1]], *r[1:4]) for r in several], length, folder).tolist() if several else []
        found = dict(zip((r[:4] for r in several), masks))
        yield _emit([(*r, mask) for r, mask in found.items() if mask], MASKS_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:
            rows: list[tuple] = []
            for batch in batches:
                for row in zip(*(batch[c].to_pylist() for c in ("core", "span", "left", "right"))):
                    if len(rows) >= COLLECTION and row[:2] != rows[-1][:2]:
                        yield from finish(rows, folder)
                        rows = []
                    rows.append(row)
            if rows:
                yield from finish(rows, folder)

    return run


def _block_masks(blocks: DataFrame, length: int, most_blocks: int, scratch: Scratch) -> DataFrame:
    """``piece, first, mask``: the repeated windows of each block; groups with too many different blocks are halved first."""
    done, rest = None, scratch.store(blocks, "blocks")
    while True:
        strings = scratch.store(rest.groupBy("core", "span", "left", "right").agg(F.count("*").alias("blocks")), "strings")
        groups = scratch.store(strings.groupBy("core", "span").agg(F.count("*").alias("different")).where("different > 1"), "groups")
        large = groups.where((F.col("different") > most_blocks) & (F.col("span") > 1)).select("core", "span")
        split = bool(large.head(1))
        # Shuffled by core, so that a group is in one task and sorted: it has at most ``most_blocks`` strings.
        several = strings.join(groups.where((F.col("different") <= most_blocks) | (F.col("span") == 1)).select("core", "span"), ["core", "span"])
        compared = several.repartition("core").sortWithinPartitions("core", "span").mapInArrow(_compare(length), MASKS)
        windows = F.octet_length("left") + F.octet_length("right") - F.col("span") + 2
        every = F.expr("shiftleft(1L, windows) - 1").alias("mask")
        alike = strings.where("blocks > 1").withColumn("windows", windows).select("core", "span", "left", "right", every)
        masks = alike.unionByName(compared)
        found = rest.join(masks, ["core", "span", "left", "right"]).select("piece", "first", "mask")
        found = scratch.store(found, "masks")
        done = found if done is None else done.unionByName(found)
        if not split:
            return done
        rest = scratch.store(rest.join(large, ["core", "span"], "left_semi").select(*rest.columns).mapInArrow(_halve, BLOCKS), "blocks")


def repeated_spans(docs: DataFrame, text: str = "text", length: int = 400, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """``text_key, runs``: for each text with repeated strings, runs of windows as ``first, mask or windows``.

    The runs are stored; what they were made from is deleted.
    """
    if length <= BLOCK:
        raise ValueError(f"length must be above {BLOCK}")
    scratch = Scratch(docs.sparkSession)
    keyed = docs.where(F.octet_length(F.col(text)) >= length).select(text_key(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    pieces = scratch.store(keyed.mapInArrow(_cut_pieces(length), PIECES), "pieces")
    # Most anchors are found once: their pieces end here, after one aggregation of two numbers a piece.
    anchors = pieces.groupBy("anchor").agg(F.count("*").alias("pieces"), F.min("content").alias("low"), F.max("content").alias("high"))
    met = anchors.where("pieces > 1").select("anchor", (F.col("low") < F.col("high")).alias("several"))
    found = scratch.store(pieces.join(met, "anchor"), "found")
    one = F.min(F.struct("text_key", "first", "windows", "place")).alias("one")
    counted = found.groupBy("anchor", "content").agg(F.count("*").alias("found"), F.first("several").alias("several"), one)
    piece = F.unhex(F.format_string("%016x%016x", "anchor", "content")).alias("piece")
    contents = scratch.store(counted.select("*", piece), "contents")
    cut = F.struct(F.col("piece").alias("content"), "one.first", "one.windows", "one.place")
    listed = contents.where("several").groupBy(F.col("one.text_key").alias("text_key")).agg(F.collect_list(cut).alias("pieces"))
    read = keyed.join(listed, "text_key").dropDuplicates(["text_key"]).select("text", "pieces")
    masks = _block_masks(read.mapInArrow(_cut_blocks(length), BLOCKS), length, most_blocks, scratch)
    # A content found several times repeats as a whole; of one found once, the windows that the blocks show.
    inside = masks.withColumnRenamed("first", "shift")
    once = contents.where("found = 1").select("piece", "one.text_key", "one.first")
    single = once.join(inside, "piece").select("text_key", (F.col("first") + F.col("shift")).alias("first"), F.lit(0).alias("windows"), "mask")
    again = contents.where("found > 1").select("anchor", "content")
    whole = found.join(again, ["anchor", "content"]).select("text_key", "first", "windows", F.lit(0).cast("long").alias("mask"))
    runs = whole.unionByName(single).distinct()
    stored = store(runs.groupBy("text_key").agg(F.collect_list(F.struct("first", "windows", "mask")).alias("runs")), "runs")
    scratch.clear()
    return stored


def removed_bytes(size: int, runs: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Maximal spans ``start, end`` of the bytes that the windows of the runs cover."""
    starts = np.zeros(size + 1, np.int64)
    for run in runs or []:
        at = run["first"]
        if run["windows"]:
            starts[at] += 1
            starts[at + run["windows"] - 1 + length] -= 1
        mask, k = run["mask"], 0
        while mask:
            if mask & 1:
                starts[at + k] += 1
                starts[at + k + length] -= 1
            mask, k = mask >> 1, k + 1
    covered = np.concatenate(([False], np.cumsum(starts[:-1]) > 0, [False]))
    edges = np.flatnonzero(np.diff(covered.astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


CLEANED_ARROW = pa.schema(
    [("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary()), ("clean", pa.string())]
)


def _without(data: bytes, spans: list[tuple[int, int]], known: bool) -> tuple:
    """A row of CLEANED_ARROW: what stays of a text without its spans."""
    parts, last = [], 0
    for start, end in spans:
        parts.append(data[last:start])
        last = end
    kept = b"".join(parts) + data[last:]
    return len(data), [{"start": s, "end": e} for s, e in spans], kept, kept.decode("utf-8", "ignore") if known else None


def _cleaned(row: pa.Array, out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out)) if out else [[]] * len(CLEANED_ARROW)
    return pa.RecordBatch.from_arrays([row, *(pa.array(c, f.type) for c, f in zip(columns, CLEANED_ARROW))], names=["row", *CLEANED_ARROW.names])


def _clean(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, runs in zip(batch["text"], batch["runs"]):
                data = (text.as_py() or "").encode()
                out.append(_without(data, removed_bytes(len(data), runs.as_py(), length) if runs.is_valid else [], text.is_valid))
            yield _cleaned(batch["row"], out)

    return run


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans without overlaps."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _clean_passages(length: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, runs, word_runs in zip(batch["text"], batch["runs"], batch["word_runs"]):
                data = (text.as_py() or "").encode()
                spans = removed_bytes(len(data), runs.as_py(), length) if runs.is_valid else []
                if word_runs.is_valid:
                    places = [m.span() for m in WORD_BYTES.finditer(data)]
                    for start, end in removed_bytes(CODE * len(places), word_runs.as_py(), CODE * words):
                        first, after = -(-start // CODE), end // CODE
                        if first < after:
                            spans.append((places[first][0], places[after][0] if after < len(places) else places[after - 1][1]))
                out.append(_without(data, _joined(spans), text.is_valid))
            yield _cleaned(batch["row"], out)

    return run


def word_codes(text: Column) -> Column:
    """A text as one string of CODE characters (48 bits of a hash) for each word."""
    code = lambda w: F.left(F.base64(F.unhex(F.lpad(F.hex(F.xxhash64(w)), 16, "0"))), F.lit(CODE))
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(WORDS), F.lit(0)), code), "")


def without_repeated_passages(docs: DataFrame, text: str = "text", length: int = 400, words: int = 51, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """Like ``without_repeats``, and also without passages of ``words`` words that occur more than once, however short they are.

    Words are compared by hash codes of equal length, so that passages are strings of ``CODE * words`` bytes; what stands
    between words doesn't count. A removed passage takes the space up to the next word with it.
    """
    runs = repeated_spans(docs, text, length, most_blocks)
    coded = docs.select(word_codes(F.col(text)).alias("code"))
    word_runs = repeated_spans(coded, "code", CODE * words, most_blocks).select(F.col("text_key").alias("code_key"), F.col("runs").alias("word_runs"))
    row = docs.select(
        F.struct(*map(F.col, docs.columns)).alias("row"), F.col(text).alias("text"), text_key(F.col(text)).alias("text_key"), text_key(word_codes(F.col(text))).alias("code_key")
    )
    kind = row.schema["row"].dataType.simpleString()
    joined = row.join(runs, "text_key", "left").join(word_runs, "code_key", "left").select("row", "text", "runs", "word_runs")
    return joined.mapInArrow(_clean_passages(length, words), f"row {kind}, n_bytes long, spans array<struct<start: bigint, end: bigint>>, kept binary, clean string")


def without_repeats(docs: DataFrame, text: str = "text", length: int = 400, carry: list[str] | None = None, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """One row per document: ``row`` (its columns, or those of ``carry``), ``n_bytes, spans, kept, clean``.

    ``kept`` are the bytes that stay; ``clean`` is their text, without the rest of a character that a removal cut.
    """
    columns = docs.columns if carry is None else carry
    runs = repeated_spans(docs, text, length, most_blocks)
    row = docs.select(F.struct(*map(F.col, columns)).alias("row"), F.col(text).alias("text"), text_key(F.col(text)).alias("text_key"))
    kind = row.schema["row"].dataType.simpleString()
    joined = row.join(runs, "text_key", "left").select("row", "text", "runs")
    return joined.mapInArrow(_clean(length), f"row {kind}, n_bytes long, spans array<struct<start: bigint, end: bigint>>, kept binary, clean string")
