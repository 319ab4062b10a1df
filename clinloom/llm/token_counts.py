"""Token counts of whole texts, without token ids.

1. Texts are cut into pre-tokens by the vocabulary file's own pre-tokenizer, a slice of some megabytes at a time. A slice is
   written as one row: its distinct pre-tokens in order, and for each of its documents the places of its pre-tokens among
   them and their frequencies.
2. Frequent pre-tokens are found on the way: each task keeps at most FREQUENT counters by Misra and Gries' rule, which holds
   every pre-token with more than one in FREQUENT of the task's (document, pre-token) pairs. The COMMON most frequent of
   all tasks' have their pieces counted and are broadcast: a bounded table of strings of at most LONGEST characters.
3. The pairs of all other pre-tokens are brought together by a shuffle and sorted, and the pieces of each are counted once.
4. Piece counts times frequencies go back to their slices and are summed for each document.

So the pieces of a pre-token are counted once, whichever way it takes, and the result does not depend on the way. A
pre-token that most documents hold sends no row, and none that is shuffled has a large share of the rows.

Cutting is done in two steps: the pre-tokenizer starts a new unit at each space that follows anything but white space, so a
slice of texts is cut there first and each distinct chunk of the slice is pre-tokenized once. An added token's string inside
a text counts as one token, which is the library's default.

Defined cases: null and empty texts have no tokens; repeated rows and ids are documents of their own; very long texts are
counted whole; no rows give no rows. Columns of the input are carried in one struct. Vocabularies with another pre-tokenizer
than byte-level, with a normalizer, or with added tokens that take in the white space beside them are an error.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.packing import default_vocabulary, slices
from clinloom.session import scratch_dir

FREQUENT = 100_000
COMMON = 300_000
# Bytes of text cut at once (a single text may be longer).
SLICE_BYTES = 2 << 20
# Characters of the longest string that a worker or the broadcast table keeps, and chunks that a worker keeps.
LONGEST = 64
CACHED_CHUNKS = 200_000
SPACE = r"\p{Z}\x09-\x0D\x1C-\x1F\x85"
CUT = regex.compile(rf"(?<![{SPACE}]) ")
RUN = r"[\pZ\x09-\x0D\x1C-\x1F\x{85}] "
# A word and the signs after it are two pre-tokens, whatever stands beside them; the letters' range holds nothing else.
PLAIN = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?]*)").fullmatch


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next free one."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


class PreTokens:
    """Pre-tokens of texts and piece counts of pre-tokens, by a tokenizer file."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        added = settings["added_tokens"]
        if (settings["pre_tokenizer"] or {}).get("type") != "ByteLevel" or settings["pre_tokenizer"]["add_prefix_space"] or settings["normalizer"]:
            raise ValueError(f"{path}: not a plain byte-level vocabulary")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in added):
            raise ValueError(f"{path}: an added token depends on the text beside it")
        tokenizer = Tokenizer.from_file(path)
        self.model, self.cut = tokenizer.model, tokenizer.pre_tokenizer.pre_tokenize_str
        self.added = {t["content"] for t in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split if added else lambda text: [text]
        self.letters = byte_letters()
        self.chunks: dict[str, tuple[str, ...]] = {}

    def of_chunk(self, chunk: str) -> tuple[str, ...]:
        """The pre-tokens of a chunk; an added token stands for itself."""
        found = self.chunks.get(chunk)
        if found is None:
            plain = PLAIN(chunk)
            if plain:
                word, signs = plain.groups()
                return (word, signs) if signs else (word,)
            parts = (((part,) if part in self.added else (part[a:b] for _, (a, b) in self.cut(part))) for part in self.split(chunk))
            found = tuple(itertools.chain.from_iterable(parts))
            if len(self.chunks) >= CACHED_CHUNKS:
                self.chunks.clear()
            if len(chunk) <= LONGEST:
                self.chunks[chunk] = found
        return found

    def pieces(self, pre_token: str) -> int:
        return 1 if pre_token in self.added else len(self.model.tokenize(pre_token.encode().decode("latin-1").translate(self.letters)))

    def frequencies(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """``names, edges, codes, counts``: document i holds ``names[codes[j]]`` counts[j] times, j from edges[i] to edges[i + 1].

        Names are in order, and so are the codes of a document.
        """
        texts = pc.fill_null(texts, "")
        runs = pc.match_substring_regex(texts, RUN)
        split = pc.split_pattern(pc.if_else(runs, "", texts), " ")
        words, sizes = pc.list_flatten(split), pc.list_value_length(split).to_numpy()
        if pc.any(runs).as_py():
            # Texts with white space before a space are cut one by one, at the same places.
            whole = {i: CUT.split(texts[i].as_py()) for i in np.flatnonzero(runs.to_numpy(zero_copy_only=False)).tolist()}
            flat, edges, parts = words.to_pylist(), np.concatenate(([0], np.cumsum(sizes))), []
            sizes = sizes.copy()
            for i in range(len(texts)):
                parts += whole.get(i) or flat[edges[i] : edges[i + 1]]
                sizes[i] = len(whole[i]) if i in whole else sizes[i]
            words = pa.array(parts, pa.string())
        coded = words.dictionary_encode()
        names, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        edges = np.concatenate(([0], np.cumsum(sizes)))
        # A text's first chunk has no space before it, so it is an entry of its own.
        firsts, which = np.unique(codes[edges[:-1]], return_inverse=True)
        codes[edges[:-1]] = len(names) + which
        places: dict[str, int] = {}
        listed = [[places.setdefault(p, len(places)) for p in self.of_chunk(c)] for c in itertools.chain((" " + w for w in names), (names[f] for f in firsts))]
        lengths = np.fromiter(map(len, listed), np.int64, len(listed))
        flat, starts = np.fromiter(itertools.chain.from_iterable(listed), np.int64, int(lengths.sum())), np.cumsum(lengths) - lengths
        # Places in order of the strings.
        names = list(places)
        order = sorted(range(len(names)), key=names.__getitem__)
        rank = np.empty(len(names), np.int64)
        rank[order] = np.arange(len(names))
        flat = rank[flat]
        # Distinct chunks of each document first: only those are spread out into pre-tokens.
        document = np.repeat(np.arange(len(sizes)), sizes)
        chunk_cells, chunk_counts = np.unique(document * len(listed) + codes, return_counts=True)
        at, chunk = np.divmod(chunk_cells, max(1, len(listed)))
        spread = lengths[chunk]
        ends = np.cumsum(spread)
        tokens = flat[np.repeat(starts[chunk] - (ends - spread), spread) + np.arange(ends[-1] if len(ends) else 0)]
        cells, back = np.unique(np.repeat(at, spread) * len(places) + tokens, return_inverse=True)
        counts = np.bincount(back, np.repeat(chunk_counts, spread), len(cells)).astype(np.int64)
        document, tokens = np.divmod(cells, max(1, len(places)))
        return [names[i] for i in order], np.searchsorted(document, np.arange(len(sizes) + 1)), tokens, counts


@functools.cache
def pre_tokens_of(path: str) -> PreTokens:
    """One for all tasks of a Python worker."""
    return PreTokens(path)


class Frequent:
    """The strings that may have a large share of all that were added, with counts that are too small by a bound."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.counts: dict[str, int] = {}

    def add(self, names: list[str], counts: list[int]) -> None:
        held = self.counts
        for name, count in zip(names, counts):
            held[name] = held.get(name, 0) + count
        if len(held) > 2 * self.most:
            found = np.fromiter(held.values(), np.int64, len(held))
            cut = int(np.partition(found, len(found) - self.most - 1)[len(found) - self.most - 1])
            self.counts = {name: count - cut for name, count in held.items() if count > cut}


def _words(values: np.ndarray) -> bytes:
    return values.astype("<i4").tobytes()


def _frequencies(path: str, most: int, size: int):
    names_ = ["slice", "documents", "tokens", "edges", "codes", "times"]

    def row(slice_: pa.Array, documents: pa.Array, tokens: list[str], edges: list[int], codes: bytes, times: bytes) -> pa.RecordBatch:
        listed = pa.array([tokens], pa.list_(pa.string())), pa.array([edges], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([slice_, documents, *listed, pa.array([codes], pa.binary()), pa.array([times], pa.binary())], names=names_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, frequent, kind = pre_tokens_of(path), Frequent(most), None
        for batch in itertools.chain.from_iterable(slices(b, most=size) for b in batches):
            names, edges, codes, counts = cutter.frequencies(batch["text"])
            frequent.add(names, np.bincount(codes, minlength=len(names)).tolist())
            documents = pa.StructArray.from_arrays([batch["row"], batch["n_bytes"]], ["row", "n_bytes"])
            kind = documents.type
            whole = pa.ListArray.from_arrays(pa.array([0, len(documents)], pa.int32()), documents)
            # Pre-tokens in order and differences of places make the table small.
            yield row(batch["uid"].slice(0, 1), whole, names, edges.tolist(), _words(np.diff(codes, prepend=0)), _words(counts))
            # What a slice took goes back to the system: the worker shares an executor's memory with the JVM.
            pa.default_memory_pool().release_unused()
        # A row without documents: what was frequent in this task, and in how many of its documents at least.
        kept = {name: count for name, count in frequent.counts.items() if count > 1 and len(name) <= LONGEST}
        if kept:
            yield row(pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(kind)), list(kept), list(kept.values()), None, None)

    return run


def _pieces(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = pre_tokens_of(path)
        for batch in batches:
            found = [cutter.pieces(token) for token in batch["token"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["token"], pa.array(found, pa.int64())], names=["token", "pieces"])

    return run


def _rare(shared):
    """A stored slice -> a row with its documents and the pieces of their common pre-tokens, and a row for each other pair.

    The documents travel as one binary value, so that the many rows beside it are flat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common: dict[str, int] = shared.value
        kinds = {"token": pa.string(), "slice": pa.int64(), "document": pa.int32(), "amount": pa.int64(), "documents": pa.binary()}

        def rows(n: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns[c].cast(k) if c in columns else pa.nulls(n, k) for c, k in kinds.items()], names=list(kinds))

        for whole in batches:
            for i in range(whole.num_rows):
                batch = whole.slice(i, 1)
                documents, tokens, edges = (batch[c].flatten() for c in ("documents", "tokens", "edges"))
                edges = edges.to_numpy()
                codes = np.cumsum(np.frombuffer(batch["codes"][0].as_py(), "<i4").astype(np.int64))
                times = np.frombuffer(batch["times"][0].as_py(), "<i4").astype(np.int64)
                pieces = np.array([common.get(t, 0) for t in tokens.to_pylist()], np.int64)
                found = pieces[codes]
                known = np.diff(np.concatenate(([0], np.cumsum(found * times)))[edges])
                counted = pa.RecordBatch.from_arrays([documents.field("row"), documents.field("n_bytes"), pa.array(known)], names=["row", "n_bytes", "n_tokens"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, counted.schema) as stream:
                    stream.write_batch(counted)
                yield rows(1, slice=batch["slice"], documents=pa.array([sink.getvalue().to_pybytes()]))
                other = np.flatnonzero(found == 0)
                owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))[other]
                number = pa.array(np.full(len(other), batch["slice"][0].as_py(), np.int64))
                yield rows(len(other), token=tokens.take(pa.array(codes[other])), slice=number, document=pa.array(owner), amount=pa.array(times[other]))

    return run


def _counted(path: str):
    """Pairs come sorted by token: the pieces of each are counted once. Slices pass as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, last, pieces = pre_tokens_of(path), None, 0
        names = ["slice", "document", "amount", "documents"]
        for batch in batches:
            slices_ = pc.is_null(batch["token"])
            yield batch.filter(slices_).select(names)
            batch = batch.filter(pc.invert(slices_))
            amounts = np.empty(batch.num_rows, np.int64)
            for i, token in enumerate(batch["token"].to_pylist()):
                if token != last:
                    last, pieces = token, cutter.pieces(token)
                amounts[i] = pieces
            amounts *= batch["amount"].to_numpy()
            yield pa.RecordBatch.from_arrays([batch["slice"], batch["document"], pa.array(amounts), batch["documents"]], names=names)

    return run


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by slice, the one with its documents first."""
    documents, totals, number = None, np.empty(0, np.int64), None

    def finished():
        return pa.RecordBatch.from_arrays([documents["row"], documents["n_bytes"], pa.array(totals)], names=["row", "n_bytes", "n_tokens"])

    for batch in batches:
        slice_ = batch["slice"].to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], slice_[1:] != slice_[:-1]))).tolist() if len(slice_) else []
        for start, stop in zip(starts, [*starts[1:], len(slice_)]):
            part = batch.slice(start, stop - start)
            if slice_[start] != number:
                if documents is not None:
                    yield finished()
                number, documents = slice_[start], pa.ipc.open_stream(part["documents"][0].as_py()).read_next_batch()
                totals = documents["n_tokens"].to_numpy().copy()
                part = part.slice(1)
            np.add.at(totals, part["document"].to_numpy(), part["amount"].to_numpy())
    if documents is not None:
        yield finished()


def pre_token_frequencies(docs: DataFrame, text: str, carry: list[str], path: str, frequent: int = FREQUENT, size: int = SLICE_BYTES) -> DataFrame:
    """One row for each slice: ``slice, documents, tokens, edges, codes, times``.

    Document i holds ``tokens[codes[j]]`` times[j] times, j from edges[i] to edges[i + 1]; codes are kept as differences. Rows
    without ``slice`` hold pre-tokens that are frequent in a task, and in ``edges`` in how many documents at least. ``slice``
    numbers the rows of this table; it is stable only in a stored table.
    """
    read = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.struct(*map(F.col, carry)).alias("row"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).alias("text"),
    )
    documents = f"array<struct<row: {read.schema['row'].dataType.simpleString()}, n_bytes: long>>"
    kind = f"slice long, documents {documents}, tokens array<string>, edges array<long>, codes binary, times binary"
    return read.mapInArrow(_frequencies(path, frequent, size), kind)


def count_tokens(
    docs: DataFrame,
    text: str = "text",
    carry: list[str] | None = None,
    path: str | None = None,
    frequent: int = FREQUENT,
    common: int = COMMON,
    size: int = SLICE_BYTES,
) -> DataFrame:
    """One row per document: ``row`` (the columns of ``carry``, all by default), ``n_bytes``, ``n_tokens``."""
    path, spark = path or default_vocabulary(), docs.sparkSession
    place = scratch_dir(spark, "frequencies")
    cut = pre_token_frequencies(docs, text, docs.columns if carry is None else carry, path, frequent, size)
    cut.write.option("compression", "zstd").parquet(place)
    held = spark.read.schema(cut.schema).parquet(place)
    candidates = held.where("slice is null").select(F.explode(F.arrays_zip("tokens", "edges")).alias("c"))
    counted = candidates.groupBy(F.col("c.tokens").alias("token")).agg(F.sum("c.edges").alias("documents"))
    # The bound of the broadcast: ``common`` rows of short strings.
    most = counted.orderBy(F.col("documents").desc(), "token").limit(common).select("token")
    known = most.mapInArrow(_pieces(path), "token string, pieces long").collect()
    shared = spark.sparkContext.broadcast({r["token"]: r["pieces"] for r in known})
    kind = "slice long, document int, amount long, documents binary"
    pairs = held.where("slice is not null").mapInArrow(_rare(shared), f"token string, {kind}")
    met = pairs.repartition(F.coalesce("token", F.col("slice").cast("string"))).sortWithinPartitions("token").mapInArrow(_counted(path), kind)
    back = met.repartition("slice").sortWithinPartitions("slice", F.col("document").asc_nulls_first())
    row = held.schema["documents"].dataType.elementType["row"].dataType.simpleString()
    return back.mapInArrow(_totals, f"row {row}, n_bytes long, n_tokens long")
