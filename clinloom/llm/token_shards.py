"""Token-ID output in training order: a keyed permutation gives every sequence a slot, shards hold slots at a fixed stride.

Documents are tokenised, closed with an end token and cut into sequences of ``length`` tokens; the last one of a document is
padded. They are written once, in compressed blocks of some hundred sequences; the N stored sequences are numbered from 0
without gaps by their place in that table, so no sort is needed: the sequences of the partitions before, and the sequence's
number in its own. A Feistel network over the next even number of bits, walked until it lands below N, maps numbers to slots
one to one, under a key. Sequences are dealt by range of slot, in the one shuffle of the whole: a task sends what it has for a
shard as compressed blocks, since ids compress by a half together and by a fifth alone. Partition s gets the slots from
``s * per_shard`` and writes them as shard s at ``stride = 2 * length`` bytes each, as little-endian unsigned 16-bit ids, so
slot k is read at ``(k % per_shard) * stride`` of file ``k // per_shard``. A shard is put together in memory. The index is
written by the same tasks.

A shard is written to a name of its own and moved into place; its bytes follow from the data and the key alone, so a task
that runs again writes the same file. The order follows from the key and from how the table was read: another layout of its
files gives another order. ``read_slots`` starts at any slot.

Defined cases: null text is empty and gives the end token alone; repeated rows are documents of their own; an empty table writes no shard; ids of 65,536 and more are an error. Other columns are not read.
"""

from __future__ import annotations

import itertools
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinloom.llm.packing import default_vocabulary, slices, tokens_of
from clinloom.llm.shared import Scratch, store

LENGTH = 256
PER_SHARD = 16_384
PAD = 0
ROUNDS = 6
# Steps of a walk that every row makes in the plan, and the most that a row which is not home then makes in a loop.
STEPS = 3
WALK = 320
# Tokens that are compressed together, and tokens that a task holds while it deals them to shards.
BLOCK = 524_288
HELD = 16_000_000


def feistel(number: Column, bits: int, key: int) -> Column:
    """One to one on ``bits`` (even) bits: ROUNDS of swapping halves, one mixed with a keyed hash of the other."""
    half = bits // 2
    mask = (1 << half) - 1
    left, right = F.shiftright(number, half), number.bitwiseAND(F.lit(mask))
    for r in range(ROUNDS):
        left, right = right, left.bitwiseXOR(F.xxhash64(F.lit(key), F.lit(r), right).bitwiseAND(F.lit(mask).cast("long")))
    return F.shiftleft(left, half).bitwiseOR(right)


def permuted(numbers: DataFrame, column: str, count: int, key: int) -> DataFrame:
    """Adds ``slot``: the place of ``column`` (0 .. count - 1) under the keyed permutation of that range.

    A value that lands outside walks on along its cycle. The domain is below 4 times ``count``, so each step of a walk
    comes home with a probability of a quarter at least.
    """
    bits = max(2, (count - 1).bit_length() + (count - 1).bit_length() % 2)
    # A row at home stays there. After STEPS steps under 1 row of 100 still walks; only those loop, and a walk longer than
    # WALK steps has a probability below 1e-40 and would be told by the writer.
    walked = numbers.withColumn("slot", feistel(F.col(column).cast("long"), bits, key))
    for _ in range(STEPS):
        walked = walked.withColumn("slot", F.when(F.col("slot") < count, F.col("slot")).otherwise(feistel(F.col("slot"), bits, key)))
    loop = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.col("slot"), lambda at, _: F.when(at < count, at).otherwise(feistel(at, bits, key)))
    return walked.withColumn("slot", F.when(F.col("slot") < count, F.col("slot")).otherwise(loop))


BLOCKS = "first long, n int, doc_id array<long>, part array<int>, tokens array<int>, ids binary"
DEALT = "shard int, n int, listed binary, ids binary"
# What a block of one shard lists of each sequence; kept as bytes of equal weight side by side, which compress best.
LISTED = (("slot", "<i8"), ("doc_id", "<i8"), ("known", "u1"), ("part", "<i4"), ("tokens", "<i4"))


def _squeezer() -> zstandard.ZstdCompressor:
    """Ids of two bytes repeat in short runs: matches of three bytes count, at the effort of level 5."""
    return zstandard.ZstdCompressor(compression_params=zstandard.ZstdCompressionParameters.from_level(5, source_size=2 * BLOCK, min_match=3))


def _listed(rows: pa.Table) -> bytes:
    """Sequences as bytes: slots and ids as differences from the row before."""
    columns = {
        "slot": np.diff(rows["slot"].to_numpy(), prepend=0),
        "doc_id": np.diff(pc.fill_null(rows["doc_id"], 0).to_numpy(), prepend=0),
        "known": pc.is_valid(rows["doc_id"]).to_numpy(),
        "part": rows["part"].to_numpy(),
        "tokens": rows["tokens"].to_numpy(),
    }
    return b"".join(columns[c].astype(kind).reshape(-1, 1).view(np.uint8).T.tobytes() for c, kind in LISTED)


def _sequences_of(data: bytes, n: int) -> pa.RecordBatch:
    """``slot, doc_id, part, tokens`` of ``n`` listed sequences."""
    columns, at = {}, 0
    for c, kind in LISTED:
        width = np.dtype(kind).itemsize
        columns[c] = np.ascontiguousarray(np.frombuffer(data, np.uint8, n * width, at).reshape(width, n).T).view(kind).ravel()
        at += n * width
    arrays = [pa.array(np.cumsum(columns["slot"])), pa.array(np.cumsum(columns["doc_id"]), mask=columns["known"] == 0), pa.array(columns["part"]), pa.array(columns["tokens"])]
    return pa.RecordBatch.from_arrays(arrays, names=["slot", "doc_id", "part", "tokens"])


def _lists(edges: list[int], values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), values)


def _sequences(path: str, length: int, end_token: int):
    """Texts -> blocks of whole sequences; ``first`` counts the sequences before a block in its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, squeeze, first = tokens_of(path), _squeezer(), 0
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            found = [np.append(ids, np.uint32(end_token)) for ids in tokens.of(batch["text"])]
            flat = np.concatenate(found)
            if flat.max() > 0xFFFF:
                raise ValueError("token ids of more than 16 bits")
            flat, sizes = flat.astype("<u2"), np.fromiter(map(len, found), np.int64, len(found))
            counts = -(-sizes // length)
            at = np.repeat(np.arange(len(found)), counts)
            part = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
            taken = np.minimum(length, sizes[at] - part * length)
            edges = [*range(0, len(at), max(1, BLOCK // length)), len(at)]
            ends = np.concatenate(([0], np.cumsum(taken)))
            columns = [
                pa.array([first + e for e in edges[:-1]], pa.int64()),
                pa.array(np.diff(edges), pa.int32()),
                _lists(edges, batch["doc_id"].take(pa.array(at))),
                _lists(edges, pa.array(part, pa.int32())),
                _lists(edges, pa.array(taken, pa.int32())),
                pa.array([squeeze.compress(flat[ends[a] : ends[b]].tobytes()) for a, b in itertools.pairwise(edges)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["first", "n", "doc_id", "part", "tokens", "ids"])
            first += len(at)
            pa.default_memory_pool().release_unused()

    return run


def _deal(per_shard: int, held_tokens: int):
    """Sequences with their slots, in order, the ids of a block at its first one -> blocks of sequences of one shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, expand = _squeezer(), zstandard.ZstdDecompressor()

        def flush(rows: list[pa.RecordBatch], ids: list[np.ndarray]) -> pa.RecordBatch:
            table, flat = pa.Table.from_batches(rows).combine_chunks(), np.concatenate(ids)
            taken, shards = table["tokens"].to_numpy(), table["slot"].to_numpy() // per_shard
            ends = np.cumsum(taken, dtype=np.int64)
            order = np.argsort(shards, kind="stable")
            edges = [0, *(np.flatnonzero(np.diff(shards[order])) + 1).tolist(), len(order)]
            pieces = [flat[a:b] for a, b in zip((ends - taken)[order].tolist(), ends[order].tolist())]
            dealt, runs = table.take(pa.array(order)).combine_chunks(), list(itertools.pairwise(edges))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(shards[order][edges[:-1]], pa.int32()),
                    pa.array(np.diff(edges), pa.int32()),
                    pa.array([squeeze.compress(_listed(dealt.slice(a, b - a))) for a, b in runs], pa.binary()),
                    pa.array([squeeze.compress(np.concatenate(pieces[a:b]).tobytes()) for a, b in runs], pa.binary()),
                ],
                names=["shard", "n", "listed", "ids"],
            )

        rows, ids, held, left = [], [], 0, np.empty(0, "<u2")
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = np.concatenate([left, *(np.frombuffer(expand.decompress(block), "<u2") for block in batch["ids"].drop_null().to_pylist())])
            need = int(batch["tokens"].to_numpy().sum())
            if need > len(flat):
                raise ValueError("a sequence came before its block")
            rows.append(batch.select(["slot", "doc_id", "part", "tokens"]))
            ids.append(flat[:need])
            held, left = held + need, flat[need:]
            if held >= held_tokens:
                yield flush(rows, ids)
                rows, ids, held = [], [], 0
        if len(left):
            raise ValueError("a block has more tokens than its sequences")
        if rows:
            yield flush(rows, ids)

    return run


def _write(folder: str, length: int, per_shard: int):
    """Blocks sorted by shard, whole shards -> one file per shard; the rows' index, and ``first_slot, sequences, crc32`` of each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pa.fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pa.fs.LocalFileSystem(), folder)
        expand = zstandard.ZstdDecompressor()
        kinds = {"shard": pa.int64(), "slot": pa.int64(), "doc_id": pa.int64(), "part": pa.int32(), "tokens": pa.int32(), "first_slot": pa.int64(), "sequences": pa.int64(), "crc32": pa.int64()}

        def rows(n: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.nulls(n, k) if c not in columns else v if isinstance(v := columns[c], pa.Array) else pa.array(v, k) for c, k in kinds.items()], names=list(kinds))

        def close(shard: int, blocks: list[tuple]) -> Iterator[pa.RecordBatch]:
            index = pa.Table.from_batches([listed for listed, _ in blocks]).sort_by("slot").combine_chunks()
            n, first = index.num_rows, shard * per_shard
            if not np.array_equal(index["slot"].to_numpy(), first + np.arange(n)):
                raise ValueError(f"the slots of shard {shard} don't follow each other")
            records = np.full((n, length), PAD, "<u2")
            for listed, packed in blocks:
                record = np.full((listed.num_rows, length), PAD, "<u2")
                record[np.arange(length) < listed["tokens"].to_numpy()[:, None]] = np.frombuffer(expand.decompress(packed), "<u2")
                records[listed["slot"].to_numpy() - first] = record
            data = records.tobytes()
            files.create_dir(root, recursive=True)
            name = f"{root}/.{shard:08d}-{uuid.uuid4().hex}"
            with files.open_output_stream(name) as stream:
                stream.write(data)
            files.move(name, f"{root}/{shard:08d}.bin")
            for part in index.to_batches():
                yield rows(part.num_rows, **{c: part[c] for c in ("slot", "doc_id", "part", "tokens")})
            yield rows(1, shard=[shard], first_slot=[first], sequences=[n], crc32=[zlib.crc32(data)])

        open_, blocks = None, []
        for batch in batches:
            for shard, n, listed, ids in zip(*(batch[c].to_pylist() for c in ("shard", "n", "listed", "ids"))):
                if blocks and shard != open_:
                    yield from close(open_, blocks)
                    blocks = []
                open_ = shard
                blocks.append((_sequences_of(expand.decompress(listed), n), ids))
        if blocks:
            yield from close(open_, blocks)

    return run


def write_training_order(
    docs: DataFrame,
    folder: str,
    identity: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    per_shard: int = PER_SHARD,
    key: int = 0,
    path: str | None = None,
    end_token: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Writes the shards; returns the index (``slot, doc_id, part, tokens``) and the list of shards with checksums."""
    spark = docs.sparkSession
    read = docs.select(F.col(identity).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scratch = Scratch(spark)
    cut = read.mapInArrow(_sequences(path or default_vocabulary(), length, end_token), BLOCKS)
    stored = scratch.store(cut.withColumn("home", F.spark_partition_id()), "sequences")
    counts = stored.groupBy("home").agg(F.sum("n").alias("n"))
    before = counts.select("home", F.coalesce(F.sum("n").over(Window.orderBy("home").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    # One row for each partition that wrote the table.
    placed = stored.join(F.broadcast(before), "home").withColumn("base", F.col("before") + F.col("first"))
    # A block's ids stay with its first sequence; rows keep their order up to the task that deals them.
    sequence = F.transform(F.arrays_zip("doc_id", "part", "tokens"), lambda s, i: F.struct(s["doc_id"], s["part"], s["tokens"], F.when(i == 0, F.col("ids")).alias("ids")))
    numbered = placed.select("base", F.posexplode(sequence).alias("nth", "s")).select("s.doc_id", "s.part", "s.tokens", "s.ids", (F.col("base") + F.col("nth")).alias("number"))
    slots = permuted(numbered, "number", max(1, total), key).select("slot", "doc_id", "part", "tokens", "ids")
    # Ranges of slots, which are known without a sample: a shard for each partition.
    shards = max(1, -(-total // per_shard))
    dealt = slots.mapInArrow(_deal(per_shard, HELD), DEALT).repartitionById(shards, "shard").sortWithinPartitions("shard")
    kind = "shard long, slot long, doc_id long, part int, tokens int, first_slot long, sequences long, crc32 long"
    written = store(dealt.mapInArrow(_write(folder, length, per_shard), kind), "manifest")
    scratch.clear()
    index = written.where("slot is not null").select("slot", "doc_id", "part", "tokens")
    return index, written.where("shard is not null").select("shard", "first_slot", "sequences", "crc32")


def read_slots(spark: SparkSession, folder: str, manifest: DataFrame, length: int = LENGTH, start: int = 0) -> DataFrame:
    """``slot, ids`` (little-endian unsigned 16-bit, padded) of all slots from ``start``, read shard by shard in order."""
    stride = 2 * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pa.fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pa.fs.LocalFileSystem(), folder)
        for batch in batches:
            for row in batch.to_pylist():
                skip = max(0, start - row["first_slot"])
                with files.open_input_file(f"{root}/{row['shard']:08d}.bin") as file:
                    file.seek(skip * stride)
                    for at in range(skip, row["sequences"], 1024):
                        n = min(1024, row["sequences"] - at)
                        data = file.read(n * stride)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.arange(at, at + n) + row["first_slot"]), pa.array([data[i * stride : (i + 1) * stride] for i in range(n)], pa.binary())],
                            names=["slot", "ids"],
                        )

    wanted = manifest.where(F.col("first_slot") + F.col("sequences") > start)
    return wanted.repartitionByRange(max(1, spark.sparkContext.defaultParallelism), "shard").mapInArrow(run, "slot long, ids binary")
