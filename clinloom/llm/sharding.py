"""Sharding by extendible hashing (native): a directory of hash prefixes whose buckets stay below a byte limit.

Every document has 64 hash bits of its id and text. The directory starts with one bucket; a bucket above the limit splits on
its next bit, others stay. A round counts the bytes of STEP more bits for the buckets still too large and settles, for each
prefix, the shortest one within the limit. Documents that agree in all columns used agree in all bits; they are numbered
within their copies, and the copy number, bit-reversed, gives the bits after those of the hash, so a group of copies of any
size splits as well.

Defined cases: null texts and ids are values like others; sizes are bytes of UTF-8, null 0; a document above the limit gets a
bucket of its own once its bits part it from the rest (``oversize``); an empty table gives no rows. Columns of the input are
carried in one struct.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.llm.shared import store, text_key

LIMIT = 8 << 20
STEP = 8
HASH_BITS = 64
COPY_BITS = 40


def _bits(column: Column, width: int) -> Column:
    """The binary digits of a long, highest first."""
    return F.lpad(F.substring(F.bin(column), -width, width), width, "0")


def keyed(docs: DataFrame, identity: str, text: str, carry: Sequence[str]) -> DataFrame:
    """``row, bytes, bits``: the columns of ``carry``, the size, and the hash and copy bits as a string of 0 and 1."""
    read = docs.select(
        F.struct(*map(F.col, carry)).alias("row"),
        F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("bytes"),
        F.xxhash64(F.coalesce(F.col(identity).cast("string"), F.lit("")), F.col(identity).isNull(), text_key(F.col(text)), F.col(text).isNull()).alias("hash"),
    )
    # Copies are counted, then written out again with their numbers: no task sorts them.
    counted = read.groupBy("row", "bytes", "hash").agg(F.count("*").alias("copies"))
    copies = counted.select("row", "bytes", "hash", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    return copies.select("row", "bytes", F.concat(_bits(F.col("hash"), HASH_BITS), F.reverse(_bits(F.col("copy"), COPY_BITS))).alias("bits"))


def directory(sizes: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``prefix, bytes, documents, oversize`` of every bucket, from ``bits, bytes`` rows.

    A bucket can't split beyond the last bit; there it holds one document.
    """
    last = HASH_BITS + COPY_BITS
    whole = sizes.agg(F.sum("bytes").alias("bytes"), F.count("*").alias("documents")).where("documents > 0")
    level = store(whole.select(F.lit("").alias("prefix"), "bytes", "documents"), "directory")
    settled, depth = [], 0
    while True:
        # A bucket of one document is settled whatever its size.
        fits = (F.col("bytes") <= limit) | (F.col("documents") == 1) | (F.length("prefix") == last)
        settled.append(level.where(fits))
        large = level.where(~fits).select(F.col("prefix").alias("above"))
        if not large.head(1):
            break
        step = min(STEP, last - depth)
        at_depth = sizes.select("bytes", F.substring("bits", 1, depth).alias("above"), F.substring("bits", 1, depth + step).alias("deep"))
        counts = at_depth.groupBy("above", "deep").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("documents")).join(large, "above", "left_semi")
        # Every prefix between the two depths with its sums: a row for each bit, from counts, not from documents.
        prefixes = counts.select(F.explode(F.sequence(F.lit(depth + 1), F.lit(depth + step))).alias("length"), "deep", "bytes", "documents")
        nodes = prefixes.groupBy(F.expr("substring(deep, 1, length)").alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.sum("documents").alias("documents"))
        fit = store(nodes.withColumn("fits", (F.col("bytes") <= limit) | (F.col("documents") == 1)), "directory")
        # A prefix is a bucket if it fits and its parent doesn't; the deepest ones that don't fit go on.
        parent = fit.select(F.col("prefix").alias("parent"), F.col("fits").alias("parent_fits"))
        placed = fit.withColumn("parent", F.expr("substring(prefix, 1, length(prefix) - 1)")).join(parent, "parent", "left")
        settled.append(placed.where("fits and not coalesce(parent_fits, false)").select("prefix", "bytes", "documents"))
        depth += step
        level = fit.where(~F.col("fits") & (F.length("prefix") == depth)).select("prefix", "bytes", "documents")
    found = settled[0]
    for part in settled[1:]:
        found = found.unionByName(part)
    return found.withColumn("oversize", F.col("bytes") > limit)


def shard(docs: DataFrame, identity: str = "doc_id", text: str = "text", carry: Sequence[str] | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per document: ``row, bytes, shard`` (the bucket's prefix as text), ``depth, shard_bytes, oversize``."""
    placed = store(keyed(docs, identity, text, docs.columns if carry is None else carry), "sharded")
    found = store(directory(placed.select("bits", "bytes"), limit), "directory")
    depths = [r["depth"] for r in found.select(F.length("prefix").alias("depth")).distinct().collect()]  # at most one for each bit
    # A document belongs to the only prefix of its bits that the directory has.
    tried = placed.select("row", "bytes", F.explode(F.array(*[F.substring("bits", 1, d) for d in sorted(depths)])).alias("prefix")) if depths else placed.select("row", "bytes", F.lit("").alias("prefix"))
    named = found.select("prefix", F.col("bytes").alias("shard_bytes"), "oversize")
    return tried.join(named, "prefix").select("row", "bytes", F.col("prefix").alias("shard"), F.length("prefix").alias("depth"), "shard_bytes", "oversize")


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT, identity: str = "doc_id", text: str = "text") -> None:
    """The documents as Parquet files, one folder per shard."""
    placed = shard(docs, identity, text, limit=limit).select("row.*", F.concat(F.lit("s"), F.col("shard")).alias("shard_name"))
    placed.repartition("shard_name").write.partitionBy("shard_name").parquet(path)
