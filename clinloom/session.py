"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Session -> how many steps of it let their shuffles pass just now (streams have threads of their own), and the setting before.
_PASSING: dict[str, tuple[int, str]] = {}
_LOCK = threading.Lock()

# Runtime settings the plans rely on; none of them depends on the cluster's size.
#   skewJoin + forceOptimizeSkewedJoin: a hot provider, patient or case is split even when that costs one more shuffle.
#   advisory and skewed partition sizes count compressed bytes, of which a sort holds ten times and more as rows: a task reads a
#   few megabytes of a shuffle, and a join splits the partition of a hot key before it fills a task's memory.
#   the broadcast thresholds are the size check behind every dimension lookup: a broadcast table passes through the driver
#   in rows, which can be a hundred times as large as their columns in Parquet files (numbered keys). So a size read off files
#   counts hundredfold; one that AQE has measured counts as it is.
#   zstd: logs, raw tables and scratch data are mostly texts and hex digits, which Snappy hardly shortens.
#   RocksDB: what a stream remembers grows with the feed; it stays on local disk, with a set amount of memory for an executor.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(8 << 20),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(16 << 20),
    "spark.sql.sources.fileCompressionFactor": "100",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.autoBroadcastJoinThreshold": str(10 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(16 << 20),
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str = "clinloom", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def spread(scan: DataFrame) -> DataFrame:
    """A file scan with fewer splits than the cluster has cores, dealt out to all cores; a larger scan as it is."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def discard(spark: SparkSession, place: str) -> None:
    """Delete a scratch folder that no frame reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is written or collected inside go when it ends; else they stay until the driver happens to
    collect its garbage, and a long job holds those of all its steps. For frames made inside that run once: one that runs again
    makes its shuffles again."""
    session = spark._jsparkSession.sessionUUID()
    with _LOCK:
        count, before = _PASSING.get(session) or (0, spark.conf.get(SHUFFLE_CLEANUP, "false"))
        _PASSING[session] = count + 1, before
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _LOCK:
            count, before = _PASSING.pop(session)
            if count > 1:
                _PASSING[session] = count - 1, before
            else:
                spark.conf.set(SHUFFLE_CLEANUP, before)


def drop_shuffles(batch: DataFrame) -> None:
    """Delete the shuffle files behind a stream's micro-batch that has been stored, while the stream still holds the batch.

    The driver goes on knowing them, so a task that asks for them again has them made again.
    """
    context = batch.sparkSession.sparkContext._jsc.sc()
    rdds, seen, shuffles = [batch._jdf.queryExecution().toRdd()], set(), set()
    while rdds:
        if (rdd := rdds.pop()).id() in seen:
            continue
        seen.add(rdd.id())
        behind = rdd.dependencies()
        for dependency in (behind.apply(i) for i in range(behind.size())):
            rdds.append(dependency.rdd())
            if dependency.getClass().getSimpleName() == "ShuffleDependency":
                shuffles.add(dependency.shuffleId())
    for number in shuffles:
        context.shuffleDriverComponents().removeShuffle(number, True)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder path below the cluster's shared checkpoint folder.

    Only where the session names none and runs on one machine (tests, laptops) a temporary folder is made and set for it.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="clinloom-")
        spark.conf.set(CHECKPOINT_DIR, base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
