"""What several operators share: stored intermediate tables, text keys and Arrow helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinloom.session import scratch_dir


def store(df: DataFrame, label: str) -> DataFrame:
    """The frame written below the shared scratch folder and read again: its lineage ends there."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Stored intermediate tables that are deleted together once what was made from them is stored itself."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def store(self, df: DataFrame, label: str) -> DataFrame:
        self.paths.append(path := scratch_dir(self.spark, label))
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        for name in self.paths:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
        self.paths = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text; null and empty texts share one key."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")
