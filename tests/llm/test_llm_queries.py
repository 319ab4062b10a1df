"""The registered training-data queries on the smallest tables: against SQL where there is some, and the whole pipeline."""

import os

import duckdb
import pytest

import corpus_pipeline
from check import rows_of
from clinloom.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    df = QUERIES[name](spark, SMALL)
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_pipeline_stages_keep_their_promises(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "minhash_dedup", "suffix_array_dedup", "source_mixing", "best_fit_packing"]
    packed = corpus_pipeline.run(spark, SMALL).collect()
    kept = {r.doc_id for r in packed}
    assert kept <= {r.doc_id for r in docs.select("doc_id").collect()} and len(kept) > 50
    assert all(0 < r.length <= 2048 for r in packed)


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0
