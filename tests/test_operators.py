import datetime as dt
import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clinloom.operators import keyed, quality
from clinloom.operators.flatten import flatten_struct
from clinloom.operators.joins import hot_keys, left_join_many
from clinloom.operators.spine import date_spine, densify
from clinloom.operators.store import TableStore
from clinloom.operators import surrogate as surrogate_module
from clinloom.operators.distinct import distinct_counts
from clinloom.operators.surrogate import surrogate_key

D = dt.date


# Spine


def test_spine_holds_both_ends(spark):
    days = [r.date_key for r in date_spine(spark, "2024-01-01", "2026-01-31").collect()]
    assert (len(days), min(days), max(days)) == (762, D(2024, 1, 1), D(2026, 1, 31))
    assert date_spine(spark, "2024-01-02", "2024-01-01").count() == 0
    assert date_spine(spark, "2024-01-01", "2024-01-01").count() == 1


def test_dense_days_equal_the_product_with_the_spine(spark, rows):
    entities = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, total int")
    daily = spark.createDataFrame(
        [
            ("a", D(2024, 1, 1), 5, 1.5),
            ("a", D(2024, 1, 3), 6, None),
            ("b", D(2024, 1, 7), 7, 2.5),
            ("b", D(2023, 12, 31), 99, 9.9),
            ("b", D(2024, 1, 8), 99, 9.9),
            ("x", D(2024, 1, 2), 99, 9.9),
            (None, D(2024, 1, 2), 99, 9.9),
        ],
        "k string, day date, n int, mean double",
    )
    spine = date_spine(spark, "2024-01-01", "2024-01-07", "day")
    product = entities.crossJoin(spine).join(daily, ["k", "day"], "left")
    expected = product.select("k", "day", "total", F.coalesce("n", F.lit(0)).alias("n"), "mean")
    got = densify(entities, daily, "k", "day", "2024-01-01", "2024-01-07", zero=["n"])
    assert got.columns == expected.columns
    assert rows(got) == rows(expected)
    assert got.count() == 21


def test_dense_days_shuffle_sparse_rows_only(spark):
    entities = spark.range(3).select(F.col("id").alias("k"), F.lit(1).alias("total"))
    daily = spark.range(3).select(F.col("id").alias("k"), F.lit("2024-01-02").cast("date").alias("day"), F.lit(1).alias("n"))
    plan = densify(entities, daily, "k", "day", "2024-01-01", "2024-01-07", zero=["n"])._jdf.queryExecution()
    physical = plan.executedPlan().toString()
    assert physical.count("Exchange hashpartitioning") == 1
    assert physical.index("Generate explode(sequence") < physical.index("Exchange hashpartitioning")
    assert "Join" not in physical


# Surrogate keys


@pytest.mark.parametrize("partitions", [1, 3, 16, None])
def test_rank_over_ranges_equals_the_window(spark, rows, partitions):
    df = spark.range(2000).select(F.md5(F.col("id").cast("string")).alias("k"), "id")
    df = df.unionByName(spark.createDataFrame([(None, -1)], "k string, id long"))
    whole = df.select(F.row_number().over(W.orderBy(F.col("k").asc_nulls_last())).cast("long").alias("key"), "k", "id")
    assert rows(surrogate_key(df, "k", "key", partitions)) == rows(whole)


def test_many_nulls_and_equal_keys_are_spread(spark, rows):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit("same")).when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"), "id")
    ranked = surrogate_key(df, "k", "key", 12)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    got = sorted(ranked.collect())
    assert [r.key for r in got] == list(range(1, 6001))
    assert [r.k or "~" for r in got] == sorted([r.k or "~" for r in got])
    # No window but the one over the partitions' counts, and no partition with most of the rows.
    assert plan.count("Window [") == 1
    at = surrogate_module.F.shiftright("_at", surrogate_module.ROW_BITS)
    sizes = [r["count"] for r in spark.read.parquet(ranked.inputFiles()[0].rsplit("/", 1)[0]).groupBy(at).count().collect()]
    assert len(sizes) > 8 and max(sizes) < 1500
    assert rows(ranked) == rows(ranked)


def test_rank_of_nothing(spark):
    assert surrogate_key(spark.createDataFrame([], "k string"), "k", "key").count() == 0


# Distinct counts


def test_several_distinct_counts_in_one_aggregation(spark, rows):
    df = spark.range(3000).select((F.col("id") % 7).alias("k"), (F.col("id") % 11).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 13).alias("b"), "id")
    df = df.unionByName(spark.createDataFrame([(None, None, None, 5)], "k long, a long, b long, id long"))
    want = df.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"), F.count_distinct("a").alias("as_"), F.count_distinct("b").alias("bs"))
    got = distinct_counts(df, ["k"], {"as_": "a", "bs": "b"}, {"n": (F.count("*"), "sum"), "top": (F.max("id"), "max")})
    assert got.columns == want.columns and rows(got) == rows(want)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


# Joins


@pytest.mark.parametrize("hot_rows", [1, 3, 1000])
def test_salted_left_join_equals_the_plain_one(spark, rows, hot_rows):
    rng = random.Random(5)
    keys = ["a", "b", "c", "d", None]
    one = [(i, rng.choice(keys), rng.choice([1, 2, None])) for i in range(60)]
    many = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([1, 2, None]), i) for i in range(80)]
    many += [("a", 1, 500)] * 7
    left = spark.createDataFrame(one, "id int, k string, m int")
    right = spark.createDataFrame(many, "k string, m int, v int")
    expected = left.join(right, ["k", "m"], "left")
    got = left_join_many(left, right, ["k", "m"], hot_rows)
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got.select(*expected.columns)) == rows(expected)


def test_only_hot_keys_are_salted(spark, rows):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    assert rows(hot_keys(df, ["k"], 100)) == [("hot", 4)]
    assert hot_keys(df, ["k"], 400).count() == 0


# Keyed loading


def test_a_table_of_many_short_keys_is_not_broadcast(spark, tmp_path):
    # Some megabytes as a file, over a hundred as rows in the driver.
    path = str(tmp_path / "keys")
    spark.range(2_000_000).select(F.concat(F.lit("ADT"), "id").alias("k"), F.lit("text").alias("v")).coalesce(1).write.parquet(path)
    assert sum(f.stat().st_size for f in (tmp_path / "keys").iterdir()) < 60 << 20
    plan = spark.read.parquet(path).join(spark.read.parquet(path).select("k"), "k", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_upsert_takes_the_latest_and_keeps_absent_rows(spark, rows):
    target = spark.createDataFrame([(1, "old", 1), (2, "stays", 1)], "id int, v string, at int")
    batch = spark.createDataFrame([(1, "newer", 3), (1, "new", 2), (3, "added", 2), (3, "added", 2)], "id int, v string, at int")
    got = keyed.upsert(target, batch, ["id"], ["at"])
    assert rows(got) == [(1, "newer", 3), (2, "stays", 1), (3, "added", 2)]
    assert rows(keyed.upsert(got, batch, ["id"], ["at"])) == rows(got)


def test_upsert_ties_do_not_depend_on_order(spark, rows):
    tied = [(1, v, 1) for v in "abcdefgh"]
    batches = [spark.createDataFrame(x, "id int, v string, at int").repartition(3) for x in (tied, tied[::-1])]
    first, second = (rows(keyed.latest_per_key(b, ["id"], ["at"])) for b in batches)
    assert len(first) == 1 and first == second


def test_latest_collapses_copies_before_the_shuffle(spark):
    batch = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("at"))
    plan = keyed.latest_per_key(batch, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_max_by")


def test_insert_ignore_keeps_the_first_of_new_keys(spark, rows):
    target = spark.createDataFrame([("x", 0)], "code string, n int")
    batch = spark.createDataFrame([("x", 1), ("y", 3), ("y", 2)], "code string, n int")
    assert rows(keyed.insert_ignore(target, batch, ["code"], ["n"])) == [("y", 2)]


@pytest.mark.parametrize("only_changed, times", [(False, ["new", "new", "old"]), (True, ["new", "old", "old"])])
def test_updates_touch_the_time(spark, only_changed, times):
    target = spark.createDataFrame([(1, "a", "old"), (2, None, "old"), (3, "c", "old")], "id int, v string, updated_at string")
    updates = spark.createDataFrame([(1, "z"), (2, None)], "id int, v string")
    got = keyed.apply_updates(target, updates, ["id"], F.lit("new"), only_changed=only_changed).orderBy("id").collect()
    assert [r.v for r in got] == ["z", None, "c"]
    assert [r.updated_at for r in got] == times


def test_absent_rows_are_marked_and_kept(spark):
    target = spark.createDataFrame([(1,), (2,)], "id int")
    snapshot = spark.createDataFrame([(2,), (2,), (3,)], "id int")
    got = keyed.mark_deleted(target, snapshot, ["id"], F.lit("2026-01-01").cast("timestamp_ntz"))
    assert {r.id: r._sdc_deleted_at for r in got.collect()} == {1: dt.datetime(2026, 1, 1), 2: None}


def test_load_columns(spark):
    row = keyed.with_load_metadata(spark.range(1), dt.datetime(2026, 1, 1, 2), 7).first()
    assert {row[c] for c in keyed.LOAD_COLUMNS[:3]} == {dt.datetime(2026, 1, 1, 2)} and row._sdc_table_version == 7


# Store


def test_store_versions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert not store.exists("raw", "t") and store.version("raw", "t") == 0
    store.write(spark.range(3), "raw", "t")
    # A table can be rewritten from its own current version.
    store.write(store.read("raw", "t").where("id > 0"), "raw", "t", sort_by=["id"])
    assert (store.version("raw", "t"), store.read("raw", "t").count()) == (2, 2)
    with pytest.raises(Exception):
        store.write(spark.range(3).select(F.raise_error(F.lit("lost"))), "raw", "t")
    assert (store.version("raw", "t"), store.read("raw", "t").count()) == (2, 2)
    assert store.write(spark.range(9), "raw", "t").count() == 9
    assert store.expire("raw", "t", keep=1) == [1, 2]
    assert store.read("raw", "t").count() == 9


# Flattening


def test_structs_flatten_and_arrays_stay(spark):
    df = spark.sql(
        "select named_struct('code', 'IMP', 'deep', named_struct('x', 1)) as class, array(named_struct('v', 2)) as items, 3 as n"
    )
    text = flatten_struct(df)
    assert text.columns == ["class_code", "class_deep_x", "items", "n"]
    assert tuple(text.first()) == ("IMP", 1, '[{"v":2}]', 3)
    assert flatten_struct(df, arrays_as_json=False).schema["items"].dataType == df.schema["items"].dataType


# Data quality


def test_single_rules(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (None, None), (2, "z")], "id int, v string")
    assert rows(quality.duplicated(df, "id")) == [(1, 2)]
    assert quality.missing(df, "id").count() == 2
    assert rows(quality.unaccepted(df, "v", ("a", "b"))) == [(2, "z")]
    parent = spark.createDataFrame([(1,), (1,), (None,)], "key int")
    assert rows(quality.orphans(df, "id", parent, "key")) == [(2, "z")]
    assert [r.v for r in quality.with_defaults(df, {"v": "open"}).where("v = 'open'").collect()] == ["open"]


def test_report(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, None)], "id int, v string")
    rules = [
        quality.Rule("t", "id", "unique"),
        quality.Rule("t", "id", "not_null"),
        quality.Rule("t", "v", "accepted_values", values=("a",)),
        quality.Rule("t", "id", "relationships", parent="p", parent_column="k"),
    ]
    report = quality.evaluate({"t": df, "p": spark.createDataFrame([(9,)], "k int")}, rules)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(rule") == 2
    assert report.columns == quality.REPORT
    assert rows(report) == [
        ("t", "id", "not_null", 1),
        ("t", "id", "relationships", 2),
        ("t", "id", "unique", 1),
        ("t", "v", "accepted_values", 1),
    ]


def test_keyed_rules_of_several_tables(spark):
    child = spark.createDataFrame([(i, i % 40 if i % 9 else None) for i in range(300)] + [(7, 1)], "id int, parent int")
    parent = spark.createDataFrame([(i,) for i in range(0, 40, 2)] * 2 + [(None,)], "key long")
    rules = [quality.Rule("c", "id", "unique"), quality.Rule("c", "parent", "relationships", parent="p", parent_column="key"), quality.Rule("p", "key", "unique"), quality.Rule("p", "key", "relationships", parent="p", parent_column="key")]
    got = {(r.table_name, r.column_name, r.rule): r.failures for r in quality.evaluate({"c": child, "p": parent}, rules).collect()}
    odd = sum(1 for i in range(300) if i % 9 and (i % 40) % 2) + 1
    assert got == {("c", "id", "unique"): 1, ("c", "parent", "relationships"): odd, ("p", "key", "unique"): 20, ("p", "key", "relationships"): 0}
