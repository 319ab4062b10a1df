"""Bucketed tables, the stream into the raw HL7 tables, and the quarantine."""

import datetime as dt
import os
import time
import zlib

import pytest
from pyspark.sql import functions as F

from clinloom.operators import buckets as buckets_module
from clinloom.operators.buckets import BucketedTable, newest
from clinloom.operators.quality import Rule
from clinloom.operators.quarantine import split, with_reasons
from clinloom.operators.store import TableStore
from clinloom.session import SHUFFLE_CLEANUP, passing_shuffles
from clinloom.streaming import hl7_tables
from clinloom.streaming.hl7_feed import current_tables, message_log, start_feed
from clinloom.streaming.hl7_tables import REJECTS, start_tables, target
from test_jobs import adt, send

AT = dt.datetime(2026, 1, 1)


# Buckets


@pytest.fixture
def table(spark, tmp_path):
    return BucketedTable(TableStore(spark, str(tmp_path)), "raw", "t", ["a", "b"], buckets=8)


def batch(spark, *rows):
    return spark.createDataFrame(rows, "a int, b string, v string, at int")


def files_of(table):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(table.place) for f in names if f.endswith(".parquet")}


def test_upsert_replaces_by_key_and_keeps_the_rest(spark, rows, table):
    assert not table.exists() and table.version() == 0
    table.upsert(batch(spark), ["at"])
    assert table.exists() and rows(table.read()) == [] and table.read().columns == ["a", "b", "v", "at"]
    table.upsert(batch(spark, (1, "x", "old", 1), (1, "y", "stays", 1), (1, "x", "older", 0)), ["at"])
    assert rows(table.read()) == [(1, "x", "old", 1), (1, "y", "stays", 1)]
    second = batch(spark, (1, "x", "newer", 3), (1, "x", "new", 2), (2, "z", "added", 2), (2, "z", "added", 2))
    for _ in range(2):
        table.upsert(second, ["at"])
        assert rows(table.read()) == [(1, "x", "newer", 3), (1, "y", "stays", 1), (2, "z", "added", 2)]


def test_untouched_files_keep_their_times(spark, table):
    table.upsert(spark.range(400).select(F.col("id").cast("int").alias("a"), F.lit("b").alias("b"), F.lit("v").alias("v"), F.lit(1).alias("at")), ["at"])
    before = files_of(table)
    assert len(before) == 8
    table.upsert(batch(spark, (7, "b", "new", 2)), ["at"])
    after = files_of(table)
    assert len(after) == 8 and sum(after.get(path) == time for path, time in before.items()) == 7
    assert table.read().where("v = 'new'").count() == 1 and table.read().count() == 400
    plan = table._rows().where("bucket in (3)")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan


def test_a_null_in_a_key_is_an_error(spark, rows, table):
    table.upsert(batch(spark, (1, "x", "old", 1)), ["at"])
    with pytest.raises(Exception, match="null in a, b"):
        table.upsert(batch(spark, (1, "x", "new", 2), (1, None, "no", 2)), ["at"])
    assert rows(table.read()) == [(1, "x", "old", 1)]


def test_an_earlier_batch_that_comes_again_changes_nothing(spark, rows, table):
    for value, at in (("first", 1), ("second", 2), ("first", 1)):
        table.upsert(batch(spark, (1, "x", value, at), (at, "own", value, at)), ["at"], newer_only=True)
    assert rows(table.read()) == [(1, "own", "first", 1), (1, "x", "second", 2), (2, "own", "second", 2)]


def test_columns_may_be_added(spark, table):
    table.upsert(batch(spark, *((i, "x", "v", 1) for i in range(20))), ["at"])
    table.upsert(batch(spark, (1, "x", "w", 2)).withColumn("more", F.lit(5)), ["at"])
    assert {r.a: r.more for r in table.read().collect() if r.more} == {1: 5}


def test_a_job_lost_while_it_copies_is_completed(spark, rows, table, monkeypatch):
    table.upsert(batch(spark, *((i, "x", "old", 1) for i in range(30))), ["at"])
    new = batch(spark, *((i, "x", "new", 2) for i in range(10, 40)))
    # Lost before the copy, and after buckets of the table are gone.
    with monkeypatch.context() as patch:
        patch.setattr(BucketedTable, "recover", lambda self: None)
        table.upsert(new, ["at"])
    for path in sorted(files_of(table))[:4]:
        os.remove(path)
    want = [(i, "x", "old" if i < 10 else "new", 1 if i < 10 else 2) for i in range(40)]
    assert rows(table.read()) == sorted(want, key=repr)
    assert not os.path.exists(table.pending)


def test_a_job_lost_before_its_buckets_are_whole_leaves_the_table(spark, rows, table):
    table.upsert(batch(spark, (1, "x", "old", 1)), ["at"])
    failing = batch(spark, (1, "x", "new", 2)).withColumn("v", F.when(F.col("at") == 2, F.raise_error(F.lit("lost"))).cast("string"))
    with pytest.raises(Exception, match="lost"):
        table.upsert(failing, ["at"])
    assert rows(table.read()) == [(1, "x", "old", 1)]
    table.upsert(batch(spark, (1, "x", "new", 2)), ["at"])
    assert rows(table.read()) == [(1, "x", "new", 2)]


def test_whole_rows_are_not_sorted_to_be_aggregated(spark):
    many = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("at"), F.lit("text").alias("v"))
    plan = newest(many, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    # Copies of a key are cut down before the shuffle.
    assert plan.index("WindowGroupLimit", plan.index("Exchange hashpartitioning")) > 0
    assert sorted(tuple(r) for r in newest(many, ["k"], ["at"]).collect()) == [(0, 998, "text"), (1, 999, "text")]


@pytest.mark.parametrize("copies, shuffles", [(1, 1), (9000, 2)])
def test_a_first_load_is_shuffled_once_unless_a_key_is_hot(spark, table, monkeypatch, copies, shuffles):
    plans, write = [], BucketedTable._write

    def seen(self, rows, place):
        plans.append(rows.repartition("bucket")._jdf.queryExecution().executedPlan().toString())
        write(self, rows, place)

    monkeypatch.setattr(BucketedTable, "_write", seen)
    hot = spark.range(copies).select(F.lit(1).alias("a"), F.lit("hot").alias("b"), F.lit("v").alias("v"), F.col("id").cast("int").alias("at"))
    others = spark.range(4000).select(F.col("id").cast("int").alias("a"), F.lit("b").alias("b"), F.lit("v").alias("v"), F.lit(1).alias("at"))
    table.upsert(hot.union(others), ["at"])
    assert plans[0].count("Exchange") == shuffles
    assert table.read().count() == 4001 and table.read().where("b = 'hot'").first().at == copies - 1


# HL7 messages into tables


class Feed:
    def __init__(self, spark, base):
        self.spark, self.base, self.store = spark, str(base), TableStore(spark, f"{base}/warehouse")

    def land(self, name, *messages):
        send(self.spark, f"{self.base}/landing/{name}", *messages)
        start_feed(self.spark, f"{self.base}/landing/*", f"{self.base}/log", f"{self.base}/state").awaitTermination()

    def load(self, **options):
        query = start_tables(self.spark, f"{self.base}/log", f"{self.base}/tables", self.store, AT, **options)
        query.awaitTermination()
        return query

    def rows(self, name="hl7_admissions"):
        return sorted(tuple(r) for r in target(self.store, name).read().drop("_sdc_table_version").collect())

    def dropped(self, query):
        return sum(int(s.customMetrics.get("numDroppedDuplicateRows", 0)) for p in query.recentProgress for s in p.stateOperators)

    def same_as_the_log(self):
        """The rows are those of all messages in the log, taken at once."""
        for name, want in current_tables(self.spark, f"{self.base}/log").items():
            if target(self.store, name).exists():
                columns = want.columns
                assert sorted(map(tuple, target(self.store, name).read().select(columns).collect())) == sorted(map(tuple, want.collect()))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_a_message_that_comes_again_is_dropped_in_the_stream(feed):
    feed.land("one", adt("1"), adt("2"), adt("3", kind="ADT^A03"))
    first = feed.load()
    assert feed.dropped(first) == 0
    held = feed.rows()
    feed.land("two", adt("1"), adt("2"), adt("2"), adt("4"))
    second = feed.load()
    assert feed.dropped(second) == 3
    assert [r for r in feed.rows() if r[0] != "4"] == held and len(feed.rows()) == 3
    assert message_log(feed.spark, f"{feed.base}/log").count() == 7
    feed.same_as_the_log()


def test_a_correction_replaces_and_an_old_delivery_does_not(feed):
    feed.land("one", adt("1"), adt("2"))
    feed.load()
    feed.land("two", adt("1", "Roe"))
    feed.load()
    assert {r[0]: r[2] for r in feed.rows()} == {"1": "Roe", "2": "Doe"}
    feed.same_as_the_log()


def test_state_is_bounded_by_the_horizon(feed):
    feed.land("one", *(adt(str(i)) for i in range(50)))
    held = feed.load(horizon="1 second")
    assert held.recentProgress[-1].stateOperators[0].numRowsTotal <= 50
    for name in ("two", "three"):
        time.sleep(2.5)
        feed.land(name, adt(name))
        last = feed.load(horizon="1 second")
    assert last.recentProgress[-1].stateOperators[0].numRowsTotal < 10
    # A message that comes again later than the horizon is parsed again, and changes nothing.
    feed.land("five", *(adt(str(i)) for i in range(50)))
    again = feed.load(horizon="1 second")
    assert feed.dropped(again) < 50 and len(feed.rows()) == 52
    assert all(s.numRowsDroppedByWatermark == 0 for q in (held, last, again) for p in q.recentProgress for s in p.stateOperators)
    feed.same_as_the_log()


def test_a_job_that_stops_between_two_outputs_is_completed(feed, monkeypatch):
    feed.land("one", adt("1"), adt("2", kind="ADT^A03"), adt("3", kind="ZZZ"))
    feed.load()
    feed.land("two", adt("1", "Roe"), adt("4", kind="ADT^A03"), adt("5", kind="ZZZ"), adt("6"))
    upsert, done = BucketedTable.upsert, []

    def stopping(self, *args, **options):
        if done:
            raise RuntimeError("stopped")
        done.append(self.table)
        return upsert(self, *args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(buckets_module.BucketedTable, "upsert", stopping)
        with pytest.raises(Exception, match="stopped"):
            feed.load()
    assert len(done) == 1
    feed.load()
    feed.same_as_the_log()
    assert [r[0] for r in feed.rows()] == ["1", "6"] and [r[0] for r in feed.rows("hl7_discharges")] == ["2", "4"]
    assert [r[0] for r in feed.rows(REJECTS)] == ["3", "5"]


def test_rejects_are_an_output_with_reasons(feed):
    broken = adt("7").replace("\nPID|1||M||Doe^J||19800101|F", "")
    feed.land("one", adt("1"), adt("2", kind="ZZZ"), broken, "no header at all")
    feed.land("two", broken, "no header at all", adt("2", "Roe", kind="ZZZ"))
    feed.load(max_files=1)
    kept = sorted((r.control_id, r.message_type, r.reason) for r in target(feed.store, REJECTS).read().collect())
    unknown = hl7_tables.UNKNOWN_TYPE
    assert kept == [("", "", unknown), ("2", "ZZZ", unknown), ("2", "ZZZ", unknown), ("7", "ADT^A01", "PID missing or short")]


# Disk


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def left_over(spark, before):
    """Shuffle files that are new and stay; they are deleted in the background."""
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def test_shuffles_go_with_the_step_that_made_them(spark, rows, table, tmp_path):
    new, parent = batch(spark, *((i, "x", "old", 1) for i in range(30))), spark.createDataFrame([(1,), (2,)], "key int")
    before = shuffle_files(spark)
    table.upsert(new, ["at"])
    table.upsert(new, ["at"], newer_only=True)
    TableStore(spark, str(tmp_path)).write(new.repartition(3, "a"), "s", "t")
    accepted, others = split(new, "t", [Rule("t", "a", "unique"), Rule("t", "a", "relationships", parent="p", parent_column="key")], ["a", "b"], {"p": parent}, f"{tmp_path}/tagged")
    assert not left_over(spark, before)
    # Frames that are not written here can run again.
    assert [accepted.count(), others.count(), accepted.count()] == [2, 28, 2]
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"


def test_shuffles_pass_until_the_last_step_has_ended(spark):
    before = shuffle_files(spark)
    one, other = passing_shuffles(spark), passing_shuffles(spark)
    one.__enter__()
    other.__enter__()
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    found = sorted(counted.collect())
    assert len(found) == 7 and not left_over(spark, before)
    one.__exit__(None, None, None)
    assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    other.__exit__(None, None, None)
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    # A frame that runs again makes its shuffles again.
    assert sorted(counted.collect()) == found and counted.count() == 7


def test_a_stream_keeps_neither_its_shuffle_nor_messages_that_are_parsed(feed, monkeypatch):
    broken = adt("7").replace("\nPID|1||M||Doe^J||19800101|F", "")
    feed.land("one", adt("1"), adt("2", kind="ADT^A03"), adt("3", kind="ZZZ"), broken)
    before, upsert, seen = shuffle_files(feed.spark), BucketedTable.upsert, []

    def looking(self, *args, **options):
        held = {name for name in ("hl7_admissions", "hl7_discharges") if os.path.exists(f"{feed.base}/tables/batch/route={name}")}
        seen.append((self.table, left_over(feed.spark, before), held))
        return upsert(self, *args, **options)

    monkeypatch.setattr(buckets_module.BucketedTable, "upsert", looking)
    feed.load()
    assert seen == [("hl7_admissions", set(), {"hl7_discharges"}), ("hl7_discharges", set(), set()), (REJECTS, set(), set())]
    feed.same_as_the_log()
    assert sorted(r[0] for r in feed.rows(REJECTS)) == ["3", "7"]


def test_messages_land_and_are_remembered_in_little_space(feed, tmp_path):
    messages = [adt(str(i), f"Name{i % 7}", kind=("ADT^A01", "ADT^A03", "ZZZ")[i % 3]) for i in range(3000)]
    feed.land("one", *messages)
    sent = sum(os.path.getsize(tmp_path / "landing/one" / f) for f in os.listdir(tmp_path / "landing/one") if f.endswith(".gz"))
    assert sent < 0.95 * len(zlib.compress("\x1c\r".join("\x0b" + m for m in messages).encode(), 1))
    fresh = hl7_tables.fresh_messages(feed.spark, f"{feed.base}/log")
    # Rows are alike up to their ends, for the shuffle.
    assert fresh.columns[-3:] == ["control_id", "digest", "message"] and sorted(fresh.columns) == sorted([*message_log(feed.spark, f"{feed.base}/log").columns, "digest"])
    assert feed.spark.conf.get("spark.sql.streaming.stateStore.rocksdb.compression") == "zstd"
    feed.load()
    feed.same_as_the_log()


# Quarantine


RULES = [
    Rule("t", "id", "unique"),
    Rule("t", "npi", "unique"),
    Rule("t", "npi", "not_null"),
    Rule("t", "kind", "accepted_values", values=("NP", "PA")),
    Rule("t", "boss", "relationships", parent="p", parent_column="key"),
    Rule("t", "boss", "relationships", parent="elsewhere", parent_column="key"),
]
ROWS = [
    (1, "n1", "NP", 1),
    (2, "n1", "PA", None),
    (3, None, "XX", 9),
    (None, "n4", None, 2),
    (5, "n5", "NP", 9),
    (6, "n6", "PA", 2),
    (6, "n6", "PA", 2),
]


def test_rows_get_all_their_reasons(spark):
    df = spark.createDataFrame(ROWS, "id int, npi string, kind string, boss int")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "key int")
    tagged = with_reasons(df, RULES, ["id"], {"p": parent})
    assert tagged.columns == [*df.columns, "_reasons"] and tagged.count() == len(ROWS)
    assert sorted(((r.id or 0, r._reasons) for r in tagged.collect())) == [
        (0, ["id not_null"]),
        (1, []),
        (2, ["npi unique"]),
        (3, ["npi not_null", "kind accepted_values", "boss relationships"]),
        (5, ["boss relationships"]),
        (6, []),
        (6, []),
    ]


def test_split_keeps_every_row_in_one_part(spark, rows):
    df = spark.createDataFrame(ROWS, "id int, npi string, kind string, boss int")
    parent = spark.createDataFrame([(1,), (2,)], "key int")
    accepted, others = split(df, "t", RULES, ["id"], {"p": parent})
    assert rows(accepted) == [(1, "n1", "NP", 1), (6, "n6", "PA", 2), (6, "n6", "PA", 2)]
    assert accepted.schema == df.schema and others.columns == ["table_name", "reasons", "record", "digest"]
    assert others.count() == 4
    record = others.where("array_contains(reasons, 'id not_null')").first().record
    assert record == '{"id":null,"npi":"n4","kind":null,"boss":2}'
    # Without rules only the key is asked for.
    assert split(df, "t", [], ["id"], {})[1].count() == 1
    assert [part.count() for part in split(df.limit(0), "t", RULES, ["id"], {"p": parent})] == [0, 0]
