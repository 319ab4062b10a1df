import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from clinloom.operators.store import TableStore
from clinloom.plans import jobs
from clinloom.sources.mllp import write_messages
from clinloom.sources.schemas import RELATIONAL
from clinloom.streaming.hl7_feed import current_tables, message_log, start_feed
from clinloom.streaming.hl7_tables import start_tables
from testbed.bed import Bed
from testbed.queries import write_sources

SMALL = "/root/testdata/sf0.001"
PERIOD = ("1995-01-01", "1998-12-31")


def adt(number, name="Doe", kind="ADT^A01"):
    visit = "PV1|1|I|||||n||||||||||||V" + number
    return f"MSH|^~\\&|S|F|W|A|20240101||{kind}|{number}|P|2.3\nPID|1||M||{name}^J||19800101|F\n{visit}"


def raw(store, table):
    return jobs.raw_table(store, table).read()


def send(spark, folder, *messages):
    write_messages(spark.createDataFrame([(m,) for m in messages], "message string").coalesce(1), folder)


def names(spark, log):
    return {r.message_id: r.patient_last_name for r in current_tables(spark, log)["hl7_admissions"].collect()}


def test_feed_takes_new_files_only_and_redelivery_replaces(spark, tmp_path):
    landing, log, state = (f"{tmp_path}/{x}" for x in ("landing", "log", "state"))
    send(spark, f"{landing}/one", adt("1"), adt("2"), adt("9", kind="ZZZ"))

    def run():
        start_feed(spark, f"{landing}/*", log, state, max_files=1).awaitTermination()

    run()
    assert names(spark, log) == {"1": "Doe", "2": "Doe"}
    run()
    assert message_log(spark, log).count() == 3
    send(spark, f"{landing}/two", adt("2", "Roe"), adt("3"))
    run()
    assert names(spark, log) == {"1": "Doe", "2": "Roe", "3": "Doe"}
    assert message_log(spark, log).where("route = 'unknown'").count() == 1


def test_nothing_is_kept_twice_once_a_batch_has_landed(spark, tmp_path):
    landing, log, state = (str(tmp_path / part) for part in ("landing", "log", "state"))
    send(spark, landing, adt("1"), adt("2", kind="ADT^A03"))
    start_feed(spark, landing, log, state).awaitTermination()
    start_tables(spark, log, f"{state}-tables", TableStore(spark, str(tmp_path / "warehouse")), dt.datetime(2026, 1, 1)).awaitTermination()
    assert message_log(spark, log).count() == 2
    assert not any(files for part in ("state/pieces", "state-tables/batch", "state-tables/rows") for _, _, files in os.walk(tmp_path / part))


def test_tagged_rows_go_once_they_are_loaded(spark, tmp_path):
    day = dt.datetime(2024, 1, 1)
    for name in RELATIONAL:
        spark.createDataFrame([], RELATIONAL[name]).write.parquet(f"{tmp_path}/extracts/{name}")
    state = spark.createDataFrame([("s1", "01", "Ohio", None, 7, day, day), ("s2", "01", "Iowa", None, 7, day, day)], RELATIONAL["states"])
    state.write.mode("overwrite").parquet(f"{tmp_path}/extracts/states")
    store, shared = TableStore(spark, f"{tmp_path}/warehouse"), spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    loaded = jobs.load_source(spark, "oltp", jobs.Places(extracts=f"{tmp_path}/extracts"), store, dt.datetime(2026, 1, 1))
    assert not set(os.listdir(shared)) - before
    assert [r.id for r in loaded["states"].collect()] == ["s1"] and raw(store, jobs.QUARANTINE).count() == 1


def test_a_new_checkpoint_neither_replaces_nor_hides_messages(spark, tmp_path):
    landing, log = f"{tmp_path}/landing", f"{tmp_path}/log"

    def run(state):
        start_feed(spark, f"{landing}/*", log, f"{tmp_path}/{state}").awaitTermination()
        return [r.n for r in message_log(spark, log).groupBy("landed_at").agg(F.count("*").alias("n")).orderBy("landed_at").collect()]

    send(spark, f"{landing}/one", adt("1"))
    assert run("first") == [1]
    send(spark, f"{landing}/two", adt("2"), adt("1", "Roe"))
    assert run("second") == [1, 3]
    send(spark, f"{landing}/three", adt("3"))
    assert run("first") == [1, 3, 3]
    assert names(spark, log).keys() == {"1", "2", "3"}


def test_file_names_are_taken_literally(spark, tmp_path):
    landing, log = tmp_path / "landing", f"{tmp_path}/log"
    landing.mkdir()
    for name in ("a[1].hl7", "b{x,y}.hl7", "c d?.hl7"):
        (landing / name).write_text(f"\x0b{adt(name[0])}\x1c\r", newline="")
    start_feed(spark, str(landing), log, f"{tmp_path}/state").awaitTermination()
    assert names(spark, log).keys() == {"a", "b", "c"}


def test_one_route_reads_its_own_folders(spark, tmp_path):
    landing, log = f"{tmp_path}/landing", f"{tmp_path}/log"
    send(spark, landing, adt("1"), adt("2", kind="ADT^A03"))
    start_feed(spark, landing, log, f"{tmp_path}/state").awaitTermination()
    plan = current_tables(spark, log)["hl7_discharges"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(route" in plan


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("elt"))
    bed = Bed(spark, SMALL)
    places, store = write_sources(bed, base), TableStore(spark, f"{base}/warehouse")
    report = jobs.run_job(spark, "elt-all", places, store, *PERIOD, dt.datetime(2026, 1, 1), gate=False)
    return places, store, report


def test_all_rules_are_reported(spark, warehouse):
    _, _, report = warehouse
    rows = report.collect()
    assert len(rows) == 77
    assert {(r.table_name, r.column_name) for r in rows if r.failures} == {("fact_patient_encounters", "visit_number")}


def test_marts_hold_their_invariants(spark, warehouse):
    _, store, _ = warehouse
    load, physicians = (store.read(jobs.MARTS, t) for t in ("fact_provider_case_load", "dim_physician"))
    assert load.count() == load.select("physician_key").distinct().count() * 1461
    assert load.join(physicians, "physician_key", "left_anti").count() == 0
    stays = store.read(jobs.MARTS, "fact_patient_encounters")
    assert stays.count() >= raw(store, "hl7_admissions").count()
    pairs = spark.table("int_appointment_utilization").join(
        store.read(jobs.MARTS, "dim_provider").select(F.col("npi").alias("provider_npi")), "provider_npi", "left_semi"
    )
    total = store.read(jobs.MARTS, "fact_patient_utilization").agg(F.sum("total_appointments")).first()[0]
    assert total == pairs.count()


def test_second_load_changes_nothing(spark, warehouse):
    places, store, _ = warehouse
    before = {t: raw(store, t).count() for t in ("cases", "contacts_csv", "contacts", "fhir_patients", "hl7_lab_results")}
    assert jobs.run_job(spark, "el-all", places, store, *PERIOD, dt.datetime(2026, 1, 2)) is None
    after = {t: raw(store, t).count() for t in before}
    assert before == after and jobs.raw_table(store, "cases").version() == 2
    assert [r[0] for r in raw(store, "cases").select("_sdc_table_version").distinct().collect()] == [2]
    # Messages that were taken in already are not parsed again.
    assert [r[0] for r in raw(store, "hl7_lab_results").select("_sdc_table_version").distinct().collect()] == [1]


def test_the_gate_stops_on_failures(spark, warehouse):
    places, store, _ = warehouse
    with pytest.raises(jobs.QualityError, match="fact_patient_encounters.visit_number unique"):
        jobs.run_job(spark, "elt-postgres", places, store, *PERIOD, dt.datetime(2026, 1, 3))


def test_relational_job_alone(spark, warehouse, tmp_path):
    places, _, _ = warehouse
    store = TableStore(spark, str(tmp_path))
    report = jobs.run_job(spark, "elt-postgres", places, store, *PERIOD, dt.datetime(2026, 1, 1))
    assert {r.table_name for r in report.collect()} >= {"stg_oltp__cases", "fact_provider_case_load", "dim_provider"}
    assert not store.exists(jobs.MARTS, "dim_patient")
    with pytest.raises(ValueError):
        jobs.extract(spark, "nowhere", places)


def test_day_filter_reaches_the_fact_files(spark, warehouse):
    _, store, _ = warehouse
    plan = store.read(jobs.MARTS, "fact_provider_case_load").where("date_key = date'1997-06-15'")
    assert "EqualTo(date_key,1997-06-15)" in plan._jdf.queryExecution().executedPlan().toString()
