"""User-level jobs: load sources into raw tables, build the models, check the rules."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinloom.operators.buckets import BucketedTable
from clinloom.operators.keyed import BATCHED, with_load_metadata
from clinloom.operators.quality import evaluate, with_defaults
from clinloom.operators.quarantine import split
from clinloom.operators.store import TableStore
from clinloom.session import discard, passing_shuffles, scratch_dir
from clinloom.plans import intermediate, marts
from clinloom.plans.rules import MART_RULES, SOURCE_RULES, STAGING_RULES
from clinloom.plans.staging import STAGING
from clinloom.sources.catalog import RAW, TABLES, select_streams, tables_of
from clinloom.sources.csv_drops import read_csv_drop
from clinloom.sources.documents import raw_resources, read_bundles, read_crm
from clinloom.sources.relational import read_extract, read_jdbc
from clinloom.sources.schemas import FHIR, RELATIONAL, RELATIONAL_DEFAULTS
from clinloom.streaming.hl7_feed import start_feed
from clinloom.streaming.hl7_tables import start_tables

MARTS = "marts"
# Rows that broke a constraint of their source, of all raw tables.
QUARANTINE = "quarantine"
# Rows of these facts are ordered inside each file, so reports on one day skip row groups.
SORTED_BY = {"fact_provider_case_load": ["date_key"], "fact_patient_utilization": ["date_key"]}

SOURCES = ("oltp", "s3_landing", "hubspot", "emr", "hl7_engine")
# Job -> (sources, whether models and rules follow).
JOBS = {
    "el-postgres": (("oltp",), False),
    "el-s3": (("s3_landing",), False),
    "el-hubspot": (("hubspot",), False),
    "el-emr": (("emr",), False),
    "el-hl7": (("hl7_engine",), False),
    "el-all": (SOURCES, False),
    "elt-postgres": (("oltp",), True),
    "elt-all": (SOURCES, True),
}


class QualityError(Exception):
    """A rule has failures; ``report`` holds the failing rows of the rule report."""

    def __init__(self, report: list):
        super().__init__("; ".join(f"{r.table_name}.{r.column_name} {r.rule}: {r.failures}" for r in report))
        self.report = report


@dataclass(frozen=True)
class Places:
    """Where the sources are. With ``jdbc_url`` the relational tables are read from the database."""

    extracts: str = ""
    drops: str = ""
    crm: str = ""
    bundles: str = ""
    landing: str = ""
    feed_log: str = ""
    feed_checkpoint: str = ""
    jdbc_url: str = ""
    jdbc_properties: dict = field(default_factory=dict)
    since: str = "2024-01-01T00:00:00Z"
    streams: tuple[str, ...] = tuple(f"public-{table}.*" for table in RELATIONAL)
    multi_line: bool = True


def extract(spark: SparkSession, source: str, places: Places) -> dict[str, DataFrame]:
    """Rows of a source's raw tables, before load columns; lazy. The HL7 feed is a stream and has no extract."""
    if source == "oltp":
        return _extract_relational(spark, places)
    if source == "s3_landing":
        names = {"contacts_csv": r"contacts\.csv", "deals_csv": r"deals\.csv"}
        return {
            table: read_csv_drop(spark, places.drops, "hubspot/", pattern, modified_after=places.since, multi_line=True)
            for table, pattern in names.items()
        }
    if source == "hubspot":
        return {"contacts": read_crm(spark, f"{places.crm}/contacts", "contacts", places.since, places.multi_line)}
    if source == "emr":
        return {
            stream: raw_resources(read_bundles(spark, f"{places.bundles}/{stream}", stream, places.multi_line))
            for stream in FHIR
        }
    raise ValueError(f"unknown source: {source}")


def _extract_relational(spark: SparkSession, places: Places) -> dict[str, DataFrame]:
    streams = {}
    for table in RELATIONAL:
        if places.jdbc_url:
            frame = read_jdbc(spark, places.jdbc_url, table, properties=places.jdbc_properties)
        else:
            frame = read_extract(spark, places.extracts, table)
        streams[f"public-{table}"] = with_defaults(frame, RELATIONAL_DEFAULTS[table])
    chosen = select_streams(streams, places.streams, schemas=["public"])
    return {stream.removeprefix("public-"): frame for stream, frame in chosen.items()}


def raw_table(store: TableStore, name: str) -> BucketedTable:
    """A raw table; its name says its source, since names are unique."""
    if name == QUARANTINE:
        return BucketedTable(store, RAW, name, ["table_name", "digest"])
    table = next(table for table in TABLES.values() if table.name == name and table.extracted)
    return BucketedTable(store, RAW, name, list(table.keys), table.buckets)


def load_source(spark: SparkSession, source: str, places: Places, store: TableStore, at: dt.datetime) -> dict[str, DataFrame]:
    """Merge one source into its raw tables by key; rows absent from the source stay.

    Rows that break a constraint of their source, or lack a key, go to the quarantine table with the reasons. Tables are
    loaded after those they refer to, so a reference is looked up among all rows that were ever accepted.
    """
    if source == "hl7_engine":
        return _load_hl7(spark, places, store, at)
    loaded = {}
    for name, frame in extract(spark, source, places).items():
        table, rules = raw_table(store, name), [rule for rule in SOURCE_RULES if source == "oltp" and rule.table == name]
        parents = {rule.parent: raw_table(store, rule.parent) for rule in rules if rule.parent}
        held = {parent: frame.read() for parent, frame in parents.items() if frame.exists()}
        tagged = scratch_dir(spark, f"tagged-{name}")
        accepted, others = split(frame, name, rules, table.keys, held, tagged)
        table.upsert(with_load_metadata(accepted, at, table.version() + 1), [BATCHED])
        raw_table(store, QUARANTINE).upsert(with_load_metadata(others, at, table.version()), [BATCHED])
        discard(spark, tagged)
        if table.exists():
            loaded[name] = table.read()
    return loaded


def _load_hl7(spark: SparkSession, places: Places, store: TableStore, at: dt.datetime) -> dict[str, DataFrame]:
    """Take new landing files into the message log, then what is new in the log into the raw tables."""
    start_feed(spark, places.landing, places.feed_log, places.feed_checkpoint).awaitTermination()
    start_tables(spark, places.feed_log, f"{places.feed_checkpoint}-tables", store, at).awaitTermination()
    tables = {table.name: raw_table(store, table.name) for table in tables_of("hl7_engine")}
    return {name: table.read() for name, table in tables.items() if table.exists()}


def staging_views(store: TableStore) -> dict[str, DataFrame]:
    """Staging models over the raw tables that exist, also registered as views."""
    views = {}
    for model, (name, build) in STAGING.items():
        table = raw_table(store, name)
        if table.exists():
            views[model] = build(table.read())
            views[model].createOrReplaceTempView(model)
    return views


def intermediate_views(stg: dict[str, DataFrame], start_date: dt.date | str, as_of: dt.date | str) -> dict:
    """Intermediate models, lazily, also registered as views."""
    cases, reviews, providers = (stg[f"stg_oltp__{t}"] for t in ("cases", "case_reviews", "providers"))
    views = {
        "int_case_review_status": intermediate.int_case_review_status(cases, reviews, providers, as_of),
        "int_physician_daily_metrics": intermediate.int_physician_daily_metrics(
            cases, reviews, providers, start_date, as_of
        ),
    }
    if "stg_emr__encounters" in stg:
        encounters = stg["stg_emr__encounters"]
        views["int_appointment_utilization"] = intermediate.int_appointment_utilization(
            stg["stg_emr__appointments"], encounters, providers
        )
        views["int_provider_panel_metrics"] = intermediate.int_provider_panel_metrics(encounters, providers)
        if "stg_hl7__admissions" in stg:
            views["int_patient_encounters"] = intermediate.int_patient_encounters(
                stg["stg_hl7__admissions"], stg["stg_hl7__discharges"], stg["stg_emr__patients"], encounters
            )
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return views


def build_marts(
    store: TableStore, stg: dict[str, DataFrame], start_date: dt.date | str, as_of: dt.date | str
) -> dict[str, DataFrame]:
    """Write the marts in dependency order; each later mart reads the written earlier ones.

    Of a mart's older versions the last one stays, for reports that still read it.
    """
    built: dict[str, DataFrame] = {}

    def publish(name: str, frame: DataFrame) -> DataFrame:
        built[name] = store.write(frame, MARTS, name, sort_by=SORTED_BY.get(name))
        store.expire(MARTS, name, keep=2)
        return built[name]

    states, physicians, providers = (stg[f"stg_oltp__{t}"] for t in ("states", "physicians", "providers"))
    publish("dim_state", marts.dim_state(states))
    dim_physician = publish("dim_physician", marts.dim_physician(physicians, states))
    dim_provider = publish("dim_provider", marts.dim_provider(providers, dim_physician, states))
    publish(
        "fact_provider_case_load",
        marts.fact_provider_case_load(
            stg["stg_oltp__cases"], stg["stg_oltp__case_reviews"], providers, dim_physician, start_date, as_of
        ),
    )
    if "stg_emr__encounters" in stg:
        patients, appointments, encounters = (stg[f"stg_emr__{t}"] for t in ("patients", "appointments", "encounters"))
        dim_patient = publish("dim_patient", marts.dim_patient(patients, encounters))
        publish(
            "fact_patient_utilization", marts.fact_patient_utilization(appointments, encounters, dim_provider)
        )
        if "stg_hl7__admissions" in stg:
            publish(
                "fact_patient_encounters",
                marts.fact_patient_encounters(
                    stg["stg_hl7__admissions"],
                    stg["stg_hl7__discharges"],
                    patients,
                    encounters,
                    dim_patient,
                    dim_provider,
                    dim_physician,
                ),
            )
    return built


def rule_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Failures of every declared rule whose table was built."""
    return evaluate(tables, [rule for rule in (*STAGING_RULES, *MART_RULES) if rule.table in tables])


def run_job(
    spark: SparkSession,
    job: str,
    places: Places,
    store: TableStore,
    start_date: dt.date | str,
    as_of: dt.date | str,
    at: dt.datetime,
    gate: bool = True,
) -> DataFrame | None:
    """Run a job; where it ends with rules, return their report, or raise when ``gate`` is on and a rule fails."""
    sources, transform = JOBS[job]
    for source in sources:
        load_source(spark, source, places, store, at)
    if not transform:
        return None
    stg = staging_views(store)
    intermediate_views(stg, start_date, as_of)
    built = build_marts(store, stg, start_date, as_of)
    with passing_shuffles(spark):
        report = rule_report({**stg, **built})
        # One row for each declared rule.
        found = report.collect()
    failing = [row for row in found if row.failures]
    if gate and failing:
        raise QualityError(failing)
    return spark.createDataFrame(found, report.schema)
