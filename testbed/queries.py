"""The registered queries: name -> callable, and name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinloom.functions import as_uuid, hl7_timestamp, json_text
from clinloom.operators import hl7, keyed, quality, quarantine
from clinloom.operators.buckets import BucketedTable
from clinloom.operators.spine import days
from clinloom.operators.store import TableStore
from clinloom.operators.surrogate import surrogate_key
from clinloom.plans import intermediate, jobs, marts, reports, rules, staging
from clinloom.session import passing_shuffles, scratch_dir, tune
from clinloom.sources.catalog import register_views, select_streams
from clinloom.sources.csv_drops import contact_rows, deal_rows, read_csv_drop, write_csv_drop
from clinloom.sources.documents import raw_resources, read_bundles, read_crm, read_parsed_hl7
from clinloom.sources.mllp import read_messages, write_messages
from clinloom.streaming.hl7_feed import current_tables, start_feed, table_counts
from clinloom.streaming.hl7_tables import REJECTS, UNKNOWN_TYPE, start_tables, target
from testbed import oracle
from testbed.bed import LOADED_AT, Bed
from testbed.flat import REVIEW_KEY, duck_ctes, uuid_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DAYS = {"start_date": oracle.START_DATE, "as_of": oracle.AS_OF}


def comparable(df: DataFrame) -> DataFrame:
    """Dates as text and decimals as doubles, which both engines give in one form; load columns are left out."""
    columns = []
    for field in df.schema.fields:
        if field.name in keyed.LOAD_COLUMNS:
            continue
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None):
    """Register a function of a test bed; its frame is made comparable."""

    def register(build: Callable[[Bed], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(Bed(tune(spark), sf_dir)))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return build

    return register


# Raw tables and staging

COUNTED = {
    "states": "nation",
    "physicians": "supplier",
    "providers": "customer",
    "cases": "orders",
    "case_reviews": "lineitem",
    "fhir_patients": "customer",
    "fhir_appointments": "events",
    "fhir_encounters": "events where event_type in ('purchase', 'signup')",
    "contacts": "customer",
    "hl7_admissions": "orders",
    "hl7_discharges": "orders where o_orderstatus = 'F'",
}


@query(
    "load_raw",
    " union all ".join(f"select '{raw}' as table_name, count(*) as n_rows from {base}" for raw, base in COUNTED.items())
    + " union all select 'hl7_lab_results', sum(least(l_linenumber % 4, 3))::bigint from lineitem",
)
def load_raw(bed: Bed) -> DataFrame:
    """Documents and messages encoded, parsed and written as the raw tables that the models read."""
    return table_counts({table: bed.raw(table) for table in (*COUNTED, "hl7_lab_results")})


for _model in staging.STAGING:
    if _model not in ("stg_s3__contacts", "stg_hubspot__contacts"):
        query(_model, oracle.SQL[_model])(lambda bed, model=_model: bed.staged(model))


@query("stg_s3__contacts", oracle.SQL["stg_s3__contacts"])
def csv_contacts(bed: Bed) -> DataFrame:
    """Contacts written as a CSV drop and read back by prefix and pattern."""
    base = scratch_dir(bed.spark, "drops")
    write_csv_drop(contact_rows(bed.contacts()), f"{base}/hubspot/contacts.csv")
    rows = read_csv_drop(bed.spark, base, "hubspot/", r"contacts\.csv")
    return staging.stg_contacts_csv(bed.loaded(rows))


@query("stg_hubspot__contacts", oracle.SQL["stg_hubspot__contacts"])
def api_contacts(bed: Bed) -> DataFrame:
    """Contacts whose properties are JSON text, as a JSON column of the raw table."""
    raw = bed.raw("contacts")
    return staging.stg_contacts_api(raw.withColumn("properties", F.to_json("properties")))


@query(
    "contacts_since",
    f"{duck_ctes('contacts')} select * exclude (modified_at), modified_at as updated_at, 'api' as source_type "
    "from contacts where modified_at >= timestamp '2024-03-01'",
)
def contacts_since(bed: Bed) -> DataFrame:
    """CRM pages written as files and read from a start date on."""
    base = scratch_dir(bed.spark, "crm")
    bed.pages(bed.contacts(), F.col("id").cast("long"), "results").write.json(base)
    rows = read_crm(bed.spark, base, "contacts", since="2024-03-01T00:00:00Z", multi_line=False)
    return staging.stg_contacts_api(bed.loaded(rows))


@query("fhir_bundle_scan", oracle.SQL["stg_emr__appointments"])
def fhir_bundle_scan(bed: Bed) -> DataFrame:
    """Appointments in bundle pages, read back, flattened with JSON text arrays, and staged by JSON path."""
    base = scratch_dir(bed.spark, "bundles")
    number = F.substring_index("id", "-", -1).cast("long")
    bed.pages(bed.appointments(), number, "entry", "resource").write.json(base)
    resources = read_bundles(bed.spark, base, "fhir_appointments", multi_line=False)
    return staging.stg_appointments(bed.loaded(raw_resources(resources, arrays_as_json=True)))


@query("encounters_from_json_arrays", oracle.SQL["stg_emr__encounters"])
def encounters_from_json_arrays(bed: Bed) -> DataFrame:
    return staging.stg_encounters(bed.encoded("fhir_encounters", arrays_as_json=True))


@query("parsed_records_scan", oracle.SQL["stg_hl7__admissions"])
def parsed_records_scan(bed: Bed) -> DataFrame:
    """Admissions that arrive parsed already, in record lists."""
    base = scratch_dir(bed.spark, "records")
    rows = bed.raw("hl7_admissions").select(*staging.ADMISSION_COLUMNS)
    bed.pages(rows, F.substring("visit_number", 3, 20).cast("long"), "records").write.json(base)
    return staging.stg_admissions(
        bed.loaded(read_parsed_hl7(bed.spark, base, staging.ADMISSION_COLUMNS, multi_line=False))
    )


@query("json_props", "select event_id, json_extract_string(props, '$.k') as k from events")
def json_props(bed: Bed) -> DataFrame:
    return bed.base("events").select("event_id", json_text("props", "$.k").alias("k"))


# HL7 messages


@query(
    "hl7_route_counts",
    "select 'ADT^A01' as message_type, count(*) as n_messages from orders "
    "union all select 'ADT^A03', count(*) from orders where o_orderstatus = 'F' "
    "union all select 'ADT^A08', count(*) from orders where o_orderstatus = 'P' "
    "union all select 'ORU^R01', count(*) from lineitem",
)
def hl7_route_counts(bed: Bed) -> DataFrame:
    """All messages written as framed landing files, cut again in splits and typed."""
    base = scratch_dir(bed.spark, "landing")
    write_messages(bed.messages(), base)
    return hl7.route_counts(hl7.with_header(read_messages(bed.spark, base)))


@query(
    "hl7_abnormal_flags",
    f"{duck_ctes('lab_results')} select abnormal_flag as reported, abnormal_flag as computed, count(*) as n_results "
    "from lab_results group by all",
)
def hl7_abnormal_flags(bed: Bed) -> DataFrame:
    """Reported flags against flags recomputed from value and range."""
    computed = hl7.abnormal_flag(F.col("result_value"), F.col("reference_range"))
    rows = bed.staged("stg_hl7__lab_results").select(F.col("abnormal_flag").alias("reported"), computed.alias("computed"))
    return rows.groupBy("reported", "computed").agg(F.count("*").alias("n_results"))


@query(
    "hl7_stream_available_now",
    "select 'hl7_admissions' as table_name, count(*) as n_rows from orders "
    "union all select 'hl7_discharges', count(*) from orders where o_orderstatus = 'F' "
    "union all select 'hl7_lab_results', sum(least(l_linenumber % 4, 3))::bigint from lineitem",
)
def hl7_stream_available_now(bed: Bed) -> DataFrame:
    """Landing files through the stream; admissions are delivered twice and stay single."""
    base = scratch_dir(bed.spark, "feed")
    write_messages(bed.messages(), f"{base}/landing/first")
    write_messages(bed.admission_messages(), f"{base}/landing/second")
    query = start_feed(bed.spark, f"{base}/landing/*", f"{base}/log", f"{base}/state")
    query.awaitTermination()
    return table_counts(current_tables(bed.spark, f"{base}/log"))


CORRECTED = "cast(substr(message_id, 4) as bigint) % 5 = 0"


@query(
    "hl7_redelivery",
    f"{duck_ctes('admissions')} select * replace (if({CORRECTED}, 'X', patient_class) as patient_class) from admissions",
)
def hl7_redelivery(bed: Bed) -> DataFrame:
    """Admissions through both streams into their raw table; all come again, a fifth of them also corrected."""
    base = scratch_dir(bed.spark, "redelivery")
    store = TableStore(bed.spark, f"{base}/warehouse")
    sent = bed.admission_messages()
    corrected = F.regexp_replace("message", r"(?m)^PV1\|1\|[^|]*", "PV1|1|X").alias("message")
    fifth = F.regexp_extract("message", r"\|ADT(\d+)\|", 1).cast("long") % 5 == 0
    for number, messages in enumerate((sent, sent.unionByName(sent.where(fifth).select(corrected)))):
        write_messages(messages, f"{base}/landing/{number}")
        start_feed(bed.spark, f"{base}/landing/*", f"{base}/log", f"{base}/state").awaitTermination()
        start_tables(bed.spark, f"{base}/log", f"{base}/tables", store, LOADED_AT).awaitTermination()
    return staging.stg_admissions(target(store, "hl7_admissions").read())


DAMAGED = {
    "ADT^A01": ("'ADT' || o_orderkey", "PID", "select o_orderkey from orders where o_orderkey % 7 = 0"),
    "ORU^R01": (f"'ORU' || {REVIEW_KEY}", "OBR", "select * from lineitem where l_orderkey % 7 = 0"),
}


@query(
    "hl7_rejects",
    f"select 'UPD' || o_orderkey as control_id, 'ADT^A08' as message_type, '{UNKNOWN_TYPE}' as reason, count(*) as n_messages "
    "from orders where o_orderstatus = 'P' group by all "
    + " ".join(
        f"union all select distinct {key}, '{kind}', '{segment} missing or short', 1 from ({rows})" for kind, (key, segment, rows) in DAMAGED.items()
    ),
)
def hl7_rejects(bed: Bed) -> DataFrame:
    """Sound, unknown and damaged messages through both streams; what no raw table takes, with the reason."""
    base = scratch_dir(bed.spark, "rejects")
    store = TableStore(bed.spark, f"{base}/warehouse")
    number = F.coalesce(F.try_to_number(F.regexp_extract("message", r"\|(?:ADT|ORU)(\d+)[-|]", 1), F.lit("9999999999")), F.lit(1))
    without = [
        rows.where(number % 7 == 0).select(F.regexp_replace("message", rf"\n{segment}[^\n]*", "").alias("message"))
        for rows, segment in ((bed.admission_messages(), "PID"), (bed.lab_messages(), "OBR"))
    ]
    with passing_shuffles(bed.spark):
        write_messages(bed.messages().unionByName(without[0]).unionByName(without[1]), f"{base}/landing")
    start_feed(bed.spark, f"{base}/landing", f"{base}/log", f"{base}/state").awaitTermination()
    start_tables(bed.spark, f"{base}/log", f"{base}/tables", store, LOADED_AT).awaitTermination()
    kept = target(store, REJECTS).read()
    # Lines that share a key give messages that differ in their text alone.
    return kept.groupBy("control_id", "message_type", "reason").agg(F.lit(1).cast("long").alias("n_messages"))


@query(
    "hl7_timestamps",
    """select o_orderkey, case o_orderkey % 5 when 0 then t when 1 then date_trunc('minute', t)
      when 2 then date_trunc('day', t) when 4 then t end as parsed
    from (select o_orderkey, o_orderdate + interval '1' second * (o_orderkey % 86400) as t from orders)""",
)
def hl7_timestamps(bed: Bed) -> DataFrame:
    """HL7 times in full, to the minute, to the day, absent, and with fraction and zone."""
    moment = F.expr("o_orderdate + interval '1' second * (o_orderkey % 86400)")
    kind = F.col("o_orderkey") % 5
    text = (
        F.when(kind == 0, F.date_format(moment, "yyyyMMddHHmmss"))
        .when(kind == 1, F.date_format(moment, "yyyyMMddHHmm"))
        .when(kind == 2, F.date_format(moment, "yyyyMMdd"))
        .when(kind == 3, F.lit(""))
        .otherwise(F.concat(F.date_format(moment, "yyyyMMddHHmmss"), F.lit(".123-0500")))
    )
    return bed.base("orders").select("o_orderkey", hl7_timestamp(text).alias("parsed"))


@query("cast_uuid", f"select o_orderkey, {uuid_of('case', 'o_orderkey')} as id from orders")
def cast_uuid(bed: Bed) -> DataFrame:
    """UUIDs spelled in capitals, in braces and without hyphens."""
    plain = F.expr(uuid_of("case", "o_orderkey"))
    kind = F.col("o_orderkey") % 3
    spelled = (
        F.when(kind == 0, F.upper(plain))
        .when(kind == 1, F.concat(F.lit("{"), plain, F.lit("}")))
        .otherwise(F.regexp_replace(plain, "-", ""))
    )
    return bed.base("orders").select("o_orderkey", as_uuid(spelled).alias("id"))


# Intermediate models and marts


def _relational(bed: Bed) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(bed.staged(f"stg_oltp__{t}") for t in ("cases", "case_reviews", "providers"))


def _emr(bed: Bed) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(bed.staged(f"stg_emr__{t}") for t in ("patients", "appointments", "encounters"))


def _adt(bed: Bed) -> tuple[DataFrame, DataFrame]:
    return bed.staged("stg_hl7__admissions"), bed.staged("stg_hl7__discharges")


def _physicians(bed: Bed) -> DataFrame:
    return marts.dim_physician(bed.staged("stg_oltp__physicians"), bed.staged("stg_oltp__states"))


def _providers(bed: Bed, physicians: DataFrame) -> DataFrame:
    return marts.dim_provider(bed.staged("stg_oltp__providers"), physicians, bed.staged("stg_oltp__states"))


@query("int_case_review_status", oracle.SQL["int_case_review_status"])
def case_review_status(bed: Bed) -> DataFrame:
    return intermediate.int_case_review_status(*_relational(bed), oracle.AS_OF)


@query("int_physician_daily_metrics", oracle.SQL["int_physician_daily_metrics"])
def physician_daily_metrics(bed: Bed) -> DataFrame:
    rows = intermediate.int_physician_daily_metrics(*_relational(bed), **DAYS)
    return rows.withColumn("avg_days_to_review", F.round("avg_days_to_review", 6))


@query("int_appointment_utilization", oracle.SQL["int_appointment_utilization"])
def appointment_utilization(bed: Bed) -> DataFrame:
    _, appointments, encounters = _emr(bed)
    return intermediate.int_appointment_utilization(appointments, encounters, bed.staged("stg_oltp__providers"))


@query("int_provider_panel_metrics", oracle.SQL["int_provider_panel_metrics"])
def provider_panel_metrics(bed: Bed) -> DataFrame:
    return intermediate.int_provider_panel_metrics(bed.staged("stg_emr__encounters"), bed.staged("stg_oltp__providers"))


@query("int_patient_encounters", oracle.SQL["int_patient_encounters"])
def patient_encounters(bed: Bed) -> DataFrame:
    patients, _, encounters = _emr(bed)
    return intermediate.int_patient_encounters(*_adt(bed), patients, encounters)


@query("dim_state", oracle.SQL["dim_state"])
def dim_state(bed: Bed) -> DataFrame:
    return marts.dim_state(bed.staged("stg_oltp__states"))


@query("dim_physician", oracle.SQL["dim_physician"])
def dim_physician(bed: Bed) -> DataFrame:
    return _physicians(bed)


@query("dim_provider", oracle.SQL["dim_provider"])
def dim_provider(bed: Bed) -> DataFrame:
    return _providers(bed, _physicians(bed))


@query("dim_patient", oracle.SQL["dim_patient"])
def dim_patient(bed: Bed) -> DataFrame:
    return marts.dim_patient(bed.staged("stg_emr__patients"), bed.staged("stg_emr__encounters"))


@query("fact_provider_case_load", oracle.SQL["fact_provider_case_load"])
def fact_provider_case_load(bed: Bed) -> DataFrame:
    return marts.fact_provider_case_load(*_relational(bed), _physicians(bed), **DAYS)


@query("fact_patient_encounters", oracle.SQL["fact_patient_encounters"])
def fact_patient_encounters(bed: Bed) -> DataFrame:
    patients, _, encounters = _emr(bed)
    physicians = _physicians(bed)
    return marts.fact_patient_encounters(
        *_adt(bed), patients, encounters, dim_patient(bed), _providers(bed, physicians), physicians
    )


@query("fact_patient_utilization", oracle.SQL["fact_patient_utilization"])
def fact_patient_utilization(bed: Bed) -> DataFrame:
    _, appointments, encounters = _emr(bed)
    return marts.fact_patient_utilization(appointments, encounters, _providers(bed, _physicians(bed)))


@query("bi_overdue_report", oracle.SQL["bi_overdue_report"])
def bi_overdue_report(bed: Bed) -> DataFrame:
    """The report over case-load facts written as a mart table, so its day filter works on files."""
    store = TableStore(bed.spark, scratch_dir(bed.spark, "marts"))
    load = store.write(fact_provider_case_load(bed), jobs.MARTS, "fact_provider_case_load", sort_by=["date_key"])
    physicians = store.write(_physicians(bed), jobs.MARTS, "dim_physician")
    return reports.overdue_report(load, physicians, oracle.REPORT_DAY)


# Single operators


@query(
    "date_spine",
    "select cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as date)::varchar as date_key "
    "from orders",
)
def date_spine(bed: Bed) -> DataFrame:
    """Every day between the first and the last order."""
    span = bed.base("orders").agg(
        F.min("o_orderdate").cast("date").alias("first"), F.max("o_orderdate").cast("date").alias("last")
    )
    return span.select(F.explode(days(F.col("first"), F.col("last"))).alias("date_key"))


@query(
    "surrogate_key_scaled",
    f"{duck_ctes('cases')} select row_number() over (order by id) as case_key, id from cases",
)
def surrogate_key_scaled(bed: Bed) -> DataFrame:
    """The surrogate key of all cases, ranked in ranges of the key."""
    return surrogate_key(bed.raw("cases").select("id"), "id", "case_key")


@query(
    "select_streams",
    "select 'public-cases' as stream, 9 as n_columns, count(*) as n_rows from orders "
    "union all select 'public-providers', 2, count(*) from customer",
)
def stream_selection(bed: Bed) -> DataFrame:
    streams = {f"public-{t}": bed.raw(t).drop(*keyed.LOAD_COLUMNS) for t in ("cases", "providers", "states")}
    streams["audit-cases"] = streams["public-cases"]
    chosen = select_streams(streams, ["*-cases.*", "public-providers.*_name"], schemas=["public"])
    frames = [
        frame.agg(F.count("*").alias("n_rows")).select(
            F.lit(stream).alias("stream"), F.lit(len(frame.columns)).alias("n_columns"), "n_rows"
        )
        for stream, frame in chosen.items()
    ]
    return frames[0].unionByName(frames[1])


@query("source_views", f"{duck_ctes('providers')} select provider_type, count(*) as n_rows from providers group by all")
def source_views(bed: Bed) -> DataFrame:
    """SQL over a raw table's view."""
    register_views({"providers": bed.raw("providers")})
    return bed.spark.sql("select provider_type, count(*) as n_rows from raw_providers group by provider_type")


@query("deals_flatten", f"{duck_ctes('deals')} select * from deals")
def deals_flatten(bed: Bed) -> DataFrame:
    return deal_rows(bed.deals())


@query("modified_since", f"{duck_ctes('deals')} select * from deals")
def modified_since(bed: Bed) -> DataFrame:
    """A CSV drop read by modification time; its files are new, so all are read."""
    base = scratch_dir(bed.spark, "drops")
    write_csv_drop(deal_rows(bed.deals()), f"{base}/hubspot/deals.csv")
    return read_csv_drop(bed.spark, base, "hubspot/", r"deals\.csv", modified_after="2024-01-01T00:00:00Z")


@query("row_count", "select count(*) as n_rows from lineitem")
def row_count(bed: Bed) -> DataFrame:
    return reports.row_count(bed.base("lineitem"))


# Loading

LATER = "o_orderdate >= timestamp_ntz'1998-01-01'"
ORDER = ["o_orderdate", "o_orderkey"]


@query(
    "load_upsert",
    """select o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders
    qualify row_number() over (partition by o_custkey
      order by o_orderdate >= timestamp '1998-01-01' desc, o_orderdate desc, o_orderkey desc) = 1""",
)
def load_upsert(bed: Bed) -> DataFrame:
    """Last order of each customer: the orders before 1998, merged with the later ones."""
    orders = bed.base("orders")
    target = keyed.latest_per_key(orders.where(f"not ({LATER})"), ["o_custkey"], ORDER)
    return keyed.upsert(target, orders.where(LATER), ["o_custkey"], ORDER)


@query(
    "load_upsert_buckets",
    """select o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders
    qualify row_number() over (partition by o_custkey
      order by o_orderdate >= timestamp '1998-01-01' desc, o_orderdate desc, o_orderkey desc) = 1""",
)
def load_upsert_buckets(bed: Bed) -> DataFrame:
    """The same in a table of hash buckets, of which each batch rewrites those it touches; the second batch comes twice."""
    orders = bed.base("orders")
    table = BucketedTable(TableStore(bed.spark, scratch_dir(bed.spark, "buckets")), "raw", "last_orders", ["o_custkey"], buckets=16)
    for batch in (orders.where(f"not ({LATER})"), orders.where(LATER), orders.where(LATER)):
        table.upsert(batch, ORDER)
    return table.read()


@query(
    "load_quarantine",
    f"""{duck_ctes('cases', 'case_reviews', 'providers', 'physicians')}, broken as (
      select id, case when o % 11 = 0 then 'status accepted_values' end as a, case when o % 13 = 0 then 'case_type not_null' end as b,
        case when o % 17 = 0 then 'provider_id relationships' end as c
      from (select *, hash_of(id) as o from cases)
    ), found as (
      select 'cases' as table_name, id, concat_ws(', ', b, a, c) as reasons from broken where coalesce(a, b, c) is not null
      union all
      select 'case_reviews', r.id, 'case_id relationships' from case_reviews r
      where r.case_id in (select id from broken where coalesce(a, b, c) is not null)
    ) select distinct * from found""".replace("hash_of(id)", "('0x' || substr(md5(id), 1, 8))::bigint"),
)
def load_quarantine(bed: Bed) -> DataFrame:
    """Damaged cases kept out at ingest with every reason, and the reviews that thereby lose their case."""
    number = F.conv(F.substring(F.md5("id"), 1, 8), 16, 10).cast("long")
    damage = {
        "status": F.when(number % 11 == 0, "lost").otherwise(F.col("status")),
        "case_type": F.when(number % 13 != 0, F.col("case_type")),
        "provider_id": F.when(number % 17 == 0, F.concat(F.lit("no-"), "provider_id")).otherwise(F.col("provider_id")),
    }
    held, out = {}, []
    for table in RELATIONAL:
        rows = bed.flat(table)
        own = [rule for rule in rules.SOURCE_RULES if rule.table == table]
        held[table], kept_out = quarantine.split(rows.withColumns(damage) if table == "cases" else rows, table, own, ["id"], held)
        out.append(kept_out.select("table_name", json_text("record", "$.id").alias("id"), F.array_join("reasons", ", ").alias("reasons")))
    return reduce(DataFrame.unionByName, out).distinct()


@query(
    "load_insert_ignore",
    """select * from lineitem where l_returnflag <> 'A'
      and (l_orderkey, l_linenumber) not in (select (l_orderkey, l_linenumber) from lineitem where l_returnflag = 'A')
    qualify row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_suppkey) = 1""",
)
def load_insert_ignore(bed: Bed) -> DataFrame:
    """Open lines whose order and number no returned line holds; the earliest of each."""
    lines = bed.base("lineitem")
    held = lines.where(F.col("l_returnflag") == "A")
    offered = lines.where(F.col("l_returnflag") != "A")
    return keyed.insert_ignore(held, offered, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


@query(
    "load_metadata",
    f"select o_orderkey, timestamp '{LOADED_AT}' as loaded_at, 3 as table_version from orders",
)
def load_metadata(bed: Bed) -> DataFrame:
    rows = keyed.with_load_metadata(bed.base("orders").select("o_orderkey"), LOADED_AT, 3)
    same = F.least(keyed.EXTRACTED, keyed.RECEIVED, keyed.BATCHED).alias("loaded_at")
    return rows.select("o_orderkey", same, F.col(keyed.VERSION).alias("table_version"))


TOUCHED_SQL = """{ctes} select id, if(priority in ('low', 'normal'), 'closed', status) as status,
  if({touched}, timestamp '2026-01-01', updated_at) as updated_at from cases"""


def _updates(bed: Bed, only_changed: bool) -> DataFrame:
    cases = bed.raw("cases").select("id", "priority", "status", "updated_at")
    low = cases.where(F.col("priority").isin("low", "normal")).select("id", F.lit("closed").alias("status"))
    now = F.lit("2026-01-01").cast("timestamp_ntz")
    rows = keyed.apply_updates(cases, low, ["id"], now, only_changed=only_changed)
    return rows.select("id", "status", "updated_at")


@query("load_touch_updated", TOUCHED_SQL.format(ctes=duck_ctes("cases"), touched="priority in ('low', 'normal')"))
def load_touch_updated(bed: Bed) -> DataFrame:
    return _updates(bed, only_changed=False)


@query(
    "load_touch_changed",
    TOUCHED_SQL.format(ctes=duck_ctes("cases"), touched="priority in ('low', 'normal') and status <> 'closed'"),
)
def load_touch_changed(bed: Bed) -> DataFrame:
    return _updates(bed, only_changed=True)


@query(
    "load_soft_delete",
    "select c_custkey, case when c_custkey not in (select user_id from events) then timestamp '2026-01-01' end "
    "as _sdc_deleted_at from customer",
)
def load_soft_delete(bed: Bed) -> DataFrame:
    """Customers that never appear as users, marked as absent and kept."""
    snapshot = bed.base("events").select(F.col("user_id").alias("c_custkey"))
    at = F.lit("2026-01-01").cast("timestamp_ntz")
    return keyed.mark_deleted(bed.base("customer").select("c_custkey"), snapshot, ["c_custkey"], at)


# Data quality


@query(
    "dq_unique", "select l_orderkey, count(*) as n_rows from lineitem group by l_orderkey having count(*) > 1"
)
def dq_unique(bed: Bed) -> DataFrame:
    return quality.duplicated(bed.base("lineitem"), "l_orderkey")


@query("dq_not_null", f"{duck_ctes('providers')} select id, npi from providers where phone is null")
def dq_not_null(bed: Bed) -> DataFrame:
    return quality.missing(bed.raw("providers"), "phone").select("id", "npi")


@query("dq_accepted", "select event_id, event_type from events where event_type not in ('view', 'click', 'signup')")
def dq_accepted(bed: Bed) -> DataFrame:
    rows = quality.unaccepted(bed.base("events"), "event_type", ("view", "click", "signup"))
    return rows.select("event_id", "event_type")


@query(
    "dq_relationships",
    "select o_orderkey, o_custkey from orders where o_custkey not in (select user_id from events)",
)
def dq_relationships(bed: Bed) -> DataFrame:
    return quality.orphans(bed.base("orders"), "o_custkey", bed.base("events"), "user_id").select("o_orderkey", "o_custkey")


RELATIONAL = ("states", "physicians", "providers", "cases", "case_reviews")


@query("dq_checks", oracle.rule_sql(rules.SOURCE_RULES, {t: f"{duck_ctes(t)} select * from {t}" for t in RELATIONAL}))
def dq_checks(bed: Bed) -> DataFrame:
    """Constraints of the relational source on its raw tables."""
    return quality.evaluate({t: bed.raw(t) for t in RELATIONAL}, rules.SOURCE_RULES)


@query(
    "dq_defaults",
    f"{duck_ctes('physicians')} select id, coalesce(specialty, 'General') as specialty, is_active from physicians",
)
def dq_defaults(bed: Bed) -> DataFrame:
    rows = quality.with_defaults(bed.raw("physicians"), {"specialty": "General", "is_active": True})
    return rows.select("id", "specialty", "is_active")


def write_sources(bed: Bed, base: str) -> jobs.Places:
    """All five sources as files."""
    with passing_shuffles(bed.spark):
        for table in RELATIONAL:
            bed.flat(table).write.parquet(f"{base}/extracts/{table}")
        write_csv_drop(contact_rows(bed.contacts()), f"{base}/drops/hubspot/contacts.csv")
        write_csv_drop(deal_rows(bed.deals()), f"{base}/drops/hubspot/deals.csv")
        number = F.substring_index("id", "-", -1).cast("long")
        bed.pages(bed.contacts(), F.col("id").cast("long"), "results").write.json(f"{base}/crm/contacts", compression="gzip")
        for stream, rows in (
            ("fhir_patients", bed.patients()),
            ("fhir_appointments", bed.appointments()),
            ("fhir_encounters", bed.encounters()),
        ):
            bed.pages(rows, number, "entry", "resource").write.json(f"{base}/bundles/{stream}", compression="gzip")
        write_messages(bed.messages(), f"{base}/landing")
    return jobs.Places(
        extracts=f"{base}/extracts",
        drops=f"{base}/drops",
        crm=f"{base}/crm",
        bundles=f"{base}/bundles",
        landing=f"{base}/landing",
        feed_log=f"{base}/feed/log",
        feed_checkpoint=f"{base}/feed/state",
        multi_line=False,
    )


@query("elt_report", oracle.rule_sql([*rules.STAGING_RULES, *rules.MART_RULES], oracle.SQL))
def elt_report(bed: Bed) -> DataFrame:
    """All sources loaded from files, all models built and written, all declared rules evaluated."""
    base = scratch_dir(bed.spark, "elt")
    store = TableStore(bed.spark, f"{base}/warehouse")
    return jobs.run_job(
        bed.spark, "elt-all", write_sources(bed, base), store, oracle.START_DATE, oracle.AS_OF, LOADED_AT, gate=False
    )
