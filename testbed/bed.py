"""Raw-shaped Spark inputs: flat records encoded as the documents and messages of the source systems."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinloom.functions import iso_timestamp
from clinloom.operators import hl7
from clinloom.operators.keyed import with_load_metadata
from clinloom.plans import staging
from clinloom.session import passing_shuffles, scratch_dir, spread
from clinloom.sources.csv_drops import contact_rows
from clinloom.sources.documents import raw_resources
from testbed.flat import BASE_TABLES, LABS, LAB_HIGH, LAB_LOW, REVIEW_KEY, flat_sql, lab_value, padded

# (application, folder, raw table) -> where it was written.
WRITTEN: dict[tuple[str, str, str], str] = {}
SPREAD = ("customer", "orders", "lineitem", "events")
LOADED_AT = dt.datetime(2026, 1, 31, 6, 0, 0)
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
STAMP = "yyyyMMddHHmmss"


def _iso(column: str) -> Column:
    return F.date_format(column, ISO)


def _coded(text: Column) -> Column:
    return F.array(F.struct(F.array(F.struct(text.alias("display"))).alias("coding")))


def _who(npi: str) -> Column:
    return F.when(F.col(npi).isNotNull(), F.struct(F.lit("npi").alias("system"), F.col(npi).alias("value")))


class Bed:
    """Inputs derived from the tables of one scale-factor folder; everything is lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def base(self, table: str) -> DataFrame:
        """A table; the larger ones come as one file each, whose rows are spread before they are encoded."""
        scan = self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")
        return spread(scan) if table in SPREAD else scan

    def flat(self, name: str) -> DataFrame:
        text = flat_sql(name, "timestamp_ntz")
        return self.spark.sql(text, **{t: self.base(t) for t in BASE_TABLES if f"{{{t}}}" in text})

    def loaded(self, df: DataFrame) -> DataFrame:
        return with_load_metadata(df, LOADED_AT, 1)

    # FHIR resources, in their own types

    def patients(self) -> DataFrame:
        return self.flat("patients").select(
            F.lit("Patient").alias("resourceType"),
            F.col("patient_id").alias("id"),
            F.array(F.struct(F.lit("usual").alias("use"), F.col("mrn").alias("value"))).alias("identifier"),
            F.lit(True).alias("active"),
            F.array(F.struct(F.col("last_name").alias("family"), F.array("first_name").alias("given"))).alias("name"),
            F.array(
                F.struct(F.lit("phone").alias("system"), F.col("phone").alias("value")),
                F.struct(F.lit("email").alias("system"), F.col("email").alias("value")),
            ).alias("telecom"),
            "gender",
            F.col("date_of_birth").alias("birthDate"),
            F.array(
                F.struct(F.array("address_line").alias("line"), "city", "state", F.col("postal_code").alias("postalCode"))
            ).alias("address"),
            F.array(F.struct(F.lit("insurance").alias("url"), F.col("insurance_type").alias("valueString"))).alias(
                "extension"
            ),
        )

    def appointments(self) -> DataFrame:
        patient = F.struct(F.concat(F.lit("Patient/"), "patient_id").alias("reference"), _no_id())
        practitioner = F.struct(F.lit("Practitioner/x").alias("reference"), _who("provider_npi").alias("identifier"))
        return self.flat("appointments").select(
            F.lit("Appointment").alias("resourceType"),
            F.col("appointment_id").alias("id"),
            F.col("appointment_status").alias("status"),
            F.when(F.col("appointment_type").isNotNull(), _coded(F.col("appointment_type"))).alias("serviceType"),
            _iso("scheduled_start").alias("start"),
            _iso("scheduled_end").alias("end"),
            F.col("duration_minutes").alias("minutesDuration"),
            _iso("created_at").alias("created"),
            F.array(F.struct(patient.alias("actor")), F.struct(practitioner.alias("actor"))).alias("participant"),
        )

    def encounters(self) -> DataFrame:
        code = F.array(F.struct(F.lit("icd").alias("url"), F.col("primary_diagnosis_code").alias("valueString")))
        condition = F.struct(F.col("primary_diagnosis_desc").alias("display"), code.alias("extension"))
        has_diagnosis = F.col("primary_diagnosis_code").isNotNull()
        return self.flat("encounters").select(
            F.lit("Encounter").alias("resourceType"),
            F.col("encounter_id").alias("id"),
            F.col("encounter_status").alias("status"),
            F.struct(F.lit("act").alias("system"), F.col("encounter_class").alias("code")).alias("class"),
            _coded(F.col("encounter_type")).alias("type"),
            F.struct(F.concat(F.lit("Patient/"), "patient_id").alias("reference")).alias("subject"),
            F.array(F.struct(F.struct(_who("provider_npi").alias("identifier")).alias("individual"))).alias("participant"),
            F.struct(_iso("encounter_start").alias("start"), _iso("encounter_end").alias("end")).alias("period"),
            F.array(F.struct(F.col("chief_complaint").alias("text"))).alias("reasonCode"),
            F.when(has_diagnosis, F.array(F.struct(condition.alias("condition")))).alias("diagnosis"),
            F.struct(F.col("length_minutes").alias("value"), F.lit("min").alias("unit")).alias("length"),
        )

    # CRM objects

    def contacts(self) -> DataFrame:
        properties = [
            *[F.col(name).alias(source) for source, name in staging.CONTACT_COLUMNS.items()],
            _iso("created_at").alias("createdate"),
            _iso("modified_at").alias("lastmodifieddate"),
            F.col("contact_id").alias("hs_object_id"),
        ]
        return self.flat("contacts").select(
            F.col("contact_id").alias("id"),
            F.struct(*properties).alias("properties"),
            _iso("created_at").alias("createdAt"),
            _iso("modified_at").alias("updatedAt"),
            F.lit(False).alias("archived"),
        )

    def deals(self) -> DataFrame:
        linked = F.array(F.struct(F.col("contact_id").alias("id"), F.lit("deal_to_contact").alias("type")))
        results = F.when(F.col("contact_id").isNotNull(), linked).otherwise(F.filter(linked, lambda _: F.lit(False)))
        return self.flat("deals").select(
            "id",
            F.struct("dealname", "amount", "dealstage").alias("properties"),
            F.struct(F.struct(results.alias("results")).alias("contacts")).alias("associations"),
        )

    # HL7 messages

    def admission_messages(self) -> DataFrame:
        return _adt(self.flat("admissions"), "ADT^A01", F.lit(""))

    def discharge_messages(self) -> DataFrame:
        return _adt(self.flat("discharges"), "ADT^A03", F.date_format("discharge_datetime", STAMP))

    def lab_messages(self) -> DataFrame:
        flag = (
            "case when {v} >= 40 then 'HH' when {v} > 30 then 'H' when {v} <= 6 then 'LL' when {v} < 10 then 'L' "
            "else 'N' end"
        )
        results = [
            F.expr(
                f"case when l_linenumber % 4 > {i} then concat_ws('|', 'OBX', '{i + 1}', 'NM', 'T{i}^Test {i}', '', "
                f"cast({lab_value(i)} as string), 'mg/dL', '{LAB_LOW}-{LAB_HIGH}', "
                f"{flag.format(v=lab_value(i))}, '', '', 'F') end"
            )
            for i in range(LABS)
        ]
        lines = [
            _header("LABSYS", "LAB", "l_shipdate", "ORU^R01", F.expr(f"concat('ORU', {REVIEW_KEY})")),
            F.expr(
                f"concat_ws('|', 'PID', '1', '', {padded('MRN', 'l_orderkey', 7)}, '', "
                "concat('Line^', cast(l_linenumber as string)), '', '19700101', 'F')"
            ),
            F.lit("PV1|1|O"),
            F.expr(
                "concat_ws('|', 'OBR', '1', concat('ORD', cast(l_orderkey as string)), repeat('|', 12), "
                f"{padded('2', 'l_suppkey', 9)})"
            ),
            *results,
        ]
        return self.base("lineitem").select(F.concat_ws("\n", *lines).alias("message"))

    def other_messages(self) -> DataFrame:
        """Updates, a type that no parser reads: one for each order that is neither finished nor open."""
        rows = self.base("orders").where(F.col("o_orderstatus") == "P")
        header = _header("ADMITSYS", "HOSPITAL", "o_orderdate", "ADT^A08", F.expr("concat('UPD', o_orderkey)"))
        return rows.select(F.concat(header, F.lit("\nPID|1||X")).alias("message"))

    def messages(self) -> DataFrame:
        return (
            self.admission_messages()
            .unionByName(self.discharge_messages())
            .unionByName(self.lab_messages())
            .unionByName(self.other_messages())
        )

    # Raw tables and staging models

    def raw(self, table: str) -> DataFrame:
        """A raw table, written once for each session and folder, as the load jobs leave it for the models."""
        place = (self.spark.sparkContext.applicationId, self.sf_dir, table)
        if place not in WRITTEN:
            path = scratch_dir(self.spark, f"raw-{table}")
            with passing_shuffles(self.spark):
                self.encoded(table).write.parquet(path)
            WRITTEN[place] = path
        return self.spark.read.parquet(WRITTEN[place])

    def encoded(self, table: str, arrays_as_json: bool = False) -> DataFrame:
        """The rows of a raw table by way of the documents or messages they come in; lazy."""
        documents = {
            "fhir_patients": self.patients,
            "fhir_appointments": self.appointments,
            "fhir_encounters": self.encounters,
        }
        messages = {
            "hl7_admissions": self.admission_messages,
            "hl7_discharges": self.discharge_messages,
            "hl7_lab_results": self.lab_messages,
        }
        if table in documents:
            rows = raw_resources(documents[table](), arrays_as_json)
        elif table in messages:
            rows = hl7.PARSERS[table](messages[table]())
        elif table == "contacts":
            rows = self.contacts().withColumn("lastmodifieddate", iso_timestamp("updatedAt"))
        elif table == "contacts_csv":
            rows = contact_rows(self.contacts())
        else:
            rows = self.flat(table)
        return self.loaded(rows)

    def staged(self, model: str) -> DataFrame:
        table, build = staging.STAGING[model]
        return build(self.raw(table))

    def pages(self, records: DataFrame, number: Column, envelope: str, inner: str | None = None) -> DataFrame:
        """Records in page documents of 50; ``number`` counts the records up."""
        record = F.struct("*") if inner is None else F.struct(F.struct("*").alias(inner))
        paged = records.select(F.floor(number / 50).alias("page"), record.alias("record"))
        return paged.groupBy("page").agg(F.collect_list("record").alias(envelope)).drop("page")


def _no_id() -> Column:
    return F.lit(None).cast("struct<system: string, value: string>").alias("identifier")


def _header(system: str, facility: str, at: str, kind: str, number: Column) -> Column:
    return F.concat_ws(
        "|",
        F.lit("MSH|^~\\&"),
        F.lit(system),
        F.lit(facility),
        F.lit("WAREHOUSE|ANALYTICS"),
        F.date_format(at, STAMP),
        F.lit(""),
        F.lit(kind),
        number,
        F.lit("P|2.3"),
    )


def _adt(rows: DataFrame, kind: str, leave: Column) -> DataFrame:
    gender = F.col("patient_gender") if "patient_gender" in rows.columns else F.lit("")
    name = F.concat_ws("^", "patient_last_name", "patient_first_name")
    person = F.concat_ws(
        "|", F.lit("PID|1|"), F.col("patient_mrn"), F.lit(""), name, F.lit(""), F.lit("19800101"), gender, F.lit("")
    )
    visit = F.concat_ws(
        "|",
        F.lit("PV1|1"),
        F.col("patient_class"),
        F.lit("|||"),
        F.concat("attending_provider_npi", F.lit("^Roe^Sam")),
        F.lit("|" * 10),
        F.col("visit_number"),
        F.lit("|" * 23),
        F.date_format("admit_datetime", STAMP),
        leave,
    )
    event = F.concat(F.lit("EVN|"), F.lit(kind[-3:]), F.lit("|"), F.date_format("message_datetime", STAMP))
    header = _header("ADMITSYS", "HOSPITAL", "message_datetime", kind, F.col("message_id"))
    return rows.select(F.concat_ws("\n", header, event, person, visit).alias("message"))
