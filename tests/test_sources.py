import json
import os

import pytest
from pyspark.sql import functions as F

from clinloom.sources import catalog
from clinloom.sources.csv_drops import deal_rows, read_csv_drop, write_csv_drop
from clinloom.sources.documents import raw_resources, read_bundles, read_crm, read_parsed_hl7
from clinloom.sources.relational import read_extract, uuid_ranges
from clinloom.sources.schemas import CRM


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as file:
        file.write(text)


def test_csv_by_prefix_and_pattern(spark, tmp_path, rows):
    base = str(tmp_path)
    put(f"{base}/hubspot/a_deals.csv", "id,other\n9,x\n")
    put(f"{base}/hubspot/2024/contacts.csv", 'id,name\n1,"Doe, ""Jo"""\n2,\n')
    put(f"{base}/hubspot/2025/contacts.csv", "id,name\n3,007\n")
    put(f"{base}/elsewhere/contacts.csv", "id,name\n4,x\n")
    got = read_csv_drop(spark, base, "hubspot/", r"contacts\.csv")
    assert got.columns == ["id", "name"]
    assert rows(got) == [("1", 'Doe, "Jo"'), ("2", None), ("3", "007")]
    assert rows(read_csv_drop(spark, base, "hubspot/", r"2025/contacts\.csv", columns=["id", "name"])) == [("3", "007")]
    with pytest.raises(FileNotFoundError):
        read_csv_drop(spark, base, "hubspot/", r"companies\.csv")


def test_csv_delimiter_start_date_and_line_breaks(spark, tmp_path, rows):
    base = str(tmp_path)
    put(f"{base}/d/old.csv", "id;v\n1;a\n")
    put(f"{base}/d/new.csv", 'id;v\n2;"b\nc"\n')
    os.utime(f"{base}/d/old.csv", (1_600_000_000, 1_600_000_000))
    got = read_csv_drop(spark, base, "d/", r"\.csv", delimiter=";", modified_after="2024-01-01T00:00:00Z", multi_line=True)
    assert rows(got) == [("2", "b\nc")]


def test_csv_with_another_header_fails(spark, tmp_path):
    base = str(tmp_path)
    put(f"{base}/d/a.csv", "id,v\n1,a\n")
    put(f"{base}/d/b.csv", "v,id\na,1\n")
    with pytest.raises(Exception, match="header"):
        read_csv_drop(spark, base, "d/", r"\.csv").collect()


def test_deals_take_the_first_contact(spark, tmp_path, rows):
    deals = spark.createDataFrame(
        [("1", ("d",), ((([("7", "t"), ("8", "t")],)),)), ("2", ("e",), (([],),)), ("3", ("f",), None)],
        "id string, properties struct<dealname: string>, "
        "associations struct<contacts: struct<results: array<struct<id: string, type: string>>>>",
    )
    assert rows(deal_rows(deals)) == [("1", "d", "7"), ("2", "e", None), ("3", "f", None)]
    write_csv_drop(deal_rows(deals), f"{tmp_path}/hubspot/deals.csv")
    assert read_csv_drop(spark, str(tmp_path), "hubspot/", r"deals\.csv").count() == 3


def test_crm_pages_from_a_date(spark, tmp_path):
    def contact(i, at):
        return {"id": str(i), "properties": {"firstname": f"n{i}", "unknown": 1}, "updatedAt": at, "archived": False}

    put(f"{tmp_path}/p1.json", json.dumps({"results": [contact(1, "2023-12-31T23:59:59.000Z"), contact(2, "2024-01-01T00:00:00.000Z")]}, indent=1))
    put(f"{tmp_path}/p2.json", json.dumps({"results": [], "paging": {}}))
    got = read_crm(spark, str(tmp_path), "contacts", since="2024-01-01T00:00:00Z").collect()
    assert [(r.id, r.properties.firstname) for r in got] == [("2", "n2")]
    assert read_crm(spark, str(tmp_path), "contacts").count() == 2
    assert set(CRM) == {"contacts", "companies", "deals"}


def test_bundles_to_raw(spark, tmp_path):
    encounter = {
        "resourceType": "Encounter",
        "id": "e1",
        "status": "finished",
        "class": {"code": "IMP"},
        "subject": {"reference": "Patient/p1"},
        "period": {"start": "2024-01-01T00:00:00Z"},
        "length": {"value": 30},
        "type": [{"coding": [{"display": "Visit"}]}],
    }
    bundle = {"resourceType": "Bundle", "entry": [{"fullUrl": "u", "resource": encounter}], "link": [{"relation": "next"}]}
    put(f"{tmp_path}/page1.json", json.dumps(bundle, indent=2))
    put(f"{tmp_path}/page2.json", json.dumps({"resourceType": "Bundle", "total": 0}))
    row = raw_resources(read_bundles(spark, str(tmp_path), "fhir_encounters"), arrays_as_json=True).first()
    assert (row.class_code, row.subject_reference, row.period_start, row.length_value) == ("IMP", "Patient/p1", "2024-01-01T00:00:00Z", 30)
    assert json.loads(row.type) == [{"coding": [{"display": "Visit"}]}]
    assert raw_resources(read_bundles(spark, str(tmp_path), "fhir_encounters")).first().type[0].coding[0].display == "Visit"


def test_parsed_records(spark, tmp_path):
    put(f"{tmp_path}/r.json", json.dumps({"records": [{"message_id": "m", "x": 1}], "total": 1}))
    assert read_parsed_hl7(spark, str(tmp_path), ["message_id", "patient_mrn"]).first().asDict() == {"message_id": "m", "patient_mrn": None}


def test_stream_selection(spark):
    frame = spark.createDataFrame([(1, 2, 3)], "id int, first_name int, last_name int")
    streams = {"public-cases": frame, "public-states": frame, "audit-cases": frame}
    chosen = catalog.select_streams(streams, ["public-cases.*", "!public-cases.id", "public-states.last_*"])
    assert {s: f.columns for s, f in chosen.items()} == {
        "public-cases": ["first_name", "last_name"],
        "public-states": ["last_name"],
    }
    assert list(catalog.select_streams(streams, ["*.*"], schemas=["audit"])) == ["audit-cases"]


def test_declared_sources():
    assert len(catalog.TABLES) == 16
    assert [t.name for t in catalog.tables_of("emr")] == ["fhir_patients", "fhir_appointments", "fhir_encounters"]
    assert catalog.TABLES["hl7_engine", "hl7_lab_results"].keys == ("message_id", "test_code")
    assert [t.name for t in catalog.TABLES.values() if not t.extracted] == ["companies", "deals"]


def test_uuid_ranges_cover_the_key_space_once(spark):
    ids = spark.range(500).select(F.regexp_replace(F.md5(F.col("id").cast("string")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5").alias("id"))
    counts = [ids.where(p).count() for p in uuid_ranges("id", 7)]
    assert sum(counts) == 500 and all(counts)
    assert uuid_ranges("id", 1) == ["id >= '00000000-0000-0000-0000-000000000000'"]


def test_extract_prunes_and_pushes_down(spark, tmp_path):
    spark.createDataFrame([("1", "AA", "A", None, 7, None, None)], "id string, code string, name string, supervision_requirements string, review_frequency_days int, created_at timestamp_ntz, updated_at timestamp_ntz").write.parquet(f"{tmp_path}/states")
    plan = read_extract(spark, str(tmp_path), "states").where("code = 'AA'").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(code,AA)" in plan and "ReadSchema: struct<id:string,code:string>" in plan
