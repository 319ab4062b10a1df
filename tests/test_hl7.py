import contextlib
import gzip
import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clinloom.operators import hl7
from clinloom.sources.mllp import PIECES, cut_pieces, messages_of, read_messages, split_states, write_messages

HEAD = "MSH|^~\\&|ADMITSYS|HOSPITAL|WAREHOUSE|ANALYTICS|20240102030405||{kind}|{number}|P|2.3"
PID = "PID|1||MRN1||Doe^Jane||19800101|F|||1 Main St"
PV1 = "PV1|1|I|||||1234567890^Roe^Sam||||||||||||VN1|||||||||||||||||||||||||20240102030405|20240103"


def message(kind, *segments, number="M1"):
    return "\n".join([HEAD.format(kind=kind, number=number), *segments])


def frame(spark, *messages):
    return hl7.with_header(spark.createDataFrame([(m,) for m in messages], "message string"))


def brute_force(data):
    """Messages of a byte stream: from each first start mark to the next end mark."""
    found, at = [], 0
    while True:
        end = data.find(b"\x1c\r", at)
        start = data.find(b"\x0b", at)
        if start == -1 or end == -1:
            return found
        if end < start:
            at = end + 2
            continue
        found.append(data[start + 1 : end].decode(errors="replace"))
        at = end + 2


def land(folder, *contents):
    os.makedirs(folder, exist_ok=True)
    for i, content in enumerate(contents):
        with open(f"{folder}/f{i}.hl7", "wb") as file:
            file.write(content)
    return str(folder)


CASES = [
    b"junk\x1c\r\x0bMSH|a\nPID|\xff\xe2\x82|x\x1c\r\x0bMSH|b\x1c\rzz\x0bMSH|tail",
    b"\x0bMSH|c\x1c\r",
    b"\x0bopen\x0binner\x1c\r\x0b\x1c\r",
    b"only junk",
    b"",
    b"\x0bcrlf\r\nsecond\x1c\x1c\r",
]


@contextlib.contextmanager
def splits_of(spark, size):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def cut(spark, path, size):
    # The landing files are read at once, in such splits; what is stored is read in usual ones.
    with splits_of(spark, size):
        frame = read_messages(spark, path)
    return sorted(r.message for r in frame.collect())


@pytest.mark.parametrize("size", [1, 5, 40, 1 << 20])
def test_frames_are_cut_like_a_byte_scan_at_every_split_size(spark, tmp_path, size):
    path = land(tmp_path / "in", *CASES)
    assert cut(spark, path, size) == sorted(m for case in CASES for m in brute_force(case))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    streams=st.lists(
        st.lists(st.sampled_from([b"\x0b", b"\x0b", b"\x1c\r", b"\x1c", b"\r", b"ab", b"MSH|", b"\n", b"\xff", b"\xc3\xa9", b"\xef\xbb\xbf"]), max_size=30),
        min_size=1,
        max_size=12,
    )
)
def test_any_streams_cut_in_splits(spark, tmp_path_factory, streams):
    contents = [b"".join(pieces) for pieces in streams]
    path = land(tmp_path_factory.mktemp("any"), *contents, b"\x0bX\x1c\r")
    expected = sorted([*(m for c in contents for m in brute_force(c)), "X"])
    for size in (5, 1 << 20):
        assert cut(spark, path, size) == expected


@pytest.mark.parametrize("tail", [b"", b"\x0bunfinished", b"junk"])
def test_a_large_file_is_read_in_many_splits(spark, tmp_path, tail):
    messages = [f"MSH|{i}|{'x' * (i % 300)}" for i in range(5000)]
    data = b"".join(b"\x0b" + m.encode() + b"\x1c\r" for m in messages) + tail
    path = land(tmp_path / "large", data)
    with splits_of(spark, 64 << 10):
        assert cut_pieces(spark, path).rdd.getNumPartitions() > 4
        place = write_pieces(spark, path, tmp_path)
    pieces = spark.read.schema(PIECES).parquet(place)
    assert sorted(r.message for r in messages_of(pieces).collect()) == sorted(messages)
    # Every split of such a file is taken as it is.
    assert split_states(pieces).where("mixed").count() == 0


def write_pieces(spark, path, folder):
    cut_pieces(spark, path).write.parquet(str(folder / "pieces"))
    return str(folder / "pieces")


def test_a_frame_may_hold_start_marks_over_many_splits(spark, tmp_path):
    rng = random.Random(9)
    frames = [b"".join(rng.choice([b"\x0b", b"abc", b"\n", b"\x0b\x0b"]) for _ in range(rng.randrange(60))) for _ in range(300)]
    data = b"junk\x1c\r" + b"".join(b"\x0b" + f + b"\x1c\r" + rng.choice([b"", b"zz", b"\x1c\r"]) for f in frames) + b"\x0btail\x0btail"
    path = land(tmp_path / "in", data, b"no start", b"\x0ball\x0bopen")
    for size in (16, 100, 1000):
        assert cut(spark, path, size) == sorted(brute_force(data))


def test_files_are_read_once(spark, tmp_path):
    path = land(tmp_path / "in", *CASES)
    plan = read_messages(spark, path)._jdf.queryExecution().executedPlan().toString()
    # What is left to do reads the stored rows.
    assert "FileScan text" not in plan and "FileScan parquet" in plan


@pytest.mark.parametrize("size", [16, 1 << 20])
def test_marked_and_compressed_files_lose_nothing(spark, tmp_path, size):
    whole = [b"\x0bMSH|%d\x1c\r\x0bMSH|%d%s\x1c\r" % (i, i, b"x" * i) for i in range(12)]
    contents = [b"\xef\xbb\xbf" + c for c in whole] + [b"\xef\xbb\xbf" + c + tail for c, tail in zip(whole, (b"\x0bMSH|t", b"t", b"\x1c"))]
    path = land(tmp_path / "in", *contents)
    packed = whole + [c + b"\x0bMSH|t" for c in whole]
    for i, content in enumerate(packed):
        with open(f"{path}/{i}.hl7.gz", "wb") as file:
            file.write(gzip.compress(content))
    assert cut(spark, path, size) == sorted(m for c in (*contents, *packed) for m in brute_force(c))


def test_written_frames_read_back(spark, tmp_path):
    path = str(tmp_path / "out")
    sent = ["MSH|1\nPID|é", "MSH|2"]
    write_messages(spark.createDataFrame([(m,) for m in sent], "message string"), path)
    assert sorted(r.message for r in read_messages(spark, path).collect()) == sorted(sent)


def test_whole_messages_are_not_shuffled(spark, tmp_path):
    write_messages(spark.range(9000).select(F.concat(F.lit("MSH|"), "id").alias("message")), str(tmp_path / "in"))
    plan = read_messages(spark, str(tmp_path / "in"))._jdf.queryExecution().executedPlan().toString()
    plain = plan[: plan.index("BroadcastExchange")]
    assert "LeftAnti" in plain and "BroadcastHashJoin" in plain and "Exchange hashpartitioning" not in plain


def test_landing_files_are_compressed_and_fit_a_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("clinloom.sources.mllp.FILE_MESSAGES", 100)
    path = str(tmp_path / "out")
    write_messages(spark.range(1000).coalesce(1).select(F.concat(F.lit("MSH|"), F.repeat(F.lit("x"), 1000), "id").alias("message")), path)
    files = [os.path.join(path, f) for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 10 and sum(map(os.path.getsize, files)) < 100_000
    assert read_messages(spark, path).count() == 1000


def test_header_fields_default_to_empty(spark):
    texts = [message("ADT^A01", PID), "MSH|a", "PID|1", " MSH|^~\\&|||||||ADT^A01|X", "x\rMSH|^~\\&|||||||ADT^A01|X", ""]
    got = [(r.control_id, r.message_type) for r in frame(spark, *texts).collect()]
    assert got == [("M1", "ADT^A01"), ("", ""), ("", ""), ("", ""), ("", ""), ("", "")]


def test_routes_and_counts(spark, rows):
    kinds = ["ADT^A01", "ADT^A03", "ORU^R01", "ADT^A08", "ADT^A08"]
    messages = frame(spark, *[message(k) for k in kinds])
    assert {name: df.count() for name, df in hl7.route(messages).items()} == {
        "hl7_admissions": 1,
        "hl7_discharges": 1,
        "hl7_lab_results": 1,
        "unknown": 2,
    }
    assert {name: df.count() for name, df in hl7.route(hl7.with_route(messages)).items()}["unknown"] == 2
    assert rows(hl7.route_counts(messages))[1:3] == [("ADT^A03", 1), ("ADT^A08", 2)]


def test_admission_fields(spark):
    got = hl7.admissions(frame(spark, message("ADT^A01", "EVN|A01", PID, PV1))).first().asDict()
    assert got == {
        "message_id": "M1",
        "patient_mrn": "MRN1",
        "patient_last_name": "Doe",
        "patient_first_name": "Jane",
        "patient_dob": "19800101",
        "patient_gender": "F",
        "attending_provider_npi": "1234567890",
        "patient_class": "I",
        "admit_datetime": "20240102030405",
        "visit_number": "VN1",
        "sending_facility": "HOSPITAL",
        "message_datetime": "20240102030405",
    }


def test_short_visit_segment_gives_empty_texts(spark):
    row = hl7.discharges(frame(spark, " \n" + message("ADT^A03", "PID|1||M||Solo", "PV1|1|E") + " \n　")).first()
    assert (row.patient_last_name, row.patient_first_name, row.patient_class) == ("Solo", "", "E")
    assert (row.attending_provider_npi, row.admit_datetime, row.discharge_datetime, row.visit_number) == ("",) * 4


def test_first_segment_wins_and_names_must_match_whole(spark):
    row = hl7.admissions(frame(spark, message("ADT^A01", "PIDX|no", PID, PID.replace("MRN1", "MRN2"), PV1))).first()
    assert row.patient_mrn == "MRN1"


OBR = "OBR|1|ORD1|||||||||||||||999"
OBX = "OBX|{i}|NM|6032-9^WBC||7.1|x10E3/uL|4.5-11.0|N|||F"


def test_one_row_for_each_result(spark):
    many = message("ORU^R01", PID, "PV1|1", "OBR|1|ORD1||||||||||||||999", OBX.format(i=1), OBX.format(i=2))
    none = message("ORU^R01", PID, "OBR|1|ORD1", number="M2")
    got = hl7.lab_results(frame(spark, many, none)).collect()
    assert len(got) == 2
    assert {(r.test_code, r.test_name, r.result_value, r.ordering_provider_npi, r.order_number) for r in got} == {
        ("6032-9", "WBC", "7.1", "999", "ORD1")
    }
    assert {r.observation_datetime for r in got} == {"20240102030405"}


def test_unreadable_messages_are_rejected_whole(spark):
    messages = frame(
        spark,
        message("ADT^A01", PV1, number="no pid"),
        message("ADT^A01", "PID|1||M||A^B", PV1, number="short pid"),
        message("ADT^A03", PID, number="no visit"),
        message("ORU^R01", PID, OBR, OBX.format(i=1), "OBX|2|NM|x", number="short result"),
        message("ADT^A01", PID, PV1, number="good"),
        message("ZZZ", number="unknown"),
        "MSH|^~\\&|a|b|c|d|2024||ADT^A01\n" + PID + "\n" + PV1,
    )
    reasons = {r.control_id: r.reason for r in hl7.rejects(messages).collect()}
    assert reasons == {
        "no pid": "PID missing or short",
        "short pid": "PID missing or short",
        "no visit": "PV1 missing or short",
        "short result": "OBX short",
        "": "MSH missing or short",
    }
    routed = hl7.route(messages)
    assert [r.message_id for r in hl7.admissions(routed["hl7_admissions"]).collect()] == ["good"]
    assert hl7.lab_results(routed["hl7_lab_results"]).count() == 0


@pytest.mark.parametrize(
    "value, limits, flag",
    [
        ("10", "10-30", "N"),
        ("30", "10-30", "N"),
        ("30.1", "10-30", "H"),
        ("39.9", "10-30", "H"),
        ("40", "10-30", "HH"),
        ("9.9", "10-30", "L"),
        ("6.1", "10-30", "L"),
        ("6", "10-30", "LL"),
        ("x", "10-30", None),
        ("5", "none", None),
    ],
)
def test_abnormal_flag(spark, value, limits, flag):
    row = spark.createDataFrame([(value, limits)], "v string, r string")
    assert row.select(hl7.abnormal_flag(F.col("v"), F.col("r"))).first()[0] == flag
