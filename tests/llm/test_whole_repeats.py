"""The registered removal of 400-byte strings on a whole table, against brute force over all starts."""

import hashlib
import os

import pytest

from clinloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
LENGTH = 400


def brute_force(texts):
    starts = {}
    for number, data in enumerate(texts):
        for at in range(len(data) - LENGTH + 1):
            starts.setdefault(hashlib.blake2b(data[at : at + LENGTH], digest_size=16).digest(), []).append((number, at))
    covered = [bytearray(len(data)) for data in texts]
    for places in starts.values():
        if len(places) > 1:
            for number, at in places:
                covered[number][at : at + LENGTH] = b"\x01" * LENGTH
    return covered


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_registered_removal_matches_brute_force(spark, tmp_path):
    given = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    longest = max((text for _, text in given if text), key=len)
    prose = "".join(text for _, text in given if text)[:6000]
    # Equal to the byte below and at the length, shifted against each other, beside unlike text, and of one symbol.
    planted = [
        longest,
        "a " + prose[:LENGTH],
        "bc " + prose[:LENGTH] + " de",
        "x" + prose[1000 : 1000 + LENGTH - 1] + "y",
        "z" + prose[1000 : 1000 + LENGTH - 1] + "w",
        prose[1500:2300] + " between " + prose[1900:2700],
        "\u00e9" * 700,
        None,
        "",
    ]
    rows = given + [(10**9 + i, text) for i, text in enumerate(planted)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    texts = [(text or "").encode() for _, text in rows]
    want = {}
    for (number, _), data, covered in zip(rows, texts, brute_force(texts)):
        kept = bytes(b for b, gone in zip(data, covered) if not gone)
        spans = sum(1 for i, gone in enumerate(covered) if gone and (i == 0 or not covered[i - 1]))
        want[number] = (len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op4_remove_repeats"](spark, str(tmp_path)).collect()}
    assert got == want and any(v[1] for v in want.values())
