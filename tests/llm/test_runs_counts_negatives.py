"""Periodic runs, token counts and hard negatives against brute force, and their defined cases."""

import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from clinloom.llm import hard_negatives, packing, runs, token_counts
from clinloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Periodic runs


def runs_by_hand(words):
    """Start, length and smallest period of every run, by comparing words for each period."""
    n, smallest = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                smallest.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in smallest.items())


def collapsed_by_hand(words, found):
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def periodic_document(rng):
    """Runs of many periods, inside each other, beside each other and with small periods inside large ones."""
    out = []
    for _ in range(rng.randrange(1, 5)):
        kind = rng.randrange(5)
        letters = "ab" if rng.random() < 0.5 else "abcdef"
        if kind == 0:
            out += rng.choices(letters, k=rng.randrange(30))
        elif kind == 1:
            root = rng.choices(letters, k=rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 33, 40, 64, 70]))
            out += (root * 9)[: int(len(root) * rng.uniform(3.7, 8))]
        elif kind == 2:
            # A root that is mostly of a smaller period.
            root = ["a", "b"] * rng.randrange(1, 20) + ["c"] * rng.randrange(0, 3)
            out += (root * 6)[: int(len(root) * rng.uniform(3.9, 6))]
        elif kind == 3:
            a, b = ["a"], ["a", "b"]
            for _ in range(rng.randrange(3, 8)):
                a, b = b, b + a
            out += b * rng.randrange(1, 6)
        else:
            inner = (rng.choices(letters, k=rng.randrange(1, 5)) * 12)[: rng.randrange(8, 40)]
            out += (inner + ["z"]) * rng.randrange(3, 6)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_many_documents_at_once(seed):
    rng = random.Random(seed)
    documents = [periodic_document(rng) for _ in range(60)] + [[], ["a"] * 5, ["a"] * 6, [], ["a", "b"] * 4]
    rng.shuffle(documents)
    edges = np.concatenate(([0], np.cumsum([len(d) for d in documents])))
    codes = np.array([ord(w) for d in documents for w in d], np.int64)
    found = [(int(s), int(e - s), int(q)) for s, e, q in runs.find_runs(codes, edges)]
    want = [(int(edges[d]) + s, length, q) for d, words in enumerate(documents) for s, length, q in runs_by_hand(words)]
    assert found == sorted(want)
    assert max(q for *_, q in found) > 60


def test_a_long_period_in_a_long_text():
    rng = random.Random(3)
    root = rng.choices(range(50), k=5000)
    codes = np.array([*rng.choices(range(50), k=1234), *(root * 5)[:20001], *rng.choices(range(50), k=99)], np.int64)
    found = runs.find_runs(codes, np.array([0, len(codes)]))
    longest = found[np.argmax(found[:, 1] - found[:, 0])]
    s, e, q = longest.tolist()
    assert q == 5000 and s <= 1234 and e >= 1234 + 20001
    assert codes[s - 1] != codes[s - 1 + q] and codes[e] != codes[e - q]


def test_synchronising_set_is_sparse():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1000, 100_000)
    left = len(codes) - np.arange(len(codes))
    windows, t = runs.Windows(codes, left), 64
    least = runs.window_minimum(np.where(left < t, np.iinfo(np.uint64).max, windows.level(6)), t + 1)
    hashes = windows.level(6)
    chosen = (least[: -2 * t] == hashes[: -2 * t]) | (least[: -2 * t] == hashes[t:-t])
    places = np.flatnonzero(chosen)
    assert len(places) < 4 * len(codes) / t and np.diff(places).max() <= t


def test_runs_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a a a a a"), (5, "a a a a a a"), (6, "x\x0b a b  a b\na b a b a b a b"), (5, "a a a a a a"), (None, "b " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)).withColumn("row", F.lit(2)).repartition(3)
    found = runs.periodic_runs(df)
    assert found.columns == ["row", "runs", "collapsed"]
    got = sorted(((r.row.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()), key=repr)
    want = [
        (0, [(0, 3000, 1)], "b"), (1, [], ""), (2, [], ""), (3, [], ""), (4, [], "a a a a a"),
        (5, [(0, 6, 1)], "a"), (5, [(0, 6, 1)], "a"), (6, [(1, 6, 1)], "x a b"),
    ]
    assert got == want
    assert runs.periodic_runs(df.limit(0)).count() == 0


@tables
def test_op11_equals_brute_force(spark):
    docs = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = {}
    for r in docs:
        words = planted(r["doc_id"], r["text"])
        if len(words) > 6000:
            continue
        found = runs_by_hand(words)
        top = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
        want[r["doc_id"]] = (len(found), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(collapsed_by_hand(words, found)))
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_periodic_runs"](spark, SMALL).collect()}
    assert len(got) == len(docs)
    assert {d: got[d] for d in want} == want
    assert sum(w[0] > 0 for w in want.values()) > 10


def test_planted_repetitions(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices("abcdefgh", k=rng.randrange(200)))) for i in range(-50, 150)] + [(None, "a b"), (7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or 0, (r.text or "").split()) for r in runs.with_stuttered_words(df).collect()), key=repr)
    assert got == sorted(((d or 0, planted(d, t)) for d, t in rows), key=repr)


# Token counts


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_vocabulary())


BITS = [" ", "  ", "\n", " \n ", "\t", "a", "don't", "é", "42", "...", "<|endoftext|>", " ", "日本", " 's", "\x1c", "x y", "  ", "the", " the", "\r\n", "🙂"]


def test_counts_equal_the_tokenizer(spark, tokenizer):
    rng = random.Random(5)
    texts = ["".join(rng.choices(BITS, k=rng.randrange(25))) for _ in range(3000)] + [None, "", "the " * 20000, "x" * 5000]
    rows = [(i // 2, t, "row") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string").withColumn("tokens", F.lit(1)).repartition(4)
    want = sorted((i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows)
    # One slice for all texts of a task and many; all pre-tokens broadcast, some, and none.
    for size, frequent, common in ((token_counts.SLICE_BYTES, 20_000, 100_000), (200, 5, 100), (200, 5, 1), (200, 5, 0)):
        got = token_counts.count_tokens(df, frequent=frequent, common=common, size=size)
        assert got.columns == ["row", "n_bytes", "n_tokens"]
        assert sorted((r.row.doc_id, r.n_bytes, r.n_tokens) for r in got.collect()) == want
    assert token_counts.count_tokens(df.limit(0)).count() == 0


def test_frequent_strings_are_kept():
    rng = random.Random(8)
    stream = ["hot"] * 900 + ["warm"] * 300 + [f"w{i}" for i in range(8000)]
    rng.shuffle(stream)
    frequent = token_counts.Frequent(50)
    for at in range(0, len(stream), 130):
        part = stream[at : at + 130]
        frequent.add(list(dict.fromkeys(part)), [part.count(w) for w in dict.fromkeys(part)])
    assert len(frequent.counts) <= 100 + 130
    assert 900 - len(stream) // 50 <= frequent.counts["hot"] <= 900 and 300 - len(stream) // 50 <= frequent.counts["warm"] <= 300


def test_frequencies_are_those_of_the_pre_tokenizer(tokenizer):
    rng, own = random.Random(6), token_counts.PreTokens(packing.default_vocabulary())
    texts = ["".join(rng.choices([b for b in BITS if b != "<|endoftext|>"], k=12)) for _ in range(50)]
    names, edges, codes, counts = own.frequencies(pa.array(texts))
    for i, text in enumerate(texts):
        got = {names[c]: int(n) for c, n in zip(codes[edges[i] : edges[i + 1]], counts[edges[i] : edges[i + 1]])}
        want = {}
        for _, (start, stop) in tokenizer.pre_tokenizer.pre_tokenize_str(text):
            want[text[start:stop]] = want.get(text[start:stop], 0) + 1
        assert got == want, repr(text)


@tables
def test_op13_equals_the_tokenizer(spark, tokenizer):
    docs = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    sizes = [(r["doc_id"], len((r["text"] or "").encode()), len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs]
    got = QUERIES["op13_token_counts"](spark, SMALL)
    assert sorted(map(tuple, got.collect())) == sorted((*s, s[2] > 1024) for s in sizes)


# Hard negatives


@pytest.mark.parametrize("dim,size", [(1, 10**9), (3, 5), (64, 300), (64, 10**8), (700, 4000), (700, 10**7)])
def test_residue_scores_are_exact(dim, size):
    rng = np.random.default_rng(dim)
    a, b = rng.integers(-size, size + 1, (7, dim)), rng.integers(-size, size + 1, (11, dim))
    most = max((v.astype(float) ** 2).sum(axis=1).max() for v in (a, b)) * 1.001 + 1
    primes = hard_negatives.primes_for(dim, most)
    assert math.prod(primes) > 2 * most and all((p // 2) ** 2 * min(dim, hard_negatives.STRIP) <= 2**24 for p in primes)
    got = hard_negatives.rns_scores(hard_negatives.residues(a, primes), hard_negatives.residues(b, primes), primes)
    assert got.tolist() == (a.astype(object) @ b.astype(object).T).tolist()


def mined_by_hand(rows, anchors, positives=5, negatives=10, low=30, high=90):
    usable = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    firsts, out = {}, []
    for i, lab, v in usable:
        if i in anchors:
            firsts[i] = min(firsts.get(i, (lab, v)), (lab, v))
    for a, (lab, v) in firsts.items():
        others = sorted((-sum(x * y for x, y in zip(v, w)), i, la) for i, la, w in usable if i != a)
        for s, p, _ in [o for o in others if o[2] == lab][:positives]:
            fitting = [(n, -t) for t, n, la in others if la != lab and low * -s <= 100 * -t <= high * -s]
            out += [(a, p, k, n, -s, t) for k, (n, t) in enumerate(fitting[:negatives], 1)]
    return sorted(out)


def test_mining_equals_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    vectors = [[rng.uniform(-1, 1) for _ in range(8)] for _ in range(400)]
    rows = [(i, rng.randrange(3), v) for i, v in enumerate(vectors)]
    # A third of all rows is one vector; ids and rows come twice; odd values.
    rows += [(1000 + i, i % 2, vectors[0]) for i in range(200)] + rows[:30] + [(20, 2, vectors[9]), (40, 1, vectors[20])]
    rows += [(2000, None, vectors[1]), (None, 1, vectors[1]), (2020, 1, None), (2040, 1, [None] * 8), (2060, 1, [math.nan] * 8), (2080, 1, [math.inf] * 8), (2100, 1, [0.0] * 8)]
    df = spark.createDataFrame(rows, "id long, label int, vector array<double>").withColumn("anchors", F.lit(1)).repartition(5)
    anchors = {i for i, *_ in rows if i is not None and i % 20 == 0}
    want = mined_by_hand(rows, anchors)
    assert len(want) > 500
    for block, columns, size in ((256, 2048, 8192), (4, 16, 50)):
        monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", block)
        monkeypatch.setattr(hard_negatives, "CANDIDATE_BLOCK", size)
        got = hard_negatives.mine(df, df.where("id % 20 = 0"))
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert sorted(map(tuple, got.collect())) == want


def test_mining_defined_cases(spark):
    kind = "id long, label int, vector array<double>"
    assert hard_negatives.mine(spark.createDataFrame([], kind), spark.createDataFrame([], kind)).count() == 0
    lone = spark.createDataFrame([(0, 1, [1.0, 0.0]), (1, 2, [0.5, 0.0])], kind)
    assert hard_negatives.mine(lone, lone.where("id = 0")).count() == 0
    assert hard_negatives.mine(lone, lone.limit(0)).count() == 0
    uneven = spark.createDataFrame([(0, 1, [1.0, 0.0]), (1, 2, [0.5])], kind)
    with pytest.raises(ValueError):
        hard_negatives.mine(uneven, uneven)
    large = spark.createDataFrame([(0, 1, [1e30]), (1, 2, [0.5])], kind)
    with pytest.raises(OverflowError):
        hard_negatives.mine(large, large)
