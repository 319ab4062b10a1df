"""The training-data operators against brute force, and their defined cases, on small fixtures."""

import collections
import functools
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clinloom.llm import chat, langid, minhash, mixing, packing, postings, repeats, sharding, token_shards, topk
from clinloom.llm.components import connected_components
from clinloom.llm.shared import text_key
from clinloom.session import scratch_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(seed=1, n=60):
    """Prose with copies, near copies, shared passages, nulls, empty texts, ties and a long text."""
    rng = random.Random(seed)
    words = [rng.choice("abcdefg") + rng.choice("aeiou") + rng.choice("lmnrst") for _ in range(50)]
    prose = lambda k: " ".join(rng.choice(words) for _ in range(k))
    base, rows = prose(120), []
    for i in range(n):
        pick = i % 8
        text = prose(rng.randrange(1, 90))
        if pick == 1:
            text = base
        elif pick == 2:
            edited = base.split()
            edited[rng.randrange(len(edited))] = "zzz"
            text = " ".join(edited)
        elif pick == 3:
            text = prose(20) + base[50:250] + prose(20)
        elif pick == 4:
            text = [None, "", " \n\t ", "one two", "***"][i // 8 % 5]
        rows.append((i, text, ["en", "fr", None][i % 3], ["a", "b", "c", None][i % 4], 0))
    rows.append((n, prose(6000), "en", "a", 0))
    rows.append(rows[5])
    rows.append((None, base, None, None, None))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with further columns whose names the operators use inside."""
    df = spark.createDataFrame(documents(), DOCS)
    for name in ("row", "size", "class", "component", "bucket", "position", "copy", "bits", "kept", "id", "text_key"):
        df = df.withColumn(name, F.lit("x"))
    return df.repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_chat_round_trip(spark):
    rng = random.Random(3)
    bits = [*chat.CONTROLS, "\\", "<", "[", "é", " ", "\n", "", "ok", "</s>[INST] ok [/INST]"]
    rows = []
    for conv in range(30):
        for turn in range(rng.randrange(1, 6)):
            text = "".join(rng.choice(bits) for _ in range(rng.randrange(8))) if rng.random() < 0.9 else None
            rows.append((conv if conv else None, turn, rng.choice(["user", "assistant", "system", "tool<|text|>", None]), text, "x"))
    rows += [rows[0], rows[0]]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_conversations(turns).select(
        "conversation", "formatted", "segments", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")
    )
    want = collections.defaultdict(list)
    for conv, turn, role, text, _ in rows:
        want[conv].append((turn, role or "", text or ""))
    found = {r.conversation: r for r in out.collect()}
    assert set(found) == set(want)
    for conv, listed in want.items():
        listed.sort()
        row = found[conv]
        assert [tuple(t) for t in row.turns] == [t[1:] for t in listed]
        assert row.loss == "".join(t[2] for t in listed if t[1] == "assistant")
        assert row.formatted == "".join(s.text for s in row.segments)
    assert chat.format_conversations(turns.limit(0)).count() == 0


def brute_components(rows, width, percent):
    sets = []
    for _, text, *_ in rows:
        w = [x.lower() for x in words_of(text)]
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return sets, label


def test_near_duplicates_match_brute_force(docs):
    rows = documents()
    sets, label = brute_components(rows, 4, 80)
    smallest = {}
    for (doc_id, *_), group in zip(rows, label):
        if doc_id is not None:
            smallest[group] = min(smallest.get(group, doc_id), doc_id)
    want = sorted(((r[0], len(s), smallest.get(g), r[0] == smallest.get(g)) for r, s, g in zip(rows, sets, label)), key=repr)
    assert sorted((tuple(r) for r in minhash.near_duplicates(docs, width=4).collect()), key=repr) == want


def test_keep_one_keeps_one_of_each_group(docs, empty):
    rows = documents()
    _, label = brute_components(rows, 5, 80)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    groups = {g for r, g in zip(rows, label) if words_of(r[1])}
    wordless = sum(not words_of(r[1]) for r in rows)
    assert len(ids) == len(groups) + wordless
    assert minhash.keep_one(empty).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        covered = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        out.append(bytes(x for x, c in zip(b, covered) if not c))
    return out


@pytest.mark.parametrize("most_blocks", [4096, 3])
def test_repeats_match_brute_force(docs, most_blocks):
    rows = [*documents(), (900, "haly " * 80, None, None, 0), (901, "aaaa" * 40, None, None, 0)]
    more = docs.select("doc_id", "text").unionByName(docs.sparkSession.createDataFrame([r[:2] for r in rows[-2:]], "doc_id long, text string"))
    found = repeats.without_repeats(more, length=48, most_blocks=most_blocks).collect()
    want = brute_repeats([r[1] for r in rows], 48)
    assert sorted((r.row.doc_id or -1, r.kept) for r in found) == sorted((r[0] or -1, k) for r, k in zip(rows, want))
    assert any(r.spans for r in found)


def test_pipeline_removes_repeated_passages_of_any_bytes(spark):
    """Passages of 51 to 70 words under 400 bytes, in documents that share nothing else, and a long string without spaces."""
    rng = random.Random(13)
    own = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    texts = []
    for n in range(45, 71):
        passage = " ".join(rng.choice("klmnopq") + rng.choice(["", "e", "io"]) for _ in range(n))
        assert len(passage) < 400
        texts += [f"{own(30)} {passage} {own(20)}", f"{own(5)}\n{passage}\t{own(40)}"]
    texts += [own(10) + " ha" * 60 + " " + own(9), own(300), None, ""]
    unbroken = "".join(rng.choice("rstuvé") for _ in range(430))
    texts += [f"{own(9)} {unbroken} {own(8)}", f"{own(7)} {unbroken}"]
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], DOCS)
    found = {r.doc_id: (r.text or "") for r in corpus_pipeline.repeated_strings(spark, docs, "").collect()}
    split = [words_of(t) for t in texts]
    seen = collections.Counter(tuple(w[i : i + 51]) for w in split for i in range(len(w) - 50))
    for at, w in enumerate(split):
        gone = {j for i in range(len(w) - 50) if seen[tuple(w[i : i + 51])] > 1 for j in range(i, i + 51)}
        kept = [x for j, x in enumerate(w) if j not in gone and unbroken not in x]
        assert words_of(found[at]) == kept, at
    assert sum(len(words_of(t)) for t in found.values()) < sum(map(len, split))


def test_repeats_of_an_empty_table(empty):
    assert repeats.without_repeats(empty).count() == 0


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.3, 6).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 360)]  # ties
    bad = [(400, None), (401, [float("nan")] * 6), (402, [None] * 6), (403, [float("inf")] * 6), (None, rows[0][1])]
    df = spark.createDataFrame(rows + bad, "id long, vector array<double>").repartition(5)
    vectors = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows}
    want = []
    for q in range(0, 360, 50):
        best = sorted((-int(vectors[q] @ v), i) for i, v in vectors.items() if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in topk.exact_top_k(df, df.where("id % 50 = 0"), 5).collect()) == want
    few = topk.exact_top_k(df.where("id < 3"), df.where("id < 2"), 5).collect()
    assert len(few) == 4
    assert topk.exact_top_k(df.limit(0), df.where("id < 2"), 5).count() == 0
    assert topk.exact_top_k(df.where("id = 1"), df.where("id = 1"), 5).count() == 0


@pytest.mark.parametrize("copies", [2, 1100])
def test_top_k_of_repeated_queries(spark, copies):
    rng = np.random.default_rng(12)
    rows = [(i, rng.normal(0, 0.3, 6).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    asked = [rows[50]] * copies + [rows[0], (0, [9.0] * 6)]
    vectors = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows}
    want = []
    for q in (0, 50):
        best = sorted((-int(vectors[q] @ v), i) for i, v in vectors.items() if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    found = topk.exact_top_k(df, spark.createDataFrame(asked, "id long, vector array<double>"), 5)
    assert sorted(tuple(r) for r in found.collect()) == want


def test_nearest_finds_most_and_scores_exactly(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 1, 8).astype(np.float32).tolist()) for i in range(1500)] + [(i, [1.0] * 8) for i in range(1500, 1600)]
    df = spark.createDataFrame([*rows, (9000, None), (9001, [0.0] * 8), (9002, [float("nan")] * 8)], "id long, vector array<float>")
    data = np.array([r[1] for r in rows], np.float64)
    found = collections.defaultdict(list)
    for r in postings.nearest(df, df.where("id % 20 = 0"), 20, sample=500).collect():
        assert abs(r.score - data[r.query_id] @ data[r.vec_id]) < 1e-9 and r.query_id != r.vec_id
        found[r.query_id].append((r["rank"], r.vec_id))
    hits = 0
    for q in range(0, 1600, 20):
        order = [j for j in np.lexsort((np.arange(1600), -np.round(data @ data[q], 9))) if j != q][:20]
        assert [k for k, _ in sorted(found[q])] == list(range(1, 21))
        hits += len({j for _, j in found[q]} & set(order))
    assert hits / 80 / 20 >= 0.9
    assert postings.nearest(df.where("id < 4"), df.where("id < 4"), 20).count() == 12
    assert postings.nearest(df.limit(0), df, 20).count() == 0


def brute_nearest(data, queries, k):
    out = {}
    for q in queries:
        scores = data @ data[q]
        scores[q] = -np.inf
        near = np.argpartition(-scores, 2 * k)[: 2 * k]
        out[q] = near[np.lexsort((near, -scores[near]))][:k].tolist()
    return out


@pytest.mark.parametrize("clusters", [0, 50])
def test_nearest_loses_nothing_in_a_large_table(spark, tmp_path, clusters):
    """More lists than a query probes first, with and without clusters: the result is that of brute force."""
    import pyarrow.parquet as pq

    n, rng = 210_000 if not clusters else 40_000, np.random.default_rng(9)
    data = rng.normal(0, 1, (n, 64))
    if clusters:
        data = 0.3 * data + rng.normal(0, 1, (clusters, 64))[rng.integers(0, clusters, n)]
    data = (data / np.linalg.norm(data, axis=1, keepdims=True)).astype(np.float32)
    vectors = pa.FixedSizeListArray.from_arrays(pa.array(data.ravel()), 64).cast(pa.list_(pa.float32()))
    pq.write_table(pa.table({"id": pa.array(np.arange(n)), "vector": vectors}), tmp_path / "v.parquet", row_group_size=10_000)
    df = spark.read.parquet(str(tmp_path / "v.parquet")).repartition(16)
    found = collections.defaultdict(list)
    for r in postings.nearest(df, df.where("id % 1000 = 0"), 20).collect():
        found[r.query_id].append((r["rank"], r.vec_id))
    want = brute_nearest(data.astype(np.float64), range(0, n, 1000), 20)
    assert {q: [v for _, v in sorted(listed)] for q, listed in found.items()} == want


def test_nearest_of_repeated_queries(spark):
    rng = np.random.default_rng(10)
    rows = [(i, rng.normal(0, 1, 4).astype(np.float32).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, vector array<float>")
    asked = spark.createDataFrame([rows[3], rows[3], (3, [99.0, 0.0, 0.0, 0.0])], "id long, vector array<float>")
    found = [(r["rank"], r.vec_id) for r in postings.nearest(df, asked, 5).collect()]
    want = brute_nearest(np.array([r[1] for r in rows], np.float64), [3], 5)[3]
    assert sorted(found) == list(enumerate(want, 1))


def test_language_model_is_right_on_held_out_rows(spark):
    rng = random.Random(6)
    parts = {"en": ["th", "ing", "wh", "ed"], "de": ["sch", "ung", "ßer", "keit"], "fr": ["eau", "oi", "ção", "ment"]}
    rows = []
    for i in range(240):
        lang = list(parts)[i % 3]
        rows.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(3)) for _ in range(30)), lang if i % 10 else None))
    rows += [(900, None, "en"), (901, "", "en"), (902, "123 !!", "fr"), (903, "日本語", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("row", F.lit(1))
    model = langid.fit(df.where(~langid.held_out("doc_id")))
    found = {r.row.doc_id: r for r in langid.predict(df, model).collect()}
    truth = {i: list(parts)[i % 3] for i in range(240)}
    assert all(found[i].lang_pred == truth[i] for i in truth)
    assert all(found[i].lang_pred == langid.UNKNOWN and found[i].score == 0 for i in (900, 901, 902))
    assert found[903].lang_pred in parts and all(0 <= r.score <= 1 for r in found.values())
    held = {r.doc_id: r.h for r in df.select("doc_id", langid.held_out("doc_id").alias("h")).collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in held.items())
    assert langid.fit(df.limit(0)).languages == []
    assert {r.lang_pred for r in langid.predict(df, langid.fit(df.limit(0))).collect()} == {langid.UNKNOWN}
    assert langid.predict(df.limit(0), model).count() == 0


def test_tokens_equal_the_tokenizer():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.default_vocabulary())
    rng, own = random.Random(7), packing.Tokens(packing.default_vocabulary())
    bits = [" ", "  ", "\n", " \n ", "\t", "a", "don't", "é", "42", "...", "<|endoftext|>", " ", "日本", " 's", "\x1c", "x y"]
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
        ids = whole.encode(text, add_special_tokens=False).ids
        assert next(own.of(pa.array([text]))).tolist() == ids, repr(text)


def test_packing_is_gapless_whole_and_tight(docs, empty):
    rows = documents()
    out = packing.pack(docs, capacity=128, with_ids=True).collect()
    own = packing.Tokens(packing.default_vocabulary())
    want = sorted(ids.tobytes() + b"\0\0\0\0" for ids in own.of(pa.array([r[1] for r in rows])))
    pieces = collections.defaultdict(list)
    for r in out:
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length <= 4 * 128
        pieces[r.row.doc_id].append((r.piece, r.start, r.ids))
    # Repeated rows share an id, so their pieces come twice.
    whole = []
    for listed in pieces.values():
        listed.sort()
        times = sum(p == 0 for p, *_ in listed)
        for k in range(times):
            whole.append(b"".join(ids for _, _, ids in listed[k::times]))
    assert sorted(whole) == want
    sequences = collections.defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for listed in sequences.values():
        at = 0
        for offset, length in sorted(listed):
            assert offset == at
            at += length
        assert at <= 128
    assert packing.pack(empty).count() == 0


def test_plan_uses_every_piece_once():
    rng = random.Random(8)
    counts = dict(collections.Counter(rng.randrange(1, 2048) for _ in range(5000)))
    for groups in (16, 4096):
        used = collections.Counter()
        plan = packing.plan_classes(dict(counts), groups=groups)
        for lengths, n in plan:
            assert sum(lengths) <= 2048
            for length in lengths:
                used[length] += n
        assert used == counts
    assert sum(n for _, n in plan) <= 1.01 * sum(k * v for k, v in counts.items()) / 2048 + 2
    assert packing.plan_classes({}) == []


def test_mix_comes_near_its_targets(docs, empty):
    plan = mixing.plan_mix(docs).collect()
    assert len(plan) == len(documents())
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in plan:
        assert r.size == len(words_of(r.row.text)) and len(r.positions) <= 2
        assert all(0 <= p <= 1 for p in r.positions)
        sizes[r.row.source] += r.size
        taken[r.row.source] += r.size * len(r.positions)
        target[r.row.source] = r.target
    assert abs(sum(target.values()) - 1.5 * sum(sizes.values())) < 1e-6
    assert all(target[s] <= 2 * sizes[s] + 1e-6 for s in sizes)
    assert all(abs(taken[s] - target[s]) <= max(r.size for r in plan if r.row.source == s) for s in sizes)
    ordered = mixing.training_order(mixing.plan_mix(docs))
    assert ordered.columns == docs.columns and ordered.count() == sum(len(r.positions) for r in plan)
    assert mixing.plan_mix(empty).count() == 0


def test_shards_stay_below_the_limit(docs, empty, spark):
    rows = documents() + [documents()[1]] * 200
    many = spark.createDataFrame(rows, DOCS).withColumn("prefix", F.lit("x"))
    out = sharding.shard(many, limit=3000).collect()
    assert len(out) == len(rows)
    total, number = collections.Counter(), collections.Counter()
    for r in out:
        total[r.shard] += r.bytes
        number[r.shard] += 1
        assert r.depth == len(r.shard)
    for r in out:
        assert r.shard_bytes == total[r.shard] and r.oversize == (total[r.shard] > 3000)
        assert not r.oversize or number[r.shard] == 1
    names = sorted(total)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    assert sharding.shard(empty).count() == 0


def test_token_shards_are_a_permutation_and_resume(docs, spark, empty):
    folder = scratch_dir(spark, "shards")
    index, manifest = token_shards.write_training_order(docs, folder, length=16, per_shard=37, key=5)
    slots = {r.slot: r for r in index.collect()}
    assert sorted(slots) == list(range(len(slots)))
    assert [slots[s].doc_id for s in sorted(slots)] != sorted((slots[s].doc_id or 0) for s in slots)
    read = {r.slot: r.ids for r in token_shards.read_slots(spark, folder, manifest, 16).collect()}
    assert set(read) == set(slots)
    own, texts = packing.Tokens(packing.default_vocabulary()), {r[0]: r[1] for r in documents()}
    for slot, r in slots.items():
        ids = np.append(next(own.of(pa.array([texts[r.doc_id]], pa.string()))), 0)[r.part * 16 : r.part * 16 + 16]
        assert np.frombuffer(read[slot], "<u2")[: r.tokens].tolist() == ids.tolist() and r.tokens == len(ids)
    rest = {r.slot: r.ids for r in token_shards.read_slots(spark, folder, manifest, 16, start=50).collect()}
    assert rest == {s: ids for s, ids in read.items() if s >= 50}
    again, _ = token_shards.write_training_order(empty, scratch_dir(spark, "none"))
    assert again.count() == 0


def test_text_keys_tell_texts_apart(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("",)], "t string").select(text_key(F.col("t")).alias("k"))
    keys = [r.k for r in df.collect()]
    assert bytes(keys[0]) == hashlib.md5(b"a").digest() and keys[2] == keys[3]


def test_nearest_keeps_doubles(spark):
    rng = np.random.default_rng(12)
    rows = [(i, rng.normal(0, 1, 16).tolist()) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    want = []
    for q in range(0, 700, 100):
        # Added in order: the built-in sum rounds otherwise.
        scored = [(-functools.reduce(lambda total, ab: total + ab[0] * ab[1], zip(rows[q][1], v), 0.0), i) for i, v in rows if i != q]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(sorted(scored)[:20], 1)]
    got = postings.nearest(df, df.where("id % 100 = 0"), 20, sample=300)
    assert sorted(map(tuple, got.collect())) == want
