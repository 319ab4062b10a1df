"""Words tokenised together, texts scored and shingled a slice at a time, and token ids compressed in blocks."""

import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from clinloom.llm import langid, minhash, packing, token_shards
from clinloom.llm.queries import QUERIES
from clinloom.session import scratch_dir


def word(rng):
    return "".join(rng.choice("aeinorstlé") for _ in range(rng.randrange(2, 9))) + rng.choice(["", "", "", ",", ".\nA", "'s", "42"])


class Counting:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, model):
        self.model, self.texts = model, 0

    def encode_batch_fast(self, texts, **settings):
        self.texts += len(texts)
        return self.model.encode_batch_fast(texts, **settings)


def test_new_words_are_tokenised_together(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 25_000)
    rng, own = random.Random(1), packing.Tokens(packing.default_vocabulary())
    whole, own.model = own.model, Counting(own.model)
    odd = ["", " ", "\n", "a ", " b", "one\n", "two <|endoftext|> three", "x" * 80 + " y", "日本 語", "  a", None]
    texts = [" ".join(word(rng) for _ in range(400)) for _ in range(100)] + odd
    for part in (texts, texts[50:], [*texts[::-1], " ".join(word(rng) for _ in range(9000))], texts):
        want = [whole.encode(text or "", add_special_tokens=False).ids for text in part]
        assert [ids.tolist() for ids in own.of(pa.array(part))] == want
    assert own.model.texts < 1000


def test_words_are_tokenised_alone_where_tokens_do_not_open_with_a_space():
    own = packing.Tokens(packing.default_vocabulary())
    own.opens[:] = False
    assert [ids.tolist() for ids in own.of(pa.array(["one two two three"]))] == [own.model.encode("one two two three").ids]


@pytest.mark.parametrize("inside", [None, "body"])
def test_texts_are_scored_a_slice_at_a_time(inside):
    words = langid.Table({"the": 0, "der": 1}, np.array([[0.0, -3.0], [-3.0, 0.0]]))
    shared = SimpleNamespace(value=langid.Model(["de", "en"], np.array([0.5, 0.5]), words, []))
    texts = pa.array(["the " * 400_000, "der " * 400_000, None, "the the der"] * 4)
    row = pa.StructArray.from_arrays([pa.array(range(16)), texts], names=["id", "body"])
    columns = {"row": row} | ({} if inside else {"text": texts})
    out = list(langid._predict(shared, *([inside] if inside else [None]))(iter([pa.RecordBatch.from_pydict(columns)])))
    assert len(out) >= 4 and [i for b in out for i in b["row"].field("id").to_pylist()] == list(range(16))
    assert [x for b in out for x in b["lang_pred"].to_pylist()] == ["de", "en", "und", "de"] * 4
    assert max(packing.pc.sum(packing.pc.binary_length(b["row"].field("body"))).as_py() for b in out) <= packing.SLICE_BYTES


def test_ids_are_compressed_in_blocks():
    rng = random.Random(2)
    known = [word(rng) for _ in range(300)]
    texts = [" ".join(rng.choice(known[: rng.randrange(1, 300)]) for _ in range(3000)) for _ in range(40)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(40)), "text": pa.array(texts)})
    out = list(token_shards._sequences(packing.default_vocabulary(), 256, 0)(iter([batch])))
    raw = 2 * sum(len(ids) + 1 for ids in packing.Tokens(packing.default_vocabulary()).of(pa.array(texts)))
    assert sum(len(ids) for b in out for ids in b["ids"].to_pylist()) < 0.5 * raw


def test_shards_do_not_depend_on_what_a_task_holds(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i % 90 if i % 7 else None, None if i % 31 == 0 else " ".join(word(rng) for _ in range(rng.randrange(60)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id")

    def written():
        folder = scratch_dir(spark, "shards")
        index, manifest = token_shards.write_training_order(docs, folder, length=16, per_shard=50)
        read = token_shards.read_slots(spark, folder, manifest, 16).collect()
        return sorted(map(tuple, index.collect())), sorted(map(tuple, manifest.collect())), sorted((r.slot, bytes(r.ids)) for r in read)

    whole = written()
    assert [s for s, *_ in whole[0]] == list(range(len(whole[0]))) and len(whole[1]) > 5
    monkeypatch.setattr(token_shards, "HELD", 100)
    assert written() == whole


def test_sequences_that_are_read_back_are_not_broadcast(spark, tmp_path):
    texts = [(i, " ".join(word(random.Random(i)) for _ in range(300))) for i in range(60)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    joined = QUERIES["op1_token_shards"](spark, str(tmp_path))
    assert len(joined.collect()) == joined.select("slot").distinct().count() > 60
    # The plan that ran: sizes are known only while it runs.
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_batches_are_signed_described_and_confirmed_a_part_at_a_time():
    rng = random.Random(4)
    texts = [" ".join(word(rng) for _ in range(rng.choice([0, 3, 30]))) if i % 50 else None for i in range(1999)] + ["long text " * 200_000]
    keys = pa.array([i.to_bytes(16, "big") for i in range(len(texts))])
    batch = pa.RecordBatch.from_pydict({"id": range(len(texts)), "text_key": keys, "class": keys, "a": keys, "b": keys} | {t: pa.array(texts) for t in ("text", "text_a", "text_b")})
    sets = [minhash.shingle_set(t, 5, minhash.WordHashes()) for t in texts]
    peaks = {}
    for name, step in (("sign", minhash._sign(5)), ("describe", minhash._describe(5))):
        tracemalloc.start()
        rows = 0
        for out in step(iter([batch])):
            assert out["n"].to_pylist() == [len(s) for s in sets[rows : rows + out.num_rows]] and out.num_rows <= 256
            rows += out.num_rows
        peaks[name] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == len(texts)
    # Sketches of all rows at once are 33 MB, several times over while they are made.
    assert peaks["describe"] < 80e6
    found = list(minhash._confirm(5, 80)(iter([batch.slice(1, 40), batch.slice(1900)])))
    assert len(found) > 2 and [a for out in found for a in out["a"].to_pylist()] == [k for i, k in enumerate(keys.to_pylist()) if 1 <= i <= 40 or i >= 1900]


class Reading(Counting):
    """A tokenizer that counts the characters it is given."""

    def encode_batch_fast(self, texts, **settings):
        self.texts += sum(map(len, texts))
        return self.model.encode_batch_fast(texts, **settings)


def test_words_are_tokenised_once_whatever_marks_and_lines_follow():
    rng, own = random.Random(5), packing.Tokens(packing.default_vocabulary())
    whole, own.model = own.model, Reading(own.model)
    known = ["".join(rng.choice("aeinorstlé") for _ in range(8)) for _ in range(200)]
    texts = ["".join(rng.choice(known) + rng.choice([" ", ", ", ". ", "!! ", ".\n", ";\n"]) for _ in range(400)).strip() for _ in range(50)]
    assert [ids.tolist() for ids in own.of(pa.array(texts))] == [whole.encode(t).ids for t in texts]
    # Each word after a space, after a new line and as a text's first, and the marks.
    assert own.model.texts < 5000


def test_texts_are_cut_only_where_the_pattern_cuts_them():
    rng, own = random.Random(6), packing.Tokens(packing.default_vocabulary())
    parts = [" ", " ", "\n", "\n\n", "\t", "\r\n", "\x00", "\x85", "\x1c", "a", "the.", "Thé", "日:", "'s", "1", "0.5", "!?", " .", ".x", "😀", "е.", "ɏ!", "\u0301", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(5000)] + ["", None, "\n", "a\n", "a \nb", "\na"]
    want = [e.ids for e in own.model.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
    assert [ids.tolist() for at in range(0, len(texts), 500) for ids in own.of(pa.array(texts[at : at + 500], pa.string()))] == want
