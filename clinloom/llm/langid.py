"""Language identification, word first with back-off.

A model holds, per language, log frequencies of words and of character n-grams of 1 to ``longest`` characters (with word
ends marked). A known word is scored by its log frequencies. An unknown word is split into its longest n-grams; if none of
them is known, into the next shorter ones, and so on. The score of a text is the sum over its words; the prediction's score
is the share of the best language after exponentiation (a probability, if words were independent).

The model is fitted on a bounded sample of the labelled rows: each language gives about ``sample`` documents (all, if it has
fewer), chosen by a hash of their text, and WORDS words and GRAMS n-grams of each length are kept: those with the largest share of any
one language, so a language with few rows keeps its own. So the model is bounded and is sent to the tasks; every text is
scored as a whole. ``evidence`` is the share of its words of which the model knows something.

Defined cases: a null text or one without letters is ``und`` with score 0; letters of no known word or n-gram give the most
frequent language with its share and no evidence; more than ``most_languages`` learned ones are an error; no labelled rows make every text ``und``; null labels are not learned from; equal scores
go to the smaller name; repeated rows are predicted alike. Columns are carried in one struct.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.packing import slices
from clinloom.llm.shared import store

SAMPLE = 2000
WORDS = 60_000
GRAMS = 60_000
LONGEST = 4
MOST_LANGUAGES = 1024
CACHED_WORDS = 200_000
UNKNOWN = "und"
LETTERS = r"[^\p{L}]+"


@dataclass
class Table:
    """Log scores of words, or of n-grams of one length: a row of the matrix for each, found by its place."""

    places: dict[str, int]
    scores: np.ndarray


@dataclass
class Model:
    languages: list[str]
    shares: np.ndarray
    words: Table
    grams: list[Table] = field(default_factory=list)

    def word(self, word: str) -> np.ndarray | None:
        """Log scores of a word, one per language; none if nothing of it is known."""
        known = self.words.places.get(word)
        if known is not None:
            return self.words.scores[known]
        marked = f"^{word}$"
        for n in range(len(self.grams), 0, -1):
            table = self.grams[n - 1]
            found = [table.places[g] for g in (marked[i : i + n] for i in range(len(marked) - n + 1)) if g in table.places]
            if found:
                return table.scores[found].mean(axis=0)
        return None


def _words(text: pa.Array) -> pa.ListArray:
    lower = pc.utf8_lower(pc.fill_null(text, ""))
    return pc.split_pattern(pc.utf8_trim(pc.replace_substring_regex(lower, LETTERS, " "), " "), " ")


def _count(longest: int):
    """Words of each slice and their n-grams with counts: ``lang, n, item, found``; n is 0 for words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            split = _words(batch["text"])
            langs = pc.take(batch["lang"], pc.list_parent_indices(split))
            table = pa.table({"lang": langs, "item": pc.list_flatten(split)}).group_by(["lang", "item"]).aggregate([([], "count_all")])
            totals: dict[tuple[str, int, str], int] = defaultdict(int)
            for row in table.to_pylist():
                word, found = row["item"], row["count_all"]
                if not word:
                    continue
                totals[row["lang"], 0, word] += found
                marked = f"^{word}$"
                for n in range(1, longest + 1):
                    for i in range(len(marked) - n + 1):
                        totals[row["lang"], n, marked[i : i + n]] += found
            keys = list(totals)
            columns = [pa.array([k[i] for k in keys], t) for i, t in ((0, pa.string()), (1, pa.int32()), (2, pa.string()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(totals.values()), pa.int64())], names=["lang", "n", "item", "found"])

    return run


def fit(labelled: DataFrame, sample: int = SAMPLE, words: int = WORDS, grams: int = GRAMS, longest: int = LONGEST, most_languages: int = MOST_LANGUAGES) -> Model:
    """A model from ``text, lang`` rows. Reads about ``sample`` documents per language, and keeps bounded tables."""
    usable = labelled.where("lang is not null and text is not null")
    totals = usable.groupBy("lang").count().limit(most_languages + 1).collect()
    if len(totals) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    languages = sorted(r["lang"] for r in totals)
    documents = {r["lang"]: r["count"] for r in totals}
    if not languages:
        return Model([], np.empty(0), Table({}, np.empty((0, 0))))
    every = sum(documents.values())
    tables: list[Table] = []
    share = F.create_map(*[F.lit(v) for x in languages for v in (x, min(1.0, sample / documents[x]))])
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / float(1 << 20)
    chosen = usable.where(place < share[F.col("lang")]).select("lang", "text")
    found_ = chosen.mapInArrow(_count(longest), "lang string, n int, item string, found long").groupBy("n", "item", "lang").agg(F.sum("found").alias("found"))
    # Counted once; the sums and the tables are read from there.
    counted = store(found_, "counted")
    sums = counted.groupBy("n", "lang").agg(F.sum("found").alias("every"))
    base = {(r["n"], r["lang"]): r["every"] for r in sums.collect()}
    shares = counted.join(F.broadcast(sums), ["n", "lang"]).withColumn("share", F.col("found") / F.col("every"))
    whole = store(
        shares.groupBy("n", "item").agg(F.max("share").alias("share"), F.map_from_entries(F.collect_list(F.struct("lang", "found"))).alias("by")), "entries"
    )
    # One bounded list of words and one per n-gram length.
    for n in range(longest + 1):
        top = whole.where(F.col("n") == n).orderBy(F.col("share").desc(), "item").limit(words if n == 0 else grams)
        rows = top.select("item", *[F.coalesce(F.col("by")[x], F.lit(0)).alias(f"c{i}") for i, x in enumerate(languages)]).toPandas()
        found = rows.iloc[:, 1:].to_numpy(np.float64)
        seen = np.array([base.get((n, x), 0) for x in languages], np.float64)
        logs = np.log((found + 0.5) / (seen + 0.5 * max(1, len(rows))))
        scores = logs - logs.max(axis=1, keepdims=True) if len(rows) else logs
        tables.append(Table({item: i for i, item in enumerate(rows["item"])}, scores))
    return Model(languages, np.array([documents[x] / every for x in languages]), tables[0], tables[1:])


def _predict(shared, inside: str | None):
    """``inside`` names the field of ``row`` that is the text; none if it is a column beside it."""

    def texts(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch if inside is None else pa.RecordBatch.from_arrays([batch["row"], batch["row"].field(inside)], names=["row", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        cache: dict[str, int] = {}
        # Scores of the words met so far, and as a last column whether the model knows something of them.
        known = np.zeros((1024, len(model.languages) + 1))
        # Some megabytes of text at a time: what is made of a slice is many times as large as its text.
        for batch in itertools.chain.from_iterable(slices(texts(b)) for b in batches):
            split = _words(batch["text"])
            items = pc.list_flatten(split)
            coded = items.dictionary_encode()
            if len(cache) > CACHED_WORDS:
                cache.clear()
            names = coded.dictionary.to_pylist()
            rows = np.empty(len(names), np.int64)
            for i, word in enumerate(names):
                at = cache.get(word)
                if at is None:
                    at = cache[word] = len(cache)
                    if at >= len(known):
                        known = np.concatenate((known, np.zeros_like(known)))
                    scores = model.word(word) if word else None
                    known[at] = 0.0 if scores is None else np.append(scores, 1.0)
                rows[i] = at
            parents = pc.list_parent_indices(split).to_numpy()
            letters = np.array([bool(w) for w in names], bool)
            codes = coded.indices.to_numpy()
            sums = np.zeros((batch.num_rows, len(model.languages)))
            for j in range(len(model.languages)):
                sums[:, j] = np.bincount(parents, known[rows[codes], j], batch.num_rows) if len(codes) else 0
            words = np.bincount(parents, letters[codes], batch.num_rows) if len(codes) else np.zeros(batch.num_rows)
            lettered = words > 0
            evidence = (np.bincount(parents, known[rows[codes], -1], batch.num_rows) if len(codes) else words) / np.maximum(1, words)
            if model.languages:
                sums += np.log(model.shares)
                best = sums.argmax(axis=1)
                share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                lang = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist())]
                score = np.where(lettered, share, 0.0)
            else:
                lang, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            columns = [batch["row"], pa.array(lang, pa.string()), pa.array(score), pa.array(evidence)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "lang_pred", "score", "evidence"])
            pa.default_memory_pool().release_unused()

    return run


def predict(docs: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``row`` (the columns of ``carry``, or all), ``lang_pred, score, evidence`` of every text."""
    columns = docs.columns if carry is None else carry
    # A text that is carried is sent once.
    beside = [] if text in columns else [F.col(text).alias("text")]
    read = docs.select(F.struct(*map(F.col, columns)).alias("row"), *beside)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = read.schema["row"].dataType.simpleString()
    return read.mapInArrow(_predict(shared, None if beside else text), f"row {kind}, lang_pred string, score double, evidence double")


def held_out(identity: str = "doc_id"):
    """Whether a document is kept from training: the checksum of its id as text modulo 3 is 1."""
    return F.pmod(F.crc32(F.coalesce(F.col(identity).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1
