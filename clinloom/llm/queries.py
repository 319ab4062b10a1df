"""The registered queries of this package: name -> callable, and name -> oracle SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinloom.llm import chat, hard_negatives, langid, minhash, mixing, packing, postings, repeats, runs, sharding, token_counts, token_shards, topk
from clinloom.llm.shared import table
from clinloom.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


_REST = "(<SYS>>|</SYS>>|INST\\]|/INST\\]|s>|/s>|\\|role\\|>|\\|text\\|>|\\|end\\|>|\\|turn\\|>)"


def _escaped(column: str) -> str:
    return f"regexp_replace({column}, '([<\\[])(\\\\*){_REST}', '\\1\\\\\\2\\3', 'g')"


@query(
    "op2_chat_format",
    f"""
with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed as (
    select *, lag(role) over w as earlier, lead(role) over w as later from rows
    window w as (partition by conv_id order by turn nulls first, role, text)
), written as (
    select *, case when earlier = role then '<|turn|>' else case role when 'user' then '[INST]' when 'assistant' then '<s>'
            when 'system' then '<<SYS>>' else '<|role|>' || {_escaped("role")} || '<|text|>' end end
        || {_escaped("text")}
        || case when later = role then '' else case role when 'user' then '[/INST]' when 'assistant' then '</s>'
            when 'system' then '<</SYS>>' else '<|end|>' end end as written
    from placed
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    sum(length(written))::bigint as formatted_chars
from written group by conv_id
""",
)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts are control strings; digests read back from the formatted texts."""
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    formatted = chat.format_conversations(turns.unionByName(odd))
    read = formatted.select(
        F.col("conversation").alias("conv_id"), "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")
    )
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query(
    "op10_mix_curriculum",
    """
with sized as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
        md5('0:' || coalesce(doc_id::varchar, '')) as digest
    from documents
), sources as (
    select source, sum(size)::bigint as source_size, (row_number() over (order by source nulls last) - 1) % 3 as place
    from sized group by source
), weighed as (
    select *, case place when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as weight, 2.0::double * source_size as cap
    from sources
), levels as (
    select *, (1.5::double * sum(source_size) over ()
        - coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
        / sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as level
    from weighed
), targets as (
    select source, source_size, coalesce(least(cap, weight * max(level) filter (level <= cap / weight) over ()), cap) as target from levels
), placed as (
    select s.*, t.source_size, t.target,
        sum(size) over (partition by s.source order by digest, size rows between unbounded preceding and current row) - size / 2::double as middle
    from sized s join targets t on s.source is not distinct from t.source
), taken as (
    select *, case when size = 0 then 0 else floor(target / source_size)
        + case when middle <= target - floor(target / source_size) * source_size then 1 else 0 end end as copies
    from placed
)
select doc_id, size, source_size, round(target, 3) as target, (size * copies)::bigint as taken from taken
""",
)
def op10_mix_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents; targets are rounded to thousandths of a word."""
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return plan.select(
        "row.doc_id", "size", "source_size", F.round("target", 3).alias("target"), (F.size("positions") * F.col("size")).cast("long").alias("taken")
    )


@query("op3_minhash_dedup")
def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents by 4-word shingles at a similarity of 0.8."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@query("op4_remove_repeats")
def op4_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 400-byte strings that occur more than once; ``text`` is what stays of a text."""
    cleaned = repeats.without_repeats(table(spark, sf_dir, "documents"), length=400, carry=["doc_id"])
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    spans = F.size("spans").cast("long").alias("n_spans")
    return cleaned.select("row.doc_id", "n_bytes", removed.alias("n_removed"), spans, F.sha2("kept", 256).alias("kept_sha256"), F.col("clean").alias("text"))


@query("op5_exact_top_k")
def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best matches of every 50th vector among all vectors."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return topk.exact_top_k(vectors, vectors.where("id % 50 = 0"), k=5)


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from those whose checksum class is not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out("doc_id")).select("text", "lang"))
    predicted = langid.predict(docs, model, carry=["doc_id"]).select("row.doc_id", "lang_pred", "score")
    return predicted.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query("op9_pack_sequences")
def op9_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as tokens, packed into sequences of at most 2048."""
    packed = packing.pack(table(spark, sf_dir, "documents"))
    return packed.select("row.doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


@query("op7_extendible_shards")
def op7_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, with shards of at most 8 MiB of text."""
    placed = sharding.shard(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return placed.select("row.doc_id", F.col("bytes").alias("n_bytes"), "shard", "depth", "shard_bytes", "oversize")


@query("op8_posting_lists")
def op8_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest neighbours found for every 20th vector."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return postings.nearest(vectors, vectors.where("id % 20 = 0"), k=20)


@query("op1_token_shards")
def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token sequences of all documents in training order, read back from the shards."""
    folder = scratch_dir(spark, "shards")
    index, manifest = token_shards.write_training_order(table(spark, sf_dir, "documents"), folder)
    read = token_shards.read_slots(spark, folder, manifest)
    # Both sides have a row for each sequence. Spark takes what is read from a shard to be as small as the shard's row in the
    # manifest, and would send all of it to the driver to broadcast it.
    return index.join(read.select("slot", F.crc32("ids").alias("ids_crc32")).hint("merge"), "slot")


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words that repeat a period four times or more, in all documents, with repetitions planted in every tenth."""
    planted = runs.with_stuttered_words(table(spark, sf_dir, "documents"))
    found = runs.periodic_runs(planted, carry=["doc_id"])
    # Runs come by start and period: of the longest, the first in order.
    longest = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))),
        F.get("runs", F.lit(0)),
        lambda best, r: F.when(r["length"] > best["length"], r).otherwise(best),
    )
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    read = found.select("row.doc_id", "runs", "collapsed", longest.alias("longest"), lines.alias("lines"))
    return read.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start",
        "longest.length",
        "longest.period",
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "op12_hard_negatives",
    """
with rows as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as vector
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select a.vec_id as anchor_id, r.vec_id, r.label = a.label as same, list_dot_product(a.vector, r.vector)::bigint as score
    from rows a join rows r on a.vec_id % 100 = 0 and r.vec_id <> a.vec_id
), positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, positive_id, (row_number() over best)::int as rank, n.vec_id as negative_id, positive_score, n.score as negative_score
from positives p join scored n on n.anchor_id = p.anchor_id and not n.same
    and 30 * positive_score <= 100 * n.score and 100 * n.score <= 90 * positive_score
window best as (partition by p.anchor_id, positive_id order by n.score desc, n.vec_id)
qualify row_number() over best <= 10
""",
)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of every 100th vector, below each of its five best matches of the same label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives.mine(rows, rows.where("id % 100 = 0"))


@query("op13_token_counts")
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of tokens of all documents."""
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return counted.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))
