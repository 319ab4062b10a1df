"""Chat formatting (native): turns of a conversation -> one training text with a loss mask.

Turns are collected as structs, sorted by (turn, role, text), adjacent turns of one role are merged to a block, and the
pieces are concatenated; all by Spark expressions. A conversation becomes one row, so it has to fit a row.

Template: ``[INST]..[/INST]`` for user, ``<s>..</s>`` for assistant, ``<<SYS>>..<</SYS>>`` for system, and
``<|role|>NAME<|text|>..<|end|>`` for any other role. Turns merged into one block are parted by ``<|turn|>``.
A control string inside a text or role name gets a backslash after its first character (one more than it has), which
``unescape`` takes away again, so every text can be read back.

Defined cases: a null text or role is empty; a null conversation id is a conversation of its own; repeated rows are turns
of their own; rows of equal turn number are ordered by role, then text; null turn numbers come first; no rows give no rows.
Other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
ROLE, TEXT, END, NEXT = "<|role|>", "<|text|>", "<|end|>", "<|turn|>"
CONTROLS = [mark for pair in MARKS.values() for mark in pair] + [ROLE, TEXT, END, NEXT]

_REST = "(?=" + "|".join(re.escape(c[1:]) for c in CONTROLS) + ")"
_ESCAPE = r"([<\[])(\\*)" + _REST
_UNESCAPE = r"([<\[])\\(\\*)" + _REST
_OPEN = "|".join([re.escape(p[0]) for p in MARKS.values()] + [re.escape(ROLE) + ".*?" + re.escape(TEXT)])
_CLOSE = "|".join([re.escape(p[1]) for p in MARKS.values()] + [re.escape(END)])
_BLOCK = f"(?s)({_OPEN})(.*?)({_CLOSE})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPE), F.lit(r"$1\\$2"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_UNESCAPE), F.lit("$1$2"))


def _mark(role: Column, side: int) -> Column:
    other = F.concat(F.lit(ROLE), escape(role), F.lit(TEXT)) if side == 0 else F.lit(END)
    for name, pair in MARKS.items():
        other = F.when(role == name, F.lit(pair[side])).otherwise(other)
    return other


def format_conversations(
    turns: DataFrame,
    conversation: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conversation, formatted, segments``.

    ``segments`` are the pieces of ``formatted`` in order; their ``loss`` flag is the loss mask.
    """
    empty = F.lit("")
    turn = F.struct(
        F.col(order).alias("turn"),
        F.coalesce(F.col(role), empty).alias("role"),
        F.coalesce(F.col(text), empty).alias("text"),
    )
    collected = turns.groupBy(F.col(conversation).alias("conversation")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def role_at(i: Column) -> Column:
        return F.get(F.col("turns"), i)["role"]

    places = F.sequence(F.lit(0), F.size("turns") - 1)
    starts = F.filter(places, lambda i: (i == 0) | (role_at(i) != role_at(i - 1)))
    blocks = F.transform(
        "starts",
        lambda start, k: F.struct(
            role_at(start).alias("role"),
            F.transform(
                F.slice("turns", start + 1, F.coalesce(F.get(F.col("starts"), k + 1), F.size("turns")) - start), lambda t: t["text"]
            ).alias("texts"),
        ),
    )

    def pieces(block: Column) -> Column:
        def around(t: Column, i: Column) -> Column:
            before = F.when(i == 0, _mark(block["role"], 0)).otherwise(F.lit(NEXT))
            after = F.when(i == F.size(block["texts"]) - 1, _mark(block["role"], 1)).otherwise(empty)
            return F.array(
                F.struct(before.alias("text"), F.lit(False).alias("loss")),
                F.struct(escape(t).alias("text"), (block["role"] == loss_role).alias("loss")),
                F.struct(after.alias("text"), F.lit(False).alias("loss")),
            )

        return F.flatten(F.transform(block["texts"], around))

    segments = F.flatten(F.transform(blocks, pieces))
    return (
        collected.withColumn("starts", starts)
        .withColumn("segments", segments)
        .select("conversation", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text, as they were before merging and escaping."""
    opens = F.regexp_extract_all(formatted, F.lit(_BLOCK), F.lit(1))
    bodies = F.regexp_extract_all(formatted, F.lit(_BLOCK), F.lit(2))

    def role_of(mark: Column) -> Column:
        name = unescape(F.substring(mark, F.lit(len(ROLE) + 1), F.length(mark) - len(ROLE) - len(TEXT)))
        for role, pair in MARKS.items():
            name = F.when(mark == pair[0], F.lit(role)).otherwise(name)
        return name

    def turns_of(mark: Column, body: Column) -> Column:
        texts = F.split(body, re.escape(NEXT), -1)
        return F.transform(texts, lambda t: F.struct(role_of(mark).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.zip_with(opens, bodies, turns_of))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
