"""Conversations as one training text each, with the spans the loss counts (expressions only).

Turns are collected and sorted (by turn, then role and text), neighbours of one role
are merged into a block by an array aggregation, and blocks are concatenated::

    ### Assistant: first text
    <part>
    second text
    </turn>

In texts a backslash, ``#`` and ``<`` are escaped by a backslash, so no text can hold a
control string, and reading is a split at ``\\n</turn>\\n`` and ``\\n<part>\\n`` with the
escapes taken back. The three usual roles are written with a capital; any other as ``=``
and the role, escaped likewise (and its colons).

Defined cases: a null text is empty, a null role is the empty role, null turns sort first;
rows with equal turns and repeated rows all count; rows with a null conv_id are one
conversation of that id; other columns are ignored. A conversation is one row of the
result, so it must fit into memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, COLON, PART, END = "### ", ": ", "\n<part>\n", "\n</turn>\n"
ROLES = {"system": "System", "user": "User", "assistant": "Assistant"}
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    for c in ("\\", "#", "<"):
        text = F.replace(text, F.lit(c), F.lit("\\" + c))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def shown(role: Column) -> Column:
    other = F.concat(F.lit("="), F.replace(escaped(role), F.lit(":"), F.lit("\\:")))
    out = F.when(role == list(ROLES)[0], ROLES[list(ROLES)[0]])
    for name in list(ROLES)[1:]:
        out = out.when(role == name, ROLES[name])
    return out.otherwise(other)


def meant(name: Column) -> Column:
    items = list(ROLES.items())
    out = F.when(name == items[0][1], items[0][0])
    for role, display in items[1:]:
        out = out.when(name == display, role)
    return out.otherwise(unescaped(F.substr(name, F.lit(2))))


def _merge(blocks: Column, turn: Column) -> Column:
    last = F.element_at(blocks, -1)
    again = (F.size(blocks) > 0) & (F.element_at(F.transform(blocks, lambda b: b["role"]), -1) == turn["role"])
    longer = F.concat(F.slice(blocks, 1, F.size(blocks) - 1),
                      F.array(F.struct(turn["role"].alias("role"),
                                       F.concat(last["parts"], F.array(turn["text"])).alias("parts"))))
    return F.when(again, longer).otherwise(
        F.concat(blocks, F.array(F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("parts")))))


def formatted(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans): spans are ``[start, end)`` in code points, one for each
    assistant text."""
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    none = F.expr("cast(array() as array<struct<role:string,parts:array<string>>>)")
    blocks = turns.withColumn("blocks", F.aggregate("turns", none, _merge))
    written = blocks.select("conv_id", F.transform("blocks", lambda b: F.struct(
        b["role"].alias("role"), F.concat(F.lit(HEAD), shown(b["role"]), F.lit(COLON)).alias("head"),
        F.transform(b["parts"], escaped).alias("parts"))).alias("blocks"))
    whole = F.array_join(F.transform("blocks", lambda b: F.concat(
        b["head"], F.array_join(b["parts"], PART), F.lit(END))), "")
    # every part with the length of what stands before it since the last part's end
    pieces = F.flatten(F.transform("blocks", lambda b, k: F.transform(b["parts"], lambda p, i: F.struct(
        (F.when(i > 0, len(PART)).otherwise(
            F.char_length(b["head"]) + F.when(k > 0, len(END)).otherwise(0))).alias("gap"),
        F.char_length(p).alias("size"), (b["role"] == LEARNED).alias("learned")))))
    start = F.expr("struct(cast(0 as int) as at, "
                   "cast(array() as array<struct<start:int,end:int>>) as spans)")

    def span(acc, p):
        a = (acc["at"] + p["gap"]).cast("int")
        b = (a + p["size"]).cast("int")
        return F.struct(b.alias("at"), F.when(p["learned"], F.concat(
            acc["spans"], F.array(F.struct(a.alias("start"), b.alias("end"))))).otherwise(acc["spans"])
            .alias("spans"))

    return written.select("conv_id", whole.alias("formatted"),
                          F.aggregate(pieces, start, span, lambda acc: acc["spans"]).alias("loss_spans"))


def read_back(texts: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_texts) of ``texts(conv_id, formatted, loss_spans)``; turns hold role
    and text of every original turn."""
    blocks = F.split("formatted", END)
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)
    shape = r"(?s)^### ((?:[^\\:]|\\.)*): (.*)$"

    def turns(block):
        role = meant(F.regexp_extract(block, shape, 1))
        return F.transform(F.split(F.regexp_extract(block, shape, 2), PART),
                           lambda p: F.struct(role.alias("role"), unescaped(p).alias("text")))

    return texts.select(
        "conv_id", "formatted", F.flatten(F.transform(blocks, turns)).alias("turns"),
        F.transform("loss_spans", lambda s: unescaped(
            F.substr(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))).alias("loss_texts"))


def digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), all from the
    formatted texts."""
    back = read_back(formatted(conversations))
    loss = F.array_join("loss_texts", "")
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
