"""Preference formatting of conversation pairs, in DataFrame functions only.

A pair holds a chosen and a rejected conversation. Their longest common prefix of
equal turns (role and text) is rendered once, as the prompt; what follows on either
side is that side's completion. Each completion comes with its loss mask: the spans
of its rendered text, in characters, that hold assistant words; markers and the
turns of others are left out of the loss.

The turns of one conversation meet in one row, since a conversation is one training
example and one row of the result; all its turns and twice its text have to fit one row
(under 2 GB). Of a sibling only the one turn that is needed is found, by a maximum that
is combined before the shuffle, and joined.

Defined results: null roles and texts count as empty and are equal to each other;
turns are ordered by turn, then role, then text, null turns first, and repeated rows
are repeated turns; if one side is missing or is a prefix of the other, its
completion is empty with an empty mask; if both are equal, all is prompt; an empty
table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
_TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def head_of(role: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


END = "<|end|>\n"


def conversations(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per ``key``: its turns in order."""
    clean = lambda c: F.coalesce(F.col(c), F.lit(""))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), clean("role").alias("role"), clean("text").alias("text"))
    return turns.groupBy(key).agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(head_of(t["role"]), t["text"], F.lit(END))), "")


def _mask(turns: Column) -> Column:
    """start:end of each assistant text in the rendered turns, ends exclusive."""

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.length(head_of(t["role"]))
        end = start + F.length(t["text"])
        span = F.struct(start.alias("start"), end.alias("end"))
        found = F.when((t["role"] == ASSISTANT) & (end > start), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((end + len(END)).alias("at"), found.alias("spans"))

    none = F.array().cast("array<struct<start:int,end:int>>")
    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), none.alias("spans")), step)["spans"]


def common_turns(chosen: Column, rejected: Column) -> Column:
    """Length of the longest common prefix: the first place where they differ."""
    differ = F.zip_with(chosen, rejected, lambda a, b: ~(a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"])))
    at = F.array_position(F.transform(differ, lambda d: F.coalesce(d, F.lit(True))), True)
    shorter = F.least(F.size(chosen), F.size(rejected))
    return F.when(at > 0, F.least((at - 1).cast("int"), shorter)).otherwise(shorter)


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` (pair_id, chosen and rejected: arrays of turn, role, text) as
    pair_id, n_prompt (turns), prompt, chosen, rejected, chosen_mask, rejected_mask."""
    side = lambda c: F.coalesce(F.col(c), F.array().cast(_TURNS))
    cut = pairs.select("pair_id", side("chosen").alias("c"), side("rejected").alias("r")).withColumn("n", common_turns(F.col("c"), F.col("r")))
    rest = lambda c: F.slice(c, F.col("n") + 1, F.size(c))
    return cut.select(
        "pair_id",
        F.col("n").cast("long").alias("n_prompt"),
        _rendered(F.slice("c", 1, F.col("n"))).alias("prompt"),
        _rendered(rest("c")).alias("chosen"),
        _rendered(rest("r")).alias("rejected"),
        _mask(rest("c")).alias("chosen_mask"),
        _mask(rest("r")).alias("rejected_mask"),
    )


def sibling_pairs(turns: DataFrame) -> DataFrame:
    """Pairs for a table without judgements: a conversation is chosen; rejected is
    the same conversation with its last assistant turn, and what follows it, replaced
    by the last assistant turn of its sibling (conv_id 2k and 2k + 1 are siblings).
    Without a sibling's answer, rejected ends before the answer. Conversations
    without a conv_id, or without an assistant turn, make no pair."""
    known = turns.filter("conv_id is not null").withColumn("conv_id", F.col("conv_id").cast("long"))
    whole = conversations(known)
    last = F.aggregate(
        F.sequence(F.lit(0), F.size("turns") - 1),
        F.lit(-1),
        lambda acc, i: F.when(F.get("turns", i)["role"] == ASSISTANT, i).otherwise(acc),
    )
    own = whole.withColumn("last", last).filter(F.col("last") >= 0)
    # The last answer in the order of conversations(); null turns are the smallest.
    text = F.coalesce("text", F.lit(""))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.col("role").alias("role"), text.alias("text"))
    answers = known.filter(F.col("role") == ASSISTANT).groupBy(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("of")).agg(F.max(turn).alias("answer"))
    met = own.join(answers, F.col("conv_id") == F.col("of"), "left")
    other = F.when(F.col("answer").isNotNull(), F.array("answer")).otherwise(F.array().cast(_TURNS))
    rejected = F.concat(F.slice("turns", 1, F.col("last")), other)
    return met.select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"), rejected.alias("rejected"))
