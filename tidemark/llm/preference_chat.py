"""Operator 5. Preference formatting of chosen and rejected conversations.

For a pair, the longest common prefix of turns (equal role and text, position
by position) is rendered once as the prompt; what follows in either
conversation is its completion, with a mask: the character spans ("start:end",
joined by commas) of the completion that a model is trained on, namely the text
and end mark of its assistant turns. Rendering is one block a turn:
``<|im_start|>role\\ntext<|im_end|>\\n``. Prompt and completion together are the
whole conversation; nothing is truncated. Only DataFrame functions are used.

``pairs`` derives pairs from a table of conversations: conversations with the
same opening turn are siblings and are paired in order of their ids, the longer
of two being the chosen one (ties: the smaller id). At most one conversation of
an opening is left over: it is the chosen one against itself with a stale last
reply: its last assistant turn replaced by the assistant turn before it, or dropped
if there is none, and later turns dropped. A conversation's place among its siblings
comes from ranges of (opening, id) and the counts of the ranges before, so an
opening with a third of all conversations is in no single task; only openings
(their MD5) and ids are moved for it.

Edge cases: null roles are "user", null texts are empty; turns with a null
conversation are dropped, as they belong to none; turns that repeat a position
are ordered by role and text, null positions come first; equal conversations
have empty completions and empty masks; a conversation without assistant turns
has an equal copy as its rejected one; an empty table gives no rows; other
columns do not reach the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.split_windows import RangeSplit
from .common import saved

START, END = "<|im_start|>", "<|im_end|>"


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and turns (array of role, text in order), one row per conversation."""
    t = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("user")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    return t.groupBy("conv_id").agg(F.transform(ordered, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def pairs(convs: DataFrame) -> DataFrame:
    """chosen_id, rejected_id (null: the stale copy), chosen and rejected (arrays of turns)."""
    first = F.get("turns", F.lit(0))
    opening = F.md5(F.concat(F.length(first["role"]).cast("string"), F.lit(":"), first["role"], first["text"]).cast("binary"))
    placed = RangeSplit(convs.select("conv_id", F.size("turns").alias("n"), opening.alias("opening")), ["opening"], ["conv_id"]).numbered("nth")
    couple = placed.groupBy("opening", F.floor(F.col("nth") / 2).alias("c")).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("shorter"), "conv_id"))).alias("two"))
    ids = couple.select(F.col("two")[0]["conv_id"].alias("chosen_id"),
                        F.get("two", F.lit(1))["conv_id"].alias("rejected_id"))
    chosen = convs.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("chosen"))
    rejected = convs.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("rejected"))
    both = ids.join(chosen, "chosen_id")
    return both.where("rejected_id is not null").join(rejected, "rejected_id").select(
        "chosen_id", "rejected_id", "chosen", "rejected").unionByName(
        both.where("rejected_id is null").select("chosen_id", "rejected_id", "chosen", stale("chosen").alias("rejected")))


def stale(turns: str) -> Column:
    """The turns up to the last assistant turn, which is replaced by the assistant turn before it (or dropped)."""
    replies = F.filter(F.transform(turns, lambda x, i: F.when(x["role"] == "assistant", i)), lambda i: i.isNotNull())
    n = F.size(replies)
    last, before = F.element_at(replies, -1), F.element_at(replies, -2)
    head = F.slice(turns, F.lit(1), F.coalesce(last, F.lit(0)))
    return (F.when(n == 0, F.col(turns)).when(n == 1, head)
            .otherwise(F.concat(head, F.slice(turns, F.coalesce(before, F.lit(0)) + 1, F.lit(1)))))


def _render(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit("\n"), turn["text"], F.lit(END + "\n"))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _render), "")


def _mask(turns: Column) -> Column:
    """Spans of the text and end mark of assistant turns, from the lengths of the turns before."""
    length = lambda x: F.length(_render(x))
    step = lambda s, x: F.struct(
        (s["at"] + length(x)).alias("at"),
        F.when(x["role"] == "assistant", F.array_append(s["spans"], F.concat_ws(
            ":", (s["at"] + F.length(F.lit(START + "\n")) + F.length(x["role"])).cast("string"),
            (s["at"] + length(x) - 1).cast("string")))).otherwise(s["spans"]).alias("spans"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.aggregate(turns, start, step, lambda s: F.array_join(s["spans"], ","))


def common_turns(a: str, b: str) -> Column:
    """Number of leading turns that are equal in both."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x.eqNullSafe(y), F.lit(False)))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def formatted(pair_rows: DataFrame) -> DataFrame:
    """The columns of ids and, per pair: n_common, prompt, chosen, rejected (completions) and their masks."""
    p = pair_rows.withColumn("n_common", common_turns("chosen", "rejected"))
    rest = lambda c: F.slice(c, F.col("n_common") + 1, F.size(c))
    cut = p.select("chosen_id", "rejected_id", "n_common", F.slice("chosen", F.lit(1), F.col("n_common")).alias("p"),
                   F.when(F.size("chosen") > 0, rest("chosen")).alias("c"), F.when(F.size("rejected") > 0, rest("rejected")).otherwise(
                       F.slice("chosen", 1, 0)).alias("r"))
    return cut.select("chosen_id", "rejected_id", "n_common", _text(F.col("p")).alias("prompt"), _text(F.col("c")).alias("chosen"),
                      _mask(F.col("c")).alias("chosen_mask"), _text(F.col("r")).alias("rejected"),
                      _mask(F.col("r")).alias("rejected_mask"))


def preferences(turns: DataFrame) -> DataFrame:
    """Preference rows of a table of turns (conv_id, turn, role, text)."""
    return formatted(pairs(saved(conversations(turns), "conversations")))
