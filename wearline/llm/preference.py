"""Preference pairs: one prompt, two completions, and which characters to train on.

A pair is two conversations about the same start. Their longest common prefix of
turns (equal role and text) is rendered once as the prompt; what follows in each
is a completion. Loss is taken on the assistant's turns of a completion, end
mark included, and never on the prompt, on headers or on other roles; spans of
such characters come with each completion.

Turns of a pair are gathered in one aggregate with a sort per row, since a row of
the result is made of all of them; everything else happens inside the row.

Edge cases: a null text is empty and a null role is ``unknown``; turns with equal
numbers are ordered by role and text, repeated ones all kept, null numbers come
first; equal conversations are all prompt with empty completions (``n_common``
tells); a pair with one side only has an empty prompt and one completion; null
pair ids form a pair of their own; empty tables give no rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"
END = "<|end|>\n"


def _turns(df: DataFrame) -> DataFrame:
    return df.select(
        "pair_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def _header(role: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t["role"]), t["text"], F.lit(END))), "")


def _spans(turns: Column) -> Column:
    """Start and end, in characters of the rendered turns, of what is trained on."""
    start = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")
    )

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(_header(turn["role"]))
        end = begin + F.length(turn["text"]) + len(END)
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        spans = F.when(turn["role"] == TRAINED_ROLE, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step)["spans"]


def format_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Format turns (``pair_id``, ``turn``, ``role``, ``text``) of both sides.

    Returns ``pair_id``, ``n_common``, ``prompt``, ``chosen``, ``rejected``,
    ``chosen_spans`` and ``rejected_spans``.
    """
    both = _turns(chosen).withColumn("side", F.lit(0)).unionByName(_turns(rejected).withColumn("side", F.lit(1)))
    turn = F.struct("turn", "role", "text")
    sides = both.groupBy("pair_id").agg(
        *(
            F.sort_array(F.collect_list(F.when(F.col("side") == k, turn))).alias(name)
            for k, name in enumerate(("a", "b"))
        )
    )
    said = lambda turns: F.transform(turns, lambda t: F.struct(t["role"], t["text"]))
    unequal = F.zip_with(said(F.col("a")), said(F.col("b")), lambda x, y: ~x.eqNullSafe(y))
    # The position of the first difference; the shorter side ends with one.
    first = F.array_position(unequal, True)
    counted = sides.withColumn(
        "n_common", F.when(first > 0, first - 1).otherwise(F.size("a")).cast("int")
    )
    rest = {
        name: F.slice(side, F.col("n_common") + 1, F.greatest(F.size(side) - F.col("n_common"), F.lit(0)))
        for name, side in (("chosen_turns", F.col("a")), ("rejected_turns", F.col("b")))
    }
    cut = counted.withColumns({"prompt_turns": F.slice("a", F.lit(1), F.col("n_common")), **rest})
    return cut.select(
        "pair_id",
        "n_common",
        _rendered(F.col("prompt_turns")).alias("prompt"),
        _rendered(F.col("chosen_turns")).alias("chosen"),
        _rendered(F.col("rejected_turns")).alias("rejected"),
        _spans(F.col("chosen_turns")).alias("chosen_spans"),
        _spans(F.col("rejected_turns")).alias("rejected_spans"),
    )


def replies_of_neighbours(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected sides from plain conversations.

    Chosen is each conversation up to its last assistant turn. Rejected is the
    same up to that turn, which is answered with the last assistant turn of the
    conversation with the next number, or with nothing if there is none. Without
    an assistant turn both sides are the whole conversation.
    """
    turns = _turns(conversations.withColumnRenamed("conv_id", "pair_id"))
    replies = turns.filter(F.col("role") == TRAINED_ROLE).groupBy("pair_id")
    replies = replies.agg(F.max(F.struct("turn", "text")).alias("last"))
    other = replies.select((F.col("pair_id") - 1).alias("pair_id"), F.col("last.text").alias("other"))
    answers = replies.join(other, "pair_id", "left").select(
        "pair_id",
        F.col("last.turn").alias("last_turn"),
        F.col("last.text").alias("reply"),
        F.coalesce("other", F.lit("")).alias("other"),
    )
    joined = turns.join(answers, "pair_id", "left")
    kept = joined.filter(F.col("last_turn").isNull() | (F.col("turn") <= F.col("last_turn")))
    is_reply = (
        (F.col("turn") == F.col("last_turn")) & (F.col("role") == TRAINED_ROLE) & (F.col("text") == F.col("reply"))
    )
    columns = ("pair_id", "turn", "role")
    answered = F.when(F.coalesce(is_reply, F.lit(False)), F.col("other")).otherwise(F.col("text"))
    return kept.select(*columns, "text"), kept.select(*columns, answered.alias("text"))
