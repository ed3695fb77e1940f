"""Preference pairs rendered for training, in DataFrame operations only.

A pair holds a chosen and a rejected conversation. Their longest common prefix of turns, equal in
role and text, is rendered once as the prompt; what is left of each is rendered as a completion.
A completion comes with the spans that a loss may see: the text and end mark of the turns of the
trained role, in code points of ``prompt || completion``. All other characters are masked.

Defined results: a null turn list is an empty one; a null role or text in a turn is an empty
string, and equals another null; two equal conversations share all their turns, so the last turn
of the trained role, and what follows it, goes to both completions (the prompt ends before it);
without such a turn both completions are empty; conversations without a common turn have an empty
prompt. Turns are ordered by turn number, then role and text, so repeated and tied turns have an
order. Rows with a null conversation id are no conversation. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.llm.common import pick

TRAINED_ROLE = "assistant"
OPEN, AFTER_ROLE, CLOSE = "<|", "|>\n", "<|end|>\n"


def conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, turns): one row per conversation with its ordered (role, text) turns. A
    conversation is one training example, so its turns fit in one row."""
    rows = pick(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col).filter(F.col("conv_id").isNotNull())
    held = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return rows.groupBy("conv_id").agg(_without_nulls(held).alias("turns"))


def _without_nulls(turns: Column) -> Column:
    return F.transform(
        turns, lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text"))
    )


def common_turns(chosen: Column, rejected: Column) -> Column:
    """The number of leading turns that are equal."""
    least = F.least(F.size(chosen), F.size(rejected))
    places = F.filter(F.sequence(F.lit(1), F.greatest(least, F.lit(1))), lambda i: i <= least)
    differing = F.filter(
        places, lambda i: ~F.element_at(chosen, i.cast("int")).eqNullSafe(F.element_at(rejected, i.cast("int")))
    )
    return F.coalesce(F.try_element_at(differing, F.lit(1)) - 1, least)


def rendered(turns: Column) -> Column:
    parts = F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(AFTER_ROLE), t["text"], F.lit(CLOSE)))
    return F.array_join(parts, "")


def loss_spans(turns: Column, offset: Column, role: str) -> Column:
    """(start, end) of the text and end mark of every turn of ``role``, in the order of turns."""
    start = F.struct(offset.cast("int").alias("at"), F.expr("array()").cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + len(OPEN) + F.length(turn["role"]) + len(AFTER_ROLE)
        end = (begin + F.length(turn["text"]) + len(CLOSE)).cast("int")
        span = F.struct(begin.cast("int").alias("start"), end.alias("end"))
        spans = F.when(turn["role"] == role, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda s: s["spans"])


def preference_pairs(
    pairs: DataFrame, chosen_col: str = "chosen", rejected_col: str = "rejected", role: str = TRAINED_ROLE
) -> DataFrame:
    """``pairs`` with n_common, prompt, chosen_text, rejected_text, chosen_spans and rejected_spans
    in place of the two turn lists, which are arrays of (role, text)."""
    empty = F.expr("array()").cast("array<struct<role:string,text:string>>")
    chosen, rejected = (_without_nulls(F.coalesce(F.col(f"`{c}`"), empty)) for c in (chosen_col, rejected_col))
    others = [c for c in pairs.columns if c not in (chosen_col, rejected_col)]
    base = pairs.select(
        *[F.col(f"`{c}`") for c in others], chosen.alias("__c"), rejected.alias("__r"), common_turns(chosen, rejected).alias("__n")
    )
    same = (F.col("__n") == F.size("__c")) & (F.col("__n") == F.size("__r"))
    placed = F.transform("__c", lambda t, i: F.when(t["role"] == role, i).otherwise(-1))
    last = F.coalesce(F.array_max(placed), F.lit(-1))
    cut = F.when(same & (last >= 0), last).otherwise(F.col("__n")).cast("int")
    base = base.withColumn("__n", cut)
    base = base.select(
        *[F.col(f"`{c}`") for c in others],
        F.col("__n").alias("n_common"),
        rendered(F.slice("__c", F.lit(1), F.col("__n"))).alias("prompt"),
        F.slice("__c", F.col("__n") + 1, F.size("__c")).alias("__c"),
        F.slice("__r", F.col("__n") + 1, F.size("__r")).alias("__r"),
    )
    return base.select(
        *[F.col(f"`{c}`") for c in others],
        "n_common",
        "prompt",
        rendered(F.col("__c")).alias("chosen_text"),
        rendered(F.col("__r")).alias("rejected_text"),
        loss_spans(F.col("__c"), F.length("prompt"), role).alias("chosen_spans"),
        loss_spans(F.col("__r"), F.length("prompt"), role).alias("rejected_spans"),
    )
