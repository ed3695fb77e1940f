"""Pairing messages with the replies they got, and reply chains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskloom.functions import text as tx
from deskloom.functions.policy import Policy
from deskloom.functions.rules import classify, with_response_type
from deskloom.operators.skew import ROWS_PER_TASK, keep_first, lookup_join
from deskloom.session import cut_lineage


def pair_replies(messages: DataFrame, brand: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """One row per brand reply whose parent exists and is not the brand's own message."""
    replies = messages.filter((F.col("author_id") == brand) & F.col("parent_id").isNotNull()).select(
        F.col("message_id").alias("reply_id"), "parent_id", F.col("text").alias("support_reply")
    )
    parents = messages.filter(F.col("author_id") != brand).select(
        F.col("message_id").alias("parent_id"),
        F.col("author_id").alias("customer_id"),
        F.col("text").alias("customer_text"),
    )
    return (
        lookup_join(replies, parents, "parent_id", spread_by=["reply_id"], rows_per_task=rows_per_task)
        .filter(F.col("customer_text").isNotNull() & F.col("support_reply").isNotNull())
        .select(
            "reply_id",
            F.col("parent_id").alias("message_id"),
            "customer_id",
            tx.strip(F.col("customer_text")).alias("customer_text"),
            tx.strip(F.col("support_reply")).alias("support_reply"),
        )
    )


def useful_pairs(
    pairs: DataFrame,
    min_chars: int = 20,
    min_words: int = 4,
    min_reply_chars: int = 5,
    raw_reply: bool = False,
) -> DataFrame:
    """Pairs whose message and reply say enough to learn from. ``raw_reply`` measures the
    reply before cleaning."""
    tmp = "__cleaned"
    reply = F.col("support_reply") if raw_reply else tx.clean(F.col("support_reply"), "index")
    return (
        pairs.withColumn(tmp, tx.clean(F.col("customer_text"), "index"))
        .filter(tx.is_useful(F.col(tmp), min_chars, min_words))
        .filter(F.length(reply) >= min_reply_chars)
        .drop(tmp)
    )


def build_cases(messages: DataFrame, brand: str, policy: Policy, min_chars: int = 20, min_words: int = 4) -> DataFrame:
    """Historical cases: paired, filtered, one per distinct message text, labelled."""
    pairs = useful_pairs(pair_replies(messages, brand), min_chars, min_words)
    distinct = keep_first(pairs, ["customer_text"], ["reply_id"]).withColumnRenamed("reply_id", "case_id")
    labelled = classify(distinct, policy.case_rules or policy.rules, "customer_text", "intent")
    return with_response_type(labelled, policy.responses, "support_reply")


def answered_messages(messages: DataFrame, brand: str) -> DataFrame:
    """Customer messages that the brand answered at least once."""
    answered = (
        messages.filter((F.col("author_id") == brand) & F.col("parent_id").isNotNull())
        .select(F.col("parent_id").alias("message_id"))
        .distinct()
    )
    return messages.filter(F.col("author_id") != brand).join(answered, "message_id", "left_semi")


def first_replies(messages: DataFrame, brand: str, min_chars: int = 12) -> DataFrame:
    """One row per customer message with the brand's earliest reply to it."""
    replies = messages.filter((F.col("author_id") == brand) & F.col("parent_id").isNotNull()).select(
        F.col("message_id").alias("reply_id"),
        F.col("created_at").alias("reply_created_at"),
        F.col("parent_id").alias("message_id"),
        F.col("text").alias("support_reply"),
    )
    earliest = keep_first(replies, ["message_id"], ["reply_created_at", "reply_id"])
    customers = messages.filter(F.col("author_id") != brand).select(
        "message_id",
        F.col("created_at").alias("customer_created_at"),
        tx.clean(F.col("text"), "squeeze").alias("customer_text"),
    )
    return (
        customers.join(earliest, "message_id")
        .withColumn("support_reply", tx.clean(F.col("support_reply"), "squeeze"))
        .filter(F.length("customer_text") >= min_chars)
    )


# --- chains -------------------------------------------------------------------------------------


def relevant_messages(messages: DataFrame, brands: Sequence[str]) -> DataFrame:
    """Brand messages and the messages they answer."""
    is_brand = F.col("author_id").isin(*brands)
    answered = (
        messages.filter(is_brand & F.col("parent_id").isNotNull())
        .select(F.col("parent_id").alias("message_id"))
        .distinct()
        .withColumn("__answered", F.lit(True))
    )
    joined = messages.join(answered, "message_id", "left")
    return joined.filter(is_brand | F.col("__answered")).drop("__answered")


def reply_chains(
    messages: DataFrame, brands: Sequence[str], relevant_only: bool = True, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """For every brand message the chain of parents up to the root.

    Returns ``message_id, author_id, root_id, length, customer_messages`` for chains with at
    least one customer message. A missing parent ends the chain. Path doubling needs about
    log2(longest chain) joins. Every round finishes some of the open chains unless all of
    them lead into a cycle; those are settled by their cycles.
    """
    base = relevant_messages(messages, brands) if relevant_only else messages
    nodes = base.select(
        "message_id",
        "author_id",
        "parent_id",
        (~F.col("author_id").isin(*brands)).cast("long").alias("customer"),
    )
    exists = nodes.select(F.col("message_id").alias("parent_id"), F.lit(True).alias("__found"))
    linked = lookup_join(nodes, exists, "parent_id", "left", ["message_id"], rows_per_task).withColumn(
        "next_id", F.when(F.col("__found"), F.col("parent_id"))
    )
    state = cut_lineage(
        linked.select(
            "message_id",
            "author_id",
            "next_id",
            F.col("message_id").alias("last_id"),
            F.lit(1).cast("long").alias("length"),
            F.col("customer").alias("customers"),
        )
    )
    edges = state.select("message_id", "author_id", "next_id", F.col("customers").alias("customer"))
    done, looping, left = _to_roots(state, rows_per_task)
    if left:
        looping = cut_lineage(edges.join(looping.select("message_id"), "message_id", "left_semi"))
        done = done.unionByName(_settle_cycles(looping, left, rows_per_task))
    return done.filter(F.col("author_id").isin(*brands) & (F.col("customers") > 0)).select(
        "message_id",
        "author_id",
        F.col("last_id").alias("root_id"),
        "length",
        F.col("customers").alias("customer_messages"),
    )


def _to_roots(state: DataFrame, rows_per_task: int) -> tuple[DataFrame, DataFrame, int]:
    """Path doubling: (rows that reached a root, rows that lead into a cycle, their number).

    next_id is the ancestor reached so far and still to be expanded, last_id the last one counted.
    """
    before = None
    left = state.filter(F.col("next_id").isNotNull()).count()
    while left and left != before:
        before = left
        ahead = state.select(
            F.col("message_id").alias("next_id"),
            F.col("next_id").alias("n_next"),
            F.col("last_id").alias("n_last"),
            F.col("length").alias("n_length"),
            F.col("customers").alias("n_customers"),
        )
        going = state.filter(F.col("next_id").isNotNull())
        moved = lookup_join(going, ahead, "next_id", "inner", ["message_id"], rows_per_task, left).select(
            "message_id",
            "author_id",
            F.col("n_next").alias("next_id"),
            F.col("n_last").alias("last_id"),
            (F.col("length") + F.col("n_length")).alias("length"),
            (F.col("customers") + F.col("n_customers")).alias("customers"),
        )
        state = cut_lineage(state.filter(F.col("next_id").isNull()).unionByName(moved))
        left = state.filter(F.col("next_id").isNotNull()).count()
    return state.filter(F.col("next_id").isNull()), state.filter(F.col("next_id").isNotNull()), left


def _settle_cycles(nodes: DataFrame, n: int, rows_per_task: int) -> DataFrame:
    """Chains of ``n`` messages (message_id, author_id, next_id, customer) that all lead into cycles.

    A walk over parents ends when it would take a parent again; the start itself may be reached once
    more, as its own ancestor. So a message on a cycle of L messages counts L + 1, itself twice, and
    one whose walk takes t steps to its cycle counts t + L and ends before the place it entered at.

    All in about log2(n) rounds of jumps of doubled length. After n steps every walk is on its cycle,
    and the messages reached are the cycles' own. The least id on the way, also doubled, names a
    cycle. The rest are paths to those messages, which ``_to_roots`` follows.
    """
    spark = nodes.sparkSession
    # a round is one job, not one for every exchange or broadcast
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in plain}
    for key, value in plain.items():
        spark.conf.set(key, value)
    try:
        jumps = nodes.select("message_id", F.col("next_id").alias("far"), F.col("message_id").alias("least"))
        steps = 1
        while steps < n:
            ahead = jumps.select(F.col("message_id").alias("far"), F.col("far").alias("n_far"), F.col("least").alias("n_least"))
            moved = lookup_join(jumps, ahead, "far", "inner", ["message_id"], rows_per_task, n)
            jumps = cut_lineage(moved.select("message_id", F.col("n_far").alias("far"), F.least("least", "n_least").alias("least")))
            steps *= 2
        reached = jumps.select(F.col("far").alias("message_id")).distinct()
        own = nodes.join(reached, "message_id", "left_semi").join(
            jumps.select("message_id", F.col("least").alias("cycle")), "message_id"
        )
        own = cut_lineage(own)
        sums = own.groupBy("cycle").agg(F.count(F.lit(1)).alias("size"), F.sum("customer").alias("all_customers"))
        on_cycle = cut_lineage(lookup_join(own, sums, "cycle", "inner", ["message_id"], rows_per_task, n))
        tails = nodes.join(on_cycle.select("message_id"), "message_id", "left_anti")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    done = on_cycle.select(
        "message_id",
        "author_id",
        F.lit(None).cast("string").alias("next_id"),
        F.col("message_id").alias("last_id"),
        (F.col("size") + 1).alias("length"),
        (F.col("customer") + F.col("all_customers")).alias("customers"),
    )
    if on_cycle.count() == n:
        return done
    start = {
        "last_id": F.col("message_id"),
        "length": F.lit(1).cast("long"),
        "customers": F.col("customer"),
    }
    columns = ["message_id", "author_id", "next_id", *start]
    ends = on_cycle.select("message_id", "author_id", F.lit(None).cast("string").alias("next_id"), "customer")
    state = tails.unionByName(ends).withColumns(start).select(*columns)
    paths, _, _ = _to_roots(cut_lineage(state), rows_per_task)
    entered = on_cycle.select(F.col("message_id").alias("last_id"), "size", "all_customers", F.col("customer").alias("own"))
    ends = on_cycle.select(F.col("next_id").alias("last_id"), F.col("message_id").alias("end_id"))
    led = paths.join(on_cycle.select("message_id"), "message_id", "left_anti")
    led = lookup_join(led, entered.join(ends, "last_id"), "last_id", "inner", ["message_id"], rows_per_task, n)
    return done.unionByName(
        led.select(
            "message_id",
            "author_id",
            "next_id",
            F.col("end_id").alias("last_id"),
            (F.col("length") - 1 + F.col("size")).alias("length"),
            (F.col("customers") - F.col("own") + F.col("all_customers")).alias("customers"),
        )
    )
