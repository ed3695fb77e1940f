"""The whole triage as one plan: classify, retrieve, gate, decide, reply."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskloom.functions import text as tx
from deskloom.functions.policy import Policy
from deskloom.functions.rules import classify, with_signals
from deskloom.operators import evidence as ev
from deskloom.operators.retrieval import retrieve, with_cases
from deskloom.operators.tfidf import TfidfIndex
from deskloom.session import cut_lineage


def classified_messages(messages: DataFrame, policy: Policy) -> DataFrame:
    """(query_id, customer_text, intent, current_signals), written once: retrieval, evidence
    and decision all read it, each only the columns it needs."""
    labelled = classify(messages.select("query_id", "customer_text"), policy.rules, "customer_text", "intent")
    return cut_lineage(
        with_signals(labelled, "customer_text", policy.signals, policy.synonyms, "current_signals")
    )


def evidence_rows(
    classified: DataFrame, index: TfidfIndex, cases: DataFrame, policy: Policy, route_col: str = "intent"
) -> DataFrame:
    """(query_id, intent, current_signals, rank_no, similarity, case texts and signals) for
    classified messages. ``route_col`` names the label that chooses the part of the index, so
    an evaluation can route by the gold label instead."""
    hits = retrieve(classified, index, policy.top_k, "query_id", "customer_text", route_col)
    known = cases if "historical_signals" in cases.columns else with_signals(
        cases, "customer_text", policy.signals, policy.synonyms, "historical_signals"
    )
    return with_cases(hits, known).join(classified.select("query_id", "intent", "current_signals"), "query_id")


def with_grounding(classified: DataFrame, index: TfidfIndex, cases: DataFrame, policy: Policy) -> DataFrame:
    """Classified messages with ``evidence``, ``best_similarity``, ``grounding`` and
    ``evidence_available`` (the intent is indexed and the message is not empty)."""
    gathered = ev.gather_evidence(evidence_rows(classified, index, cases, policy), policy)
    # parts: one row per label of the rule set
    known = index.parts.select(F.col("part").alias("intent"), F.lit(True).alias("__indexed"))
    return (
        classified.drop("current_signals")
        .join(F.broadcast(known), "intent", "left")
        .join(gathered, "query_id", "left")
        .withColumn(
            "evidence_available",
            F.coalesce(F.col("__indexed"), F.lit(False)) & (tx.clean(F.col("customer_text"), "message") != ""),
        )
        .drop("__indexed")
    )


def triage(
    messages: DataFrame,
    index: TfidfIndex,
    cases: DataFrame,
    policy: Policy,
    entities: str = "full",
) -> DataFrame:
    """One result row per message (``query_id, customer_text``)."""
    joined = with_grounding(classified_messages(messages, policy), index, cases, policy)
    decided = ev.grounded_reply(ev.decide(joined, policy), policy, "reply", entities=entities)
    names = F.create_map(*[F.lit(x) for x in chain(*policy.intent_names.items())])
    return decided.select(
        "query_id",
        "customer_text",
        "intent",
        names[F.col("intent")].alias("intent_name"),
        "should_escalate",
        "escalation_reason",
        "reply",
        ev.draft_reply().alias("draft"),
        "evidence_available",
        F.coalesce(F.size("evidence"), F.lit(0)).alias("evidence_count"),
        F.coalesce("best_similarity", F.lit(0.0)).alias("best_similarity"),
        "evidence",
        "grounding",
    )


def predictions(results: DataFrame, gold: DataFrame) -> DataFrame:
    """Triage results next to gold labels (``query_id, gold_intent``) in the one schema that
    all evaluation operators read."""
    return results.join(gold.select("query_id", "gold_intent"), "query_id").select(
        F.col("query_id").alias("case_id"),
        "customer_text",
        "gold_intent",
        F.col("intent").alias("predicted_intent"),
        (F.col("intent") == F.col("gold_intent")).alias("intent_correct"),
        "should_escalate",
        "escalation_reason",
        "reply",
        "evidence_available",
        F.col("grounding").isNotNull().alias("evidence_selected"),
        F.coalesce("grounding.similarity", F.lit(0.0)).alias("selected_similarity"),
        F.coalesce("grounding.response_type", F.lit("")).alias("selected_response_type"),
        F.coalesce("grounding.historical_customer", F.lit("")).alias("selected_customer"),
        F.coalesce("grounding.historical_reply", F.lit("")).alias("selected_reply"),
    )
