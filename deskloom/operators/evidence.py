"""From retrieved cases to a decision and a reply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.functions import lexicon as lex
from deskloom.functions import text as tx
from deskloom.functions.policy import Policy
from deskloom.functions.rules import consistent, with_signals


def with_consistency(evidence: DataFrame, policy: Policy) -> DataFrame:
    """Add ``is_consistent`` to evidence rows with ``intent`` and both sides' signals; signals
    that are not there yet are taken from ``customer_text`` and ``historical_customer``."""
    marked = evidence
    for text_col, out in (("customer_text", "current_signals"), ("historical_customer", "historical_signals")):
        if out not in marked.columns:
            marked = with_signals(marked, text_col, policy.signals, policy.synonyms, out)
    return marked.withColumn(
        "is_consistent",
        consistent(policy.gate, F.col("intent"), F.col("current_signals"), F.col("historical_signals")),
    )


def type_bonus(response_type: Column, policy: Policy) -> Column:
    bonus = None
    for name, value in policy.bonus.items():
        hit = response_type == name
        bonus = F.when(hit, F.lit(value)) if bonus is None else bonus.when(hit, F.lit(value))
    return F.lit(0.0) if bonus is None else bonus.otherwise(F.lit(0.0))


EVIDENCE_FIELDS = [
    "rank_no",
    "similarity",
    "case_id",
    "historical_customer",
    "historical_reply",
    "response_type",
]


def gather_evidence(evidence: DataFrame, policy: Policy) -> DataFrame:
    """One row per query: ``evidence`` (array in rank order), ``best_similarity`` and
    ``grounding`` (a struct, or null).

    The lists hold at most ``top_k`` entries, so everything after the one aggregation is done
    inside the row. Choosing comes first and the confidence gates second: if the best
    candidate fails a gate there is no fall-back to the next.
    """
    scored = with_consistency(evidence, policy).withColumn(
        "score", F.round(F.col("similarity") + type_bonus(F.col("response_type"), policy), 9)
    )
    item = F.struct(*EVIDENCE_FIELDS, "is_consistent", "score")
    lists = scored.groupBy("query_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    candidates = F.filter(
        "items", lambda e: (e["similarity"] >= policy.min_ground) & e["is_consistent"]
    )
    order = F.transform(
        candidates,
        lambda e: F.struct(e["score"].alias("score"), (-e["rank_no"]).alias("closeness"), e.alias("item")),
    )
    best = F.array_max(order)["item"]
    chosen = lists.withColumn("__best", best)
    weak = F.col("__best.response_type").isin(*policy.weak_types) if policy.weak_types else F.lit(False)
    passes = (F.col("__best.similarity") >= policy.min_auto) & (
        ~weak | (F.col("__best.similarity") >= policy.min_weak_type)
    )
    return chosen.select(
        "query_id",
        F.transform("items", lambda e: F.struct(*[e[f].alias(f) for f in EVIDENCE_FIELDS])).alias("evidence"),
        F.aggregate(
            "items", F.lit(0.0), lambda acc, e: F.greatest(acc, e["similarity"])
        ).alias("best_similarity"),
        F.when(passes, F.col("__best")).alias("grounding"),
    )


def choose_grounding(evidence: DataFrame, policy: Policy) -> DataFrame:
    """The chosen evidence row per query; queries without one are absent."""
    picked = gather_evidence(evidence, policy).filter(F.col("grounding").isNotNull())
    return picked.select("query_id", *[F.col("grounding")[f].alias(f) for f in EVIDENCE_FIELDS], F.col("grounding.score").alias("grounding_score"))


def decide(df: DataFrame, policy: Policy) -> DataFrame:
    """Add ``should_escalate`` and ``escalation_reason`` to rows with ``intent``,
    ``evidence_available``, ``best_similarity`` and ``grounding``."""
    intent = F.col("intent")
    reason = None
    for label, why in policy.always_escalate.items():
        hit = intent == label
        reason = F.when(hit, F.lit(why)) if reason is None else reason.when(hit, F.lit(why))

    def then(chain, hit, value):
        return F.when(hit, value) if chain is None else chain.when(hit, value)

    no_grounding = F.format_string(lex.REASON_NO_GROUNDING, F.coalesce(F.col("best_similarity"), F.lit(0.0)))
    reason = then(reason, ~F.col("evidence_available"), F.lit(lex.REASON_NO_EVIDENCE))
    reason = then(reason, F.col("grounding").isNull(), no_grounding)
    if policy.require_actionable:
        reason = then(
            reason,
            ~F.col("grounding.response_type").isin(*policy.actionable_types),
            F.lit(lex.REASON_NOT_ACTIONABLE),
        )
    auto = lex.REASON_AUTO_STRICT if policy.require_actionable else lex.REASON_AUTO
    out = df.withColumn("__why", reason)
    return (
        out.withColumn("should_escalate", F.col("__why").isNotNull())
        .withColumn("escalation_reason", F.coalesce(F.col("__why"), F.lit(auto)))
        .drop("__why")
    )


# --- the first policy: only the best hit counts ------------------------------------------------------


def safe_first_hit(evidence: DataFrame, policy: Policy) -> DataFrame:
    """Add ``is_safe`` to the rank-1 rows: similar enough and of a reusable type."""
    return evidence.filter(F.col("rank_no") == 1).withColumn(
        "is_safe",
        (F.col("similarity") >= policy.min_ground)
        & ~F.col("response_type").isin("unknown", "generic", "escalation"),
    )


def decide_first_hit(df: DataFrame, policy: Policy) -> DataFrame:
    """Escalation by the rank-1 hit alone: rows with ``intent``, ``evidence_available``,
    ``similarity`` (of rank 1, null if none) and ``is_safe``."""
    similarity = F.coalesce(F.col("similarity"), F.lit(0.0))
    reason = None
    for label, why in policy.always_escalate.items():
        hit = F.col("intent") == label
        reason = F.when(hit, F.lit(why)) if reason is None else reason.when(hit, F.lit(why))
    escalates = F.col("intent").isin(*policy.always_escalate)
    reason = (
        (F if reason is None else reason)
        .when(~F.col("evidence_available"), F.lit(lex.REASON_NO_EVIDENCE))
        .when(similarity < policy.min_ground, F.format_string(lex.REASON_V1_WEAK, similarity))
        .when(~F.coalesce(F.col("is_safe"), F.lit(False)), F.lit(lex.REASON_V1_UNSAFE))
        .when(similarity < policy.min_auto, F.format_string(lex.REASON_V1_LOW, similarity))
        .otherwise(F.format_string(lex.REASON_V1_AUTO, similarity))
    )
    auto = (
        ~escalates
        & F.col("evidence_available")
        & (similarity >= policy.min_auto)
        & F.coalesce(F.col("is_safe"), F.lit(False))
    )
    return df.withColumn("should_escalate", ~auto).withColumn("escalation_reason", reason)


# --- replies -----------------------------------------------------------------------------------------------


def _by_intent(texts: dict[str, str], default: Column) -> Column:
    chain = None
    for label, body in texts.items():
        hit = F.col("intent") == label
        chain = F.when(hit, F.lit(body)) if chain is None else chain.when(hit, F.lit(body))
    return default if chain is None else chain.otherwise(default)


def draft_reply(
    templates: dict[str, str] | None = None, default: str = lex.DRAFT_DEFAULT
) -> Column:
    """Template when escalated, otherwise the historical reply as it was."""
    texts = lex.DRAFT_ESCALATION if templates is None else templates
    return F.when(F.col("should_escalate"), _by_intent(texts, F.lit(default))).otherwise(
        F.coalesce(F.col("grounding.historical_reply"), F.lit(default))
    )


def draft_first_hit_reply(
    reply: Column, templates: dict[str, str] | None = None, default: str = lex.DRAFT_DEFAULT
) -> Column:
    """Template when escalated, otherwise the rank-1 reply unless it is empty or "nan"."""
    texts = lex.DRAFT_ESCALATION if templates is None else templates
    incomplete = reply.isNull() | (reply == "") | (F.lower(reply) == "nan")
    return (
        F.when(F.col("should_escalate"), _by_intent(texts, F.lit(default)))
        .when(incomplete, F.lit(lex.DRAFT_V1_INCOMPLETE))
        .otherwise(reply)
    )


def grounded_reply(
    df: DataFrame,
    policy: Policy,
    out: str = "reply",
    templates: dict[str, str] | None = None,
    reuse_when_escalated: bool = False,
    entities: str = "full",
) -> DataFrame:
    """Template, or the sanitised reply of reusable evidence, or a fall-back text.

    ``reuse_when_escalated`` lets escalated intents without a template of their own go through
    the evidence steps as well (the behaviour of the first generator).
    """
    texts = lex.GROUNDED_ESCALATION if templates is None else templates
    reply = "__sanitised"
    marked = df.withColumn(reply, tx.sanitize_reply(F.col("grounding.historical_reply"), entities))
    by_evidence = (
        F.when(~F.col("evidence_available"), F.lit(lex.GROUNDED_NO_EVIDENCE))
        .when(F.col("grounding").isNull(), F.lit(lex.GROUNDED_NO_GROUNDING))
        .when(F.col(reply) == "", F.lit(lex.GROUNDED_EMPTY))
        .when(F.col("grounding.response_type").isin(*policy.reusable_types), F.col(reply))
        .otherwise(F.lit(lex.GROUNDED_WEAK_TYPE))
    )
    escalated = _by_intent(texts, by_evidence if reuse_when_escalated else F.lit(lex.GROUNDED_DEFAULT))
    return marked.withColumn(out, F.when(F.col("should_escalate"), escalated).otherwise(by_evidence)).drop(reply)
