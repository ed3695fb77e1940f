from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from deskloom.functions import lexicon as lex
from deskloom.functions.policy import SUPPORT
from deskloom.operators import evidence as ev
from deskloom.operators import tfidf
from deskloom.plans.triage import triage

NOW, THEN = "my router is dead", "the modem is dead"
SCHEMA = (
    "query_id int, rank_no int, similarity double, response_type string, historical_customer string, "
    "case_id int, customer_text string, intent string, historical_reply string"
)


def evidence(spark, *rows):
    """rows: (rank, similarity, type, historical text)"""
    full = [(1, r, s, t, h, 100 + r, NOW, "I03", f"reply {r} ^AB") for r, s, t, h in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.mark.parametrize(
    "rows, chosen",
    [
        ([(1, 0.19, "troubleshooting", THEN)], None),
        ([(1, 0.5, "troubleshooting", "tv is off")], None),
        # the best score wins even if a later gate rejects it
        ([(1, 0.31, "unknown", THEN), (2, 0.29, "troubleshooting", THEN)], None),
        ([(1, 0.31, "clarification", THEN), (2, 0.30, "troubleshooting", THEN)], 2),
        ([(1, 0.59, "unknown", THEN)], None),
        ([(1, 0.60, "unknown", THEN)], 1),
        ([(1, 0.60, "generic", THEN)], 1),
        # a tie on the score goes to the earlier rank
        ([(1, 0.44, "clarification", THEN), (2, 0.40, "account_action", THEN)], 1),
        ([(1, 0.90, "troubleshooting", "tv is off"), (2, 0.30, "troubleshooting", THEN)], 2),
        ([(1, 0.35, "escalation", THEN)], 1),
    ],
)
def test_choice(spark, rows, chosen):
    got = ev.choose_grounding(evidence(spark, *rows), SUPPORT).collect()
    assert [r.rank_no for r in got] == ([chosen] if chosen else [])


def decided(spark, policy, intent="I03", available=True, best=0.0, grounding=None):
    df = spark.createDataFrame(
        [(intent, available, best, grounding)],
        "intent string, evidence_available boolean, best_similarity double, "
        "grounding struct<similarity:double,response_type:string,historical_reply:string>",
    )
    return ev.grounded_reply(ev.decide(df, policy), policy).withColumn("draft", ev.draft_reply()).first()


def test_decisions_and_replies(spark):
    for intent, why in lex.REASON_BY_INTENT.items():
        row = decided(spark, SUPPORT, intent, grounding=(0.9, "troubleshooting", "r"))
        assert (row.should_escalate, row.escalation_reason) == (True, why)
        assert row.reply == lex.GROUNDED_ESCALATION[intent] and row.draft == lex.DRAFT_ESCALATION[intent]
    row = decided(spark, SUPPORT, available=False)
    assert row.escalation_reason == lex.REASON_NO_EVIDENCE and row.reply == lex.GROUNDED_DEFAULT
    row = decided(spark, SUPPORT, best=0.1234)
    assert row.escalation_reason.endswith("(best similarity=0.123).") and row.draft == lex.DRAFT_DEFAULT
    row = decided(spark, SUPPORT, grounding=(0.9, "clarification", "@1 Which one? ^ABC"))
    assert (row.should_escalate, row.reply, row.draft) == (False, "Which one?", "@1 Which one? ^ABC")
    assert decided(spark, SUPPORT, grounding=(0.9, "escalation", "x")).reply == lex.GROUNDED_WEAK_TYPE
    assert decided(spark, SUPPORT, grounding=(0.9, "troubleshooting", "@1 https://x")).reply == lex.GROUNDED_EMPTY


def test_strict_policy(spark):
    strict = SUPPORT.strict()
    row = decided(spark, strict, grounding=(0.9, "clarification", "r"))
    assert (row.should_escalate, row.escalation_reason) == (True, lex.REASON_NOT_ACTIONABLE)
    assert decided(spark, strict, grounding=(0.9, "account_action", "r")).escalation_reason == lex.REASON_AUTO_STRICT


def test_reuse_when_escalated(spark):
    df = spark.createDataFrame([("I03", False)], "intent string, evidence_available boolean").withColumn(
        "grounding", F.lit(None).cast("struct<similarity:double,response_type:string,historical_reply:string>")
    ).withColumn("should_escalate", F.lit(True))
    assert ev.grounded_reply(df, SUPPORT, reuse_when_escalated=True).first().reply == lex.GROUNDED_NO_EVIDENCE
    assert ev.grounded_reply(df, SUPPORT).first().reply == lex.GROUNDED_DEFAULT


@pytest.mark.parametrize(
    "similarity, kind, escalates, reason",
    [
        (0.1, "troubleshooting", True, lex.REASON_V1_WEAK % 0.1),
        (0.9, "escalation", True, lex.REASON_V1_UNSAFE),
        (0.25, "clarification", True, lex.REASON_V1_LOW % 0.25),
        (0.9, "clarification", False, lex.REASON_V1_AUTO % 0.9),
    ],
)
def test_first_policy(spark, similarity, kind, escalates, reason):
    rows = ev.safe_first_hit(evidence(spark, (1, similarity, kind, THEN), (2, 0.1, "generic", THEN)), SUPPORT)
    row = ev.decide_first_hit(rows.withColumn("evidence_available", F.lit(True)), SUPPORT).collect()
    assert [(r.should_escalate, r.escalation_reason) for r in row] == [(escalates, reason)]


def test_first_policy_reply(spark):
    df = spark.createDataFrame([(False, "I03", "nan"), (False, "I03", "ok"), (True, "I07", "ok")], "should_escalate boolean, intent string, r string")
    got = [r[0] for r in df.select(ev.draft_first_hit_reply(F.col("r"))).collect()]
    assert got == [lex.DRAFT_V1_INCOMPLETE, "ok", lex.DRAFT_ESCALATION["I07"]]


def test_triage_end_to_end(spark):
    cases = spark.createDataFrame(
        [
            (1, "my router shows a red light today", "Please restart the router ^AB", "I03", "troubleshooting"),
            (2, "router shows a green light today", "ok", "I03", "generic"),
            (3, "tv channel is missing today", "Which channel?", "I04", "clarification"),
            (4, "tv channel is frozen today", "Which tv?", "I04", "clarification"),
        ],
        "case_id int, customer_text string, support_reply string, intent string, response_type string",
    )
    index = tfidf.build_index(cases, tfidf.TfidfSpec())
    asked = spark.createDataFrame(
        [(1, "My router shows a red light"), (2, "I was charged twice"), (3, "@x"), (4, "my voicemail is broken"), (5, None)],
        "query_id int, customer_text string",
    )
    for parts in (1, 7):
        got = {r.query_id: r for r in triage(asked.repartition(parts), index, cases, SUPPORT).collect()}
        assert (got[1].intent, got[1].should_escalate, got[1].reply) == ("I03", False, "Please restart the router")
        assert got[1].grounding.case_id == 1 and [e.rank_no for e in got[1].evidence] == [1, 2]
        assert got[2].intent_name == "billing_payment" and got[2].should_escalate
        assert got[3].intent == "I12" and got[5].intent == "I12"
        assert got[4].escalation_reason == lex.REASON_NO_EVIDENCE and not got[4].evidence_available


def test_policy_is_data():
    assert replace(SUPPORT, min_auto=0.5).min_auto == 0.5
