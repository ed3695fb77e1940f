import pytest
from pyspark.sql import functions as F

from deskloom.functions.policy import SUPPORT, SUPPORT_RULES
from deskloom.functions.rules import (
    GateStep, Rule, RuleSet, ScoredSet, classify, classify_by_score, consistent, rule_set_from_table,
    scored_set_from_table, unreachable_phrases, with_response_type, with_signals,
)

MESSAGES = [
    ("Thank you", "I12"),
    ("help me now please", "I12"),
    ("Someone made an unauthorized charge on my account.", "I10"),
    ("My fios mobile app fails", "I06"),
    ("My voicemail is full", "I09"),
    ("My technician appointment was cancelled.", "I08"),
    ("I was charged twice on my bill.", "I07"),
    ("there is no internet here", "I01"),
    ("internet and cable are both down", "I01"),
    ("My internet is extremely slow and keeps buffering.", "I02"),
    ("the cable box recording failed", "I04"),
    ("My router has a red light.", "I03"),
    ("5g is weak", "I05"),
    ("Your customer service is terrible.", "I11"),
    ("slow internet, I restarted my router", "I02"),
    ("nice day", "I12"),
    (None, "I12"),
]


def test_support_rules(spark):
    df = spark.createDataFrame(MESSAGES, "t string, want string")
    wrong = classify(df, SUPPORT_RULES, "t").filter("intent <> want").collect()
    assert wrong == []


def test_reordered_drops_the_compound_rule(spark):
    plain = SUPPORT_RULES.reordered("plain", ["I10", "I04", "I01"])
    df = spark.createDataFrame([("internet and cable are both down",)], "t string")
    assert classify(df, plain, "t").first().intent == "I04"


def test_max_score_ties(spark):
    scored = ScoredSet("s", {"B": (["x", "y"], 2), "A": (["z"], 4)}, "none")
    df = spark.createDataFrame([("X y z", "B", 4), ("z", "A", 4), ("x", "B", 2), ("q", "none", 0)], "t string, w string, s int")
    assert classify_by_score(df, scored, "t").filter("intent <> w or score <> s").count() == 0


@pytest.mark.parametrize(
    "reply, want",
    [
        ("Please DM us. What is wrong?", "escalation"),
        ("Did you restart it?", "clarification"),
        ("Please restart it", "troubleshooting"),
        ("We added a refund", "account_action"),
        ("Have a nice day", "generic"),
        ("We hope you have a nice day", "unknown"),
    ],
)
def test_response_types(spark, reply, want):
    df = spark.createDataFrame([(reply,)], "r string")
    assert with_response_type(df, SUPPORT.responses, "r").first().response_type == want


GATE = [
    ("I01", "internet is down", "no internet at all", True),
    ("I01", "internet is down", "slow internet", False),
    ("I02", "so slow", "it keeps dropping", True),
    ("I02", "so slow", "router", False),
    ("I03", "router", "my modem", True),
    ("I03", "router", "slow", False),
    ("I04", "tv channel", "tv show", True),
    ("I04", "tv show", "tv channel", False),
    ("I04", "tv show", "tv movie", True),
    ("I05", "cell phone", "sms", True),
    ("I05", "cell phone", "tv", False),
    ("I06", "app is down", "login", False),
    ("I06", "app is down", "the app is down", True),
    ("I06", "login", "password", True),
    ("I06", "login", "app", False),
    ("I06", "my fios", "login", True),
    ("I07", "bill", "payment", True),
    ("I08", "tech", "install", True),
    ("I09", "landline", "landline", False),
    ("I09", "voicemail", "voice mail", True),
    ("I10", "fraud", "scam", True),
    ("I11", "worst", "awful", True),
    ("I12", "worst", "awful", False),
    ("I03", "nothing here", "router", False),
]


def test_consistency_gate(spark):
    df = spark.createDataFrame(GATE, "intent string, cur string, hist string, want boolean")
    df = with_signals(df, "cur", SUPPORT.signals, SUPPORT.synonyms, "a")
    df = with_signals(df, "hist", SUPPORT.signals, SUPPORT.synonyms, "b")
    got = df.select("*", consistent(SUPPORT.gate, F.col("intent"), F.col("a"), F.col("b")).alias("got")).collect()
    assert [r for r in got if r.got != r.want] == []


def test_gate_without_steps_is_false(spark):
    df = spark.createDataFrame([("X", ["a"], ["a"])], "i string, a array<string>, b array<string>")
    gate = {"Y": [GateStep(["a"], ["a"])]}
    assert df.select(consistent(gate, F.col("i"), F.col("a"), F.col("b"))).first()[0] is False


def test_rules_from_a_table(spark):
    rows = [("s", 1, "A", None, "x"), ("s", 2, "B", 1, "u"), ("s", 2, "B", 2, "v"), ("other", 1, "C", None, "x")]
    table = spark.createDataFrame(rows, "rule_set string, priority int, label string, group_no int, phrase string")
    rules = rule_set_from_table(table, "s", "Z")
    df = spark.createDataFrame([("u v x", "A"), ("v u", "B"), ("u", "Z")], "t string, want string")
    assert classify(df, rules, "t").filter("intent <> want").count() == 0
    with pytest.raises(ValueError):
        rule_set_from_table(table, "missing", "Z")


def test_scores_from_a_table(spark):
    rows = [("s", 2, "A", "x", 3), ("s", 1, "B", "y", 3), ("s", 1, "B", "z", 3)]
    table = spark.createDataFrame(rows, "rule_set string, priority int, label string, phrase string, weight int")
    scored = scored_set_from_table(table, "s", "none")
    df = spark.createDataFrame([("x y", "B", 3), ("y z x", "B", 6), ("x", "A", 3), ("q", "none", 0)], "t string, w string, s int")
    assert classify_by_score(df, scored, "t").filter("intent <> w or score <> s").count() == 0


def test_unreachable_phrases():
    rules = RuleSet("r", (Rule("A", any_of=["can't", "ok"]),), "Z", profile="index")
    assert unreachable_phrases(rules) == [("A", "can't")]


def test_whole_texts_from_a_table(spark):
    rows = spark.createDataFrame(
        [("r", 1, "vague", None, "yes", 2), ("r", 1, "vague", None, "thank you", 2), ("r", 2, "pay", None, "bill", None)],
        "rule_set string, priority int, label string, group_no int, phrase string, max_words int",
    )
    rules = rule_set_from_table(rows, "r", "other")
    texts = spark.createDataFrame([("yes",), ("Thank  you",), ("yes my bill",), ("no",)], "t string")
    assert [r.i for r in classify(texts, rules, "t", "i").collect()] == ["vague", "vague", "pay", "other"]
