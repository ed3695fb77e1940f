import random
import time

from pyspark.sql import functions as F

from deskloom.functions import text as tx
from deskloom.functions.phrases import WIDTH, PhraseBits, found_words
from deskloom.functions.policy import SUPPORT_RULES
from deskloom.functions.rules import RuleSet, Rule, ScoredSet, classify, classify_by_score, classify_in_one_pass, with_signals

TEXTS = [
    "my internet is down and the cable box too", "", None, "aaaa", "the bill was charged twice", "ünïcödé ß", "x" * 100_000 + " fraud",
    "I was no-show'd by a technician", "yes", "DM?", "Help", "no internet",
]


def vocabulary(rng, n):
    return ["".join(rng.choice("abc ") for _ in range(rng.randint(1, 5))) for _ in range(n)]


def test_bits_equal_single_tests(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abc ") for _ in range(rng.randint(0, 30))) for _ in range(80)]
    df = spark.createDataFrame([(t,) for t in texts + [None]], "t string").repartition(3)
    lists = [vocabulary(rng, n) for n in (1, 4, 70, 300)] + [[], ["", "a"], ["ab", "ab", "b"]]
    bits = PhraseBits(*lists)
    assert len(bits.phrases) > 2 * WIDTH
    marked = df.withColumn("b", bits.of(F.col("t"))).withColumn("t", F.coalesce("t", F.lit("")))
    for phrases in lists:
        plain = F.lit(False) if not phrases else tx.contains_any(F.col("t"), phrases)
        assert marked.filter(bits.any_of(F.col("b"), phrases) != plain).count() == 0
        assert marked.filter(bits.count(F.col("b"), phrases) != tx.phrase_hits(F.col("t"), phrases)).count() == 0


def test_one_pass_gives_the_same_labels(spark):
    scored = ScoredSet("s", {"B": (["bill", "charged", "a"], 2), "A": (["internet"], 4)}, "none")
    short = RuleSet("short", (Rule("x", all_of=(["my", "the"], ["box", "bill"])), Rule("y", any_of=["ß", "zz"]), Rule("z", any_of=[])), "w", profile="lower")
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    got = classify_in_one_pass(df, "t", {"support": SUPPORT_RULES, "short": short}, {"scored": scored})
    assert got.columns == ["i", "t", "support", "short", "scored", "scored_score"]
    want = classify(df, SUPPORT_RULES, "t", "support")
    want = classify_by_score(classify(want, short, "t", "short"), scored, "t", "scored", "scored_score")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert classify_in_one_pass(df.limit(0), "t", {"support": SUPPORT_RULES}).count() == 0


def test_signals_in_one_pass(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    signals = {"net": ["internet", "online"], "money": ["bill", "fraud"], "none": []}
    pairs = [("cable", "internet"), ("charged", "bill")]
    plain, once = (with_signals(df, "t", signals, pairs, one_pass=x).collect() for x in (False, True))
    assert sorted(map(str, plain)) == sorted(map(str, once))


def test_the_time_does_not_hang_on_the_number_of_phrases():
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefghij ") for _ in range(400_000))

    def took(n):
        phrases = tuple(sorted({"".join(rng.choice("klmnopqr") + rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)}))
        found_words("", phrases)
        best = 1e9
        for _ in range(5):
            start = time.perf_counter()
            found_words(text, phrases)
            best = min(best, time.perf_counter() - start)
        return best

    assert took(2000) < 4 * took(50) + 0.01
