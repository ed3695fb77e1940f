import random

import pytest
from pyspark.sql import functions as F

from deskloom.operators import leakage
from deskloom.operators.leakage import containment_report, without_contained

QUERIES = "query_id int, q string, __n string"
CORPUS = "case_id int, t string, h string"


def brute(corpus, asked, words=5):
    pairs = []
    for q, x in asked:
        for c, t in corpus:
            x_, t_ = (" ".join("".join(ch if ch.isalnum() else " " for ch in (s or "").lower()).split()) for s in (x, t))
            if x_ and (x_ == t_ or len(x_.split()) >= words and f" {x_} " in f" {t_} "):
                pairs.append((q, c))
    return pairs


def tables(spark, corpus, asked):
    held = spark.createDataFrame([(*r, "x") for r in corpus], CORPUS).repartition(3)
    return held, spark.createDataFrame([(*r, "x") for r in asked], QUERIES)


def check(spark, corpus, asked, words=5):
    held, queries = tables(spark, corpus, asked)
    pairs = brute(corpus, asked, words)
    want = {}
    for q, c in pairs:
        want.setdefault(q, []).append(c)
    got = containment_report(queries, held, "query_id", "q", "case_id", "t", words).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((q, len(c), min(x for x in c if x is not None)) for q, c in want.items()), key=str)
    leaking = {t for q, c in pairs for i, t in corpus if i == c}
    kept = without_contained(held, queries, "t", "q", words)
    assert kept.columns == held.columns
    assert sorted((r["case_id"] or -1, r["t"] or "") for r in kept.collect()) == sorted((i or -1, t or "") for i, t in corpus if t not in leaking)
    return pairs


@pytest.mark.parametrize("limit", [leakage.BROADCAST_SHINGLES, 0])
def test_random_texts(spark, monkeypatch, limit):
    monkeypatch.setattr(leakage, "BROADCAST_SHINGLES", limit)
    rng = random.Random(4)
    corpus = [(i, " ".join(rng.choice("abc") * 2 for _ in range(rng.randint(1, 40)))) for i in range(60)]
    asked = [(q, " ".join(rng.choice("abc") * 2 for _ in range(rng.randint(1, 7)))) for q in range(40)]
    assert check(spark, corpus, asked)


def test_edges_of_words_marks_and_short_queries(spark):
    corpus = [
        (1, "He said: the quick brown fox jumps, over it."), (2, "xthe quick brown fox jumpsy"), (3, "help"), (4, "please help me now or never"),
        (5, None), (6, ""), (7, "!!!"), (8, "the quick brown fox jumps"), (9, "the  quick\nbrown fox jumps"),
    ]
    asked = [(1, "The quick brown FOX jumps"), (2, "help"), (3, None), (4, "..."), (5, "the quick brown fox jumps"), (6, "fox jumps over it he said")]
    pairs = check(spark, corpus, asked)
    assert sorted(pairs) == [(1, 1), (1, 8), (1, 9), (2, 3), (5, 1), (5, 8), (5, 9)]


def test_a_passage_in_a_third_of_all_texts(spark):
    passage = "this agreement is made between both parties named below"
    corpus = [(i, f"start {i} {passage} end {i}" if i % 3 == 0 else f"some other text number {i} goes here") for i in range(300)]
    corpus += [(1000 + i, corpus[0][1]) for i in range(20)]
    asked = [(1, passage), (2, passage), (3, passage + " end 3"), (4, "some other text number 7 goes here"), (5, passage + " x")]
    assert len(check(spark, corpus, asked)) == 2 * 120 + 1 + 1


def test_long_texts_and_no_rows(spark):
    words = [f"w{i}" for i in range(60_000)]
    corpus = [(1, " ".join(words)), (None, "w5 w6 w7 w8 w9 w10"), (2, "w1 w2")]
    asked = [(1, " ".join(words[59_990:])), (2, "w9 w8 w7 w6 w5"), (3, " ".join(words[100:20_000]))]
    held, queries = tables(spark, corpus, asked)
    got = containment_report(queries, held, "query_id", "q", "case_id", "t").collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1), (3, 1, 1)]
    assert without_contained(held, queries, "t", "q").count() == 2
    # a text without an id is guarded like any other
    only = spark.createDataFrame([(1, "w5 w6 w7 w8 w9", "x")], QUERIES)
    assert sorted(r["case_id"] for r in without_contained(held, only, "t", "q").collect()) == [2]
    assert containment_report(queries, held.limit(0), "query_id", "q", "case_id", "t").count() == 0
    assert without_contained(held, queries.limit(0), "t", "q").count() == 3


def test_a_corpus_is_cleaned_once(spark):
    """What is left of a corpus is read from the cleaned table, not cleaned anew for every pass."""
    texts = ["One, two three four five six!", "two three four", "", None, "other words here"]
    corpus = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    asked = spark.createDataFrame([("two THREE four five six",), ("Other words... here",)], "text string")
    left = leakage.without_contained(corpus, asked, "text", "text")
    assert "regexp_replace" not in left._jdf.queryExecution().toString()
    assert sorted(r["id"] for r in left.collect()) == [1, 2, 3]
    runs = spark.createDataFrame([("a b c d e f",), ("a b c d e",), ("a b",), ("",), (None,)], "t string")
    found = [r["h"] for r in runs.select(leakage.shingles(F.col("t"), 5).alias("h")).collect()]
    assert [len(h or []) for h in found] == [2, 1, 0, 0, 0] and found[1][0] == found[0][0]
