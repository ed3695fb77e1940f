import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from deskloom.operators import metrics, review, sampling
from deskloom.operators.skew import hash_rank_key


def brute_report(pairs, labels):
    out = {}
    for label in labels:
        hits = sum(g == p == label for g, p in pairs)
        gold, claimed = sum(g == label for g, _ in pairs), sum(p == label for _, p in pairs)
        out[label] = (
            hits / claimed if claimed else 0.0, hits / gold if gold else 0.0,
            2 * hits / (gold + claimed) if gold + claimed else 0.0, gold,
        )
    return out


@pytest.mark.parametrize("labels", [None, ["A", "B", "C", "D", "E"]])
def test_class_report_and_f1(spark, labels):
    rng = random.Random(3)
    pairs = [(rng.choice("AABC"), rng.choice("ABBD")) for _ in range(60)]
    df = spark.createDataFrame(pairs, "g string, p string")
    want = brute_report(pairs, labels or sorted({x for pair in pairs for x in pair}))
    got = {r.label: (r.precision, r.recall, r.f1, r.support) for r in metrics.class_report(df, "g", "p", labels).collect()}
    assert got.keys() == want.keys()
    for label in want:
        assert got[label] == pytest.approx(want[label])
    f1 = metrics.f1_scores(df, "g", "p", labels).first()
    assert f1.macro_f1 == pytest.approx(sum(w[2] for w in want.values()) / len(want))
    accuracy = metrics.accuracy(df, "g", "p").first().accuracy
    weighted_recall = sum(w[1] * w[3] for w in want.values()) / 60
    assert accuracy == pytest.approx(weighted_recall)


def test_confusion(spark):
    df = spark.createDataFrame([("A", "A"), ("A", "B"), ("B", "B")], "g string, p string")
    long = {(r.gold, r.predicted): r.n for r in metrics.confusion_long(df, "g", "p", ["A", "B", "C"]).collect()}
    assert long[("A", "B")] == 1 and long[("C", "C")] == 0 and len(long) == 9
    wide = {r.gold: (r.PRED_A, r.PRED_B, r.PRED_C) for r in metrics.confusion_matrix(df, "g", "p", ["A", "B", "C"]).collect()}
    assert wide == {"A": (1, 1, 0), "B": (0, 1, 0), "C": (0, 0, 0)}


def brute_kappa(a, b, quadratic):
    labels = sorted(set(a) | set(b))
    place = {x: i for i, x in enumerate(labels)}
    n = len(a)
    w = (lambda x, y: (place[x] - place[y]) ** 2) if quadratic else (lambda x, y: float(x != y))
    seen = sum(w(x, y) for x, y in zip(a, b)) / n
    ca, cb = Counter(a), Counter(b)
    chance = sum(ca[x] * cb[y] * w(x, y) for x in labels for y in labels) / n / n
    return 1 - seen / chance if chance else None


@pytest.mark.parametrize("weights", [None, "quadratic"])
def test_kappa(spark, weights):
    rng = random.Random(5)
    # score 3 never occurs: its neighbours are one step apart
    a = [rng.choice([1, 2, 4, 5]) for _ in range(40)]
    b = [rng.choice([1, 2, 4, 5]) for _ in range(40)]
    rows = [(float(x), float(y), 7.0) for x, y in zip(a, b)] + [(None, 1.0, 7.0), (2.0, None, 7.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {r.dimension: r for r in metrics.agreement(df, {"ab": ("a", "b"), "aa": ("a", "a"), "cc": ("c", "c")}, weights).collect()}
    assert got["ab"].n == 40 and got["ab"].kappa == pytest.approx(brute_kappa(a, b, weights == "quadratic"))
    assert got["ab"].exact_agreement == pytest.approx(sum(x == y for x, y in zip(a, b)) / 40)
    assert got["aa"].kappa == pytest.approx(1.0)
    assert got["cc"].kappa is None and got["cc"].exact_agreement == 1.0


PRED = "case_id int, intent_correct boolean, should_escalate boolean, evidence_available boolean, evidence_selected boolean, selected_similarity double, reply string"


def test_decision_metrics(spark):
    rows = [
        (1, True, False, True, True, 0.5, "a"),
        (2, False, False, True, True, 0.3, "historical case"),
        (3, True, True, True, False, 0.0, "see https://x"),
        (4, False, True, False, False, 0.0, None),
    ]
    df = spark.createDataFrame(rows, PRED)
    safe = metrics.safety(df).first()
    assert (safe.auto_handled, safe.safety_proxy, safe.evidence_selected) == (2, 0.5, 2)
    assert metrics.safety(df.filter("should_escalate")).first().safety_proxy == 0.0
    cross = metrics.decision_crosstab(df).first()
    assert tuple(cross)[:4] == (1, 1, 1, 1)
    cover = metrics.similarity_coverage(df).first()
    assert (cover.at_least_30, cover.at_least_50, cover.median_similarity, cover.rows) == (2, 1, 0.15, 4)
    assert metrics.similarity_coverage(df, selected_only=True).first().mean_similarity == pytest.approx(0.4)
    edge = metrics.similarity_coverage(df.withColumn("selected_similarity", F.lit(0.1999996))).first()
    assert edge.at_least_20 == 0 and edge.mean_similarity == pytest.approx(0.1999996, abs=1e-9)
    quality = metrics.reply_quality(df).first()
    assert (quality.replies, quality.internal_leakage, quality.artifact_leakage) == (3, 1, 1)
    assert [r.case_id for r in metrics.risky_auto(df).collect()] == [2]


def test_evidence_metrics(spark):
    rows = [
        ("a", "I", "t", 1, 0.9, "no", "YES", "yes "), ("a", "I", "t", 2, 0.5, " Yes", "NO", "NO"),
        ("b", "I", "u", 1, 0.1, "NO", "NO", "NO"), ("b", "I", "u", 2, 0.05, "NO", "?", None),
    ]
    df = spark.createDataFrame(rows, "case_id string, gold_intent string, customer_text string, rank int, similarity double, relevant string, actionable string, safe_to_ground string")
    rates = {r.judgement: (r.top1, r.top3) for r in metrics.evidence_rates(df).collect()}
    assert rates == {"relevant": (0.0, 0.5), "actionable": (0.5, 0.5), "safe_to_ground": (0.5, 0.5)}
    summary = {r.case_id: r for r in metrics.case_summary(df).collect()}
    assert summary["a"].top1_relevant == "NO" and summary["a"].any_relevant and not summary["b"].any_actionable
    check = {r.column: r.invalid for r in metrics.annotation_check(df).collect()}
    assert check == {"relevant": 0, "actionable": 1, "safe_to_ground": 1}
    assert [r.case_id for r in metrics.weak_first_hits(df).collect()] == ["b"]
    assert [r.case_id for r in metrics.similar_but_irrelevant(df).collect()] == ["a"]


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i, "abc"[i % 7 % 3]) for i in range(200)] + [(900, "z")], "id long, s string")
    quotas = {"a": 5, "b": 500, "z": 3, "missing": 2}
    results = []
    for parts in (1, 5):
        picked = sampling.stratified_sample(df.repartition(parts), "s", ["id"], quotas)
        results.append(sorted(r.id for r in picked.collect()))
        counts = {r.s: r["count"] for r in picked.groupBy("s").count().collect()}
        assert counts == {"a": 5, "b": df.filter("s = 'b'").count(), "z": 1}
    assert results[0] == results[1]
    many = sampling.stratified_sample(df, "s", ["id"], 2000)
    assert many.count() == 201
    assert sampling.random_sample(df, ["id"], 10).count() == 10
    report = {r.s: tuple(r)[1:] for r in sampling.stratum_report(df, picked, "s", quotas).collect()}
    assert report["missing"] == (0, 2, 0) and report["z"] == (1, 3, 1)


def test_top_up(spark):
    pool = spark.range(20)
    picked = pool.filter("id < 3")
    for target, want in ((10, 10), (50, 20), (2, 3)):
        got = sampling.top_up(picked, pool, ["id"], target, 3)
        assert got.count() == want and got.distinct().count() == want


def test_split_is_stratified_and_matches_a_plain_ranking(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else "cold") for i in range(3000)], "id long, s string")
    split = sampling.stratified_split(df, "s", ["id"])
    assert split.count() == 3000
    shares = {r.s: r.n for r in split.filter("is_test").groupBy("s").agg({"id": "count"}).withColumnRenamed("count(id)", "n").collect()}
    assert shares == {"hot": 400, "cold": 200}
    rows = split.withColumn("h", hash_rank_key(["id"], 42)).collect()
    for s, n in shares.items():
        ordered = sorted((r.h, r.id) for r in rows if r.s == s)
        assert {i for _, i in ordered[:n]} == {r.id for r in rows if r.s == s and r.is_test}


def test_calibration_mix(spark):
    rows = [(i, i % 4 == 0, i % 2 == 0) for i in range(100)]
    df = spark.createDataFrame(rows, "case_id int, intent_correct boolean, should_escalate boolean")
    got = sampling.calibration_mix(df).collect()
    assert len(got) == 30 and len({r.case_id for r in got}) == 30
    assert sampling.calibration_mix(df.limit(0)).count() == 0
    assert sampling.calibration_mix(df.filter("case_id < 8")).count() == 8


def test_overrides_and_changes(spark):
    df = spark.createDataFrame([("C-1", "I01"), ("C-2", "I02"), ("C-3", None)], "case_id string, prelabel_intent string")
    out = review.apply_overrides(df, review.overrides_table(spark, {"C-2": "I09", "C-3": "I12"}), ["C-1"])
    got = {r.case_id: (r.final_intent, r.intent_confidence) for r in out.collect()}
    assert got == {"C-1": ("I01", "medium"), "C-2": ("I09", "high"), "C-3": ("I12", "high")}
    assert {r.case_id for r in review.label_changes(out).collect()} == {"C-2", "C-3"}


def test_numbered(spark):
    got = [r.case_id for r in sampling.numbered(spark.range(2), ["id"], "VX").orderBy("id").collect()]
    assert got == ["VX-001", "VX-002"]
