import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from deskloom.operators import learning
from deskloom.operators.tfidf import TfidfSpec


def sparse(seed, n, terms=12):
    rng = random.Random(seed)
    rows = {}
    for i in range(n):
        own = rng.sample(range(terms), rng.randint(0, 4))
        weights = [rng.choice([1.0, 2.0]) for _ in own]
        size = sum(w * w for w in weights) ** 0.5
        rows[i] = {f"t{t}": w / size for t, w in zip(own, weights)}
    return rows


def tables(spark, rows):
    entries = spark.createDataFrame([(i, t, w) for i, own in rows.items() for t, w in own.items()], "id long, term string, weight double")
    return entries.repartition(3), spark.createDataFrame([(i,) for i in rows], "id long")


def plain_assign(rows, centres, k):
    out = {}
    for i, x in rows.items():
        costs = []
        for c in range(k):
            own = centres.get(c, {})
            raw = sum(v * v for v in own.values()) - 2 * sum(v * own.get(t, 0.0) for t, v in x.items())
            costs.append((round(raw, 9), c, raw))
        _, c, raw = min(costs)
        out[i] = c, round(sum(v * v for v in x.values()) + raw, 6)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_assignment_and_means_equal_dense_ones(spark, seed):
    rows = sparse(seed, 70)
    entries, ids = tables(spark, rows)
    k, runs = 5, 3
    centres = learning.first_centres(entries, ids, k, runs, seed)
    by_run = defaultdict(lambda: defaultdict(dict))
    for r in centres.collect():
        by_run[r["run"]][r["cluster"]][r["term"]] = r["centre"]
    for _ in range(2):
        assigned = learning.assign_sparse(entries, ids, centres, k, runs)
        got = {(r["run"], r["id"]): (r["cluster"], round(r["distance"], 6)) for r in assigned.collect()}
        want = {(run, i): v for run in range(runs) for i, v in plain_assign(rows, by_run[run], k).items()}
        assert got == want
        centres = learning.mean_centres(entries, assigned)
        by_run = defaultdict(lambda: defaultdict(dict))
        for run in range(runs):
            for c in range(k):
                members = [rows[i] for i in rows if want[run, i][0] == c]
                for t in {t for m in members for t in m}:
                    by_run[run][c][t] = sum(m.get(t, 0.0) for m in members) / len(members)


def test_kmeans_finds_groups_and_takes_no_rows(spark):
    rows = {i: {f"g{i % 3}": 0.8, f"own{i}": 0.6} for i in range(30)}
    entries, ids = tables(spark, rows)
    best, centres = learning.sparse_kmeans(entries, ids, 3, runs=6, rounds=5)
    groups = defaultdict(set)
    for r in best.collect():
        groups[r["cluster"]].add(r["id"] % 3)
    assert sorted(map(len, groups.values())) == [1, 1, 1] and centres.count() > 3
    assert learning.sparse_kmeans(entries.limit(0), ids.limit(0), 2, runs=2)[0].count() == 0


def test_the_fitted_regression_has_no_gradient(spark):
    rng = random.Random(3)
    words = {"a": ["red", "light", "router"], "b": ["bill", "paid", "late"], "c": ["tv", "box", "film"]}
    rows = [(i, label, " ".join(rng.choice(words[label]) if rng.random() < 0.6 else rng.choice(sum(words.values(), [])) for _ in range(6)))
            for i in range(60) for label in [rng.choice("abbc")]]
    docs = spark.createDataFrame(rows, "id int, label string, text string")
    spec = TfidfSpec(profile="lower", max_features=None)
    others = docs.limit(5).withColumn("id", F.col("id") + 1000)
    model, _ = learning.train_intent_model(docs, others, "id", "text", "label", spec)
    features, vocab, _ = learning.sparse_features(docs, docs, spec, "id", "text")
    names = {r["position"]: r["term"] for r in vocab.collect()}
    entries = [(r["doc_id"], names[int(j)], float(v)) for r in features.collect() for j, v in zip(r["features"].indices, r["features"].values)]
    entries = spark.createDataFrame(entries, "id int, term string, weight double")
    examples = learning.balanced_weights(docs.select("id", "label"), "label").withColumnRenamed("weight", "importance")
    labels = sorted({r[1] for r in rows})
    matrix = model.coefficientMatrix.toArray()
    given = [(labels[i], names[j], float(matrix[i, j])) for i in range(len(labels)) for j in names]
    given = spark.createDataFrame(given, "label string, term string, coefficient double")
    level = spark.createDataFrame([(x, float(v)) for x, v in zip(labels, model.interceptVector)], "label string, intercept double")
    at = learning.regression_certificate(entries, examples, given, level, 1 / 60).first()
    off = learning.regression_certificate(entries, examples, given.withColumn("coefficient", F.col("coefficient") + 0.1), level, 1 / 60).first()
    assert at["gradient_max"] < 1e-4 < off["gradient_max"] and at["loss"] < off["loss"] and at["examples"] == 60
    assert abs(at["loss"] - model.summary.objectiveHistory[-1]) < 1e-6


def test_a_wide_regression_equals_the_estimator_s(spark, monkeypatch):
    rng = random.Random(5)
    words = {"a": ["red", "light", "router"], "b": ["bill", "paid", "late"], "c": ["tv", "box", "film"]}
    rows = [(i, label, " ".join(rng.choice(words[label]) if rng.random() < 0.5 else rng.choice(sum(words.values(), [])) for _ in range(6)))
            for i in range(90) for label in [rng.choice("abbc")]]
    docs = spark.createDataFrame([*rows, (90, "a", None), (91, "b", "unknown")], "id int, label string, text string").repartition(3)
    train, test = docs.filter("id % 3 > 0"), docs.filter("id % 3 = 0")
    spec = TfidfSpec(profile="lower", max_features=None)
    narrow, want = learning.train_intent_model(train, test, "id", "text", "label", spec)
    monkeypatch.setattr(learning, "DRIVER_COEFFICIENTS", 10)
    wide, got = learning.train_intent_model(train, test, "id", "text", "label", spec)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert isinstance(wide, learning.WideRegression) and wide.gap <= 1e-6
    assert wide.losses[-1] == pytest.approx(narrow.summary.objectiveHistory[-1], rel=2e-5)
    matrix = narrow.coefficientMatrix.toArray()
    found = {(r["label"], r["position"]): r["coefficient"] for r in wide.coefficients.collect()}
    assert max(abs(matrix["abc".index(label), j] - x) for (label, j), x in found.items()) < 0.02
    assert len(found) == matrix.size


def test_cluster_features_are_counted_without_the_estimators(spark, monkeypatch):
    from pyspark.ml import feature

    rng = random.Random(7)
    texts = [" ".join(rng.choice(["red", "The", "router", "bill", "#late", "paid", "box"]) for _ in range(rng.randint(3, 9))) for _ in range(40)]
    texts += ["short", None, texts[0], "unknown words only here", "every " * 4]
    docs = spark.createDataFrame([(i % 43, t) for i, t in enumerate(texts)], "id int, text string").repartition(3)
    monkeypatch.setattr(feature.CountVectorizer, "fit", lambda *a: pytest.fail("texts are tokenised once more"))
    model, out, terms = learning.cluster_messages(docs, "id", "text", k=2, restarts=1, stop_words=["the"])
    kept = [t.lower().replace("#", "") for t in texts if t and len(t.strip()) >= 10]
    bags = []
    for words in ([w for w in t.split() if w != "the"] for t in kept):
        bags.append(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
    df = {t: sum(t in b for b in bags) for b in bags for t in b}
    known = {t for t in df if 5 <= df[t] <= 0.9 * len(kept)}
    assert set(terms) == known and len(terms) == len(known) == len(model.clusterCenters()[0])
    totals = [sum(b.count(t) for b in bags) for t in terms]
    assert totals == sorted(totals, reverse=True)
    want = []
    for text, bag in zip(kept, bags):
        raw = {t: bag.count(t) * (math.log((len(kept) + 1) / (df[t] + 1)) + 1) for t in set(bag) & known}
        size = sum(x * x for x in raw.values()) ** 0.5
        want.append((text, sorted((t, round(x / size, 9)) for t, x in raw.items())))
    got = [(r["clean_text"], sorted((terms[int(j)], round(float(x), 9)) for j, x in zip(r["features"].indices, r["features"].values)))
           for r in out.collect()]
    assert sorted(got) == sorted((t.strip(), v) for t, v in want)
