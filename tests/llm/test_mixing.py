import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from deskloom.llm.mixing import Path, document_rates, fit_domains, fit_rates, mix

TARGETS = {"blue": 0.5, "green": 0.3, "red": 0.2}


def colours(make, copies=30):
    words = {"blue": "sea sky ice", "green": "leaf grass moss", "red": "fire rose brick"}
    rows = []
    for k, (name, w) in enumerate(sorted(words.items())):
        rows += [(1000 * k + i, f"{w} and more {i} " * (1 + i % 5)) for i in range(copies * (k + 1))]
    docs = make([*rows, (None, None), (1, ""), (1, "sea sky ice")])
    marks = docs.filter("doc_id % 3 = 0").select("doc_id", F.expr("array('blue', 'green', 'red')[int(doc_id / 1000)]").alias("domain"))
    return docs, marks.unionByName(marks.select("doc_id", F.lit(None).cast("string").alias("domain")))


def test_totals_match_targets(make):
    docs, marks = colours(make)
    model = fit_domains(docs, marks, sorted(TARGETS))
    got = document_rates(docs, model, TARGETS).toPandas()
    assert len(got) == docs.count() and (got["rate"] >= 0).all()
    known = got[got["n_tokens"] > 3]
    assert (known["domain"] == known["doc_id"].floordiv(1000).map({0: "blue", 1: "green", 2: "red"})).all()
    tokens = (got["rate"] * got["n_tokens"]).groupby(got["domain"]).sum()
    for name, share in TARGETS.items():
        assert abs(tokens[name] / got["n_tokens"].sum() - share) < 0.02
    mixed = mix(docs, model, TARGETS)
    assert mixed.columns == docs.columns
    assert mixed.count() > 0 and abs(mixed.count() - got["rate"].sum()) < 25


def test_rates_equal_a_dense_projected_gradient(spark):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.3, 0.3, 0.3], 80)
    tokens = rng.integers(0, 500, 80)
    members = spark.createDataFrame([(int(t), x.tolist()) for t, x in zip(tokens, p)], "n_tokens bigint, p array<double>")
    weights = np.array([0.5, 0.3, 0.2])
    path = fit_rates(members, weights, steps=60, tolerance=1e-9)
    target = weights * tokens.sum()
    rate = point = np.ones(80)
    for pull in path.pulls:
        assert np.allclose(pull, (point * tokens) @ p / target - 1)
        moved = np.maximum(0, point - path.step * p @ ((point * tokens) @ p / target - 1))
        point, rate = moved + path.momentum * (moved - rate), moved
    assert np.allclose(path.rates(p)[0], rate) and np.allclose((rate * tokens) @ p / target, 1, atol=1e-3)


def test_no_rows(make):
    docs = make([])
    model = fit_domains(docs, spark_marks(docs), ["a", "b"])
    assert document_rates(docs, model, {"a": 1, "b": 1}).count() == 0 and mix(docs, model, {"a": 1, "b": 1}).count() == 0
    tokens, even = model.posteriors(pa.array([None, "", "some words"], pa.string()))
    assert tokens.tolist() == [0, 0, 2] and np.allclose(even, 0.5)
    assert Path(0.0, 0.0, []).rates(even)[0].tolist() == [1, 1, 1]


def spark_marks(docs):
    return docs.select("doc_id", F.lit("a").alias("domain"))
