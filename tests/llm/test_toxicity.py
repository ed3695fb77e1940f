import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskloom.llm import gru, toxicity


def corpus():
    random.seed(9)
    word = lambda: "".join(random.choices(["ka", "lo", "mi", "ne", "pu", "ra", "si", "to"], k=random.choice([1, 2, 3])))
    rows = []
    for i in range(240):
        words = [word() for _ in range(random.choice([12, 60, 150]))]
        if i % 4 == 0:
            for at in range(3, len(words), 12):
                words[at] = random.choice(["idiot", "scum", "grom" + word(), "Grom" + word()])
        rows.append((i, " ".join(words) + "."))
    return rows


def test_held_out_rows_are_told_apart(make, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 90)
    monkeypatch.setattr(toxicity, "BATCH", 96)
    rows = corpus()
    docs = make([*rows, (None, None), (900, ""), (901, "ka lo " * 30_000)])
    labels = docs.filter("doc_id < 240").select("doc_id", F.expr("int(doc_id % 4 = 0)").alias("toxic"), F.lit(1).alias("text"))
    labels = labels.unionByName(labels.limit(3).withColumn("toxic", F.lit(None).cast("int")))
    scorer = toxicity.fit(docs, labels, F.col("doc_id") % 5 != 2)
    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, scorer).collect()}
    held = [i for i in range(240) if i % 5 == 2]
    caught = [(got[i] >= 0.3) == (i % 4 == 0) for i in held]
    assert len(got) == 243 and np.mean(caught) > 0.9
    assert all(0 <= s <= 1 for s in got.values()) and got[None] == got[900]
    kept = toxicity.drop_toxic(docs, scorer)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in got.items() if s < 0.3}
    nothing = toxicity.fit(docs, labels.filter("toxic = 0"), F.lit(True))
    assert all(r["score"] < 0.3 for r in toxicity.score_documents(docs, nothing).collect())
    assert toxicity.score_documents(make([]), scorer).count() == 0


def plain_logit(weights, gates, ids):
    """One window, number by number: two gated recurrent passes, attention over the tokens that are
    no padding, one output."""
    n, padding = gru.HIDDEN, len(gates[0][0]) - 1
    logistic = lambda x: 1 / (1 + math.exp(-x))

    def passed(side, order):
        h, out = [0.0] * n, []
        for i in order:
            z, r, c = ([float(g[side][i][k]) for k in range(n)] for g in gates)
            z, r = ([logistic(own[k] + sum(h[j] * float(weights[name][side][j][k]) for j in range(n))) for k in range(n)]
                    for own, name in ((z, "z_state"), (r, "r_state")))
            c = [math.tanh(c[k] + sum(r[j] * h[j] * float(weights["c_state"][side][j][k]) for j in range(n))) for k in range(n)]
            h = [h[k] + z[k] * (c[k] - h[k]) for k in range(n)]
            out.append(h)
        return out

    ahead, back = passed(0, ids), passed(1, ids[::-1])[::-1]
    both = [a + b for a, b in zip(ahead, back)]
    energies = []
    for state in both:
        hidden = [math.tanh(float(weights["attend_bias"][k]) + sum(x * float(weights["attend"][j][k]) for j, x in enumerate(state))) for k in range(n)]
        energies.append(sum(x * float(w) for x, w in zip(hidden, weights["attend_out"])))
    shares = [math.exp(e) if i != padding else 0.0 for e, i in zip(energies, ids)]
    pooled = [sum(s * state[j] for s, state in zip(shares, both)) / sum(shares) for j in range(2 * n)]
    return float(weights["out_bias"][0]) + sum(x * float(w) for x, w in zip(pooled, weights["out"]))


def test_forward_equals_plain_loops():
    rng = np.random.default_rng(4)
    model = gru.Model.fresh(np.zeros(0, np.uint64), 2)
    model.weights["attend_bias"] += rng.normal(size=gru.HIDDEN).astype(np.float32)
    model.weights["out_bias"] += np.float32(0.3)
    gates = [rng.normal(size=(2, 6, gru.HIDDEN)).astype(np.float32) for _ in range(3)]
    ids = np.array([[0, 3, 1, 4], [2, 2, 5, 5], [4, 5, 5, 5]])  # 5 is padding
    logits, _ = model.forward([g.copy() for g in gates], ids)
    want = [plain_logit(model.weights, gates, row.tolist()) for row in ids]
    assert np.allclose(logits, want, atol=1e-4)


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    texts = ["one two three idiot four", "five six one"]
    tokens = gru.tokenize(texts)
    model = gru.Model.fresh(tokens.hashes[:3], 1)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    rows, (buckets, upto) = model.rows(tokens.hashes), gru.char_grams(tokens)
    start, end, _ = gru.windows(tokens.upto, 4, 3)
    ids = gru.window_ids(tokens, start, end, 4)
    pull = rng.normal(size=len(ids))

    def loss():
        logits, _ = model.forward(model.gates(model.word_inputs(rows, buckets, upto)), ids)
        return float(logits @ pull)

    keep = []
    _, memo = model.forward(model.gates(model.word_inputs(rows, buckets, upto)), ids, keep)
    grad = model.backward(pull, memo, keep, len(tokens.hashes))
    for name in ("z_state", "r_state", "c_state", "attend", "out", "attend_out"):
        value = model.weights[name]
        at = tuple(rng.integers(0, s) for s in value.shape)
        value[at] += 0.01
        up = loss()
        value[at] -= 0.02
        down = loss()
        value[at] += 0.01
        assert (up - down) / 0.02 == pytest.approx(grad[name][at], rel=0.05, abs=2e-4), name


def test_windows_cover_every_token_and_overlap():
    upto = np.array([0, 0, 5, 64, 65 + 64, 400])
    start, end, text = gru.windows(upto, 64, 48)
    for t in range(5):
        own = text == t
        seen = np.zeros(upto[t + 1] - upto[t], int)
        for s, e in zip(start[own], end[own]):
            assert e - s <= 64
            seen[s - upto[t] : e - upto[t]] += 1
        assert own.sum() >= 1 and (seen >= 1).all()


def test_word_inputs_agree_for_training_and_scoring():
    tokens = gru.tokenize(["aa bbb ab Zürich 😀 x", "", "aa"])
    model = gru.Model.fresh(tokens.hashes[::2], 3)
    assert np.allclose(model.all_word_inputs(tokens), model.word_inputs(model.rows(tokens.hashes), *gru.char_grams(tokens)), atol=1e-5)
    merged = gru.tokenize_all(["aa bbb ab Zürich 😀 x", "", "aa"], together=1)
    assert (merged.hashes == tokens.hashes).all() and (merged.word == tokens.word).all() and (merged.upto == tokens.upto).all()
