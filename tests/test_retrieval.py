import dataclasses
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from deskloom.operators import blocks, retrieval, tfidf
from deskloom.sources import index_store

WORDS = ["the"] * 12 + ["net"] * 8 + ["slow"] * 4 + [f"w{i}" for i in range(25)]


def corpus(seed, n, parts=("A", "B")):
    rng = random.Random(seed)
    rows = [(i, rng.choice(parts), " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 9)))) for i in range(n)]
    # copies: a third of the corpus is one text
    return [(i, p, "the net is slow again") if i % 3 == 0 else (i, p, t) for i, p, t in rows]


def grams(text):
    w = [x for x in text.split() if len(x) > 1]
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def brute(cases, queries, k, min_df=2):
    out = {}
    by_part = defaultdict(list)
    for i, p, t in cases:
        by_part[p].append((i, Counter(grams(t))))
    for q, p, t in queries:
        docs = by_part[p]
        df = Counter(x for _, c in docs for x in c)
        idf = {x: math.log((1 + len(docs)) / (1 + n)) + 1 for x, n in df.items() if n >= min_df}

        def vec(c):
            v = {x: (1 + math.log(n)) * idf[x] for x, n in c.items() if x in idf}
            norm = math.sqrt(sum(y * y for y in v.values()))
            return {x: y / norm for x, y in v.items()} if v else {}

        qv = vec(Counter(grams(t)))
        scored = []
        for i, c in docs:
            dv = vec(c)
            if set(dv) & set(qv):
                scored.append((-round(sum(qv[x] * dv[x] for x in qv if x in dv), 9), i))
        for rank, (s, i) in enumerate(sorted(scored)[:k], 1):
            out[(q, rank)] = (i, round(-s, 6))
    return out


@pytest.fixture(scope="module")
def built(spark):
    cases, queries = corpus(1, 90), corpus(2, 40, ("A", "B", "C"))
    df = spark.createDataFrame(cases, "case_id long, intent string, customer_text string")
    asked = spark.createDataFrame(queries, "query_id long, intent string, customer_text string")
    return cases, queries, df, asked, tfidf.build_index(df, tfidf.TfidfSpec(profile="index", postings_per_task=5))


@pytest.mark.parametrize("k", [1, 3, 10])
@pytest.mark.parametrize("budget", [10**9, 0])
def test_topk_is_exact(built, k, budget):
    cases, queries, _, asked, index = built
    rows = retrieval.retrieve(asked, index, k, pair_budget=budget).collect()
    assert {(r.query_id, r.rank_no): (r.case_id, round(r.similarity, 6)) for r in rows} == brute(cases, queries, k)


@pytest.mark.parametrize("per_shard, per_task", [(7, 1024), (30, 5), (1000, 3)])
def test_shards_and_shares_of_any_size(spark, built, monkeypatch, per_shard, per_task):
    cases, queries, _, asked, index = built
    cut = dataclasses.replace(index, shards=blocks.shards_of(index.vectors, per_shard))
    found = blocks.best_vectors
    monkeypatch.setattr(retrieval, "best_vectors", lambda d, s, k: found(d, s, k, per_task))
    for k in (1, 4):
        rows = retrieval.retrieve(asked, cut, k, pair_budget=0).collect()
        assert {(r.query_id, r.rank_no): (r.case_id, round(r.similarity, 6)) for r in rows} == brute(cases, queries, k)


def shard_of(rows, n_terms):
    """A shard from {place: {term: weight}}."""
    entries = sorted((t, -w, p) for p, own in enumerate(rows) for t, w in own.items())
    starts = np.searchsorted([t for t, *_ in entries], np.arange(n_terms + 1))
    ids = pa.array(range(100, 100 + len(rows)))
    terms = pa.array([f"t{i:03d}" for i in range(n_terms)])
    return blocks.Shard(ids, ids, terms, starts, np.array([p for *_, p in entries]), np.array([-w for _, w, _ in entries]))


@pytest.mark.parametrize("block", [1, 3, 64])
@pytest.mark.parametrize("seed", range(4))
def test_blocks_and_cuts_lose_nothing(monkeypatch, block, seed):
    """With every list read in blocks, and from no, low, exact and high floors, the k best stay."""
    monkeypatch.setattr(blocks, "BLOCK", block)
    monkeypatch.setattr(blocks, "READ_ALL", 0)
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(300):
        own = rng.choice(40, size=rng.integers(1, 12), replace=False, p=np.arange(40, 0, -1) / 820)
        weights = rng.choice([1.0, 2.0, 5.0], size=len(own)) if seed % 2 else rng.random(len(own)) + 0.01
        rows.append(dict(zip(own.tolist(), (weights / np.sqrt((weights**2).sum())).tolist())))
    shard = shard_of(rows, 40)
    for k in (1, 3, 20, 400):
        for _ in range(15):
            terms = np.sort(rng.choice(40, size=rng.integers(1, 8), replace=False))
            weights = rng.random(len(terms)) + 0.01
            asked = dict(zip(terms.tolist(), weights.tolist()))
            full = [(-round(sum(w * asked[t] for t, w in own.items() if t in asked), 9), p) for p, own in enumerate(rows)]
            want = sorted(x for x in full if x[0] < 0)[:k]
            for floor in (0.0, -want[-1][0] if len(want) == k else 0.0):
                places, scores = shard.best(terms, weights, k, floor)
                assert [(-round(s, 9), p) for s, p in zip(scores.tolist(), places.tolist())] == want
            if want:
                places, scores = shard.best(terms, weights, k, -want[0][0])
                assert [(-round(s, 9), p) for s, p in zip(scores.tolist(), places.tolist())] == [x for x in want if x[0] == want[0][0]]


def test_a_floor_spares_postings(monkeypatch):
    monkeypatch.setattr(blocks, "READ_ALL", 0)
    rng = np.random.default_rng(1)
    rows = [{0: 0.05 + 0.1 * rng.random(), 1: 0.9 if i < 20 else 0.01, 2: 0.2 * rng.random() + 0.01} for i in range(5000)]
    shard = shard_of(rows, 3)
    places, _ = shard.best(np.array([0, 1, 2]), np.array([0.1, 0.9, 0.1]), 5, 0.0)
    assert set(places.tolist()) <= set(range(20)) and shard.read < 3000


def test_short_queries_ask_nothing(spark, built):
    index = built[4]
    asked = spark.createDataFrame([(1, "A", " @x w1! "), (2, "A", "w1 w"), (3, "A", "slow")], "query_id long, intent string, customer_text string")
    found = lambda n: {r.query_id for r in retrieval.retrieve(asked, index, 2, min_chars=n).collect()}
    assert (found(0), found(3), found(5)) == ({1, 2, 3}, {2, 3}, set())


def test_a_hot_query_vector_is_salted(built, monkeypatch):
    cases, queries, _, asked, index = built
    plain = retrieval._owner_join
    monkeypatch.setattr(retrieval, "_owner_join", lambda owners, lists: plain(owners, lists, 3))
    rows = retrieval.retrieve(asked, index, 3).collect()
    assert {(r.query_id, r.rank_no): (r.case_id, round(r.similarity, 6)) for r in rows} == brute(cases, queries, 3)


def test_copies_share_a_vector(built):
    index = built[4]
    assert index.vectors.count() < 70
    assert index.members.groupBy("part", "vec_id").count().agg(F.max("count")).first()[0] > 5


def test_large_vocabulary_path(spark, built, monkeypatch):
    cases, queries, df, asked, _ = built
    monkeypatch.setattr(tfidf, "BROADCAST_TERMS", 0)
    index = tfidf.build_index(df, tfidf.TfidfSpec(profile="index"))
    rows = retrieval.retrieve(asked, index, 3).collect()
    assert {(r.query_id, r.rank_no): (r.case_id, round(r.similarity, 6)) for r in rows} == brute(cases, queries, 3)


def test_feature_cap_keeps_the_most_frequent(spark, built):
    df = built[2]
    for cap in (5, 1500):
        spec = tfidf.TfidfSpec(profile="index", max_features=cap)
        assert tfidf.build_index(df, spec).vocab.groupBy("part").count().agg(F.max("count")).first()[0] <= cap


@pytest.mark.parametrize("cap", [1, 7, 40, 100, 10_000])
@pytest.mark.parametrize("lead", [1, 3])
def test_the_cap_falls_inside_ties(spark, cap, lead):
    rng = random.Random(cap)
    names = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 5))) for _ in range(400)]
    rows = sorted({(p, t): (p, t, rng.choice([2, 2, 2, 3, 9])) for t in names for p in ("x", "y") if p == "x" or len(t) > 3}.values())
    terms = spark.createDataFrame(rows, "part string, term string, total long").repartition(3)
    want = []
    for p in ("x", "y"):
        want += sorted((r for r in rows if r[0] == p), key=lambda r: (-r[2], r[1].encode()))[:cap]
    assert sorted(map(tuple, tfidf.most_frequent(terms, cap, lead).collect())) == sorted(want)


def test_index_survives_a_roundtrip(spark, built, tmp_path):
    _, _, df, asked, index = built
    index_store.save_index(index, df, str(tmp_path / "ix"))
    loaded, cases = index_store.load_index(spark, str(tmp_path / "ix"))
    order = ["query_id", "rank_no"]
    first = retrieval.retrieve(asked, index, 3).orderBy(order).collect()
    again = retrieval.retrieve(asked, loaded, 3).orderBy(order).collect()
    assert first == again and cases.count() == df.count()
    assert loaded.spec == tfidf.TfidfSpec(**{**loaded.spec.__dict__})


def entries(index):
    rows = index.postings().join(index.members, ["part", "vec_id"]).collect()
    return sorted((r.part, r.case_id, r.term, round(r.weight, 9)) for r in rows)


def test_merged_cases_equal_a_new_index(spark, built, tmp_path):
    cases, queries, df, asked, index = built
    first, second = (spark.createDataFrame(c, df.schema) for c in (cases[:50], cases[50:] + [(500, "C", "the new part is the new part"), (501, "A", "")]))
    index_store.save_index(tfidf.build_index(first, index.spec), first, str(tmp_path / "ix"))
    loaded, _ = index_store.load_index(spark, str(tmp_path / "ix"))
    merged = tfidf.merge_cases(loaded, second)
    whole = tfidf.build_index(first.unionByName(second), index.spec)
    assert entries(merged) == entries(whole)
    vocab = ["part", "term", "df", "idf"]
    assert sorted(map(tuple, merged.vocab.select(vocab).collect())) == sorted(map(tuple, whole.vocab.select(vocab).collect()))
    rows = retrieval.retrieve(asked, merged, 3).collect()
    assert {(r.query_id, r.rank_no): (r.case_id, round(r.similarity, 6)) for r in rows} == brute(cases + [(500, "C", "the new part is the new part"), (501, "A", "")], queries, 3)


def test_the_kept_postings_are_joined_where_they_lie(spark, built, tmp_path):
    _, _, df, asked, index = built
    index_store.save_index(index, df, str(tmp_path / "ix"), buckets=16)
    loaded, _ = index_store.load_index(spark, str(tmp_path / "ix"))
    distinct, _, _ = tfidf.vectorize_queries(asked, loaded, "query_id", "customer_text", "intent")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        pieces = distinct.select("part", "q_key", F.inline("vec").alias("term", "weight", "df", "salts"))
        plan = retrieval._scores(pieces, loaded)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    scan = next(i for i, x in enumerate(lines) if "SelectedBucketsCount" in x or "Bucketed: true" in x)
    join = max(i for i in range(scan) if "Join" in lines[i])
    # between the join and the scan of the postings, on the scan's own branch, nothing is exchanged
    depth = [len(x) - len(x.lstrip(" :|+-")) for x in lines]
    own = [i for i in range(join + 1, scan + 1) if all(depth[j] > depth[i] for j in range(i + 1, scan + 1))]
    assert not any("Exchange" in lines[i] for i in own)


def test_rerank(spark):
    rows = [(1, 1, 10, 0.9, "generic"), (1, 2, 11, 0.5, "troubleshooting"), (1, 3, 12, 0.1, "troubleshooting"), (1, 4, 13, 0.4, "clarification")]
    hits = spark.createDataFrame(rows, "query_id int, rank_no int, case_id int, similarity double, response_type string")
    got = [(r.new_rank, r.case_id) for r in retrieval.rerank(hits, 3).orderBy("new_rank").collect()]
    assert got == [(1, 11), (3, 13)]  # the 0.1 row takes a place and is dropped afterwards


def test_knn_vote(spark):
    hits = spark.createDataFrame([(1, 1, 1.0), (1, 2, 0.9), (1, 3, 0.9), (2, 2, 0.5), (2, 3, 0.5), (2, 1, 0.2)], "query_id int, case_id int, similarity double")
    labels = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], "case_id int, label string")
    got = {r.query_id: (r.predicted, round(r.votes, 6)) for r in retrieval.knn_vote(hits, labels).collect()}
    assert got == {1: ("x", 1.0), 2: ("y", 4.0)}


def test_leaks(spark):
    corpus_ = spark.createDataFrame([(1, "Hello, World!"), (2, "other"), (3, "hello world")], "case_id int, t string")
    asked = spark.createDataFrame([(9, "@x hello world"), (8, "new")], "query_id int, q string")
    report = retrieval.leakage_report(asked, corpus_, "query_id", "q", "case_id", "t").collect()
    assert [(r.query_id, r.copies, r.first_case) for r in report] == [(9, 2, 1)]
    assert [r.case_id for r in retrieval.without_leaks(corpus_, asked, "t", "q").collect()] == [2]


def test_a_text_without_kept_characters_leaks_nothing(spark):
    corpus_ = spark.createDataFrame([(1, "привет"), (2, "пока"), (3, "same words"), (4, None)], "case_id int, t string")
    asked = spark.createDataFrame([(9, "日本語"), (8, "Same, words")], "query_id int, q string")
    assert sorted(r.case_id for r in retrieval.without_leaks(corpus_, asked, "t", "q").collect()) == [1, 2, 4]


def test_every_copy_is_a_member_and_any_k_is_answered(spark):
    rows = [(i, "router light red", "a") for i in range(150)] + [(200 + i, f"router modem {i % 7} red", "a") for i in range(20)]
    df = spark.createDataFrame(rows, "case_id int, customer_text string, intent string")
    index = tfidf.build_index(df, tfidf.TfidfSpec(profile="index"))
    assert index.members.count() == 170
    asked = spark.createDataFrame([(1, "red router light", "a")], "query_id int, customer_text string, intent string")
    hits = retrieval.retrieve(asked, index, 140).orderBy("rank_no").collect()
    assert [r.case_id for r in hits] == list(range(140))


def test_words_are_worked_on_a_piece_at_a_time(monkeypatch):
    """A batch is cut between documents, whatever their lengths; blank ones and long ones stay whole."""
    lengths = [3, 0, 4, 25, None, 2, 2, 9, 1, 0]
    words = pa.array([None if n is None else ["w"] * n for n in lengths], pa.list_(pa.string()))
    batch = pa.RecordBatch.from_arrays([pa.array([f"p{i % 2}" for i in range(10)]), pa.array(range(10)), words], ["part", "doc_id", "words"])
    monkeypatch.setattr(tfidf, "WORDS_AT_ONCE", 10)
    found = [(part, rows["doc_id"].to_pylist(), sum(n or 0 for n in rows["words"].value_lengths().to_pylist())) for part, rows in tfidf._by_part(batch)]
    assert sorted(d for part, docs, _ in found for d in docs if part == f"p{d % 2}") == list(range(10))
    assert all(n <= 10 + max(lengths[d] or 0 for d in docs) for _, docs, n in found) and len(found) > 4
    assert list(tfidf._by_part(batch.slice(0, 0))) == []


def test_one_task_holds_a_pile_of_shards(spark, built, monkeypatch):
    """A query that comes more than once is answered once, and by a pile of shards with its k best
    (and what ties with them), not with k of every shard."""
    cases, queries, _, asked, index = built
    weighed, _, _ = tfidf.weigh_queries(asked, index, "query_id", "customer_text", "intent")
    twice = weighed.unionByName(weighed).withColumnRenamed("key", "q_key")
    shards = blocks.shards_of(index.vectors, 3).cache()
    piles = {r["part"]: r["shards"] for r in shards.select("part", "shards").distinct().collect()}
    assert min(piles.values()) > 4
    for size in (100, 4):
        monkeypatch.setattr(blocks, "SHARDS_PER_TASK", size)
        rows = blocks.best_vectors(twice, shards, 1).collect()
        assert len({(r.part, r.q_key, r.vec_id) for r in rows}) == len(rows)
        best = {}
        for r in rows:
            best.setdefault((r.part, r.q_key), []).append(round(r.score, 9))
        tied = all(len(set(scores)) == 1 for scores in best.values())
        assert tied if size == 100 else all(len(set(s)) <= -(-piles[p] // 4) for (p, _), s in best.items())
    shards.unpersist()
