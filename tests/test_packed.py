import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from deskloom.operators import blocks, learning, packed, retrieval, tfidf

WORDS = ["net", "ñet", "slow", "red"] + [f"wörd{i}" for i in range(40)]


@pytest.fixture(scope="module")
def cases(spark):
    rng = random.Random(4)
    rows = [(i % 50, rng.choice(["A", "B", None]), " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 300)))) for i in range(60)]
    return rows + [(99, "B", None)], spark.createDataFrame([*rows, (99, "B", None)], "case_id long, intent string, customer_text string").repartition(3)


def bags(rows):
    for i, part, text in rows:
        words = (text or "").split()
        yield i, part, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def test_numbers_and_entries_come_back():
    values = np.array([0, 1, 127, 128, 300, 16_383, 16_384, 2**21, 2**28 - 1, 2**28, 2**34])
    data, sizes = packed.varints(values)
    assert packed.numbers(data)[0].tolist() == values.tolist() and sizes.sum() == len(data)
    doc, place, tf = np.array([0, 0, 2, 2, 2, 5]), np.array([3, 70_000, 0, 1, 500, 9]), np.array([1, 400, 2, 1, 1, 7])
    held = packed.pack_entries(doc, place, tf, 7)
    assert [x.tolist() for x in packed.unpack_entries(held)] == [doc.tolist(), place.tolist(), tf.tolist()]
    assert [x.tolist() for x in packed.unpack_entries(held.slice(2, 4))] == [[0, 0, 0, 3], [0, 1, 500, 9], [2, 1, 1, 7]]
    assert [len(x) for x in packed.unpack_entries(held.slice(0, 0))] == [0, 0, 0]


def test_terms_come_back_and_hash_alike():
    terms = pa.array(["ab", "ñandú x", "ab c", "zz"])
    assert packed.terms_of(packed.whole(packed.squeezed(packed.text_of(terms.slice(1, 2)))), 2).to_pylist() == ["ñandú x", "ab c"]
    assert packed.hashes(terms.slice(1)).tolist() == packed.hashes(terms).tolist()[1:]
    many = pa.array([f"{a} {b}" for a in range(200) for b in range(200)])
    assert len(set(packed.hashes(many).tolist())) == 40_000
    assert np.bincount((packed.hashes(many) % np.uint64(8)).astype(int)).min() > 4_500


@pytest.mark.parametrize("at_once", [50, 500_000])
def test_terms_are_counted(spark, cases, monkeypatch, at_once):
    monkeypatch.setattr(tfidf, "WORDS_AT_ONCE", at_once)
    rows, df = cases
    spec = tfidf.TfidfSpec(profile="lower")
    words = tfidf.words_table(df, spec, "case_id", "customer_text", "intent")
    want = {}
    for _, part, bag in bags(rows):
        if part:
            for t, n in Counter(bag).items():
                df_, total = want.get((part, t), (0, 0))
                want[part, t] = df_ + 1, total + n
    docs = {(p, None): (n, n) for p, n in Counter(part for _, part, _ in rows if part).items()}
    got = {(r.part, r.term): (r.df, r.total) for r in tfidf.count_terms(words, spec, with_rows=True).collect()}
    assert got == want | docs
    some = {(r.part, r.term): (r.df, r.total) for r in tfidf.count_terms(words, spec, least=3).collect()}
    assert some == {k: v for k, v in want.items() if v[0] >= 3}


def test_vectors_are_written_as_places(spark, cases):
    """What an index writes of its vectors and moves is a few bytes an entry; read, they are whole."""
    rows, df = cases
    index = tfidf.build_index(df, tfidf.TfidfSpec(profile="lower"))
    size = index.packed.agg(F.sum(F.length("entries")), F.sum("n")).first()
    assert size[0] < 3 * size[1]
    rows_of = lambda d: sorted((r.part, r.doc_id, [(x.term, round(x.weight, 12), x.df, x.salts) for x in r.vec]) for r in d.collect())
    # a join puts the rows of one id together, so it is asked about ids that come once
    once = index.words.join(index.words.groupBy("doc_id").count().filter("count = 1"), "doc_id").select(*index.words.columns)
    assert rows_of(tfidf.weigh(once, index.vocab, False, index.spec)) == rows_of(tfidf.weigh(once, index.vocab, True, index.spec))
    joined = index.postings().join(index.members, ["part", "vec_id"])
    entries, want = (sorted((r.part, r.case_id, r.term, round(r.weight, 12)) for r in d.collect()) for d in (index.entries(), joined))
    assert entries == want and len(want) > 1_000
    for frame in (index.vectors, index.entries(), index.dealt()):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        moved = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
        assert not any("vec#" in x or "weight#" in x for x in moved)


def test_few_hits_do_not_move_the_cases(spark, cases, monkeypatch):
    rows, df = cases
    known = df.dropDuplicates(["case_id"]).withColumns({"support_reply": F.col("customer_text"), "response_type": F.lit("x")})
    known = known.unionByName(known.filter("case_id < 5")).localCheckpoint()
    hits = spark.createDataFrame([(q, "A", 1, q % 50, 0.5) for q in range(120)], "query_id long, part string, rank_no int, case_id long, similarity double")
    few = retrieval.with_cases(hits, known)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and not any("customer_text" in x for x in plan.splitlines() if "Exchange" in x)
    monkeypatch.setattr(retrieval, "FEW_HITS", 10)
    many = retrieval.with_cases(hits, known)
    assert few.columns == many.columns and few.count() > 120
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))


@pytest.mark.parametrize("few", [1_000_000, 0])
def test_a_certificate_of_packed_entries(spark, cases, monkeypatch, few):
    """Entries that come packed give the loss and gradient of the same entries in rows; neither they nor
    the rows are moved to meet few coefficients. Ids that come twice count twice."""
    monkeypatch.setattr(learning, "BROADCAST_COEFFICIENTS", few)
    index = tfidf.build_index(cases[1].withColumn("intent", F.lit("all")), tfidf.TfidfSpec(profile="lower"))
    examples = cases[1].select(F.col("case_id").alias("id"), F.coalesce("intent", F.lit("C")).alias("label"), (1 + F.col("case_id") % 3).alias("importance"))
    given = index.vocab.select("term", F.explode(F.array(*map(F.lit, "ABC"))).alias("label"))
    given = given.select("label", "term", (F.length("term") % 5 / 10.0 - F.length("label") / 4).alias("coefficient")).filter("length(term) < 14")
    level = spark.createDataFrame([("A", 0.1), ("B", 0.0), ("C", -0.2)], "label string, intercept double")
    both = [
        learning.regression_certificate(entries, examples, given, level, 0.01, book).first()
        for entries, book in (
            (index.packed_cases().withColumnRenamed("case_id", "id"), index.codebook),
            (index.entries().withColumnRenamed("case_id", "id"), None),
        )
    ]
    assert both[0]["examples"] == both[1]["examples"] > 0
    assert tuple(both[0]) == pytest.approx(tuple(both[1]), rel=1e-9) and both[0]["gradient_max"] > 0


@pytest.mark.parametrize("per_task, per_pile", [(7, 2), (100, 3), (5, 64)])
def test_piles_and_shares_of_packed_shards(spark, cases, monkeypatch, per_task, per_pile):
    """Any number of shares and piles finds the same; a query is moved as bytes, once to each pile."""
    monkeypatch.setattr(blocks, "PACKED_SHARDS_PER_TASK", per_pile)
    monkeypatch.setattr(blocks, "SHARDS_PER_TASK", per_pile)
    index = tfidf.build_index(cases[1], tfidf.TfidfSpec(profile="lower"))
    asked = tfidf.pack_queries(cases[1], index, "case_id", "customer_text", "intent")[0].withColumnRenamed("key", "q_key")
    dealt = blocks.deal(index.packed, "n", 3)
    assert dealt.agg(F.max("shards")).first()[0] > 6
    found = blocks.best_vectors(asked, dealt, 3, per_task, index.codebook)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any("vec#" in x or "weights#" in x for x in plan.splitlines() if "Exchange" in x)
    want = blocks.best_vectors(tfidf.unpack(asked.drop("n", "postings"), index.codebook), blocks.shards_of(index.vectors), 3)
    rows = [
        sorted((r.part, r.q_key, round(r.score, 6), r.vec_id, r.copies) for r in retrieval._best(d, 3).collect()) for d in (found, want)
    ]
    assert rows[0] == rows[1] and len(rows[0]) > 100


@pytest.mark.parametrize("at_once", [40, 500_000])
def test_features_without_a_row_for_a_term(spark, cases, monkeypatch, at_once):
    """Every row, also of an id that comes twice, gets the vector of its own text; terms meet the
    vocabulary in pieces of the documents and not one by one."""
    monkeypatch.setattr(tfidf, "WORDS_AT_ONCE", at_once)
    monkeypatch.setattr(tfidf, "exploded", lambda *_: pytest.fail("a row for a term"))
    rows, df = cases
    spec = tfidf.TfidfSpec(profile="lower", max_df=0.8, max_features=None)
    train = df.filter("case_id < 40")
    table, vocab, width, path = learning.feature_table(df.withColumn("no", F.length("customer_text")), train, spec, "case_id", "customer_text", ("no",))
    terms = {r.position: r.term for r in vocab.collect()}
    seen = [set(bag) for i, _, bag in bags(rows) if i < 40]
    n = Counter(t for bag in seen for t in bag)
    n = {t: c for t, c in n.items() if 2 <= c <= math.floor(0.8 * len(seen))}
    assert sorted(terms.values()) == sorted(n) and sorted(terms) == list(range(width))
    want = []
    for i, _, bag in bags(rows):
        raw = {t: (1 + math.log(c)) * (math.log((1 + len(seen)) / (1 + n[t])) + 1) for t, c in Counter(bag).items() if t in n}
        size = math.sqrt(sum(x * x for x in raw.values()))
        want.append((i, sorted((t, round(x / size, 9)) for t, x in raw.items())))
    got = table.collect()
    assert len({r.n for r in got}) == len(got) and all(r.features.indices == sorted(r.features.indices) for r in got)
    assert sorted((r.doc_id, sorted((terms[j], round(x, 9)) for j, x in zip(r.features.indices, r.features["values"]))) for r in got) == sorted(want)
    assert sorted((r.doc_id, r.no or 0) for r in got) == sorted((i, len(t or "")) for i, _, t in rows)
    assert sum(r["features"].numNonzeros() for r in learning.as_vectors(table, path).collect()) == sum(len(v) for _, v in want)
