"""Exact top-k retrieval by cosine over the relational index."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskloom.functions import lexicon as lex
from deskloom.functions import text as tx
from deskloom.operators.blocks import best_vectors
from deskloom.operators.packed import unpack
from deskloom.operators.skew import ROWS_PER_TASK, lookup_join, top_within
from deskloom.operators.tfidf import TfidfIndex, distinct_queries, pack_queries, weigh_queries
from deskloom.session import cut_lineage

# Joining every shared term pays for small work only: beyond this many (query, vector, term) rows,
# counted exactly from the vocabulary before anything runs, the shards of the index are searched.
PAIR_BUDGET = 2_000_000
EPS = 2e-9
FEW_HITS = 100_000  # of ids and numbers: some 5 MB


def _scores(entries: DataFrame, index: TfidfIndex) -> DataFrame:
    """(part, q_key, vec_id, score): dot product over the given query entries. The query side is
    repeated per piece of a term's postings, so a frequent term is never one task."""
    asked = entries.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).select(
        "part", "q_key", "term", "salt", F.col("weight").alias("q_weight")
    )
    return (
        asked.join(index.salted_postings(), ["part", "term", "salt"])
        .groupBy("part", "q_key", "vec_id")
        .agg(F.sum(F.col("q_weight") * F.col("weight")).alias("score"))
    )


def _best(scores: DataFrame, k: int) -> DataFrame:
    """k best vectors per query; scores are compared at nine decimals, then by id."""
    rounded = scores.withColumn("score", F.round("score", 9))
    return top_within(rounded, ["part", "q_key"], [F.col("score").desc(), F.col("vec_id")], k)


def _nearest_vectors(weighed: DataFrame, index: TfidfIndex, k: int, postings: int, budget: int, packed: bool) -> DataFrame:
    """(part, q_key, vec_id, score, copies). ``packed`` says whether the queries are."""
    vectors = index.dealt() if packed else None
    if postings > budget and vectors is not None:
        return _best(best_vectors(weighed.withColumnRenamed("key", "q_key"), vectors, k, book=index.codebook), k)
    if packed:
        weighed = unpack(weighed.drop("n", "postings"), index.codebook)
    if postings > budget:
        return _best(best_vectors(weighed.withColumnRenamed("key", "q_key"), index.sharded(), k), k)
    entries = distinct_queries(weighed).select("part", "q_key", F.inline("vec").alias("term", "weight", "df", "salts"))
    best = _best(_scores(entries, index), k)
    return best.join(index.sizes(), ["part", "vec_id"])


def _owner_join(owners: DataFrame, lists: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    if owners.count() <= rows_per_task:  # a footer count: owners are a written table
        return owners.join(lists, ["part", "q_key"])
    key = F.struct("part", "q_key")
    keyed = lists.select(key.alias("__owner"), "found")
    return lookup_join(owners.withColumn("__owner", key), keyed, "__owner", "inner", ["query_id"], rows_per_task)


def retrieve(
    queries: DataFrame,
    index: TfidfIndex,
    k: int,
    id_col: str = "query_id",
    text_col: str = "customer_text",
    part_col: str = "intent",
    pair_budget: int = PAIR_BUDGET,
    min_chars: int = 0,
) -> DataFrame:
    """(query_id, part, rank_no, case_id, similarity): k most similar cases per query.

    Only cases that share a term with the query appear, and none for a query of fewer than
    ``min_chars`` cleaned characters. Ties go to the smaller case id.
    Queries with the same vector are answered once. The number of rows a plain join would
    make is read off the vocabulary first; beyond ``pair_budget`` the shards of the index are
    searched, which returns the same rows.
    """
    packed = index.small_vocab
    weighed, owners, postings = (pack_queries if packed else weigh_queries)(queries, index, id_col, text_col, part_col, min_chars)
    best = cut_lineage(_nearest_vectors(weighed, index, k, postings, pair_budget, packed))
    # a vector without copies is its own case; of a vector with copies no later one can be among the
    # first k: each task passes on k of them at most
    copied = best.filter("copies > 1")
    found = index.members.join(copied.select("part", "vec_id").distinct(), ["part", "vec_id"], "left_semi")
    heads = top_within(found, ["part", "vec_id"], [F.col("case_id")], k)
    cases = (
        best.filter("copies = 1")
        .withColumn("case_id", F.col("vec_id"))
        .unionByName(copied.join(heads, ["part", "vec_id"]))
    )
    ranked = top_within(
        cases, ["part", "q_key"], [F.col("score").desc(), F.col("case_id")], k, out="rank_no"
    )
    # one row per distinct query vector, so that a vector shared by a third of all queries is
    # an ordinary many-to-one lookup that can be salted
    lists = ranked.groupBy("part", "q_key").agg(
        F.collect_list(F.struct("rank_no", "case_id", F.col("score").alias("similarity"))).alias("found")
    )
    joined = _owner_join(owners, lists)
    return joined.select("query_id", "part", F.inline("found"))


def with_cases(hits: DataFrame, cases: DataFrame) -> DataFrame:
    """Attach texts, response type and, if present, problem signals of the retrieved cases."""
    extra = [c for c in ("historical_signals",) if c in cases.columns]
    details = cases.select(
        "case_id",
        F.col("customer_text").alias("historical_customer"),
        F.col("support_reply").alias("historical_reply"),
        "response_type",
        *extra,
    )
    hits = cut_lineage(hits)
    rows = hits.count()
    if rows <= FEW_HITS:  # the cases stay where they are
        joined = details.join(F.broadcast(hits), "case_id")
        return joined.select("case_id", *[c for c in hits.columns if c != "case_id"], *[c for c in details.columns if c != "case_id"])
    # the best case of a popular message owns a large share of the hits
    return lookup_join(hits, details, "case_id", spread_by=["query_id"], rows=rows)


def type_priority(response_type: F.Column) -> F.Column:
    order = None
    for name, place in lex.TYPE_PRIORITY.items():
        hit = response_type == name
        order = F.when(hit, place) if order is None else order.when(hit, place)
    return order.otherwise(max(lex.TYPE_PRIORITY.values()))


def rerank(hits: DataFrame, k: int, min_similarity: float = lex.MIN_SIMILARITY) -> DataFrame:
    """From an over-fetched list prefer substantive replies, keep k, then drop the weak ones."""
    chosen = top_within(
        hits,
        ["query_id"],
        [type_priority(F.col("response_type")), F.col("similarity").desc(), F.col("rank_no")],
        k,
        out="new_rank",
    )
    return chosen.filter(F.col("similarity") >= min_similarity)


def knn_vote(hits: DataFrame, labels: DataFrame, label_col: str = "label") -> DataFrame:
    """(query_id, predicted, votes): neighbours vote with 1/distance; exact copies outvote
    everything else; ties go to the smaller label."""
    joined = lookup_join(hits, labels.select("case_id", label_col), "case_id", spread_by=["query_id"])
    distance = F.lit(1.0) - F.col("similarity")
    exact = F.col("similarity") >= 1.0 - EPS
    tallied = joined.groupBy("query_id", label_col).agg(
        F.sum(F.when(exact, 1.0).otherwise(0.0)).alias("__exact"),
        F.sum(F.when(exact, 0.0).otherwise(F.lit(1.0) / distance)).alias("__near"),
    )
    any_exact = F.max("__exact").over(Window.partitionBy("query_id")) > 0
    votes = tallied.withColumn("votes", F.when(any_exact, F.col("__exact")).otherwise(F.col("__near")))
    best = top_within(votes, ["query_id"], [F.round("votes", 9).desc(), F.col(label_col)], 1)
    return best.select("query_id", F.col(label_col).alias("predicted"), "votes")


def leakage_report(
    queries: DataFrame, corpus: DataFrame, query_id: str, query_text: str, case_id: str, case_text: str
) -> DataFrame:
    """(query_id, copies, first_case): queries whose cleaned text occurs in the corpus."""
    asked = _text_keys(queries, query_id, query_text)
    held = (
        _text_keys(corpus, case_id, case_text)
        .groupBy("text_key")
        .agg(F.countDistinct(case_id).alias("copies"), F.min(case_id).alias("first_case"))
    )
    return asked.join(held, "text_key").drop("text_key")


def _text_keys(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    cleaned = df.select(id_col, tx.clean(F.col(text_col), "index").alias("__t"))
    return cleaned.filter(F.col("__t") != "").select(id_col, F.md5("__t").alias("text_key"))


def without_leaks(
    corpus: DataFrame, queries: DataFrame, case_text: str, query_text: str
) -> DataFrame:
    """Corpus rows whose cleaned text is not also a query: run it before building an index
    that is going to be evaluated with these queries."""

    def key(text: str) -> F.Column:
        # a text without any kept character is like no other one
        return F.md5(F.nullif(tx.clean(F.col(text), "index"), F.lit("")))

    keys = queries.select(key(query_text).alias("__key")).filter(F.col("__key").isNotNull()).distinct()
    return corpus.withColumn("__key", key(case_text)).join(keys, "__key", "left_anti").drop("__key")
