import random

import pytest
from pyspark.sql import functions as F

from deskloom.functions.policy import SUPPORT
from deskloom.operators import profile, threads
from deskloom.operators.skew import keep_first, lookup_join
from deskloom.sources.tables import typed_messages

RAW = [
    # id, author, inbound, created, text, response, parent
    ("1", "c1", "True", "Fri Nov 24 10:00:00 +0000 2017", "my router is broken since monday please help", "2", None),
    ("2.0", "Brand", "False", "Mon Nov 27 10:00:00 +0000 2017", "please restart the router", None, "1.0"),
    ("3", "Brand", "False", "Fri Nov 24 11:00:00 +0000 2017", "did you restart?", None, "1"),
    ("4", "c1", "True", "Fri Nov 24 12:00:00 +0000 2017", "yes", "5", "3"),
    ("5", "Brand", "False", "Fri Nov 24 13:00:00 +0000 2017", "fine", None, "4"),
    ("6", "Brand", "False", "Fri Nov 24 13:00:00 +0000 2017", "self talk", None, "5"),
    ("7", "Brand", "False", "Fri Nov 24 13:00:00 +0000 2017", "orphan", None, "99"),
    # two-message cycle and a message that leads into it, a self-parent
    ("a", "c2", "True", "", "x", None, "b"),
    ("b", "Brand", "False", "", "y", None, "a"),
    ("d", "Brand", "False", "", "w", None, "b"),
    ("s", "Brand", "False", "", "z", None, "s"),
]


@pytest.fixture(scope="module")
def messages(spark):
    schema = "tweet_id string, author_id string, inbound string, created_at string, text string, response_tweet_id string, in_response_to_tweet_id string"
    return typed_messages(spark.createDataFrame(RAW, schema))


@pytest.mark.parametrize("rows_per_task", [1_000_000, 1])
def test_pairs(messages, rows_per_task):
    got = {(r.reply_id, r.message_id) for r in threads.pair_replies(messages, "Brand", rows_per_task).collect()}
    assert got == {("2", "1"), ("3", "1"), ("5", "4"), ("b", "a")}


def test_first_reply_by_time_not_by_weekday_name(messages):
    rows = threads.first_replies(messages, "Brand", min_chars=3).collect()
    assert {(r.message_id, r.reply_id) for r in rows} == {("1", "3"), ("4", "5")}


def brute_chains():
    parent = {r[0].removesuffix(".0"): (r[6] or "").removesuffix(".0") or None for r in RAW}
    author = {r[0].removesuffix(".0"): r[1] for r in RAW}
    out = {}
    for start in parent:
        if author[start] != "Brand":
            continue
        chain, seen, here = [start], set(), start
        while parent[here] and parent[here] not in seen and parent[here] in parent:
            here = parent[here]
            seen.add(here)
            chain.append(here)
        if any(author[m] != "Brand" for m in chain):
            out[start] = (chain[-1], len(chain), sum(author[m] != "Brand" for m in chain))
    return out


@pytest.mark.parametrize("rows_per_task", [1_000_000, 1])
def test_chains(messages, rows_per_task):
    rows = threads.reply_chains(messages, ["Brand"], rows_per_task=rows_per_task).collect()
    assert {r.message_id: (r.root_id, r.length, r.customer_messages) for r in rows} == brute_chains()


def test_chain_stats_upper_median(spark):
    chains = spark.createDataFrame([("B", n) for n in (2, 2, 4, 6)], "author_id string, length long")
    row = profile.chain_stats(chains).first()
    assert (row.chains, row.mean_length, row.median_length, row.multi_turn_share, row.long_share) == (4, 3.5, 4, 0.5, 0.25)


def test_answered_and_brand_stats(messages):
    assert {r.message_id for r in threads.answered_messages(messages, "Brand").collect()} == {"1", "4", "a"}
    row = profile.brand_stats(messages, ["Brand"]).first()
    assert (row.total, row.outbound, row.with_parent, row.customers) == (8, 8, 8, 2)


def test_cases_are_distinct_and_labelled(messages):
    rows = threads.build_cases(messages, "Brand", SUPPORT).collect()
    assert [(r.case_id, r.intent, r.response_type) for r in rows] == [("2", "I03", "troubleshooting")]


def test_keep_first_and_salted_join(spark):
    df = spark.createDataFrame([("k", 3), ("k", 1), (None, 5), (None, 4), ("z", 9)], "k string, i long")
    assert sorted(r.i for r in keep_first(df, ["k"], ["i"]).collect()) == [1, 4, 9]
    left = spark.range(100).select(F.lit("hot").alias("k"), "id").unionByName(
        spark.createDataFrame([("cold", 100), (None, 101)], "k string, id long")
    )
    right = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    for how in ("inner", "left"):
        plain = sorted(map(tuple, left.join(right, "k", how).fillna(-1).collect()), key=str)
        salted = sorted(map(tuple, lookup_join(left, right, "k", how, ["id"], 7).fillna(-1).collect()), key=str)
        assert plain == salted


MESSAGES = "message_id string, author_id string, parent_id string, text string, created_at timestamp"


def walked(parents, authors, start):
    """The reference walk: parents one by one until one would be taken again."""
    taken, chain, at = set(), [start], parents.get(start)
    while at in parents and at not in taken:
        taken.add(at)
        chain.append(at)
        at = parents[at]
    return start, authors[start], chain[-1], len(chain), sum(authors[x] != "Brand" for x in chain)


@pytest.mark.parametrize("rows_per_task", [1_000_000, 3])
def test_chains_into_cycles_of_any_length(spark, rows_per_task):
    rng = random.Random(rows_per_task)
    ids = [f"m{i}" for i in range(90)]
    # a few messages are the parents of a third of all; some parents are missing
    parents = {m: rng.choice(ids[:3]) if rng.random() < 0.3 else rng.choice([*ids, None, "gone"]) for m in ids}
    parents |= {f"c{i}": f"c{(i + 1) % 7}" for i in range(7)} | {f"t{i}": f"t{i + 1}" for i in range(9)} | {"t9": "c3", "self": "self", "to": "self"}
    authors = {m: rng.choice(["Brand", "x", "y"]) for m in parents}
    df = spark.createDataFrame([(m, authors[m], p, "t", None) for m, p in parents.items()], MESSAGES)
    got = threads.reply_chains(df, ["Brand"], relevant_only=False, rows_per_task=rows_per_task).collect()
    want = [w for w in (walked(parents, authors, m) for m in parents if authors[m] == "Brand") if w[4]]
    assert sorted(map(tuple, got)) == sorted(want) and any(m.startswith("t") for m, *_ in want)


def test_a_long_cycle_takes_few_jobs(spark):
    n = 10_000
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("message_id"),
        F.when(F.col("id") % 2 == 0, "Brand").otherwise("x").alias("author_id"),
        ((F.col("id") + 1) % n).cast("string").alias("parent_id"),
    )
    sc = spark.sparkContext
    sc.setJobGroup("cycle", "cycle")
    got = threads.reply_chains(rows, ["Brand"], relevant_only=False)
    seen = got.groupBy("length", "customer_messages").count().collect()
    jobs = len(sc.statusTracker().getJobIdsForGroup("cycle"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert [tuple(r) for r in seen] == [(n + 1, n // 2, n // 2)] and jobs <= 40, jobs
