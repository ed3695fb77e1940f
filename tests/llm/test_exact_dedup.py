import hashlib

from deskloom.llm.exact_dedup import drop_exact_duplicates, exact_duplicates, frequent_digests

LONG = "word " * 200_000


def test_every_row_gets_its_groups_winner(make):
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, LONG), (6, LONG), (None, "a"), (7, "b"), (9, "c"), (9, "c")]
    got = sorted(map(tuple, exact_duplicates(make(rows), counters=2).collect()), key=str)
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    want = []
    seen = set()
    for i, t in rows:
        ids = groups[t or ""]
        keep = max(x for x in ids if x is not None)
        kept = i == keep and (i, t) not in seen
        seen.add((i, t))
        want.append((i, keep, len(ids), kept, hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_one_row_per_text_stays_with_all_columns(make):
    docs = make([(1, "a"), (2, "a"), (2, "a"), (3, "b"), (None, None)])
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [(0, ""), (2, "a"), (3, "b")]


def test_only_null_ids_and_no_rows(make):
    rows = exact_duplicates(make([(None, "x"), (None, "x")])).collect()
    assert sorted(r["kept"] for r in rows) == [False, True] and rows[0]["keep_id"] is None
    assert exact_duplicates(make([])).count() == 0 and drop_exact_duplicates(make([])).count() == 0


def test_frequent_digests_are_found_with_few_counters(spark):
    from pyspark.sql import functions as F

    values = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"))
    digests = values.repartition(5).select(F.unhex(F.sha2(F.col("v").cast("string"), 256)).alias("sha"))
    found = [bytes(r["sha"]) for r in frequent_digests(digests, 4).collect()]
    assert len(found) <= 4 and hashlib.sha256(b"0").digest() in found
