import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from deskloom.llm import toxicity
from test_ngram_join import brute

WORDS = [a + b for a in "ka lo mi ne pu ra si to".split() for b in "ba de fi go hu".split()]


def corpus():
    random.seed(21)
    rows = []
    for i in range(160):
        words = random.choices(WORDS, k=random.choice([30, 80, 200]))
        if i % 5 == 0:
            words[3::12] = ["scum"] * len(words[3::12])
        rows.append((i, " ".join(words), random.choice(["en", "de", "fr", "es"]), f"src{i % 3}", 1))
    rows += [(200 + i, rows[1][1], "en", "src0", 1) for i in range(6)]
    rows += [(300 + i, rows[2][1] + " " + WORDS[i], "en", "src0", 1) for i in range(6)]
    rows += [(400, None, None, None, None), (401, "", "en", "src1", 0)]
    return rows


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame(corpus(), "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.repartition(3).write.parquet(f"{at}/documents.parquet")
    marks = docs.filter("doc_id < 160").select("doc_id", F.expr("int(doc_id % 3 > 0)").alias("quality"), F.expr("int(doc_id % 5 = 0)").alias("toxic"))
    marks.write.parquet(f"{at}/labels.parquet")
    return at


def test_each_stage_takes_effect(spark, tables, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 60)
    monkeypatch.setattr(toxicity, "BATCH", 96)
    text = {r[0]: r[1] for r in corpus()}
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tables}/{name}"
        stage(spark, docs, tables).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns
        seen.append([r["doc_id"] for r in docs.select("doc_id").collect()])
    clean, unique, near, mixed, packed = seen
    toxic = [i for i in range(160) if i % 5 == 0]
    assert len(set(clean) & set(toxic)) <= 3 and len(set(range(160)) - set(toxic) - set(clean)) <= 6
    best = {}
    for i in clean:
        best[text[i] or ""] = max(i, best.get(text[i] or "", i))
    assert sorted(unique) == sorted(best.values())
    parts = brute([(i, text[i]) for i in unique])
    assert sorted(near) == sorted(i for i in unique if parts[i][1] == i)
    assert set(mixed) <= set(near) and len(mixed) > 0
    assert set(packed) == set(mixed) and len(packed) >= len(mixed)
