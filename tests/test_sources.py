import datetime

import pytest
from pyspark.sql import functions as F

from deskloom.operators import learning
from deskloom.operators.tfidf import TfidfSpec
from deskloom.sources import parsing, sinks
from deskloom.sources.tables import first_present, read_messages, read_table, require_columns
from deskloom.streaming import streams


def test_csv_roundtrip(spark, tmp_path):
    rows = [(1, 'two\nlines, "quoted"', None), (2, "plain", "x")]
    df = spark.createDataFrame(rows, "id int, t string, n string")
    sinks.write_csv(df, str(tmp_path / "out"))
    back = read_table(spark, str(tmp_path / "out"), "id int, t string, n string")
    assert sorted(map(tuple, back.collect())) == rows


def test_read_messages(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_bytes(
        "﻿tweet_id,author_id,inbound,created_at,text,response_tweet_id,in_response_to_tweet_id\n"
        '1.0,c,True,Thu Nov 23 23:20:17 +0000 2017,"a ""b""\nc",2,\n2,B,False,bad,x,,1.0\n'.encode()
    )
    one, two = sorted(read_messages(spark, str(path)).collect(), key=lambda r: r.message_id)
    assert (one.message_id, one.inbound, one.text, one.response_id, one.parent_id) == ("1", True, 'a "b"\nc', "2", None)
    assert one.created_at == datetime.datetime(2017, 11, 23, 23, 20, 17)
    assert (two.created_at, two.parent_id, two.inbound) == (None, "1", False)


def test_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, gold_intent int")
    with pytest.raises(ValueError, match="missing"):
        require_columns(df, ["a", "zz"])
    assert first_present(df, ["final_intent", "gold_intent"]) == "gold_intent"
    with pytest.raises(ValueError):
        first_present(df, ["x"])


def test_case_lines(spark):
    lines = ["VX-001   my bill I07 is wrong I07 we see ", "case_id header", "VX-002 no code", "  VX-3 a I12 ", "VX-4 b I13 I01 c"]
    got = {r.value: r for r in parsing.parse_case_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    first = got[lines[0]]
    assert (first.case_id, first.customer_text, first.prelabel_intent, first.support_reply) == ("VX-001", "my bill", "I07", "is wrong I07 we see")
    assert not got[lines[1]].parsed and not got[lines[2]].parsed
    assert (got[lines[3]].customer_text, got[lines[3]].support_reply) == ("a", "")
    assert (got[lines[4]].prelabel_intent, got[lines[4]].customer_text) == ("I01", "b I13")


def test_judge_answers(spark):
    rows = [("a", ' {"relevance": 5, "tone": 4.0, "overall_acceptable": "YES", "reason": "ok"} '), ("b", "oops"), ("c", None)]
    got = {r.case_id: r for r in parsing.parse_judge_answers(spark.createDataFrame(rows, "case_id string, answer string")).collect()}
    assert (got["a"].relevance, got["a"].tone, got["a"].helpfulness, got["a"].reason) == (5.0, 4.0, None, "ok")
    assert got["b"].relevance is None and "oops" in got["b"].reason and got["c"].reason == "unparsed: "


def test_review_queue(spark):
    df = spark.createDataFrame([("C-1", "t", "x")], "case_id string, customer_text string, extra string")
    out = sinks.review_queue(df, ["case_id", "customer_text"], last=["extra"])
    assert out.columns == ["case_id", "customer_text", *sinks.REVIEW_COLUMNS, "extra"]


def test_stream_counts_over_two_files(spark, tmp_path):
    source = str(tmp_path / "in")
    for part in (["a", "a", "b"], ["a", "c"]):
        spark.createDataFrame([(x,) for x in part], "author_id string").coalesce(1).write.mode("append").parquet(source)
    arriving = streams.arriving_files(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
    for _ in range(2):  # the second start finds nothing new
        streams.start_counts(
            streams.running_counts(arriving, "author_id"), str(tmp_path / "out"), str(tmp_path / "state")
        ).awaitTermination()
    got = {r.author_id: r.messages for r in streams.latest_counts(spark, str(tmp_path / "out"), ["author_id"]).collect()}
    assert got == {"a": 3, "b": 1, "c": 1}


def toy(spark):
    rows = [(i, f"{'bill charge refund' if i % 2 else 'router modem light'} word{i % 5}", "pay" if i % 2 else "net") for i in range(60)]
    return spark.createDataFrame(rows, "id long, text string, label string")


def test_intent_model(spark):
    df = toy(spark)
    spec = TfidfSpec(profile="lower", max_df=0.95, max_features=1000)
    _, out = learning.train_intent_model(df.filter("id < 40"), df.filter("id >= 40"), "id", "text", "label", spec, 20)
    assert out.count() == 20 and out.filter("gold <> predicted").count() == 0


def test_clusters(spark):
    model, out, terms = learning.cluster_messages(toy(spark), "id", "text", k=2, restarts=2)
    groups = {frozenset(r.ids) for r in out.groupBy("cluster").agg(F.collect_list("id").alias("ids")).collect()}
    assert groups == {frozenset(range(0, 60, 2)), frozenset(range(1, 60, 2))}
    assert "bill" in terms
    near = learning.cluster_distance(out, model)
    assert near.agg(F.sum("distance")).first()[0] == pytest.approx(model.summary.trainingCost, rel=1e-6)


def test_scratch_tables_go_with_their_scope(spark):
    import os

    from deskloom.session import cut_lineage, scratch_scope

    outside = cut_lineage(spark.range(3))
    with scratch_scope(spark):
        inside = cut_lineage(spark.range(5))
        assert inside.count() == 5
        [path] = {os.path.dirname(f.removeprefix("file://")) for f in inside.inputFiles()}
        assert os.path.exists(path)
    assert not os.path.exists(path) and outside.count() == 3
