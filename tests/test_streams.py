import pytest
from pyspark.sql import functions as F

from deskloom.session import child_folders
from deskloom.streaming import streams
from deskloom.streaming.count_table import CountTable

SCHEMA = "message_id long, author string, at timestamp"


def drop(spark, folder, rows):
    """One more file for a stream."""
    spark.createDataFrame(rows, "message_id long, author string, seconds long").select(
        "message_id", "author", F.timestamp_seconds("seconds").alias("at")
    ).coalesce(1).write.mode("append").parquet(folder)


def arriving(spark, folder):
    return streams.arriving_files(spark, folder, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)


def test_counts_over_many_batches(spark, tmp_path):
    source, path, state = (str(tmp_path / x) for x in ("in", "counts", "state"))
    for i in range(7):
        drop(spark, source, [(10 * i + j, f"a{(i + j) % 4}", i) for j in range(5)] + [(99, None, i)])
    counts = streams.running_counts(arriving(spark, source), "author")
    streams.start_counts(counts, path, state, compact_every=3).awaitTermination()
    want = {r["author"]: r["n"] for r in spark.read.parquet(source).groupBy("author").agg(F.count("*").alias("n")).collect()}
    assert {r["author"]: r["messages"] for r in streams.latest_counts(spark, path, ["author"]).collect()} == want
    for key in want:  # one key reads one bucket
        assert [tuple(r) for r in streams.latest_counts(spark, path, ["author"], {"author": key}).collect()] == [(key, want[key])]
    # however many batches ran, two generations and fewer than 2 * compact_every batches are kept
    assert len(child_folders(spark, path)) <= 2 + 2 * 3
    drop(spark, source, [(500, "a0", 9)])
    streams.start_counts(streams.running_counts(arriving(spark, source), "author"), path, state, compact_every=3).awaitTermination()
    assert streams.latest_counts(spark, path, ["author"], {"author": "a0"}).first()["messages"] == want["a0"] + 1


def test_replayed_and_broken_batches_count_once(spark, tmp_path):
    path = str(tmp_path / "counts")
    table = CountTable(spark, path, ["k"], compact_every=2)
    with pytest.raises(ValueError):
        table.read()

    def batch(*rows):
        return spark.createDataFrame(rows, "k string, messages long")

    table.append(batch(("x", 1), ("y", 1)), 0)
    table.append(batch(("x", 1), ("y", 1)), 0)
    table.append(batch(("x", 5)), 1)  # compacts
    assert table.generation() == 1
    table.append(batch(("x", 5)), 1)  # a replay of what a generation holds
    table.append(batch(("z", 2)), 2)
    # a generation without its commit mark does not count
    spark.createDataFrame([("x", 77, 0)], "k string, messages long, bucket int").write.parquet(f"{path}/upto=9")
    (tmp_path / "counts" / "upto=9" / "_SUCCESS").unlink()
    assert sorted(map(tuple, table.read().collect())) == [("x", 5), ("y", 1), ("z", 2)]
    assert [n for n in child_folders(spark, path) if n.startswith("batch")] and table.generation() == 1


def test_a_stop_between_write_and_commit_leaves_each_message_once(spark, tmp_path):
    source, path, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for i in range(3):
        drop(spark, source, [(10 * i + j, "a", i) for j in range(4)])
    seen = []

    def make(batch):
        return batch.select("message_id", F.length("author").alias("n"))

    def stop_in_second(rows, batch_id):
        seen.append((batch_id, rows.count()))
        if batch_id == 1:
            raise RuntimeError("stopped after the write")

    with pytest.raises(Exception, match="stopped after the write"):
        streams.start_batches(arriving(spark, source), make, path, state, stop_in_second).awaitTermination()
    assert seen == [(0, 4), (1, 4)]
    streams.start_batches(arriving(spark, source), make, path, state, lambda rows, i: seen.append((i, rows.count()))).awaitTermination()
    assert seen == [(0, 4), (1, 4), (1, 4), (2, 4)]  # the second batch ran again and only once counts
    got = [r["message_id"] for r in spark.read.parquet(path).collect()]
    assert sorted(got) == sorted(10 * i + j for i in range(3) for j in range(4))


def test_a_stream_that_runs_on_drops_repeats(spark, tmp_path):
    source, path, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    drop(spark, source, [(1, "a", 10), (2, "b", 11), (1, "a", 10)])
    once = streams.without_repeats(arriving(spark, source), "message_id", "at", "1 hour")
    query = streams.start_batches(once, lambda b: b, path, state, trigger={"processingTime": "200 milliseconds"})
    try:
        query.processAllAvailable()
        drop(spark, source, [(2, "b", 12), (3, "c", 13)])  # delivered again
        query.processAllAvailable()
        assert query.isActive
        assert sorted(r["message_id"] for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    finally:
        query.stop()


def test_a_streamed_table_may_be_one_file_or_a_folder(spark, tmp_path):
    """The registered streams read a table that is a single file as well as one of many part files."""
    import __spark_entry__ as entry

    rows = [(i, i % 3) for i in range(12)]
    frame = spark.createDataFrame(rows, "event_id long, user_id long")
    frame.repartition(3).write.parquet(str(tmp_path / "many" / "events.parquet"))
    (tmp_path / "one").mkdir()
    frame.toPandas().to_parquet(tmp_path / "one" / "events.parquet")
    for folder in ("many", "one"):
        got = entry.queries()["stream_author_counts"](spark, str(tmp_path / folder)).collect()
        assert sorted((r["user_id"], r["messages"]) for r in got) == [(0, 4), (1, 4), (2, 4)]
