import csv
import random

import pytest

from deskloom.operators import threads
from deskloom.sources.tables import MESSAGE_SCHEMA, read_messages
from deskloom.streaming import ingest
from deskloom.streaming.ingest import MessageTable, arriving_messages, start_ingest


def deliver(folder, name, rows):
    folder.mkdir(exist_ok=True)
    with open(folder / name, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, quoting=csv.QUOTE_MINIMAL)
        out.writerow([c.name for c in MESSAGE_SCHEMA])
        out.writerows(rows)


def thread_rows(rng, n):
    rows = []
    for i in range(n):
        parent = rng.choice([None, rng.randrange(n), rng.randrange(n), 10_000 + i])
        author = "Brand" if rng.random() < 0.5 else f"c{rng.randrange(4)}"
        text = None if rng.random() < 0.05 else f'text "{i}",\nsecond line'
        rows.append((i, author, author != "Brand", "Fri Nov 24 10:00:00 +0000 2017", text, None, parent if parent is None else f"{parent}.0"))
    rng.shuffle(rows)
    return rows


def plain(spark, folder):
    found = threads.pair_replies(read_messages(spark, str(folder)), "Brand")
    return sorted(map(tuple, found.select("reply_id", "message_id", "customer_id", "customer_text", "support_reply").collect()))


def test_late_parents_are_paired_as_in_one_batch(spark, tmp_path):
    rng = random.Random(6)
    rows, source = thread_rows(rng, 80), tmp_path / "in"
    path, state = str(tmp_path / "table"), str(tmp_path / "state")
    table = MessageTable(spark, path, "Brand")
    assert table.pairs().count() == 0 and table.messages() is None
    for i in range(0, 60, 20):
        deliver(source, f"{i}.csv", rows[i : i + 20])
    start_ingest(arriving_messages(spark, str(source), 1), path, state, "Brand").awaitTermination()
    assert sorted(map(tuple, table.pairs().collect())) == plain(spark, source)
    deliver(source, "rest.csv", rows[60:])
    start_ingest(arriving_messages(spark, str(source), 1), path, state, "Brand").awaitTermination()
    got = plain(spark, source)
    assert sorted(map(tuple, table.pairs().collect())) == got and len(got) > 5
    assert table.messages().count() == 80
    # what still waits has a parent that never came
    assert {int(r["parent_id"]) >= 10_000 for r in table.waiting().collect()} == {True}


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path, monkeypatch):
    rng = random.Random(7)
    rows, source = thread_rows(rng, 30), tmp_path / "in"
    path, state = str(tmp_path / "table"), str(tmp_path / "state")
    for i in range(0, 30, 10):
        deliver(source, f"{i}.csv", rows[i : i + 10])
    whole = MessageTable.add

    def stop(self, batch, batch_id):
        whole(self, batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("stopped before the commit")

    monkeypatch.setattr(ingest.MessageTable, "add", stop)
    with pytest.raises(Exception, match="stopped before the commit"):
        start_ingest(arriving_messages(spark, str(source), 1), path, state, "Brand").awaitTermination()
    monkeypatch.setattr(ingest.MessageTable, "add", whole)
    start_ingest(arriving_messages(spark, str(source), 1), path, state, "Brand").awaitTermination()
    table = MessageTable(spark, path, "Brand")
    assert sorted(map(tuple, table.pairs().collect())) == plain(spark, source) and table.messages().count() == 30
