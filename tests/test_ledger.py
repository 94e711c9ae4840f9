"""Messages that fail on their own, and a batch that is taken again."""

from __future__ import annotations

import json
from collections import Counter

import pytest

from claimloom.streaming.ledger import dead_letters, drain_each, read_ledger, settle_batch

SCHEMA = "id bigint, body string"


def put(folder, ids):
    folder.mkdir(exist_ok=True)
    for i in ids:
        (folder / f"{i}.json").write_text(json.dumps({"id": i, "body": "poison" if i == 7 else f"m{i}"}))


def work_into(log):
    def work(message, attempt):
        with open(f"{log}/{message['id']}", "a") as f:
            f.write(f"{attempt}\n")
        if message["body"] == "poison":
            raise ValueError("cannot be read")
        return message["body"].upper()

    return work


def test_one_poison_message_among_twenty(spark, tmp_path):
    log, source, ledger, state = (str(tmp_path / n) for n in ("log", "in", "ledger", "state"))
    (tmp_path / "log").mkdir()
    put(tmp_path / "in", range(12))
    drain_each(spark, source, SCHEMA, work_into(log), ledger, state, max_files=6).awaitTermination()
    put(tmp_path / "in", range(12, 20))  # and a restart
    drain_each(spark, source, SCHEMA, work_into(log), ledger, state, max_files=6).awaitTermination()
    tried = {int(p.name): p.read_text().split() for p in (tmp_path / "log").iterdir()}
    assert tried == {i: ["1", "2", "3"] if i == 7 else ["1"] for i in range(20)}
    assert [(r.id, r.attempt, r.error) for r in dead_letters(spark, ledger, SCHEMA).collect()] == [(7, 3, "ValueError: cannot be read")]
    done = read_ledger(spark, ledger, SCHEMA).where("status = 'done'").collect()
    assert {r.id: r.result for r in done} == {i: f"M{i}" for i in range(20) if i != 7} and len(done) == 19


def test_goes_on_where_it_stopped(spark, tmp_path):
    """The driver dies behind the first attempt; the batch comes again."""
    log, entry = str(tmp_path / "log"), str(tmp_path / "ledger" / "batch=0")
    (tmp_path / "log").mkdir()
    messages = spark.createDataFrame([(i, "poison" if i == 7 else f"m{i}") for i in range(20)], SCHEMA)
    assert settle_batch(messages, work_into(log), entry, 3) == 3
    for part in (tmp_path / "ledger" / "batch=0" / "try=3").iterdir():
        part.unlink()
    assert settle_batch(messages, work_into(log), entry, 3) == 1
    tried = Counter({int(p.name): len(p.read_text().split()) for p in (tmp_path / "log").iterdir()})
    assert tried == Counter({i: 4 if i == 7 else 1 for i in range(20)})


@pytest.mark.parametrize("rows", [[], [(None, None), (1, "same"), (1, "same")]])
def test_empty_batches_nulls_and_equal_messages(spark, tmp_path, rows):
    def work(message, attempt):
        return None if message["id"] is None else str(message["id"])

    settle_batch(spark.createDataFrame(rows, SCHEMA), work, str(tmp_path / "batch=0"), 2)
    found = read_ledger(spark, str(tmp_path), SCHEMA).collect()
    assert sorted((r.id is not None, r.result, r.status) for r in found if r.id) == [(True, "1", "done")] * (2 if rows else 0)
    assert len(found) == len(rows)
