"""Upserts into bucketed tables: what they touch, and writers at the same time."""

from __future__ import annotations

import random
import threading
from collections import Counter
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimloom.operators import forecast
from claimloom.sources import manifest
from claimloom.sources.manifest import Manifest, commit, read_manifest, read_table, upsert_table, vacuum
from claimloom.sources.storage import create_file, read_file
from claimloom.streaming import flows

SCHEMA = "id bigint, part string, v string, at int"


def rows(spark, *some):
    return spark.createDataFrame(list(some), SCHEMA)


def bag(df):
    return Counter(tuple(r) for r in df.select("id", "part", "v", "at").collect())


def test_one_key_touches_one_bucket(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.range(2000).selectExpr("id", "'p' AS part", "'old' AS v", "1 AS at")
    assert upsert_table(path, first, ["id", "part"]) == 0
    before = read_manifest(spark, path)
    assert before.buckets == 64 and len(before.folders) == 64
    assert upsert_table(path, rows(spark, (7, "p", "new", 2)), ["id", "part"]) == 1
    after = read_manifest(spark, path)
    changed = [b for b in range(64) if before.folders[b] != after.folders[b]]
    assert len(changed) == 1
    found = read_table(spark, path)
    assert found.count() == 2000 and bag(found.where("v = 'new'")) == Counter([(7, "p", "new", 2)])
    assert read_table(spark, path, 0).where("v = 'new'").count() == 0
    assert vacuum(spark, path, keep=1) == [before.folders[changed[0]]]
    assert read_table(spark, path).count() == 2000


def test_null_keys_repeats_and_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert upsert_table(path, rows(spark), ["id", "part"], buckets=4) == 0
    assert read_table(spark, path).collect() == []
    upsert_table(path, rows(spark, (None, None, "a", 1), (1, "x", "b", 1), (1, "x", "c", 3), (1, "x", "d", 2)), ["id", "part"], ["at"])
    upsert_table(path, rows(spark, (None, None, "e", 1), (2, "x", None, None)).select("at", "v", "part", "id"), ["id", "part"], ["at"])
    assert upsert_table(path, rows(spark), ["id", "part"]) == 2
    assert bag(read_table(spark, path)) == Counter([(None, None, "e", 1), (1, "x", "c", 3), (2, "x", None, None)])
    with pytest.raises(ValueError, match="keys"):
        upsert_table(path, rows(spark), ["id"])
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "none"))


def test_file_is_made_once(spark, tmp_path):
    made = []
    threads = [threading.Thread(target=lambda k=k: made.append((k, create_file(spark, f"{tmp_path}/a/f", str(k))))) for k in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert [ok for _, ok in made].count(True) == 1
    assert read_file(spark, f"{tmp_path}/a/f") == next(str(k) for k, ok in made if ok)
    assert [p.name for p in (tmp_path / "a").iterdir()] == ["f"]


def test_writers_at_the_same_time(spark, tmp_path):
    """Each adds a row, and all replace one that they share; no update is lost."""
    path, failed = str(tmp_path / "t"), []
    upsert_table(path, rows(spark, (0, "shared", "start", 0)), ["id", "part"], buckets=8)

    def write(k):
        try:
            upsert_table(path, rows(spark, (k, "own", f"w{k}", k), (0, "shared", f"w{k}", k)), ["id", "part"])
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(1, 6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed
    found = read_table(spark, path).collect()
    assert sorted((r.id, r.v) for r in found if r.part == "own") == [(k, f"w{k}") for k in range(1, 6)]
    assert [r.part for r in found].count("shared") == 1
    assert read_manifest(spark, path).number == 5


def test_late_writer_keeps_files_that_are_still_right(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    upsert_table(path, spark.range(100).selectExpr("id", "'p' AS part", "'old' AS v", "1 AS at"), ["id", "part"], buckets=16)
    number, real, written = read_manifest(spark, path).number, manifest.commit, []
    late = rows(spark, (1, "p", "late", 2))
    mine = [r[0] for r in late.select(manifest.bucket_of(["id", "part"], 16)).collect()]
    others = next(k for k in range(2, 100) if [r[0] for r in rows(spark, (k, "p", "", 0)).select(manifest.bucket_of(["id", "part"], 16)).collect()] != mine)

    def slow(session, where, entry):
        if not written:  # another writer comes first
            written.append(entry.folders[mine[0]])
            monkeypatch.setattr(manifest, "commit", real)
            upsert_table(path, rows(spark, (others, "p", "first", 2)), ["id", "part"])
        return real(session, where, entry)

    monkeypatch.setattr(manifest, "commit", slow)
    assert upsert_table(path, late, ["id", "part"]) == number + 2
    assert read_manifest(spark, path).folders[mine[0]] == written[0]
    assert {r.v for r in read_table(spark, path).where(f"id IN (1, {others})").collect()} == {"late", "first"}
    assert not commit(spark, path, Manifest(0, "{}", (), 1, {}))


def test_state_of_weeks_stays_small(spark, tmp_path):
    """Twenty batches, one of them twice: files are bounded, and the sums are those of all rows at once."""
    state, some = str(tmp_path / "s"), random.Random(2)
    every: Counter = Counter()
    for batch in range(20):
        rows = [(some.choice(["a", "b", "c", None]), date(2024, 1, 7) + timedelta(weeks=some.randrange(30)), Decimal(some.randrange(1000)) / 100) for _ in range(40)]
        for region, day, y in rows:
            every[region, day] += y
        df = spark.createDataFrame(rows, "region string, day date, y decimal(18,2)").groupBy("region", "day").agg(F.sum("y").alias("y"))
        got = flows.fold_weeks(df, state, batch, buckets=4)
        if batch == 7:
            got = flows.fold_weeks(df, state, batch, buckets=4)
        regions = {r[0] for r in rows}
        if batch in (0, 7, 19):
            assert {(r.region, r.day): r.y for r in got.collect()} == {k: v for k, v in every.items() if k[0] in regions}
        files = [p for p in (tmp_path / "s").rglob("*.parquet")]
        assert len(files) <= 2 * 4 * 2 and len(list((tmp_path / "s" / "log").glob("*.json"))) <= 2
    assert read_table(spark, state).count() == len(every)


def test_forecast_from_the_state_equals_one_of_all_rows(spark, tmp_path):
    lines = [(r, date(2020, 1, 5) + timedelta(days=3 * k), Decimal(10 + k % 7 + (r == "b") * 5)) for k in range(250) for r in "ab"]
    schema = "region string, day date, y decimal(18,2)"
    want = forecast.forecast_regions(spark.createDataFrame(lines, schema), "2024-01-01")
    paths = [str(tmp_path / n) for n in ("in", "out", "state", "checkpoint")]
    for part in range(3):
        spark.createDataFrame(lines[part::3], schema).write.mode("append").partitionBy("region").parquet(paths[0])
        flows.retrain_stream(spark, paths[0], "day date, y decimal(18,2)", *paths[1:], "2024-01-01").awaitTermination()
    columns = ["Region", "forecast_date", "Amount"]
    got = {(r[0], r[1]): r[2] for r in spark.read.parquet(paths[1]).select(*columns).collect()}
    assert got == pytest.approx({(r[0], r[1]): r[2] for r in want.select(*columns).collect()})
