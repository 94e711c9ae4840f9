"""Loads that hang, and cells that do not convert."""

from __future__ import annotations

import threading
import time

from pyspark.sql import functions as F

from claimloom.functions.casts import cast_cells
from claimloom.operators.incremental import run_isolated


def test_hanging_loads_hold_up_no_others(spark):
    """One hangs in a Spark job, one outside of Spark; two places only."""
    never, ended = threading.Event(), []

    def slow_job():
        def crawl(batches):
            for batch in batches:
                time.sleep(600)
                yield batch

        try:
            return spark.range(2).mapInArrow(crawl, "id bigint").count()
        finally:
            ended.append("slow_job")

    def slow_outside():
        never.wait(600)
        return 0

    tasks = {"slow_job": slow_job, "slow_outside": slow_outside} | {f"t{k}": lambda k=k: spark.range(k + 1).count() for k in range(4)}
    tasks["bad"] = lambda: 1 // 0
    start = time.monotonic()
    rows = {r.source: r for r in run_isolated(spark, tasks, parallel=2, seconds=8).collect()}
    assert time.monotonic() - start < 60
    never.set()
    assert list(rows) == list(tasks)
    assert all(rows[f"t{k}"].ok and rows[f"t{k}"].rows == k + 1 for k in range(4))
    for name in ("slow_job", "slow_outside"):
        assert not rows[name].ok and rows[name].rows is None and rows[name].error.startswith("TimeoutError")
    assert rows["bad"].error.startswith("ZeroDivisionError")
    for _ in range(100):  # its job was cancelled, so its thread ends
        if ended:
            break
        time.sleep(0.2)
    assert ended == ["slow_job"]


def test_no_limit_and_no_tasks(spark):
    assert [r.rows for r in run_isolated(spark, {"a": lambda: 3}).collect()] == [3]
    assert run_isolated(spark, {}).collect() == []


def test_cells_that_do_not_convert(spark):
    df = spark.createDataFrame([(1, "5", "x", "a"), (2, "y", "2024-01-02", "b"), (None, None, None, "c"), (4, "z", "1/1", "d")], "id bigint, `a b` string, day string, keep string")
    rows, rejects, counts = cast_cells(df, {"a b": "int", "day": "date"}, ["id"], "s")
    assert rows.dtypes == [("id", "bigint"), ("a b", "int"), ("day", "date"), ("keep", "string")]
    assert {r.keep: (r["a b"], str(r.day)) for r in rows.collect()} == {"a": (5, "None"), "b": (None, "2024-01-02"), "c": (None, "None"), "d": (None, "None")}
    assert sorted(map(tuple, rejects.collect())) == [("s", 1, "day", "x"), ("s", 2, "a b", "y"), ("s", 4, "a b", "z"), ("s", 4, "day", "1/1")]
    assert counts == {"a b": 2, "day": 2}
    none = cast_cells(df.where(F.lit(False)), {"day": "date"}, ["id", "day"], "s")
    assert none[0].collect() == [] and none[2] == {"day": 0}
