"""Laws that hold on the given tables and on skewed data, against brute force."""

from __future__ import annotations

import re
from datetime import date, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from claimloom.operators import documents, features, forecast, incremental, lookups, metrics, models, series
from claimloom.plans import triage, views
from claimloom.session import remove_work, shared_folder, work_path
from claimloom.sources import sinks, versions
from claimloom.sources.storage import exists
from claimloom.streaming import flows


def bag(df):
    return sorted(map(str, df.collect()))


def test_deltas_add_up(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    low, mid, high = "2024-01-05", "2024-01-11 07:00:00", "2024-01-25"
    parts = incremental.delta(events, "ts", low, mid).unionByName(incremental.delta(events, "ts", mid, high))
    assert bag(parts) == bag(incremental.delta(events, "ts", low, high))


def test_upsert_twice_is_once(spark, sf_dir):
    target = views.table(spark, sf_dir, "customer")
    updates = target.filter("c_nationkey < 5").withColumn("c_acctbal", F.lit(1.0))
    new = updates.limit(1).withColumn("c_custkey", F.lit(-1).cast("bigint"))
    updates = updates.unionByName(new)
    once = sinks.upsert(target, updates, ["c_custkey"])
    assert once.count() == target.count() + 1
    assert bag(sinks.upsert(once, updates, ["c_custkey"])) == bag(once)


def test_upsert_of_null_and_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a", 0), (None, "b", 0)], "k int, v string, at int")
    updates = spark.createDataFrame([(None, "c", 1), (None, "d", 2), (2, "e", 1), (2, "e", 1)], "k int, v string, at int")
    assert bag(sinks.upsert(target, updates, ["k"], ["at"]).select("k", "v")) == bag(spark.createDataFrame([(1, "a"), (None, "d"), (2, "e")], "k int, v string"))


def test_snapshot_twice_is_once(spark, sf_dir):
    path = work_path(spark, "snapshot")
    for _ in range(2):
        versions.snapshot_replace(views.table(spark, sf_dir, "nation"), path, "1")
    assert versions.read_current(spark, path).count() == 25


def test_sums_are_kept(spark, sf_dir):
    lines = views.payable_lines(spark, sf_dir, "1900-01-01")
    weeks = series.weekly_series(lines, ["country_code"], "payment_date", "invoice_fee")
    months = series.monthly_rollup(weeks, ["country_code"], "ds", "invoice_fee")
    totals = [df.agg(F.sum("invoice_fee")).first()[0] for df in (lines, weeks, months)]
    assert totals[0] == totals[1] == totals[2]
    gaps = weeks.groupBy("country_code").agg(
        F.count("ds").alias("n"), (F.datediff(F.max("ds"), F.min("ds")) / 7 + 1).cast("bigint").alias("expected")
    )
    assert gaps.filter("n <> expected").isEmpty()


def test_splits_ignore_partitions(spark, sf_dir):
    claims = views.claims(spark, sf_dir).select("claim_id", "labels")
    shuffled = claims.repartition(13, "labels")
    for split in (
        lambda df: features.hash_split(df, ["claim_id"], 0.3),
        lambda df: features.stratified_split(df, "labels", ["claim_id"]),
    ):
        assert bag(split(claims)) == bag(split(shuffled))
    share = features.hash_split(claims, ["claim_id"], 0.3).agg(F.avg(F.col("is_test").cast("int"))).first()[0]
    assert 0.25 < share < 0.35


def test_stratified_split_of_skewed_and_tiny_classes(spark):
    data = [(i, "big") for i in range(3000)] + [(i, "small") for i in range(3000, 3009)] + [(9000, None)]
    split = features.stratified_split(spark.createDataFrame(data, "id int, label string"), "label", ["id"])
    got = {r.label: (r.n, r.t) for r in split.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert got == {"big": (3000, 750), "small": (9, 2), None: (1, 0)}


def test_merged_parts_of_a_hot_base(spark, sf_dir):
    """One base holds most parts; the parts are the same for any number of partitions."""
    docs = views.documents(spark, sf_dir)
    ids = [("d0", None)] + [(f"d0_{n}", n) for n in range(20_000)] + [("d1", None), ("d1_7", 7), ("d1_3", 3), ("d9999_1", 1), ("d2", None)]
    rows = spark.createDataFrame(ids, "ID string, n int")
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema if f.name != "ID"]
    typed = rows.select("ID", *nulls, "n").select(*docs.columns, "n")
    found = []
    for tasks in ("2", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        headers, parts = documents.merge_parts(typed.repartition(int(tasks)), ["n"])
        found.append((bag(headers.select("documentId")), bag(parts.select("documentId", "n", "part.documentId"))))
        lists = documents.nested_parts(headers, parts, ["n"]).select("documentId", F.transform("splitDocumentList", lambda p: p["documentId"]).alias("l"))
        assert {r.documentId: r.l for r in lists.collect()} == {"d0": [f"d0_{n}" for n in range(20_000)], "d1": ["d1_3", "d1_7"]}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1] and len(found[0][0]) == 2 and len(found[0][1]) == 20_002


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.lists(st.integers(0, 6), max_size=5)), min_size=1, max_size=8))
def test_array_resolution(spark, arrays):
    known = {str(i): f"v{i}" for i in range(0, 7, 2)}
    rows = [(i, None if a is None else [str(x) for x in a]) for i, a in enumerate(arrays)]
    df = spark.createDataFrame(rows, "k int, ids array<string>")
    dim = spark.createDataFrame(list(known.items()), "id string, v string")
    full, misses = lookups.resolve_children(df, "k", "ids", dim, "id", F.struct("v"), "found")
    got = {r.k: [c.v for c in r.found] for r in full.collect()}
    assert got == {k: [known[x] for x in a or [] if x in known] for k, a in rows}
    assert sorted(tuple(r) for r in misses.collect()) == sorted((k, x) for k, a in rows for x in a or [] if x not in known)


def test_hot_key_updates(spark):
    """A third of all updates and targets share one key."""
    target = spark.createDataFrame([("hot", i, "old") for i in range(300)] + [(f"k{i}", i, "old") for i in range(600)], "id string, n int, v string")
    source = spark.createDataFrame([(["hot", f"k{i}"], i, f"new{i}") for i in range(300)], "ids array<string>, at int, v string")
    many = lookups.update_from(target, source, "id", "ids", {"v": "v"}, ["at"])
    assert many.filter("v = 'new299'").count() == 301 and many.filter("v = 'old'").count() == 300
    one = lookups.update_from(target, source, "id", "ids", {"v": "v"}, ["at"], first_only=["n"])
    assert {tuple(r) for r in one.filter("id = 'hot' and v <> 'old'").collect()} == {("hot", 0, "new299")}
    assert one.count() == 900


def test_first_of_twins(spark):
    """Rows that agree in the order are told apart by their other columns; of equal rows one is changed."""
    rows = [("a", "p", None, k, "old") for k in range(50)] + [("a", "q", "j", 0, "old")] + [("b", None, "j", 7, "old")] * 3 + [("c", "p", "j", 1, "old")]
    target = spark.createDataFrame(rows, "id string, path string, json string, n int, v string")
    updates = spark.createDataFrame([("a", "new"), ("b", None), ("d", "new")], "id string, v string")
    order = ["path", "json"]
    runs = [sorted(map(tuple, lookups.apply_updates(target.repartition(k), updates, "id", ["v"], order).collect()), key=repr) for k in (1, 5)]
    assert runs[0] == runs[1] and len(runs[0]) == len(rows)
    changed = [r for r in runs[0] if r[4] != "old"]
    assert [(r[0], r[1], r[4]) for r in changed] == [("a", "p", "new"), ("b", None, None)]
    first = lookups.first_per_key(target, ["id"], [*order, lookups.tie_break(target, ["id", *order])])
    assert first.filter("id = 'a'").first().n == changed[0][3]


def weekly(values, region="A"):
    start = date(2018, 1, 7)
    return [(region, start + timedelta(weeks=i), float(v)) for i, v in enumerate(values)]


def simulated(rng, size, noise, weeks=200, ahead=40, changes=25):
    """A trend that changes its slope now and then, also later, with season and noise."""
    days = 7.0 * np.arange(weeks + ahead)
    t = days / days[weeks - 1]
    count = rng.poisson(changes * t[-1])
    bends = np.maximum(t[:, None] - rng.uniform(0, t[-1], count), 0) * rng.laplace(0, size, count)
    return days, 5 + rng.normal() * t + bends.sum(1) + 0.3 * np.sin(2 * np.pi * days / 365.25) + rng.normal(0, noise, len(t))


@pytest.mark.parametrize("size, noise", [(0.1, 0.05), (0.1, 0.2), (0.3, 0.2), (0.6, 0.2)])
def test_forecast_band_covers_what_comes(size, noise):
    rng, inside = np.random.default_rng(4), []
    for _ in range(150):
        days, y = simulated(rng, size, noise)
        yhat, spread = forecast.fit_predict(days[:200], y[:200], days[200:])
        assert (np.diff(spread) > 0).all()
        inside.append(np.abs(y[200:] - yhat) <= forecast.BAND * spread)
    assert 0.75 <= np.mean(inside) <= 0.85


def test_forecast_changes_are_sparse():
    days = 7.0 * np.arange(150)
    knots = np.linspace(0, 0.8, 26)[1:]
    y = 3 + np.maximum(days / days[-1] - knots[12], 0) * 8 + np.random.default_rng(1).normal(0, 0.02, 150)
    beta, *_ = forecast.fit_trend(forecast._design(days, days[-1], knots, 0), y / y.max(), len(knots))
    sizes = np.abs(beta[2:])
    # a ridge would spread the change over all knots
    assert sizes.argmax() == 12 and sizes[12] > 0.7 * sizes.sum() and (sizes < 0.01 * sizes.max()).sum() > 12


def test_forecast_recovers_trend_and_season(spark):
    t = np.arange(200)
    truth = 100 + 0.5 * t + 20 * np.sin(2 * np.pi * t * 7 / 365.25)
    data = weekly(truth[:180]) + weekly([5.0], "short") + weekly(np.zeros(30), "zero")
    points = spark.createDataFrame(data, "region string, ds date, y double")
    horizon = spark.createDataFrame([("A", 20), ("short", 2), ("zero", 1), ("none", 3)], "region string, periods int")
    got = forecast.forecast(points, horizon)
    a = got.filter("region = 'A'").orderBy("ds").collect()
    error = np.abs(np.array([r.yhat for r in a]) - truth[180:]) / truth[180:]
    assert len(a) == 20 and a[0].ds == date(2018, 1, 7) + timedelta(weeks=180) and error.max() < 0.05
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in a)
    assert [r.yhat for r in got.filter("region = 'short'").collect()] == [5.0, 5.0]
    assert [r.yhat for r in got.filter("region = 'zero'").collect()] == [0.0]
    assert bag(got) == bag(forecast.forecast(points.repartition(7), horizon))


def test_regression_metrics_match_the_evaluator(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(float(a), float(a + b)) for a, b in rng.normal(size=(200, 2))], "y double, p double")
    ours = metrics.regression_metrics(df, "y", "p").first()
    for name in ("mae", "mse", "rmse", "r2"):
        theirs = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(df)
        assert ours[name] == pytest.approx(theirs)


def test_triage_model(spark, sf_dir):
    claims = views.claims(spark, sf_dir)
    model = models.train_multiclass(claims, triage.TEXT_COLUMNS, "labels")
    scored = models.score(claims, model, ["claim_id", "labels"])
    assert scored.select("recommendedServiceCode").distinct().count() == 5
    assert metrics.accuracy(scored, "labels", "recommendedServiceCode").first().accuracy > 0.85
    again = models.score(claims, models.train_multiclass(claims, triage.TEXT_COLUMNS, "labels"), ["claim_id", "labels"])
    assert bag(scored) == bag(again)
    path = work_path(spark, "model")
    models.save_model(model, path)
    assert bag(models.score(claims, models.load_model(path), ["claim_id", "labels"])) == bag(scored)
    unseen = claims.limit(3).withColumns({c: F.lit("never seen") for c in triage.TEXT_COLUMNS}).drop("labels")
    vectors = model.transform(unseen).select("features").collect()
    assert all(v.features.numNonzeros() == 0 for v in vectors)


def test_full_grid_size():
    trees = models.GBTClassifier()
    assert len(models.param_maps(trees, models.FULL_GRID)) == 540


def test_stream_restart(spark, tmp_path):
    """New files after a restart are added once; files that were acknowledged are not read again."""
    source, out, bad, state = (str(tmp_path / n) for n in ("in", "out", "bad", "state"))
    schema = "id bigint, v string"
    spark.range(5).selectExpr("id", "'a' as v").write.json(source)
    flows.log_stream(spark, source, schema, out, bad, state).awaitTermination()
    spark.range(5, 8).selectExpr("struct(id, 'b' as v) as body").write.mode("append").json(source)
    for _ in range(2):
        flows.log_stream(spark, source, schema, out, bad, state).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 8 and got.filter("v = 'b'").count() == 3


def test_logged_events_are_not_lost(spark):
    """Bodies as object and as text are read; malformed lines, lists and wrong types become rejects."""
    good = ['{"id": 1, "v": "a"}', '{"body": {"id": 1, "v": "a"}}', r'{"body": "{\"id\": 1, \"v\": \"a\"}"}']
    bad = ["{", "", "[]", '{"body": [{"id": 1}]}', '{"body": "text"}', '{"id": "x"}', r'{"body": "{\"id\": \"x\"}"}']
    got = flows.parse_events(spark.createDataFrame([(t,) for t in good + bad], "value string"), "id bigint, v string").collect()
    assert {r.raw: r.event and tuple(r.event) for r in got} == dict.fromkeys(good, (1, "a")) | dict.fromkeys(bad)


def test_delta_stream_equals_batch(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "k bigint, at bigint, v string"
    tables = [spark.range(40).selectExpr("id % 3 as k", f"id * {m} as at", f"concat('{m}-', id) as v") for m in (3, 1, 2)]
    expected = tables[0]
    for i, df in enumerate(tables):
        expected = df if i == 0 else expected.unionByName(df)
        df.write.mode("append").parquet(source)
        arrivals = spark.readStream.schema(schema).parquet(source)
        flows.delta_stream(arrivals, ["k"], "at", out, state, tie=["v"]).awaitTermination()
        if i == 1:
            flows.compact(spark, out, schema, ["k"], "at", ["v"])
            assert len([p for p in (tmp_path / "out" / "batches").iterdir() if p.is_dir()]) == 1
        batch = incremental.latest_per_key(expected, ["k"], "at", ["v"])
        assert bag(flows.merged(spark, out, schema, ["k"], "at", ["v"]).select("k", "at", "v")) == bag(batch.select("k", "at", "v"))


def test_retrain_stream_refreshes_arriving_regions_only(spark, tmp_path):
    source, out, sums, state = (str(tmp_path / n) for n in ("in", "out", "sums", "state"))
    schema = "day date, y double"

    def arrive(region, factor):
        rows = [(d, float(v) * factor) for _, d, v in weekly(range(1, 120))]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{source}/region={region}")

    def run(load_date):
        flows.retrain_stream(spark, source, schema, out, sums, state, load_date).awaitTermination()

    arrive("A", 1), arrive("B", 10)
    run("2020-06-01")
    arrive("A", 1)
    run("2020-07-01")
    got = spark.read.parquet(out)
    dates = {(r.Region, str(r.Load_date)) for r in got.select("Region", "Load_date").distinct().collect()}
    assert dates == {("A", "2020-06-01"), ("A", "2020-07-01"), ("B", "2020-06-01")}
    stored = spark.read.schema(f"{schema}, region string").parquet(source)
    batch = forecast.forecast_regions(stored.filter("region = 'A'"), "2020-07-01")
    columns = ["forecast_date", "Region", "Load_date", F.round("Amount", 6)]
    newest = got.filter("Region = 'A' AND Load_date = '2020-07-01'")
    assert bag(newest.select(*columns)) == bag(batch.select(*columns))


def test_batches_reach_the_second_zone(spark, sf_dir):
    out, second, marks = (work_path(spark, n) for n in ("raw", "second", "marks"))
    specs = [incremental.TableSpec("events", "delta", "event_id", "ts", also_to=(second,))]
    for high in ("2024-01-10 00:00:00", "2024-01-20 00:00:00"):
        incremental.load_source(spark, "s", specs, lambda s: views.table(spark, sf_dir, s.name), out, marks, high)
    expected = views.table(spark, sf_dir, "events").filter("ts <= '2024-01-20 00:00:00'").count()
    for zone in (f"{out}/events", second):
        stored = spark.read.parquet(zone)
        assert stored.count() == stored.select("event_id").distinct().count() == expected
    assert incremental.read_mark(spark, marks, "s", "none") == "2024-01-20 00:00:00"


def test_failed_load_keeps_the_mark(spark, sf_dir):
    marks, out = work_path(spark, "marks"), work_path(spark, "raw")
    specs = [incremental.TableSpec("events", "delta", "event_id", "ts"), incremental.TableSpec("missing")]
    status = incremental.load_source(
        spark, "s", specs, lambda s: views.table(spark, sf_dir, s.name), out, marks, "2024-01-10 00:00:00"
    )
    assert {(r.source, r.ok) for r in status.collect()} == {("events", True), ("missing", False)}
    assert incremental.read_mark(spark, marks, "s", "none") == "none"


def test_work_folders_are_removed(spark):
    path = work_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert remove_work(spark) >= 1 and not exists(spark, path) and remove_work(spark) == 0


def test_shared_folder_follows_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert shared_folder(spark) == folder.rstrip("/")


def test_one_hot_long_numbers_by_ranges(spark):
    """Answers of two open-ended columns are numbered in order, and not one column in one task."""
    coalesce, least = "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions"
    before = {k: spark.conf.get(k) for k in (coalesce, least)}
    try:
        spark.conf.set(coalesce, "false")
        spark.conf.set(least, "7")
        wide = spark.range(3000).selectExpr("id", "concat('a', id) as v", "concat('b', id % 1000) as w")
        long = features.one_hot_long(wide, ["w", "v"], ["id"])
        got = {(r.feature, r.position) for r in long.collect()}
        plan = long._jdf.queryExecution().analyzed().toString()
    finally:
        for k, value in before.items():
            spark.conf.set(k, value)
    names = [f"w_{x}" for x in sorted(f"b{k}" for k in range(1000))] + [f"v_{x}" for x in sorted(f"a{k}" for k in range(3000))]
    assert got == {(name, k) for k, name in enumerate(names)}
    specs = re.findall(r"row_number\(\) windowspecdefinition\((.*?)\)", plan)
    assert specs and all("_range" in spec for spec in specs)
