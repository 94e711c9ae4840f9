"""Joint boosting against a plain booster over one-hot rows, prefixes against separate fits."""

from __future__ import annotations

import random

import numpy as np
import pytest

from claimloom.operators import boosting
from claimloom.operators.boosting import SCALE, BoostedModel, Setting, fit_settings, load_boosted, sampled_answers, search_boosted, train_boosted
from claimloom.operators.features import row_hash
from pyspark.sql import functions as F

COLUMNS = ["colour", "size of", "kind"]
SCHEMA = "id bigint, colour string, `size of` string, kind string, label string"


def rows(n, classes, seed=1):
    some = random.Random(seed)
    out = []
    for k in range(n):
        a, b, c = some.choice(["red", "blue", "green", None]), some.choice("smlx"), some.choice(["p", "q"])
        rule = (a == "red") + 2 * (b in "sm") + (c == "q" and a is None)
        out.append((k, a, b, c, f"c{(rule if some.random() < 0.8 else some.randrange(9)) % classes}"))
    return out


def one_hot(data):
    columns = [[r[k + 1] if r[k + 1] is not None else "NA" for r in data] for k in range(3)]
    return np.array([[v == a for v in column] for column in columns for a in sorted(set(column))], float).T


def plain(data, setting, only=None, hashes=None):
    """Margins of all rows, tree by tree and row by row; only the rows in ``only`` train."""
    x, labels = one_hot(data), sorted({r[-1] for r in data})
    y = np.array([labels.index(r[-1]) for r in data])
    train = np.array([True] * len(data) if only is None else only)
    parts = 1 if len(labels) == 2 else len(labels)
    margin = np.zeros((len(data), parts))
    for turn in range(setting.rounds):
        use = train & boosting.sampled(hashes, setting.rows, setting.seed, turn) if hashes is not None else train
        if parts == 1:
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y[:, None], p * (1 - p)
        else:
            p = np.exp(margin) / np.exp(margin).sum(1, keepdims=True)
            g, h = p - (y[:, None] == np.arange(parts)), 2 * p * (1 - p)
        g, h = (np.rint(v * SCALE) / SCALE for v in (g, h))
        add = np.zeros_like(margin)
        for k in range(parts):
            allowed = sampled_answers(setting, turn, k, x.shape[1])

            def node(inside, depth):
                own = inside & use
                best, top = None, 1e-6
                if depth < setting.depth:
                    for f in np.flatnonzero(allowed):
                        right, left = own & (x[:, f] == 1), own & (x[:, f] == 0)
                        if min(h[right, k].sum(), h[left, k].sum()) < 1:
                            continue
                        gain = sum(g[s, k].sum() ** 2 / (h[s, k].sum() + 1) for s in (left, right)) - g[own, k].sum() ** 2 / (h[own, k].sum() + 1)
                        if gain > top:
                            best, top = f, gain
                if best is None:
                    add[inside, k] = -setting.step * g[own, k].sum() / (h[own, k].sum() + 1)
                else:
                    node(inside & (x[:, best] == 0), depth + 1)
                    node(inside & (x[:, best] == 1), depth + 1)

            node(np.ones(len(data), bool), 0)
        margin = margin + add
    return margin


def hashed(df, seed=42):
    return np.array([r[0] for r in df.select(F.xxhash64(F.lit(seed), "id")).collect()], np.int64).view(np.uint64)


@pytest.mark.parametrize("classes", [2, 3, 5])
def test_equals_a_plain_booster(spark, classes):
    data = rows(300, classes)
    df = spark.createDataFrame(data, SCHEMA)
    for setting in (Setting(3, 0.3, 10), Setting(2, 0.1, 12, 0.7, 0.6, seed=7)):
        model = train_boosted(df.repartition(5), COLUMNS, "label", setting, ["id"])
        got = {r[0]: list(r[1]) for r in df.select("id", model.probabilities()).collect()}
        margin = plain(data, setting, hashes=hashed(df, setting.seed))
        want = boosting.probabilities(margin)
        assert max(abs(got[r[0]][k] - want[i][k]) for i, r in enumerate(data) for k in range(classes)) < 1e-6


def test_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame(rows(500, 3), SCHEMA)
    one, other = (train_boosted(df.repartition(n), COLUMNS, "label", Setting(rows=0.8, columns=0.8), ["id"]) for n in (1, 7))
    assert all((a.asks == b.asks).all() and (a.output == b.output).all() for x, y in zip(one.trees, other.trees, strict=True) for a, b in zip(x, y, strict=True))


def test_prefixes_equal_separate_fits(spark):
    data = rows(240, 3)
    df = spark.createDataFrame(data, SCHEMA)
    grid = {"maxDepth": [1, 3], "stepSize": [0.3], "maxIter": [4, 11], "subsamplingRate": [0.8], "featureSubsetStrategy": ["0.8", "all"]}
    results, best = search_boosted(df, COLUMNS, "label", ["id"], grid, at_once=5)
    assert len(results) == 2 * 2 * 2 * 3
    fold = np.array([r[0] for r in df.select(F.pmod(row_hash(["id"], 42), F.lit(3))).collect()])
    labels = sorted({r[-1] for r in data})
    y = np.array([labels.index(r[-1]) for r in data])
    accuracy = {}
    for point, k, n, ok in results:
        setting = Setting(point["maxDepth"], point["stepSize"], point["maxIter"], point["subsamplingRate"], 0.8 if point["featureSubsetStrategy"] == "0.8" else 1.0)
        guess = plain(data, setting, fold != k, hashed(df)).argmax(1)
        assert (n, ok) == ((fold == k).sum(), ((guess == y) & (fold == k)).sum())
        accuracy.setdefault(tuple(point.values()), []).append(ok / n)
    top = max(accuracy.values(), key=sum)
    assert sum(top) == max(map(sum, accuracy.values())) and len(best.trees) in (4, 11)


def test_model_store_and_unseen_answers(spark, tmp_path):
    df = spark.createDataFrame(rows(200, 3) + [(900, None, None, None, None), (901, "new", "s", "p", "c0")], SCHEMA)
    model = train_boosted(df.where("id < 901"), COLUMNS, "label", Setting(), ["id"])
    model.save(spark, str(tmp_path / "m"))
    again = load_boosted(spark, str(tmp_path / "m"))
    scored = sorted(map(tuple, model.score(df, ["id"]).collect()))
    assert scored == sorted(map(tuple, again.score(df, ["id"]).collect())) and len(scored) == 202
    assert all(r[2] in model.labels and 33 <= float(r[1]) <= 100 for r in scored)


def test_one_class_and_no_rows(spark):
    df = spark.createDataFrame([(1, "red", "s", "p", "x"), (2, "blue", "s", "p", "x")], SCHEMA)
    assert {r[2] for r in train_boosted(df, COLUMNS, "label").score(df, ["id"]).collect()} == {"x"}
    with pytest.raises(ValueError, match="no row"):
        fit_settings(df.limit(0), COLUMNS, "label", [Setting()])


def test_names():
    assert BoostedModel({"a": ["x"]}, ["l"], []).labels == ["l"]


def test_rows_of_few_answers_are_one_block(spark):
    """A pass of a level goes over distinct answers, not over rows."""
    data = spark.createDataFrame(rows(25_000, 2), SCHEMA).coalesce(1)
    fitted, blocks = fit_settings(data, COLUMNS, "label", [Setting(rounds=2, rows=0.8), Setting(rounds=2, left_out=1)], ["id"], F.pmod("id", F.lit(3)))
    sizes = [r.n for r in blocks.select("n").collect()]
    assert sizes == [32]
    kept = fitted.kept(blocks, 0, 0).collect()
    assert sum(int(np.frombuffer(r.counts, np.int32).reshape(-1, r.n, 2)[fitted.slots[(1, 1.0, 42), 0]].sum()) for r in kept) == sum(k % 3 != 1 for k in range(25_000))
