"""Gradient boosting over answers, fitted jointly for all classes and for many settings at once.

The method is second-order boosting (Chen & Guestrin, "XGBoost", 2016) with softmax gradients: every round adds
a tree per class, or one tree for two classes. A split asks whether a column has one of its answers, as a
one-hot column does. All trees of a round, of all classes, settings and folds, grow together: one aggregate
per level sums gradients and hessians by (setting, class, node, answer). The sums are of whole numbers, so a
model does not depend on partitions or their order. What comes to the driver, and what goes to the tasks, is
the size of the models and does not grow with the rows.

Rows are packed into blocks of coded answers, as many rows as have ``BLOCK`` distinct answers or ``ROWS``;
before every ``KEEP`` rounds one pass over the rows stores the margins of all settings and how many sampled
rows each of these rounds has by distinct answers and label. The levels go over distinct answers only, and
a lost executor costs a few trees.
Rows are sampled per round by a hash of their keys, columns (of the one-hot table) per tree by a seed.

Trees of fewer rounds are a prefix of more: a setting is fitted once with the most rounds, and its accuracy
after each asked number of rounds comes from one pass over running sums of the trees' outputs.

Null answers are the answer ``NA``; answers that the training did not have match no split. Rows without a
label do not train. With no row at all there is no model: ValueError.
"""

from __future__ import annotations

import json
import random
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from claimloom.functions.text import confidence
from claimloom.operators.features import MISSING, learn_vocabulary, row_hash
from claimloom.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 1 << 24  # gradients are summed as whole numbers of this part
KEEP = 8
BLOCK, ROWS = 1 << 14, 1 << 20
LEAF_PENALTY, LEAST_HESSIAN, LEAST_GAIN = 1.0, 1.0, 1e-6


@dataclass(frozen=True)
class Setting:
    """How one ensemble is grown; rows of fold ``left_out`` (none by default) do not train it."""

    depth: int = 3
    step: float = 0.3
    rounds: int = 10
    rows: float = 1.0
    columns: float = 1.0
    left_out: int = -1
    seed: int = 42


@dataclass(frozen=True)
class Tree:
    """A binary tree in heap order: the answer that each node asks for (-1: none), and the leaves' outputs."""

    asks: np.ndarray
    output: np.ndarray

    def leaves(self, answers: np.ndarray, column_of: np.ndarray) -> np.ndarray:
        """The node where each row of coded answers ends."""
        node, rows = np.zeros(len(answers), np.int64), np.arange(len(answers))
        for _ in range(int(len(self.asks) + 1).bit_length() - 2):
            asked = self.asks[node]
            hit = answers[rows, column_of[asked]] == asked
            node = np.where(asked < 0, node, 2 * node + 1 + hit)
        return node


def codes_of(columns: Sequence[pa.Array], answers: Mapping[str, Sequence[str]]) -> np.ndarray:
    """Answers numbered through all columns; -2 for unknown ones."""
    out, first = np.empty((len(columns[0]), len(columns)), np.int32), 0
    for k, (column, known) in enumerate(zip(columns, answers.values(), strict=True)):
        place = pc.fill_null(pc.index_in(pc.fill_null(column, MISSING), pa.array(known, pa.string())), -1)
        place = place.to_numpy(zero_copy_only=False)
        out[:, k] = np.where(place < 0, -2, place + first)
        first += len(known)
    return out


def columns_of(answers: Mapping[str, Sequence[str]]) -> np.ndarray:
    """The column of each numbered answer."""
    return np.repeat(np.arange(len(answers)), [len(a) for a in answers.values()])


def probabilities(margins: np.ndarray) -> np.ndarray:
    """Of all classes; one margin stands for the second of two classes."""
    if margins.shape[1] == 1:
        second = 1 / (1 + np.exp(-margins))
        return np.hstack([1 - second, second])
    odds = np.exp(margins - margins.max(1, keepdims=True))
    return odds / odds.sum(1, keepdims=True)


def gradients(margins: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the derivatives of the log loss, in whole parts, for rows that are counted by label."""
    p = probabilities(margins)
    h = 2 * p * (1 - p)
    if margins.shape[1] == 1:
        p, h = p[:, 1:], h[:, 1:] / 2
        every, own = counts.sum(1, keepdims=True), counts[:, 1:].sum(1, keepdims=True)
    else:
        every, own = counts.sum(1, keepdims=True), counts
    other, same = np.rint(p * SCALE).astype(np.int64), np.rint((p - 1) * SCALE).astype(np.int64)
    return (every - own) * other + own * same, every * np.rint(np.maximum(h, 1e-16) * SCALE).astype(np.int64)


def sampled(hashes: np.ndarray, share: float, seed: int, turn: int) -> np.ndarray:
    """Whether a row is in the sample of a round."""
    if share >= 1:
        return np.ones(len(hashes), bool)
    x = hashes ^ np.uint64((seed * 0x9E3779B97F4A7C15 + turn * 0xC2B2AE3D27D4EB4F) % (1 << 64))
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(11)).astype(np.float64) / (1 << 53) < share


def sampled_answers(setting: Setting, turn: int, part: int, n: int) -> np.ndarray:
    """Which answers a tree may ask for."""
    allowed = np.zeros(n, bool)
    count = n if setting.columns >= 1 else max(1, int(n * setting.columns))
    allowed[random.Random(f"{setting.seed}:{turn}:{part}").sample(range(n), count)] = True
    return allowed


BLOCKS = "n int, answers binary, place binary, label binary, hash binary, fold binary, margins binary, counts binary"


def pack_rows(df: DataFrame, answers: Mapping[str, Sequence[str]], labels: Sequence[str], label: str, keys: Sequence[str], fold: Column | None, seed: int) -> DataFrame:
    """The training rows as stored blocks: the distinct answers of a block's rows, which of these a row has,
    its label, hash and fold. A tree goes over the distinct answers only."""
    names = list(answers)
    row = F.xxhash64(F.lit(seed), *[F.col(f"`{k}`") for k in keys or [*names, label]])
    kept = df.where(F.col(f"`{label}`").isNotNull()).select(*[F.col(f"`{c}`").cast("string") for c in names], F.col(f"`{label}`").cast("string"), row, (F.lit(0) if fold is None else fold).cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded, cells = np.empty((0, len(names)), np.int32), []
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                own, at = np.unique(codes_of([batch.column(k) for k in range(len(names))], answers), axis=0, return_inverse=True)
                both, place = np.unique(np.vstack([coded, own]), axis=0, return_inverse=True)
                place = place.ravel().astype(np.int32)
                if cells and (len(both) > BLOCK or sum(len(c[0]) for c in cells) + batch.num_rows > ROWS):
                    yield packed(coded, cells)
                    coded, cells = own, []
                    place = np.arange(len(own), dtype=np.int32)
                else:  # the answers so far have new numbers
                    for c in cells:
                        c[0] = place[: len(coded)][c[0]]
                    place, coded = place[len(coded) :], both
                label = pc.index_in(batch.column(len(names)), pa.array(labels, pa.string())).to_numpy(zero_copy_only=False)
                rest = [batch.column(len(names) + k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (1, 2)]
                cells.append([place[at.ravel()], label.astype(np.int32), *rest])
        if cells:
            yield packed(coded, cells)

    def packed(coded: np.ndarray, cells: list[list[np.ndarray]]) -> pa.RecordBatch:
        columns = [coded.astype(np.int32), *(np.concatenate(c) for c in zip(*cells, strict=True))]
        row = dict(zip(("answers", "place", "label", "hash", "fold"), (c.tobytes() for c in columns), strict=True))
        return pa.RecordBatch.from_pydict({"n": pa.array([len(coded)], pa.int32())} | {k: pa.array([c], pa.binary()) for k, c in row.items()} | {k: pa.array([b""], pa.binary()) for k in ("margins", "counts")})

    return stored(kept.mapInArrow(run, BLOCKS), "boost-rows")


class Block:
    """The rows of a block, and the margins of all settings: the stored ones and the pending rounds' outputs."""

    def __init__(self, block: dict, pending: Sequence[Sequence[Sequence[Tree]]], classes: int, column_of: np.ndarray) -> None:
        n, self.classes = block["n"], classes
        self.answers = np.frombuffer(block["answers"], np.int32).reshape(n, -1)
        # the levels read no rows
        self.place, self.label, self.hashes, self.fold = (np.frombuffer(block.get(k, b""), kind) for k, kind in (("place", np.int32), ("label", np.int32), ("hash", np.uint64), ("fold", np.int64)))
        self.drawn = np.frombuffer(block["counts"], np.int32).reshape(-1, n, classes).astype(np.int64)
        shape = (len(pending), n, 1 if classes <= 2 else classes)
        self.margins = np.frombuffer(block["margins"], np.float64).reshape(shape).copy() if block["margins"] else np.zeros(shape)
        for s, rounds in enumerate(pending):
            for trees in rounds:
                for k, tree in enumerate(trees):
                    self.margins[s, :, k] += tree.output[tree.leaves(self.answers, column_of)]

    def counts(self, rows: np.ndarray) -> np.ndarray:
        """How many of some rows have each of the distinct answers and each label."""
        cells = self.place[rows].astype(np.int64) * self.classes + self.label[rows]
        return np.bincount(cells, minlength=len(self.answers) * self.classes).reshape(-1, self.classes)


class Boosting:
    """The common facts of a training, which travel to its tasks."""

    def __init__(self, answers: Mapping[str, Sequence[str]], labels: Sequence[str], settings: Sequence[Setting]) -> None:
        self.answers, self.labels, self.settings = answers, list(labels), list(settings)
        self.column_of = columns_of(answers)
        self.parts = 1 if len(labels) <= 2 else len(labels)  # trees of a round
        self.trees: list[list[list[Tree]]] = [[] for _ in settings]  # by setting, round, part
        draws = sorted({(x.left_out, x.rows, x.seed) for x in settings})
        # what is counted before every KEEP rounds: the draws, and again for each round if they sample rows
        self.slots = {slot: k for k, slot in enumerate((d, t) for d in draws for t in (range(KEEP) if d[1] < 1 else (0,)))}

    def histogram(self, blocks: DataFrame, since: int, turn: int, level: int, grown: dict[tuple[int, int], Tree]) -> tuple[np.ndarray, np.ndarray]:
        """Sums of gradients and hessians by (tree, node of the level, answer); the last answer is the node's total."""
        width, nodes, index = len(self.column_of) + 2, 1 << level, {t: k for k, t in enumerate(grown)}
        shape = (len(index), nodes, width)
        wanted = sorted({s for s, _ in grown})
        # a task is sent what it needs, not all trees
        settings, parts, classes, column_of, pending = self.settings, self.parts, len(self.labels), self.column_of, [rounds[since:turn] for rounds in self.trees]
        draws = [(x.left_out, x.rows, x.seed) for x in settings]
        slots = [self.slots[d, turn - since if d[1] < 1 else 0] for d in draws]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((2, int(np.prod(shape))), np.int64)
            for batch in batches:
                for block in (Block(row, pending, classes, column_of) for row in batch.to_pylist()):
                    cells = np.where(block.answers < 0, width - 2, block.answers)
                    cells = np.hstack([cells, np.full((len(cells), 1), width - 1)])
                    for s in wanted:
                        both = gradients(block.margins[s], block.drawn[slots[s]])
                        for k in range(parts):
                            if (s, k) not in index:
                                continue
                            at = grown[s, k].leaves(block.answers, column_of) - (nodes - 1)
                            here = np.flatnonzero(at >= 0)
                            place = ((index[s, k] * nodes + at[here, None]) * width + cells[here]).ravel()
                            for side, values in enumerate(both):
                                np.add.at(sums[side], place, np.repeat(values[here, k], cells.shape[1]))
            some = np.flatnonzero(sums.any(0))
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(sums[0, some]), pa.array(sums[1, some])], names=["cell", "g", "h"])

        sums = blocks.select("n", "answers", "margins", "counts").mapInArrow(run, "cell bigint, g bigint, h bigint")
        found = sums.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
        out = np.zeros((2, int(np.prod(shape))))
        for side, name in enumerate("gh"):
            out[side, found["cell"].to_numpy()] = found[name].to_numpy() / SCALE
        return out[0].reshape(shape), out[1].reshape(shape)

    def grow(self, blocks: DataFrame, since: int, turn: int) -> None:
        """Add the trees of a round."""
        trees = {(s, k): Tree(np.full((2 << setting.depth) - 1, -1), np.zeros((2 << setting.depth) - 1)) for s, setting in enumerate(self.settings) if turn < setting.rounds for k in range(self.parts)}
        allowed = {t: sampled_answers(self.settings[t[0]], turn, t[1], len(self.column_of)) for t in trees}
        growing = trees
        for level in range(max(s.depth for s in self.settings)):
            growing = {t: tree for t, tree in growing.items() if level < self.settings[t[0]].depth and (not level or (tree.asks[(1 << level - 1) - 1 : (1 << level) - 1] >= 0).any())}
            if not growing:
                break
            for (t, tree), g, h in zip(growing.items(), *self.histogram(blocks, since, turn, level, growing), strict=True):
                split_nodes(tree, g, h, level, allowed[t], self.settings[t[0]].step)
        for s, setting in enumerate(self.settings):
            if turn < setting.rounds:
                self.trees[s].append([trees[s, k] for k in range(self.parts)])

    def fit(self, blocks: DataFrame) -> DataFrame:
        """Grow all trees; returns the blocks."""
        since, now = 0, self.kept(blocks, 0, 0)
        rounds = max(s.rounds for s in self.settings)
        for turn in range(rounds):
            self.grow(now, since, turn)
            if turn + 1 - since == KEEP and turn + 1 < rounds:
                now, since = self.kept(now, since, turn + 1), turn + 1
        return blocks

    def kept(self, blocks: DataFrame, since: int, until: int) -> DataFrame:
        """The blocks with the margins after some rounds and the counts of the next ones."""
        classes, column_of, pending, slots = len(self.labels), self.column_of, [rounds[since:until] for rounds in self.trees], list(self.slots)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k, row in enumerate(batch.to_pylist()):
                    block = Block(row, pending, classes, column_of)
                    drawn, counts = {}, np.empty((len(slots), row["n"], classes), np.int32)
                    for place, ((left_out, share, seed), t) in enumerate(slots):
                        if (share, seed, t) not in drawn:
                            drawn[share, seed, t] = sampled(block.hashes, share, seed, until + t)
                        counts[place] = block.counts(drawn[share, seed, t] & (block.fold != left_out))
                    cells = [pa.array([c.tobytes()], pa.binary()) for c in (block.margins, counts)]
                    yield pa.RecordBatch.from_arrays([*batch.slice(k, 1).columns[:-2], *cells], names=batch.schema.names)

        return stored(blocks.mapInArrow(run, BLOCKS), "boost-margins")

    def right_answers(self, blocks: DataFrame, rounds: Sequence[int]) -> dict[tuple[int, int], tuple[int, int]]:
        """(setting, rounds) -> rows of the fold that was left out, and how many of them are right."""
        asked = sorted(set(rounds))
        settings, classes, column_of, ensembles = self.settings, len(self.labels), self.column_of, self.trees

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = np.zeros((len(settings), len(asked), 2), np.int64)
            for batch in batches:
                for row in batch.to_pylist():
                    block = Block(row | {"margins": b""}, [[]] * len(settings), classes, column_of)
                    counts = {fold: block.counts(block.fold == fold) for fold in {x.left_out for x in settings}}
                    for s, setting in enumerate(settings):
                        margin, count = block.margins[s], counts[setting.left_out]
                        for turn, trees in enumerate(ensembles[s], 1):
                            for k, tree in enumerate(trees):
                                margin[:, k] += tree.output[tree.leaves(block.answers, column_of)]
                            if turn in asked:
                                best = probabilities(margin).argmax(1)
                                seen[s, asked.index(turn)] += count.sum(), count[np.arange(len(best)), best].sum()
            s, k = (x.ravel() for x in np.indices(seen.shape[:2]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (s, k, *seen.reshape(-1, 2).T)], names=["s", "k", "n", "ok"])

        found = blocks.mapInArrow(run, "s bigint, k bigint, n bigint, ok bigint").groupBy("s", "k").agg(F.sum("n").alias("n"), F.sum("ok").alias("ok"))
        return {(r.s, asked[r.k]): (r.n, r.ok) for r in found.collect() if asked[r.k] <= self.settings[r.s].rounds}


def split_nodes(tree: Tree, g: np.ndarray, h: np.ndarray, level: int, allowed: np.ndarray, step: float) -> None:
    """Split the nodes of a level where that gains most; sets the outputs of the children."""
    first = (1 << level) - 1
    all_g, all_h = g[:, -1:], h[:, -1:]
    hit_g, hit_h = g[:, :-2], h[:, :-2]

    def worth(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * a / (b + LEAF_PENALTY)

    gain = worth(hit_g, hit_h) + worth(all_g - hit_g, all_h - hit_h) - worth(all_g, all_h)
    gain[(hit_h < LEAST_HESSIAN) | (all_h - hit_h < LEAST_HESSIAN) | ~allowed] = 0
    for node, best in enumerate(gain.argmax(1).tolist()):
        here = first + node
        if not level:
            tree.output[here] = -step * all_g[node, 0] / (all_h[node, 0] + LEAF_PENALTY)
        if gain[node, best] > LEAST_GAIN:
            tree.asks[here] = best
            for child, a, b in ((1, all_g[node, 0] - hit_g[node, best], all_h[node, 0] - hit_h[node, best]), (2, hit_g[node, best], hit_h[node, best])):
                tree.output[2 * here + child] = -step * a / (b + LEAF_PENALTY)


@dataclass(frozen=True)
class BoostedModel:
    """A fitted ensemble with its answers and the names of its classes."""

    answers: dict[str, list[str]]
    labels: list[str]
    trees: list[list[Tree]]

    def probabilities(self) -> Column:
        """An array of the probabilities of all classes, in the order of ``labels``."""
        answers, trees, column_of = self.answers, self.trees, columns_of(self.answers)

        def run(*columns: pd.Series) -> pd.Series:
            coded = codes_of([pa.array(c, pa.string(), from_pandas=True) for c in columns], answers)
            margins = np.zeros((len(coded), len(trees[0])))
            for parts in trees:
                for k, tree in enumerate(parts):
                    margins[:, k] += tree.output[tree.leaves(coded, column_of)]
            return pd.Series(list(probabilities(margins)))

        return pandas_udf(run, "array<double>")(*[F.col(f"`{c}`").cast("string") for c in answers])

    def score(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """Class and confidence text of every record."""
        scored = df.withColumn("_probabilities", self.probabilities())
        best = F.array_position("_probabilities", F.array_max("_probabilities")).cast("int")
        name = F.element_at(F.array(*[F.lit(name) for name in self.labels]), best)
        return scored.select(*keep, confidence(F.col("_probabilities")).alias("confidenceScore"), name.alias("recommendedServiceCode"))

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per node of a tree, and one for what the model is about."""
        about = json.dumps({"answers": self.answers, "labels": self.labels})
        nodes = [(r, k, n, int(a), float(o), None) for r, parts in enumerate(self.trees) for k, tree in enumerate(parts) for n, (a, o) in enumerate(zip(tree.asks, tree.output, strict=True))]
        spark.createDataFrame([(-1, -1, -1, -1, 0.0, about), *nodes], "round int, part int, node int, asks int, output double, about string").write.mode("overwrite").parquet(path)


def load_boosted(spark: SparkSession, path: str) -> BoostedModel:
    rows = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    about = json.loads(rows[0][-1])
    cells: dict[tuple[int, int], list[tuple]] = {}
    for turn, part, _, asks, output, _ in rows[1:]:
        cells.setdefault((turn, part), []).append((asks, output))
    trees: list[list[Tree]] = []
    for (_, part), nodes in cells.items():
        if not part:
            trees.append([])
        trees[-1].append(Tree(np.array([a for a, _ in nodes]), np.array([o for _, o in nodes])))
    return BoostedModel(about["answers"], about["labels"], trees)


def fit_settings(df: DataFrame, columns: Sequence[str], label: str, settings: Sequence[Setting], keys: Sequence[str] = (), fold: Column | None = None, seed: int = 42) -> tuple[Boosting, DataFrame]:
    """Fit all settings together; the blocks are returned for ``right_answers``."""
    narrow = stored(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, label, *keys])]), "boost-input")
    labels = sorted(str(r[0]) for r in narrow.select(F.col(f"`{label}`").cast("string")).where(F.col(f"`{label}`").isNotNull()).distinct().collect())
    if not labels:
        raise ValueError("no row has a label")
    answers = learn_vocabulary(narrow.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING)).alias(c) for c in columns]), columns)
    blocks = pack_rows(narrow, answers, labels, label, keys, fold, seed)
    fitted = Boosting(answers, labels, settings)
    fitted.fit(blocks)
    return fitted, blocks


def train_boosted(df: DataFrame, columns: Sequence[str], label: str, setting: Setting = Setting(), keys: Sequence[str] = ()) -> BoostedModel:
    fitted, _ = fit_settings(df, columns, label, [setting], keys, seed=setting.seed)
    return BoostedModel(fitted.answers, fitted.labels, fitted.trees[0])


def search_boosted(df: DataFrame, columns: Sequence[str], label: str, keys: Sequence[str], grid: Mapping[str, Sequence], folds: int = 3, seed: int = 42, at_once: int = 64) -> tuple[list[tuple[dict, int, int, int]], BoostedModel]:
    """Cross-validated search: (point, fold, rows, right ones) of all points, and the best point's model of all rows.

    The points of a grid that differ in ``maxIter`` only are one fit. ``at_once``: how many ensembles grow
    together; margins take 8 bytes for distinct answers of a block, ensemble and class.
    """
    rounds = sorted(grid["maxIter"])
    names = ("maxDepth", "stepSize", "subsamplingRate", "featureSubsetStrategy")
    fits = list(product(*(grid[n] for n in names)))
    share = {"all": 1.0}
    settings = [Setting(d, step, rounds[-1], rows, share.get(c) or float(c), fold, seed) for d, step, rows, c in fits for fold in [*range(folds), -1]]
    fold = F.pmod(row_hash(keys, seed), F.lit(folds))
    df = stored(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, label, *keys])]), "search-input")
    results: list[tuple[dict, int, int, int]] = []
    whole: dict[tuple, BoostedModel] = {}
    for start in range(0, len(settings), at_once):
        now = settings[start : start + at_once]
        fitted, blocks = fit_settings(df, columns, label, now, keys, fold, seed)
        found = fitted.right_answers(blocks, rounds)
        for k, setting in enumerate(now):
            point = fits[(start + k) // (folds + 1)]
            if setting.left_out < 0:
                whole[point] = BoostedModel(fitted.answers, fitted.labels, fitted.trees[k])
            else:
                results += [({**dict(zip(names, point, strict=True)), "maxIter": r}, setting.left_out, *found[k, r]) for r in rounds]
    means: dict[tuple, list[float]] = {}
    for point, _, n, ok in results:
        means.setdefault(tuple(point[k] for k in (*names, "maxIter")), []).append(ok / n if n else 0.0)
    *point, best_rounds = max(means, key=lambda p: sum(means[p]))  # of equal ones the first
    model = whole[tuple(point)]
    return results, BoostedModel(model.answers, model.labels, model.trees[:best_rounds])
