"""Quality rules as a learned decision list.

Sequential covering over labelled statistics: a rule grows by the threshold that gains most information
about low quality, is pruned on rows that it did not grow on, and takes the rows that it covers out of
the next rule's sight. The rules become one ordered Spark conditional expression over the statistics, so
deciding a document takes no model file and no Python.

Null and empty texts have zero statistics and fail the base rule. Labels that are null, or that contradict
each other for one document, are not used; without labels the list is empty and keeps everything. Rows are
decided one by one, repeated ones alike. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import arrow_map, hex_number, utf8
from claimloom.session import stored

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_same")
SYMBOLS = b"#*$%&|<>"
MARKS = b"!?.,;:"
SPACE = b" \t\n\v\f\r"
WINDOW = 8
# odd multipliers from the golden ratio; a window's key is a weighted sum of its words' hashes
WEIGHTS = [np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1)) & (2**64 - 1)) for k in range(WINDOW)]

#: What rules test: shares that do not change with the length of a text, so that long texts are judged like short ones.
FEATURES = {
    "word_length": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "repeated_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "upper_case": ("n_upper", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "same_as_last": ("n_same", "n_words"),
}


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside windows of 8 words that the text holds twice or more, every occurrence counted."""
    n = len(hashes) - WINDOW + 1
    if n < 2:
        return 0
    keys = hashes[:n] * WEIGHTS[0]
    for k in range(1, WINDOW):
        keys = keys + hashes[k : n + k] * WEIGHTS[k]
    order = np.argsort(keys)
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(hashes) + 1, np.int64)
    change[:n] += twice
    change[WINDOW : WINDOW + n] -= twice
    return int((np.cumsum(change[:-1]) > 0).sum())


def text_counts(text: bytes) -> tuple[int, ...]:
    words = text.split()
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    points = len(text) - int(seen[0x80:0xC0].sum())
    lines = [line for line in text.split(b"\n") if line.strip()]
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    return (
        len(words),
        points - int(seen[list(SPACE)].sum()),
        int(seen[list(SYMBOLS)].sum()),
        len(lines) - len(set(lines)),
        repeated_words(hashes),
        len(lines),
        int(seen[65:91].sum()),
        int(seen[list(MARKS)].sum()),
        int((hashes[1:] == hashes[:-1]).sum()),
    )


def statistics(docs: DataFrame) -> DataFrame:
    """The counts of each document's whole text."""

    def run(batch: pa.RecordBatch) -> dict:
        rows = [text_counts(t) for t in utf8(batch)]
        return {"doc_id": batch.column(0)} | dict(zip(COUNTS, zip(*rows), strict=True))

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS))


def feature(name: str) -> Column:
    top, base = FEATURES[name]
    return F.col(top) / F.greatest(F.lit(1), F.col(base))


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = feature(self.feature)
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Test, ...]


def _covers(rule: Rule, x: np.ndarray, names: Sequence[str]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for t in rule:
        out &= (x[:, names.index(t.feature)] > t.threshold) == t.above
    return out


def _best_test(x: np.ndarray, y: np.ndarray, names: Sequence[str]) -> tuple[float, Test | None]:
    """The threshold with the most gain: rows of low quality kept times the bits they become surer by."""
    best, found = 0.0, None
    p, n = int(y.sum()), int((~y).sum())
    if not p or not n:
        return best, found
    prior = np.log2(p / (p + n))
    for j, name in enumerate(names):
        order = np.argsort(x[:, j], kind="stable")
        value, label = x[order, j], y[order]
        cut = np.flatnonzero(value[1:] != value[:-1])
        if not len(cut):
            continue
        low_p = np.cumsum(label)[cut]
        low = cut + 1
        for above, kept_p, kept in ((False, low_p, low), (True, p - low_p, p + n - low)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(kept_p > 0, kept_p * (np.log2(kept_p / kept) - prior), 0.0)
            k = int(np.argmax(gain))
            if gain[k] > best + 1e-9:
                best, found = float(gain[k]), Test(name, above, float((value[cut[k]] + value[cut[k] + 1]) / 2))
    return best, found


def cover(x: np.ndarray, y: np.ndarray, names: Sequence[str], precision: float, longest: int, most: int) -> list[Rule]:
    """Ordered rules for the rows with y; every third row prunes, the others grow."""
    prune = np.arange(len(y)) % 3 == 2
    left, rules = np.ones(len(y), bool), []
    while len(rules) < most and (left & y).any():
        rule: list[Test] = []
        inside = left & ~prune
        while len(rule) < longest and (~y[inside]).any():
            _, test = _best_test(x[inside], y[inside], names)
            if test is None:
                break
            rule.append(test)
            inside &= _covers((test,), x, names)
        if not rule:
            break
        best, kept = -1.0, ()
        for size in range(1, len(rule) + 1):
            hit = left & _covers(tuple(rule[:size]), x, names)
            right, wrong = int((hit & prune & y).sum()), int((hit & prune & ~y).sum())
            worth = (right - wrong) / (right + wrong) if right + wrong else -1.0
            if worth > best + 1e-9:
                best, kept = worth, tuple(rule[:size])
        hit = left & _covers(kept, x, names) if kept else np.zeros(len(y), bool)
        if hit.sum() < 2 or y[hit].mean() < precision:
            break
        rules.append(kept)
        left &= ~hit
    return rules


def learn_rules(stats: DataFrame, labels: DataFrame, sample: int = 20_000, precision: float = 0.95, longest: int = 4, most: int = 16) -> list[Rule]:
    """Rules for low quality.

    ``sample``: the fit uses this many labelled rows at most, those with the smallest digests of their
    ids; ``precision``: what a rule must reach to be kept; ``longest``, ``most``: tests in a rule, rules.
    """
    agreed = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    names = list(FEATURES)
    known = stats.join(agreed.where("low = high"), "doc_id").where(~base_failed())
    digest = F.md5(F.col("doc_id").cast("string").cast("binary"))
    rows = stored(known.select(digest.alias("digest"), "low", *[feature(n).alias(n) for n in names]), "labelled-statistics")
    # only digests that can be among the smallest are sorted, so that few rows leave each task
    share = min(1.0, (1.2 * sample + 1000) / max(1, rows.count()))
    rows = rows.where(hex_number(F.col("digest"), 1, 12) <= int(share * (1 << 48))).orderBy("digest", *names).limit(sample).collect()
    if not rows:
        return []
    x = np.array([[r[n] for n in names] for r in rows], np.float64)
    return cover(x, np.array([r.low == 0 for r in rows]), names, precision, longest, most)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def verdict(rules: Sequence[Rule]) -> Column:
    """False where a rule of the list holds, in their order; true where none does."""
    out = None
    for rule in rules:
        test = rule[0].column()
        for t in rule[1:]:
            test = test & t.column()
        out = F.when(test, False) if out is None else out.when(test, False)
    return F.lit(True) if out is None else out.otherwise(True)


def judge(stats: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))
