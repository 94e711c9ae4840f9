"""Spelling variants against a comparison of every two words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from claimloom.llm.common import read_table
from claimloom.llm.spelling import one_edit_pairs, spelling_variants
from tests.llm.conftest import document


def variants(word, alphabet):
    for k in range(len(word) + 1):
        if k < len(word):
            yield word[:k] + word[k + 1 :]
        for c in alphabet:
            yield word[:k] + c + word[k:]
            yield word[:k] + c + word[k + 1 :]


def brute(rows, least=7, one_in=31):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= least and k >= 2}
    alphabet = {c for w in n for c in w}
    near = {w: {v for v in variants(w, alphabet) if v in n and v != w} if len(w) < 200 else {v for v in n if abs(len(v) - len(w)) < 2 and v != w and apart(v, w)} for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, n[w], len(near[w]), form.get(w), n[form[w]] if w in form else None, root))
    return out


def apart(a, b):
    """One edit apart."""
    if len(a) > len(b):
        a, b = b, a
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k:] == b[k + 1 :] if len(a) < len(b) else a[k + 1 :] == b[k + 1 :] and k < len(a)


def found(df):
    rows = [tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def frame(spark, rows):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, word int, node string, rest string, n int, root bigint, _key int"
    return spark.createDataFrame([document(*r) for r in rows], schema).repartition(3)


def test_random_words(spark):
    some = random.Random(3)
    stems = ["".join(some.choices("abcé", k=some.randrange(6, 12))) for _ in range(40)]
    words = stems + [v for s in stems[:25] for v in some.sample(list(variants(s, "abcéÿ")), 12)]
    words += [s + x for s in stems[:6] for x in ("s", "es", "ing", "ings")] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "aaaaaab", "baaaaaa", "abababab", "babababa", "bababab"]
    rows = [(k, " ".join(some.choices(words, k=60)).title() if k % 3 else "-".join(some.choices(words, weights=range(1, len(words) + 1), k=60))) for k in range(60)]
    rows += [(None, "commonword Commonword"), (None, None), (7, ""), (8, "short one"), (9, "commonword")] + [(k, "fréquent×÷ " * 30 + "frequent×÷ frequent×÷") for k in range(200, 240)]
    want = brute(rows)
    assert sum(r[3] is not None for r in want) > 0 and sum(r[2] > 2 for r in want) > 50
    assert found(spelling_variants(frame(spark, rows))) == want


def test_edge(spark, edge_rows):
    rows = [r[:2] for r in edge_rows]
    rows += [(50, "y" * 3000 + " " + "y" * 3001), (51, "y" * 3000 + " " + "y" * 3001), (52, "z" * 2999 + "q" + "y" * 50), (52, "z" * 2999 + "p" + "y" * 50), (53, "z" * 2999 + "q" + "y" * 50), (54, "z" * 2999 + "p" + "y" * 50)]
    assert found(spelling_variants(frame(spark, rows))) == brute(rows)


def test_chains_of_forms(spark):
    rows = [(k, " ".join(["abcdefgh"] * 50 + ["abcdefg"] * 5)) for k in range(100)] + [(200, "abcdefgX abcdefgX xabcdefgX xabcdefgX abcdefgXY abcdefgXY"), (201, "zbcdefg zbcdefg")]
    got = found(spelling_variants(frame(spark, rows), one_in=1 << 40))
    assert got == brute(rows, one_in=1 << 40)
    roots = {r[0]: r[-1] for r in got}
    assert roots["abcdefg"] == "abcdefgh" and roots["zbcdefg"] == "abcdefgh"


def test_table(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    assert found(spelling_variants(docs)) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_every_word(spark, sf_dir):
    """Words that occur once too, so that there are many pairs."""
    docs = read_table(spark, sf_dir, "documents")
    texts = [r.text or "" for r in docs.select("text").limit(60).collect()]
    words = sorted({w for t in texts for w in re.findall("[a-zÀ-ÿ]{4,}", t.lower())})[:6000]
    alive = set(words)
    alphabet = {c for w in words for c in w}
    want = {(w, v) for w in words for v in variants(w, alphabet) if v in alive and v != w}
    pairs = [tuple(r) for r in one_edit_pairs(spark.createDataFrame([(w,) for w in words], "word string")).collect()]
    assert set(pairs) | {(b, a) for a, b in pairs} == want


def test_nothing(spark, nothing):
    assert spelling_variants(nothing).collect() == []


@pytest.mark.parametrize("text", [b"caf\xe9 wordword wordword", b"\xff\xfe"])
def test_not_utf8(spark, text):
    docs = spark.createDataFrame([(1, bytearray(text))], "doc_id bigint, text binary").selectExpr("doc_id", "cast(text AS string) AS text")
    assert len(spelling_variants(docs).collect()) == (1 if b"word" in text else 0)
