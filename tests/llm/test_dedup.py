"""Line dedup, near duplicates and components against brute force."""

from __future__ import annotations

import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from claimloom.llm import line_dedup
from claimloom.llm.common import read_table, row_key
from claimloom.llm.graph import components
from claimloom.llm.line_dedup import chunk_batch, cut_lines, drop_repeated_lines
from claimloom.llm.minhash import _links_between, near_duplicates
from tests.llm.conftest import PASSAGE, document, prose

ALL = (1 << 64) - 1


def _mixed(x):
    for _ in range(2):
        x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & ALL
    return x ^ (x >> 32)


def _chunks(lines):
    before, out, start = 0, [], 0
    for k, line in enumerate(lines):
        now = xxh3_64_intdigest(line)
        if _mixed((before * 0x9E3779B97F4A7C15 + now) & ALL) % 2 == 0 or k == len(lines) - 1:
            out.append((start, k + 1))
            start = k + 1
        before = now
    return out


def brute_lines(rows, min_words=20):
    """(key -> text) by dictionaries."""
    cut, groups = {}, defaultdict(list)
    for doc_id, text, key in rows:
        units = cut_lines((text or "").encode())
        lines = [u.strip() for u in units]
        cut[key] = (units, lines, _chunks(lines))
    for doc_id, _, key in sorted({(d, None, k) for d, _, k in rows}, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        for n, (a, b) in enumerate(cut[key][2]):
            if b - a > 1:
                groups[b"\n".join(cut[key][1][a:b])].append((key, n))
    gone = defaultdict(set)

    def around(key, n):
        _, lines, chunks = cut[key]
        a, b = chunks[n]
        low = chunks[n - 1][0] if n else a
        high = chunks[n + 1][1] if n + 1 < len(chunks) else b
        return lines[low:a][::-1], lines[b:high]

    def agree(x, y):
        return next((k for k, (p, q) in enumerate(itertools.zip_longest(x, y)) if p is None or p != q), min(len(x), len(y)))

    for members in groups.values():
        head = around(*members[0])
        for key, n in members[1:]:
            a, b = cut[key][2][n]
            before, behind = around(key, n)
            gone[key].update(range(a - agree(before, head[0]), b + agree(behind, head[1])))
    out = {}
    for key, (units, _, _) in cut.items():
        kept = b""
        for is_gone, run in itertools.groupby(range(len(units)), lambda k: k in gone[key]):
            part = b"".join(units[k] for k in run)
            if not is_gone or len(part.split()) < min_words:
                kept += part
        out[key] = kept.decode()
    return out


@pytest.mark.parametrize("which", ["edge", "table"])
def test_line_dedup_brute_force(spark, sf_dir, edge, which):
    docs = edge if which == "edge" else read_table(spark, sf_dir, "documents")
    keyed = docs.select("doc_id", "text", row_key(docs.doc_id, docs.text).alias("k")).collect()
    want = brute_lines([(r.doc_id, r.text, bytes(r.k)) for r in keyed])
    text_of = {(r.doc_id, r.text): want[bytes(r.k)] if r.text is not None else None for r in keyed}
    got = drop_repeated_lines(docs)
    assert got.columns == [*docs.columns, "removed_lines", "removed_words"]
    left = sorted(((r.doc_id, r.text) for r in got.select("doc_id", "text").collect()), key=repr)
    assert left == sorted((((r.doc_id, text_of[r.doc_id, r.text])) for r in keyed), key=repr)


def test_line_dedup_takes_passages(spark):
    """Passages of over 50 words go wherever they stand, also inside a line; the first copy stays."""
    passage = prose(901, 60).replace("\n", " ")
    rows = [document(k, f"{prose(3 * k, 40)} {passage} {prose(3 * k + 1, 37)}") for k in range(40)]
    rows += [document(100 + k, prose(500 + k, 90)) for k in range(40)]
    got = {r.doc_id: r for r in drop_repeated_lines(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, a int, b string, c string, d int, e bigint, f int")).collect()}
    assert got[0].removed_words == 0
    assert all(got[k].removed_words >= 40 for k in range(1, 40))
    assert all(got[100 + k].removed_words == 0 for k in range(40))


def common_runs(texts, min_words=20):
    """The texts without the runs of lines that stand in an earlier text, by comparing all places of lines."""
    places, out = defaultdict(list), []
    lines = [[u.strip() for u in cut_lines(t.encode())] for t in texts]
    for d, own in enumerate(lines):
        gone = set()
        for k in range(len(own)):
            for e, j in places[own[k]]:
                n = 0
                while k + n < len(own) and j + n < len(lines[e]) and own[k + n] == lines[e][j + n]:
                    n += 1
                if sum(len(x.split()) for x in own[k : k + n]) >= min_words:
                    gone.update(range(k, k + n))
        for k, line in enumerate(own):
            places[line].append((d, k))
        out.append("".join(u.decode() for k, u in enumerate(cut_lines(texts[d].encode())) if k not in gone))
    return out


def test_line_dedup_finds_every_common_run(spark):
    """Random passages of 50 to 200 words, in lines of any length, one without marks; each second copy goes whole."""
    draw, texts = random.Random(11), []

    def words(n, marks):
        return " ".join(f"w{draw.randrange(10**6)}" + (draw.choice(".,") if marks and draw.random() < marks else "") for _ in range(n))

    passages = [words(draw.randint(50, 200), draw.choice([0, 0.02, 0.1, 0.2])) + draw.choice(["", "."]) for _ in range(60)]
    for passage in passages * 2:
        texts.append(f"{words(40, 0.1)}\n{passage}\n{words(40, 0.1)}")
    rows = [(k, t) for k, t in enumerate(texts)]
    got = [r.text for r in drop_repeated_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).orderBy("doc_id").collect()]
    assert got == common_runs(texts)
    assert got[:60] == texts[:60]
    assert all(passage not in text and len(text.split()) == 80 for passage, text in zip(passages, got[60:], strict=True))


def brute_windows(rows, min_words=20):
    """(id, key) -> text without the windows that stand earlier, by a dictionary of their lines."""
    heads, out = {}, {}
    for (doc_id, key), text in sorted(dict(((d, k), t) for d, k, t in rows).items(), key=lambda r: (r[0][0] is not None, *(x or 0 for x in r[0]))):
        units = cut_lines(text.encode())
        lines, counts = [u.strip() for u in units], [len(u.split()) for u in units]
        runs = set()
        for k in range(len(units)):
            runs.update(itertools.islice(((k, e + 1) for e in range(k, len(units)) if sum(counts[k : e + 1]) >= min_words), 1))
            runs.update(itertools.islice(((a, k + 1) for a in range(k, -1, -1) if sum(counts[a : k + 1]) >= min_words), 1))
        gone = set()
        for a, e in sorted(runs):
            head = heads.setdefault(tuple(lines[a:e]), (doc_id, key, a, e))
            if head[:2] != (doc_id, key) or a >= head[3]:
                gone.update(range(a, e))
        out[doc_id, key] = b"".join(u for k, u in enumerate(units) if k not in gone).decode()
    return out


@pytest.mark.parametrize("which", ["edge", "table"])
def test_line_dedup_drops_every_repeated_window(spark, sf_dir, edge, which):
    docs = edge if which == "edge" else read_table(spark, sf_dir, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", F.xxhash64("text", F.col("doc_id").isNull()), "text").collect()]
    want = brute_windows([r for r in rows if r[2] is not None])
    got = drop_repeated_lines(docs).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((d, None if t is None else want[d, k]) for d, k, t in rows), key=repr)


def test_line_dedup_compares_bytes(spark, monkeypatch):
    """With rolling hashes that are all equal, only texts that are equal in bytes go."""
    monkeypatch.setattr(line_dedup, "_run_hashes", lambda hashes, low, *_: np.zeros(len(low), np.uint64))
    cloudpickle.register_pickle_by_value(line_dedup)
    try:
        texts = [prose(k, 70) for k in range(12)] + [f"{prose(50, 30)}\n{prose(3, 70)}"]
        got = drop_repeated_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).orderBy("doc_id").collect()
    finally:
        cloudpickle.unregister_pickle_by_value(line_dedup)
    assert [r.text for r in got] == common_runs(texts)
    assert [r.removed_words for r in got] == [0] * 12 + [70]


def test_chunks_depend_on_their_lines_only():
    """A run that two texts share has a chunk of the same hash in both, whatever stands around it."""
    draw = random.Random(5)
    for k in range(200):
        run = prose(k, draw.randint(40, 60)) + ".\n"
        both = [cut_lines((prose(1000 + draw.randrange(999), draw.randint(1, 50)) + "\n" + run + prose(2000 + draw.randrange(999), 30)).encode()) for _ in range(2)]
        owner, low, high, value = chunk_batch(both, 20)
        assert (low < high).all() and set(value[owner == 0].tolist()) & set(value[owner == 1].tolist())


def test_line_dedup_leaves_one_copy_of_a_repeated_line(spark):
    rows = [(1, "one two. " * 100), (2, "one two. " * 30)]
    got = [r.text for r in drop_repeated_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).orderBy("doc_id").collect()]
    assert got == ["one two. " * 10, ""]


def test_line_dedup_empty(nothing):
    assert drop_repeated_lines(nothing).count() == 0


def test_cut_lines_keeps_text():
    for text in ("", "a", "a. b, c\n\nd;  e", "a\0b. c\nd", PASSAGE):
        assert b"".join(cut_lines(text.encode())) == text.encode()


def brute_groups(rows, shingle, percent=80):
    sets, parent = defaultdict(set), {}
    sizes = []
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        own = frozenset(tuple(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))) if w else frozenset()
        sizes.append((doc_id, len(own)))
        if doc_id is not None:
            parent[doc_id] = doc_id
            if own:
                sets[own].add(doc_id)

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    def join(ids):
        low = min(map(root, ids))
        for k in ids:
            parent[root(k)] = low

    for ids in sets.values():
        join(ids)
    for (a, x), (b, y) in itertools.combinations(sets.items(), 2):
        shared = len(a & b)
        if 100 * shared >= percent * (len(a) + len(b) - shared):
            join(x | y)
    return sorted(((d, n, None if d is None else root(d), d is None or root(d) == d) for d, n in sizes), key=repr)


@pytest.mark.parametrize(("which", "shingle"), [("edge", 2), ("table", 2), ("table", 5), ("chain", 2), ("nothing", 2)])
def test_near_duplicates_brute_force(spark, sf_dir, edge, nothing, which, shingle):
    if which == "chain":  # neighbours are similar, ends are not: buckets with several components
        words = [f"w{k}" for k in range(400)]
        docs = spark.createDataFrame([(500 - k, " ".join(words[12 * k % 300 : 12 * k % 300 + 100])) for k in range(60)], "doc_id bigint, text string")
    else:
        docs = {"edge": edge, "nothing": nothing}.get(which) or read_table(spark, sf_dir, "documents")
    want = brute_groups([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], shingle)
    assert sorted((tuple(r) for r in near_duplicates(docs, shingle=shingle).collect()), key=repr) == want


def test_links_between_blocks(spark):
    """Blocks of a few documents, a large component with blocks of its own: all links are found."""
    draw = random.Random(4)
    sets = {}
    for k in range(60):
        base = range(1000 * (k % 3), 1000 * (k % 3) + 40)
        sets[k] = sorted({x if draw.random() > 0.1 else draw.randrange(10**6) for x in base})
    comp = {k: 0 if k % 3 == 0 and k < 45 else k for k in sets}
    crowd = spark.createDataFrame([(k, comp[k], len(sets[k]), k % 3) for k in sets], "rep bigint, comp bigint, n bigint, first bigint")
    table = spark.createDataFrame([(k, len(v), v) for k, v in sets.items()], "rep bigint, n bigint, hashes array<bigint>")

    def groups(links):
        root = dict(comp)
        for a, b in links:
            low, high = sorted((root[a], root[b]))
            root = {k: low if c == high else c for k, c in root.items()}
        return root

    similar = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(set(sets[a]) & set(sets[b])) >= 80 * len(set(sets[a]) | set(sets[b]))]
    links = [tuple(r) for r in _links_between(crowd, table, 80, block=200, least=1).collect()]
    assert set(links) <= set(similar) and groups(links) == groups(similar) != comp


def test_components(spark):
    links = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 199)]
    got = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert got == {k: 0 for k in range(51)} | {k: 100 for k in range(100, 140)} | {199: 199, 200: 199}
