"""Alignment against tokens of whole texts, laid side by side token by token."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from claimloom.llm.alignment import BYTE_LEVEL, PIECES, WORDS, Aligner, align_documents, align_tokenizers, merged, pack_postings, pair_counts, rank_encoder, unpack_postings
from claimloom.llm.common import read_table
from claimloom.llm.packing import vocabulary_path
from tests.llm.conftest import document


def byte_names():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@pytest.fixture(scope="module")
def encoders():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocabulary_path(BYTE_LEVEL))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(PIECES)), byte_names()


def tokens(text, encoders):
    a, b, names = encoders
    of_a = [(i, bytes(names[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    of_b = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in ((i, b.id_to_piece(i)) for i in b.encode(text))]
    want = (" " + text).encode()
    if not text or b"".join(x for _, x in of_a) != want or b"".join(x for _, x in of_b) != want:
        return [], []
    return of_a, of_b


def spans(side):
    out, at = [], 0
    for i, data in side:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def brute(rows, encoders):
    docs = []
    for doc_id, text in rows:
        a, b = (spans(x) for x in tokens(text or "", encoders))
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [";".join(f"{','.join(str(i) for i, s, e in a if low <= s and e <= high)}|{','.join(str(i) for i, s, e in b if low <= s and e <= high)}" for low, high in zip([0, *cuts], cuts))] if cuts else []
        links, k = [], 0
        for i, s, e in a:
            while b[k][2] <= s:
                k += 1
            j = k
            while j < len(b) and b[j][1] < e:
                links.append((i, b[j][0]))
                j += 1
        docs.append((doc_id, len(a), len(b), len(cuts), links, groups))
    count = Counter(pair for *_, links, _ in docs for pair in set(links))
    best = {}
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    out = Counter()
    for doc_id, n_a, n_b, n_groups, links, groups in docs:
        sha = hashlib.sha256(groups[0].encode()).hexdigest() if groups else ""
        out[(doc_id, n_a, n_b, n_groups, len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), sha)] += 1
    return out, count, Counter(p for *_, links, _ in docs for p in links)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = [
    "a  b", " lead", "trail ", "\n", " ", "\t\tx\n\n y", "it's they'll \n'tis", "<s> </s> <|endoftext|> <unk> <0x0A>", "▁ mark", "x▁y z", "  　 x y",
    "\r\n{\r\n} \r ;\r\nx", "é ́x ﬁ Ａ ​", "\x00 \x1c \x1f\n\x1d", "\U0001f600\U0001f468‍\U0001f469 漢字 仮名\nかな", "1234 5.67e8 --- ... !!!", "﻿bom", "don't  'S 'RE", "word\n next\n\tz \n q",
]


def check(spark, rows, encoders, **options):
    docs = spark.createDataFrame([document(*r) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, pair string, block string, place int, n bigint, _key int")
    found = align_tokenizers(docs.repartition(3), **options)
    assert Counter(tuple(r) for r in found.select(*COLUMNS).collect()) == brute(rows, encoders)[0]


def test_odd_texts(spark, encoders):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(k, t) for k, t in enumerate(ODD[:4])] + [(90, None), (91, ""), (None, "no id"), (None, None), (92, "x" * 9000)]
    check(spark, rows, encoders)


def test_edge(spark, edge_rows, encoders):
    check(spark, [r[:2] for r in edge_rows if len(r[1] or "") < 30_000], encoders, most=2000)


def test_random_texts(spark, encoders):
    some = random.Random(5)
    letters = [" ", " ", "\n", "  ", "the", "ing", "é", "'s", "▁", "\t", "漢", "9", ".", "\r", "<s>", "́", " "]
    check(spark, [(k, "".join(some.choices(letters, k=some.randrange(30)))) for k in range(400)], encoders)


def test_table(spark, sf_dir, encoders):
    docs = read_table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if len(r.text or "") < 20_000]
    small = docs.where("text IS NULL OR char_length(text) < 20000")
    want, count, links = brute(rows, encoders)
    assert Counter(tuple(r) for r in align_tokenizers(small, most=50_000).select(*COLUMNS).collect()) == want
    blocks = align_documents(small, vocabulary_path(BYTE_LEVEL), vocabulary_path(PIECES), 10_000)
    found = pair_counts(blocks).collect()
    assert {(r.a, r.b): r.documents for r in found} == dict(count)
    assert {(r.a, r.b): r.links for r in found} == dict(links)


def test_nothing(spark, nothing):
    assert align_tokenizers(nothing).collect() == []


def test_not_utf8(spark):
    docs = spark.sql("SELECT 1L AS doc_id, cast(unhex('61FF62') AS string) AS text")
    assert [tuple(r) for r in align_tokenizers(docs).select(*COLUMNS).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_postings():
    some = np.random.default_rng(3)
    pairs, docs = some.integers(0, 40, 6000) ** 2, np.where(some.random(6000) < 0.5, some.integers(0, 30, 6000), some.integers(0, 5000, 6000))
    keys, counts = merged([(pairs << 16 | docs, some.integers(1, 300, 6000))])
    packed = pack_postings(keys, counts, 5000)
    row, found, links = unpack_postings(packed["dense"], packed["n"], packed["docs"], packed["planes"])
    assert (packed["pair"][row] << 16 | found == keys).all() and (links == counts).all()
    keys, counts = merged([(np.arange(900) | 7 << 16, np.ones(900, np.int64)), (np.array([9 << 16]), np.array([1 << 20]))])
    packed = pack_postings(keys, counts, 900)
    assert packed["dense"].tolist() == [True, False] and len(packed["planes"][1]) == 20
    row, found, links = unpack_postings(packed["dense"], packed["n"], packed["docs"], packed["planes"])
    assert (packed["pair"][row] << 16 | found == keys).all() and (links == counts).all()


def test_memory_is_bounded():
    small, large = (Aligner(vocabulary_path(BYTE_LEVEL), vocabulary_path(PIECES), most) for most in (4, 1000))
    for text in ("one two three", "four five six seven", "one seven▁", "two two"):
        for x, y in zip(small.documents([text, "six"]), large.documents([text, "six"]), strict=True):
            assert list(map(str, x)) == list(map(str, y))
    assert len(small.known) <= 8


def test_common_words_are_encoded_once(monkeypatch):
    tool, encoded = Aligner(vocabulary_path(BYTE_LEVEL), vocabulary_path(PIECES), 100), Counter()
    learn = tool.learn
    monkeypatch.setattr(tool, "learn", lambda words, apart: (encoded.update(words), learn(words, apart)))
    common, rare = " ".join(f"common{k}" for k in range(40)), iter(range(10_000))
    for _ in range(12):
        tool.documents([f"{common} {common}", " ".join(f"rare{next(rare)}" for _ in range(50))])
    assert sum(n for word, n in encoded.items() if word.startswith(" common")) == 40
    assert len(tool.known) <= 100


def test_whole_texts_and_words_without_tokens_are_forgotten():
    small, large = (Aligner(vocabulary_path(BYTE_LEVEL), vocabulary_path(PIECES), most) for most in (8, 1000))
    texts = ["one▁ two", "x▁y z one two", "one", "", None, "two one \x00 one", "three four five six seven", "word " * 90 + "x" * 5000]
    for k in range(12):
        part = texts[k % 8 :] + texts[: k % 5]
        for x, y in zip(small.documents(part), large.documents(part), strict=True):
            assert list(map(str, x)) == list(map(str, y))
        assert len(small.known) <= 8 and len(small.known) == len(small.groups) == len(small.uses) == len(small.first) - 1


def test_words_are_cut_as_the_pattern_says():
    some, tool = random.Random(8), Aligner(vocabulary_path(BYTE_LEVEL), vocabulary_path(PIECES))
    letters = [" ", "\n", "a", "bc", "\t", "\r", " ", "　", "\x00", "\x1c", "é", "▁"]
    for text in [*ODD, *("".join(some.choices(letters, [9, 5, 9, 9, *[1] * 8], k=some.randrange(1, 12))) for _ in range(5000))]:
        assert tool.words(text) == WORDS.split(" " + text)


def test_ranks_are_the_vocabulary(encoders, tmp_path):
    tool, some = Aligner(vocabulary_path(BYTE_LEVEL), vocabulary_path(PIECES)), random.Random(9)
    assert tool.ranks is not None
    texts = [f" {t}." for t in ODD] + [" ".join(f"a{chr(c)}b{chr(c)} {chr(c)}1" for c in range(low, low + 256)) for low in range(0, 0xD800, 256)]
    names = [t.decode() for t in tool.bytes_a if t.isascii()]
    texts += [" " + "".join(some.choices(names, k=6)) for _ in range(3000)]
    for text in texts:
        assert tool.ranks.encode_ordinary(text) == encoders[0].encode(text, add_special_tokens=False).ids
    alone = tmp_path / "byte_bpe_50k.json"
    alone.write_bytes(Path(vocabulary_path(BYTE_LEVEL)).read_bytes())
    assert rank_encoder(str(alone), tool.bytes_a) is None
    ranks = Path(vocabulary_path(BYTE_LEVEL)).with_suffix(".tiktoken").read_bytes().splitlines()
    alone.with_suffix(".tiktoken").write_bytes(b"\n".join(ranks[:-1]))
    assert rank_encoder(str(alone), tool.bytes_a) is None
