"""Lexical retrieval packing: windows are filled with documents that read alike.

Documents are encoded, each with an end token, and laid in the order of their heaviest BM25 terms, among
those that other documents have too. This order is cut into shards of about ``shard_tokens`` tokens, at
places that a sample by hashes tells, so documents of one topic meet at any size of the corpus; documents
of the same terms are ordered by a hash, so that a large group of them is cut too. A shard has a BM25
inverted index over its token ids, with document frequencies and the mean length of the whole corpus. A
window starts with a seed document; the unused documents that score best for all of the seed's tokens (or
its ``query_terms`` heaviest) fill it up. A document that does not fit is cut, and its rest is the next
window's seed, so every window is full. What is left at the end of a shard is cut into sequences whose
lengths are powers of two, which need no padding.

Words are encoded once and remembered: the tokenizer never joins text across ASCII white space.

Null and empty texts consist of the end token. Texts of any length are encoded whole. Every row is packed,
repeated rows too, and equal ids are told apart by their rows. Ties are broken by the order of ids, nulls
first. Extra columns are ignored.
"""

from __future__ import annotations

import os
import unicodedata
from bisect import bisect_right
from codecs import charmap_decode
from collections.abc import Iterator
from itertools import compress, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import arrow_map, pa_schema, slices, worker_memory
from claimloom.session import work_path

VOCABULARY = "word_bpe_49k.json"
END = 1
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())  # ASCII, neither letter nor digit
SPACES = b" \t\n\v\f\r"
LOWER = bytes(range(256)).lower()
OTHER, SPACE, LETTER, MARK = range(4)  # kinds of bytes
KINDS = bytes(SPACE if b in SPACES else LETTER if bytes([b]).isalpha() else MARK if b in b".,;:!?" else OTHER for b in range(256))
CASED = (b"\xcc", b"\xcd", b"<|")  # the first bytes of U+0300 to U+037F, and of control strings
SPACES = b" \t\n\v\f\r"
LOWER = bytes(range(256)).lower()
# kinds of bytes; a lead and what may follow it make a letter from U+00C0 to U+023F
OTHER, SPACE, LETTER, MARK, LEAD, FOLLOW = range(6)
KINDS = bytearray(256)
for _kind, _bytes in (
    (SPACE, SPACES),
    (LETTER, [b for b in range(128) if chr(b).isalpha()]),
    (MARK, [b for b in MARKS if b not in b"|>"]),  # these two end control strings
    (LEAD, range(0xC3, 0xC9)),
    (FOLLOW, [b for b in range(0x80, 0xC0) if b not in b"\x97\xb7\xb0"]),  # no × and ÷, no İ, which becomes two characters
):
    for _byte in _bytes:
        KINDS[_byte] = _kind
MOST_MARKS = 8  # longer tails of marks stay with their word
RARE = 8
LATIN = "ɐ"  # letters before this are letters to every library
SMALL = np.array([c == " " or c.isalpha() and c == c.lower() for c in map(chr, range(ord(LATIN)))] + [False])


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)]


class WordTokens(dict):
    """The token ids of white-space separated words, as 16-bit binary.

    ``learn`` encodes the words of a batch that are not known yet, all in one call. Once there are more than
    about ``most`` words, only those of the last batch are kept.
    """

    def __init__(self, path: str, most: int = 500_000) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("token ids must fit in 16 bits")
        self.plain = Tokenizer.from_file(path)  # for runs of letters, each one token run
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.last = np.zeros(1 << 16, bool)  # ids that end a run
        for token, number in self.tokenizer.get_vocab().items():
            self.last[number] = token.endswith("</w>")
        letters = byte_letters()
        self.letters = "".join([*letters[:32], " ", *letters[33:]])
        self.most = most

    def __missing__(self, word: bytes) -> bytes:
        return self.learn([word])[0]

    def learn(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words that are not known yet, and remembers them."""
        if not words:
            return []
        small = small_letters(words)
        parts: list[tuple[bytes, bytes, bytes]] = []
        stems: set[bytes] = set()
        others: list[bytes] = []
        for word in compress(words, [not s for s in small]):
            # marks behind letters are a token run of their own
            stem = word.rstrip(MARKS)
            run = as_run(stem)
            if run is None:
                others.append(word)
                continue
            parts.append((word, run, mark := word[len(stem) :]))
            if run not in self:
                stems.add(run)
            if mark and mark not in self:
                self[mark] = self.whole([mark])[0]
        runs = [*compress(words, small), *stems]
        found = self.encode_runs(runs)
        self.update(zip(runs, found, strict=True))
        self.update(zip(others, self.whole(others), strict=True))
        for word, run, mark in parts:
            self[word] = self[run] + self[mark] if mark else self[run]
        ids = iter(found)
        return [next(ids) if s else self[w] for w, s in zip(words, small, strict=True)]

    def forget(self, words: list[bytes], ids: list[bytes]) -> None:
        """Keeps only these words if there are too many."""
        if len(self) > self.most:
            self.clear()
            self.update(zip(words, ids, strict=True))

    def whole(self, words: list[bytes]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch([w.decode() for w in words], add_special_tokens=False)
        return [np.array(e.ids, np.uint16).tobytes() for e in encoded]

    def encode_runs(self, runs: list[bytes], step: int = 256) -> list[bytes]:
        if not runs:
            return []
        joined = b" ".join(runs)
        text, _ = charmap_decode(joined, "strict", self.letters)  # one character a byte
        cuts = [-1, *np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)[step - 1 :: step].tolist(), len(text)]
        encoded = self.plain.encode_batch_fast([text[i + 1 : j] for i, j in pairwise(cuts)], add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint16) for e in encoded])
        ends = ((np.flatnonzero(self.last[ids]) + 1) * 2).tolist()
        binary = ids.tobytes()
        return [binary[i:j] for i, j in pairwise([0, *ends])]


def small_letters(words: list[bytes]) -> list[bool]:
    """Which words consist of small Latin letters; these are their own normal form."""
    points = np.frombuffer(b" ".join(words).decode().encode("utf-32-le"), np.uint32)
    first = np.concatenate([[0], np.flatnonzero(points == 32) + 1])
    return np.logical_and.reduceat(SMALL[np.minimum(points, len(SMALL) - 1)], first).tolist()


def as_run(word: bytes) -> bytes | None:
    """A word of letters in lower case; None for other words."""
    if word.isalpha():
        return word.lower()
    text = word.decode()
    if text.isalpha() and max(text) < LATIN and unicodedata.is_normalized("NFC", text):
        lower = text.lower()
        if len(lower) == len(text):
            return lower.encode()
    return None


def word_tokens(path: str) -> WordTokens:
    """The memory of this process; workers that are used again keep it from task to task."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    memories = worker_memory().setdefault("word tokens", {})
    if path not in memories:
        memories[path] = WordTokens(path)
    return memories[path]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after the other, and the number of words before each text and in all.

    ASCII letters are in lower case, and marks between a letter and white space are a word of their own: the
    vocabulary's tokens are the same, and there are fewer distinct words. A text with combining marks or what
    may be a control string keeps its case: a few letters join with one in lower case only.
    """
    texts = texts.fill_null("").cast(pa.binary())
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    raw = data[int(bounds[0]) : int(bounds[-1])].to_pybytes() if data else b""
    bounds -= bounds[0]
    if not raw or raw.isspace():
        return pa.array([], pa.binary()), np.zeros(len(texts) + 1, np.int64)
    lower = raw.translate(LOWER)
    if any(sign in raw for sign in CASED):
        kept = bytearray(lower)
        for i, j in pairwise(bounds.tolist()):
            if any(raw.find(sign, i, j) >= 0 for sign in CASED):
                kept[i:j] = raw[i:j]
        lower = bytes(kept)
    kind = np.frombuffer(raw.translate(KINDS), np.uint8)
    # where words begin and end
    inside = kind != SPACE
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    heads = bounds[(bounds > 0) & (bounds < len(raw))]
    begins[heads], ends[heads - 1] = inside[heads], inside[heads - 1]
    first, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    offsets = np.concatenate([[0], np.cumsum(end - first)])
    # where their marks begin
    marked = np.flatnonzero(kind[end - 1] == MARK)
    at = end[marked] - 1
    for _ in range(MOST_MARKS):
        at -= (kind[at] == MARK) & (at > first[marked])
    before = kind[np.maximum(at, 1) - 1]
    letter = (kind[at] == LETTER) | (kind[at] == FOLLOW) & (before == LEAD) & (at > first[marked])
    marked, at = marked[letter], at[letter]
    tails = offsets[marked] + at + 1 - first[marked]
    parted = np.sort(np.concatenate([offsets, tails]), kind="stable").astype(np.int32)
    words = lower.translate(None, SPACES)
    before_text = np.searchsorted(parted, offsets[np.searchsorted(first, bounds)])
    return pa.Array.from_buffers(pa.binary(), len(parted) - 1, [None, pa.py_buffer(parted), pa.py_buffer(words)]), before_text


def encode_texts(texts: pa.Array, words: WordTokens) -> tuple[pa.Array, np.ndarray]:
    """The token ids of each text as binary, and the ends of their bytes.

    Words are numbered by Arrow, so that each distinct one is looked up once, and taken in their order: the
    values of the taken words, one after the other, are the ids of the texts.
    """
    split, first = split_words(texts)
    if not len(split):
        return pa.array([b""] * len(texts), pa.binary()), first
    numbered = split.dictionary_encode()
    known = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
    found = list(map(words.get, known))
    new = [k for k, ids in enumerate(found) if ids is None]
    for k, ids in zip(new, words.learn([known[k] for k in new]), strict=True):
        found[k] = ids
    words.forget(known, found)
    ids = pa.array(found, pa.binary()).take(numbered.indices)
    ends = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset :][first]
    return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends), ids.buffers()[2]]), ends


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n and ids (16-bit little-endian binary, without the end token) of each document."""
    kinds = pa_schema(docs.sparkSession, "doc_id bigint, n bigint, ids binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokens(tokenizer)
        for batch in slices(batches):
            ids, ends = encode_texts(batch.column(1), words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends) // 2, pa.int64()), ids], schema=kinds)

    path = work_path(docs.sparkSession, "pack-tokens")
    docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n bigint, ids binary").write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def joined_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The token ids of all rows of a binary column, one after the other, and how many each row has."""
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int32, len(column) + 1, column.offset * 4).astype(np.int64) // 2
    ids = np.frombuffer(data, np.uint16, bounds[-1])[bounds[0] :] if data else np.empty(0, np.uint16)
    return ids, np.diff(bounds)


def term_counts(ids: np.ndarray, lengths: np.ndarray, step: int = 1 << 17) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct token ids of documents, in the order of documents and ids: their document, id and count.

    Documents are sorted together, about ``step`` ids at once.
    """
    ends = np.cumsum(lengths)
    found = [(np.empty(0, np.int64), np.empty(0, np.uint16), np.empty(0, np.int64))]
    low = begin = 0
    while low < len(lengths):
        high = min(max(low + 1, int(np.searchsorted(ends, begin + step, "right"))), low + (1 << 16))
        end = int(ends[high - 1])
        keys = np.repeat(np.arange(high - low, dtype=np.uint32) << 16, lengths[low:high]) | ids[begin:end]
        keys.sort()
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        own = keys[first]
        found.append((low + (own >> 16).astype(np.int64), own.astype(np.uint16), np.diff(np.append(first, len(keys)))))
        low, begin = high, end
    owner, terms, counts = map(np.concatenate, zip(*found))
    return owner, terms, counts


def document_frequencies(tokens: DataFrame, size: int = 1 << 16) -> np.ndarray:
    """In how many documents each token id occurs; one number per id of the vocabulary."""

    def run(batch: pa.RecordBatch) -> dict:
        _, terms, _ = term_counts(*joined_ids(batch.column(0)))
        seen = np.bincount(terms, minlength=size)
        found = np.flatnonzero(seen)
        return {"id": found, "n": seen[found]}

    out = np.zeros(size, np.int64)
    for row in arrow_map(tokens.select("ids"), run, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[row.id] = row.n
    return out


def heaviest_terms(ids: np.ndarray, lengths: np.ndarray, weight: np.ndarray, mean: float, k1: float, b: float) -> list[int]:
    """The three heaviest terms of each document as one number; terms without a weight are left out."""
    owner, terms, tf = term_counts(ids, lengths)
    heavy = weight[terms] * tf / (tf + (k1 * (1 - b + b * lengths / mean))[owner])
    keys = np.zeros(len(lengths), np.int64)
    own = np.unique(owner)  # documents with terms
    first = np.searchsorted(owner, own)
    sizes = np.diff(np.append(first, len(owner)))
    for _ in range(3):
        best = np.full(len(lengths), (1 << 16) - 1)
        if len(own):
            most = np.maximum.reduceat(heavy, first)
            at = np.flatnonzero(heavy == np.repeat(most, sizes))
            at = at[np.searchsorted(at, first)]  # the first one of a document
            best[own[most > 0]] = terms[at[most > 0]]
            heavy[at] = 0
        keys = keys << 16 | best
    return keys.tolist()


def deal_by_content(tokens: DataFrame, weight: np.ndarray, mean: float, k1: float, b: float, shards: int, n_docs: int, per_shard: int = 64) -> DataFrame:
    """doc_id, ids and shard: runs of documents in the order of their heaviest terms.

    The cuts are set by the tokens of a sample of about ``per_shard`` documents a shard.
    """
    salted = tokens.select("doc_id", "n", "ids", F.xxhash64("doc_id", "n", "ids").alias("salt"))

    def places(batch: pa.RecordBatch) -> list[tuple[int, int]]:
        keys = heaviest_terms(*joined_ids(batch.column(2)), weight, mean, k1, b)
        return list(zip(keys, batch.column(3).to_pylist(), strict=True))

    def locate(batch: pa.RecordBatch) -> dict:
        return dict(zip(("n", "key", "salt"), (batch.column(1), *zip(*places(batch))), strict=True)) if batch.num_rows else {"n": [], "key": [], "salt": []}

    cuts: list[tuple[int, int]] = []
    if shards > 1:
        one_in = max(1, n_docs // (shards * per_shard))
        # other bits than those that order documents of the same terms
        sample = salted.where(F.pmod(F.xxhash64("salt"), F.lit(one_in)) == 0)
        found = sorted((r.key, r.salt, r.n + 1) for r in arrow_map(sample, locate, "n bigint, key bigint, salt bigint").collect())
        ends = np.cumsum([n for *_, n in found])
        if len(ends):
            at = np.searchsorted(ends, np.arange(1, shards) * ends[-1] / shards)
            cuts = sorted({found[k][:2] for k in at.tolist()})

    def deal(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "ids": batch.column(2), "shard": [bisect_right(cuts, p) for p in places(batch)]}

    return arrow_map(salted, deal, "doc_id bigint, ids binary, shard bigint")


class Rows:
    """The postings of some terms as rows of numbers, one for each document of a shard."""

    def __init__(self, n: int, size: int, kind: type, cached: int = 1 << 18) -> None:
        self.rows = np.zeros((n, size), kind)
        # rows that are summed at once, few enough for a cache
        self.block = np.empty((2 + min(n, cached // max(1, self.rows.itemsize * size)), size), kind)

    def sum(self, picked: np.ndarray) -> np.ndarray:
        """The sum of some rows, added one by one in their order."""
        block, step = self.block, len(self.block) - 1
        block[0] = 0
        for k in range(0, len(picked), step):
            own = picked[k : k + step]
            self.rows.take(own, axis=0, out=block[1 : len(own) + 1], mode="clip")
            block[0] = block[: len(own) + 1].sum(axis=0)
        return block[0]


class Index:
    """BM25 inverted index of a shard."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float, k1: float, b: float) -> None:
        lengths = np.array([len(d) for d in docs], np.int64)
        owner, self.terms, tf = term_counts(np.concatenate(docs or [np.empty(0, np.uint16)]), lengths)
        norm = (k1 * (1 - b + b * lengths / mean)).astype(np.float32)
        self.weights = idf[self.terms] * tf.astype(np.float32) * (k1 + 1) / (tf.astype(np.float32) + norm[owner])
        self.first = np.searchsorted(owner, np.arange(len(docs) + 1))
        by_term = np.argsort(self.terms, kind="stable")
        self.post_doc, self.post_weight = owner[by_term], self.weights[by_term].astype(np.float64)
        self.post_first = np.searchsorted(self.terms[by_term], np.arange((1 << 16) + 1))
        self.size = len(docs)
        # postings of terms that a quarter of the documents have are rows of numbers, at most four for each posting;
        # so are those of one in RARE, in 64 bits like the sums of postings, which are exact in any order
        many = np.diff(self.post_first)
        self.row = np.full(1 << 16, -1)
        self.common = self.take_rows(np.flatnonzero(many * 4 > max(4, self.size)), np.float32)
        self.medium = self.take_rows(np.flatnonzero((many * RARE > max(RARE, self.size)) & (self.row < 0)), np.float64)

    def take_rows(self, terms: np.ndarray, kind: type) -> Rows:
        """A row for each term, numbered by ``row`` behind those there are."""
        self.row[terms] = self.row.max() + 1 + np.arange(len(terms))
        found = Rows(len(terms), self.size, kind)
        for k, t in enumerate(terms.tolist()):
            own = slice(self.post_first[t], self.post_first[t + 1])
            found.rows[k, self.post_doc[own]] = self.post_weight[own]
        return found

    def neighbours(self, doc: int, query_terms: int | None, used: np.ndarray) -> Iterator[int]:
        """Unused documents that share a query term, best first; None asks with all terms."""
        low, high = self.first[doc], self.first[doc + 1]
        if query_terms is not None and high - low > query_terms:
            heavy = low + np.argpartition(-self.weights[low:high], query_terms - 1)[:query_terms]
        else:
            heavy = np.arange(low, high)
        terms = self.terms[heavy]
        if not len(terms):
            return
        row = self.row[terms]
        rare = terms[row < 0].astype(np.int64)
        start = self.post_first[rare]
        many = self.post_first[rare + 1] - start
        # the places of all postings of the rare terms
        place = np.arange(many.sum()) + np.repeat(start - np.cumsum(many) + many, many)
        n = len(self.common.rows)
        scores = np.bincount(self.post_doc[place], self.post_weight[place], self.size) + self.medium.sum(row[row >= n] - n)
        scores += self.common.sum(row[(row >= 0) & (row < n)])
        scores[used] = 0
        found = np.flatnonzero(scores)
        best = 32  # most windows need a few documents only
        while len(found):
            top = found[np.argpartition(-scores[found], best - 1)[:best]] if len(found) > best else found
            yield from top[np.argsort(-scores[top], kind="stable")].tolist()
            scores[top] = 0
            found, best = found[scores[found] > 0], best * 4


def fill_windows(lengths: list[int], index: Index, window: int, query_terms: int | None) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (document, start, length); all but the last one are full."""
    used = np.zeros(len(lengths), bool)
    pieces: list[tuple[int, int, int]] = []
    room, near, fresh = window, iter(()), 0
    while True:
        doc = next((d for d in near if not used[d]), None)
        if doc is None:
            while fresh < len(lengths) and used[fresh]:
                fresh += 1
            if fresh == len(lengths):
                break
            doc = fresh
        used[doc] = True
        start = 0
        seed = not pieces
        while start < lengths[doc]:
            take = min(room, lengths[doc] - start)
            pieces.append((doc, start, take))
            start += take
            room -= take
            if not room:
                yield pieces
                pieces, room, near, seed = [], window, iter(()), True
        if seed and pieces:
            near = index.neighbours(doc, query_terms, used)
    if pieces:
        yield pieces


def powers_of_two(pieces: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The pieces of a window cut into sequences whose lengths are falling powers of two."""
    left = sum(n for _, _, n in pieces)
    sequence, room = [], 0
    for doc, start, n in pieces:
        while n:
            if not room:
                room = 1 << (left.bit_length() - 1)
            take = min(room, n)
            sequence.append((doc, start, take))
            start, n, room, left = start + take, n - take, room - take, left - take
            if not room:
                yield sequence
                sequence = []


PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack_documents(
    docs: DataFrame,
    tokenizer: str | None = None,
    window: int = 2048,
    shard_tokens: int = 2_000_000,
    query_terms: int | None = None,
    k1: float = 1.2,
    b: float = 0.75,
) -> DataFrame:
    """One row per piece: where it is in its document and in its sequence, and its ids (32-bit binary)."""
    tokens = encode_documents(docs, tokenizer or vocabulary_path())
    n_docs, total = tokens.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    seen = document_frequencies(tokens)
    idf = np.log1p((n_docs - seen + 0.5) / (seen + 0.5)).astype(np.float32)
    mean = max(1.0, total / max(1, n_docs))
    shards = max(1, -(-(total + n_docs) // shard_tokens))
    kinds = pa_schema(docs.sparkSession, PIECES)

    def pack(table: pa.Table) -> pa.Table:
        doc_ids, shard = table["doc_id"].to_pylist(), table["shard"][0].as_py()
        texts = table["ids"].to_pylist()
        order = sorted(range(len(texts)), key=lambda k: (doc_ids[k] is not None, doc_ids[k] or 0, texts[k]))
        arrays = [np.frombuffer(texts[k], np.uint16) for k in order]
        index = Index(arrays, idf, mean, k1, b)
        lengths = [len(a) + 1 for a in arrays]
        rows: list[tuple] = []
        sequence = shard << 32
        for pieces in fill_windows(lengths, index, window, query_terms):
            full = sum(n for _, _, n in pieces) == window
            for own in [pieces] if full else powers_of_two(pieces):
                offset = 0
                for doc, start, n in own:
                    ids = arrays[doc][start : start + n].astype("<u4")
                    if start + n == lengths[doc]:
                        ids = np.append(ids, np.uint32(END))
                    rows.append((doc_ids[order[doc]], start, n, ids.astype("<u4").tobytes(), lengths[doc], sequence, offset))
                    offset += n
                sequence += 1
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)

    shared = np.where(seen > 1, idf, 0)
    return deal_by_content(tokens, shared, mean, k1, b, shards, n_docs).groupBy("shard").applyInArrow(pack, PIECES)


def digest_pieces(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
