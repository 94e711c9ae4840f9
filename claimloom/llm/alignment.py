"""Cross-tokenizer alignment: how the tokens of one vocabulary meet those of another, and how often.

Tokenizer A is a byte-level BPE, B a sentence-piece BPE that writes a space before the text. Both spell the
bytes of a space and the text; where a token of A and a token of B end at the same byte, a group ends. Tokens
whose bytes overlap are linked.

The links are counted with inverted pair bitmaps. Documents are numbered within blocks, which a task closes
after ``most`` postings or 65,536 documents. A block holds for each pair of token ids one row, a posting: the
compressed bitmap of the documents that link the pair (16-bit numbers, or bits if these are fewer bytes), and
multiplicity planes: over those documents, bit k of the number of links less one. Batches are OR-merged
within their block. Blocks share no documents, so the popcounts of a pair's postings add up to its
documents, and those of its planes to its links. The counts go back to the postings, and a posting
returns them to its documents; a task scores one block at a time, which is bounded.

Both tokenizers work word by word here: neither has a token that goes on behind a letter with a space or a
line feed. A word with what stands before it is encoded and aligned once and remembered while it is among
those used most; where a vocabulary breaks this rule, texts are taken whole. Words of A are encoded by the
rank file beside its JSON file where both hold the same vocabulary, long words and whole texts by the JSON file.

Every row is a document of its own, repeated rows and null ids too. Texts that are null, empty, not UTF-8,
or whose tokens do not spell a space and the text, have no tokens: zeros and an empty digest. Texts of any
length are read whole. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, compress, count, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import pa_schema, slices, utf8, worker_memory
from claimloom.llm.packing import byte_letters, vocabulary_path
from claimloom.session import stored

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
WORDS = re.compile(r"(?<=\S)(?=[ \n]\S)")  # where a word starts
SPACES = re.compile(r"(\s(?:\s+|\Z))")  # white space in which none starts
ALONE = re.compile(r"[ \n]\S(?:.*\S)?", re.DOTALL)  # may be encoded with others like it
DOCUMENT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
POSTING = "pair bigint, n bigint, links bigint, dense boolean, docs binary, planes array<binary>"
BLOCKS = f"block bigint, place int, {DOCUMENT}, {POSTING}"
MANY = 1 << 16
LONG = 64  # words with more links are not kept when others need their room
FAR = 1000  # longer words are encoded alone


def ramp(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each length, one run behind the other."""
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def rank_encoder(path: str, names: list[bytes]):
    """The tokenizer of the rank file beside a byte-level JSON file, which is faster; None if it is not the same."""
    file, made = Path(path).with_suffix(".tiktoken"), json.loads(Path(path).read_text())
    cut = made.get("pre_tokenizer") or {}
    if not file.exists() or made.get("normalizer") or cut.get("type") != "ByteLevel" or cut["add_prefix_space"] or not cut.get("use_regex", True):
        return None
    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file.read_bytes().splitlines() if line)}
    joined = [bytes(chain.from_iterable(names[made["model"]["vocab"][t]] for t in (m.split(" ") if isinstance(m, str) else m))) for m in made["model"]["merges"]]
    if ranks != {names[k]: k for k in made["model"]["vocab"].values()} or joined != sorted((t for t in ranks if len(t) > 1), key=ranks.get):
        return None
    import tiktoken
    from public_tokenizers import PATTERN

    return tiktoken.Encoding(file.stem, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Aligner:
    """Both tokenizers, and the alignment of the words met so far (about ``most``, those used most often)."""

    def __init__(self, path_a: str, path_b: str, most: int = 200_000) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        if max(self.a.get_vocab_size(), self.b.get_piece_size()) > MANY:
            raise ValueError("token ids must fit in 16 bits")
        letters = {c: bytes([k]) for k, c in enumerate(byte_letters())}
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, number in self.a.get_vocab().items():
            self.bytes_a[number] = b"".join([letters.get(c, c.encode()) for c in token])
        self.ranks = rank_encoder(path_a, self.bytes_a)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        self.by_word = not any(re.search("[^▁]▁|\n", p) for p in pieces)
        self.space = self.b.piece_to_id("▁")
        # ids of A, then of B, in pairs: within a group, and at the end of its tokens of A or B
        self.names = [f"{k}{mark}".encode() for last in "|;" for k in range(MANY) for mark in (",", last)]
        self.name_sizes = np.array([len(n) for n in self.names], np.int64)
        self.most = most
        self.known: defaultdict[str, int] = defaultdict()  # -1: the tokens of B do not spell the word
        self.kept: list[str] = []  # the words with groups, as they are numbered
        self.groups: list[bytes] = []
        self.pairs, self.first = array("I"), array("q", [0])
        self.counts = array("i")  # tokens of A, of B, and groups of each word
        self.uses = array("q")

    def forget(self) -> None:
        """Keep three quarters of ``most`` words, those used most often; uses fade by half each time."""
        first, uses = np.array(self.first), np.array(self.uses)
        n_links = np.diff(first)
        kept = np.argsort(-uses, kind="stable")[: self.most * 3 // 4]
        kept = np.sort(kept[n_links[kept] <= LONG])
        numbers = kept.tolist()
        self.kept = list(map(self.kept.__getitem__, numbers))
        self.known = defaultdict(None, zip(self.kept, range(len(numbers)), strict=True))
        self.groups = list(map(self.groups.__getitem__, numbers))
        links = np.repeat(first[kept], n_links[kept]) + ramp(n_links[kept])
        self.pairs = array("I", np.array(self.pairs)[links].tobytes())
        self.first = array("q", np.concatenate([[0], np.cumsum(n_links[kept])]).astype(np.int64).tobytes())
        self.counts = array("i", np.array(self.counts).reshape(-1, 3)[kept].tobytes())
        self.uses = array("q", (uses[kept] // 2).tobytes())

    def words(self, text: str) -> list[str]:
        """A space and the text, cut before each word that starts where both tokenizers start anew."""
        text = " " + text
        if not self.by_word:
            return [text]
        if "\0" in text:
            return WORDS.split(text)
        parts = SPACES.split(text)
        parts[::2] = [p.replace(" ", "\0 ").replace("\n", "\0\n") for p in parts[::2]]
        return "".join(parts).removeprefix("\0").split("\0")

    def encode_b(self, words: list[str]) -> list[list[int]]:
        found = self.b.encode([w[1:] if w[0] == " " else w for w in words], num_threads=1) if words else []
        for k, word in enumerate(words):
            if word[0] != " ":  # without the space that B puts before it
                found[k] = found[k][1:] if found[k][0] == self.space else []
        return found

    def learn(self, words: list[str], apart: set[str]) -> None:
        """Encode and align words, all at once; those ``apart`` may not be encoded behind another word."""
        apart = apart.union([w for w in words if len(w) > FAR])
        words = [w for w in words if w not in apart] + [w for w in words if w in apart]
        of_b, plain = self.encode_b(words), list(map(str.encode, words))
        sizes = np.fromiter(map(len, plain), np.int64, len(plain))
        ids_b = np.fromiter(chain.from_iterable(of_b), np.int64)
        ends = np.cumsum(np.fromiter(map(len, of_b), np.int64, len(of_b)))
        spelt = np.concatenate([[0], np.cumsum(self.size_b[ids_b])])[np.concatenate([[0], ends])]
        if (np.diff(spelt) != sizes).any() or b"".join(map(self.bytes_b.__getitem__, ids_b.tolist())) != b"".join(plain):
            right = [b"".join([self.bytes_b[i] for i in ids]) == w for ids, w in zip(of_b, plain, strict=True)]
            self.known.update((w, -1) for w, r in zip(words, right, strict=True) if not r)
            words, sizes = [w for w, r in zip(words, right, strict=True) if r], sizes[right]
            ids_b = np.fromiter(chain.from_iterable(compress(of_b, right)), np.int64)
        if not words:
            return
        joined = len(words) - sum(w in apart for w in words) if self.by_word else 0
        texts = ["".join(words[k : min(k + 256, joined)]) for k in range(0, joined, 256)]
        of_a = [np.empty(0, np.int64)]
        if self.ranks:
            of_a += [self.ranks.encode_to_numpy(t, disallowed_special=()) for t in texts]
            texts = []
        of_a += [e.ids for e in self.a.encode_batch_fast(texts + words[joined:], add_special_tokens=False)]
        self.align(words, sizes, np.concatenate(of_a).astype(np.int64), ids_b)

    def align(self, words: list[str], sizes: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> None:
        """Add words whose tokens stand one behind the other."""
        ends, end_a, end_b = np.cumsum(sizes), np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        sides = [np.zeros(int(ends[-1]) + 1, bool) for _ in range(3)]
        for side, at in zip(sides, (ends, end_a, end_b), strict=True):
            side[at[at <= ends[-1]]] = True
        cut = sides[1] & sides[2]
        if not (cut[ends].all() and end_a[-1] == end_b[-1] == ends[-1]):
            raise ValueError("a vocabulary does not spell its words")
        # how many words, tokens of A, of B, and groups end up to each byte
        n_words, n_a, n_b, n_cuts = (np.cumsum(x) for x in (*sides, cut))
        cuts = np.flatnonzero(cut)
        low, high = n_b[end_a - self.size_a[ids_a]], n_b[end_a - 1] + 1
        of_a = np.repeat(np.arange(len(ids_a)), high - low)
        self.pairs.frombytes((ids_a[of_a] << 16 | ids_b[np.repeat(low, high - low) + ramp(high - low)]).astype(np.uint32).tobytes())
        word_a, word_b, word_cut = (n_words[x - 1] for x in (end_a, end_b, cuts))
        self.first.frombytes((self.first[-1] + np.cumsum(np.bincount(word_a, high - low, len(words)).astype(np.int64))).tobytes())
        numbers = [np.bincount(x, minlength=len(words)) for x in (word_a, word_b, word_cut)]
        self.counts.frombytes(np.stack(numbers, 1).astype(np.int32).tobytes())
        self.uses.extend([0] * len(words))

        # the tokens of a group in the order of their names, each with the mark behind it
        cut_a, cut_b = n_cuts[end_a - 1], n_cuts[end_b - 1]
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        codes[np.arange(len(ids_a)) + np.concatenate([[0], n_b[cuts]])[cut_a]] = 2 * ids_a + cut[end_a]
        codes[np.arange(len(ids_b)) + n_a[cuts][cut_b]] = 2 * (ids_b + MANY) + cut[end_b]
        said = b"".join(map(self.names.__getitem__, codes.tolist()))
        until = np.cumsum(self.name_sizes[codes])[np.cumsum(numbers[0] + numbers[1]) - 1].tolist()
        self.known.update(zip(words, range(len(self.kept), len(self.kept) + len(words)), strict=True))
        self.kept += words
        self.groups += [said[start:end] for start, end in zip([0, *until], until, strict=False)]

    def documents(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Tokens of A, of B, groups and links of each text; digests of the groups; all links as (text, pair)."""
        cut = [self.words(t) if t else [] for t in texts]
        met, start = len(self.known), len(self.kept)
        self.known.default_factory = count(start).__next__  # others take the next numbers
        places = [list(map(self.known.__getitem__, words)) for words in cut]
        self.known.default_factory = None
        new = list(islice(reversed(self.known), len(self.known) - met))[::-1]
        apart = {w for words in cut if words for w in (words[0], words[-1]) if not ALONE.fullmatch(w)}
        self.learn(new, apart.intersection(new))
        learned = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))
        at = np.fromiter(chain.from_iterable(places), np.int64)
        at[at >= start] = learned[at[at >= start] - start]
        lengths = np.array([len(p) for p in places], np.int64)
        if (at < 0).any():
            parts = np.split(at, np.cumsum(lengths)[:-1])
            parts = [np.array(self.unlike(t), np.int64) if (p < 0).any() else p for t, p in zip(texts, parts, strict=True)]
            at, lengths = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        # each word ends with a mark, the last one is left out
        said, ends = list(map(self.groups.__getitem__, at.tolist())), np.cumsum(lengths).tolist()
        digests = [hashlib.sha256(b"".join(said[low:high])[:-1]).hexdigest() if high > low else "" for low, high in zip([0, *ends], ends, strict=False)]
        first, counts, pairs = np.array(self.first), np.array(self.counts).reshape(-1, 3), np.array(self.pairs)
        uses = np.frombuffer(self.uses, np.int64)
        uses += np.bincount(at, minlength=len(uses))
        n_links = np.diff(first)[at]
        some, sums = lengths > 0, np.zeros((len(texts), 4), np.int64)
        if len(at):
            begin = (np.cumsum(lengths) - lengths)[some]
            sums[some] = np.stack([np.add.reduceat(x, begin, dtype=np.int64) for x in (*(c[at] for c in counts.T), n_links)], 1)
        del uses
        if len(self.known) > self.most:
            self.forget()
        return sums, digests, np.repeat(np.arange(len(texts)), sums[:, 3]), pairs[np.repeat(first[at], n_links) + ramp(n_links)].astype(np.int64)

    def unlike(self, text: str) -> list[int]:
        """A text with a word that B does not spell, taken whole; none if its tokens do not spell it."""
        whole = " " + text
        if self.known.get(whole, -1) < 0:
            ids_a, ids_b, plain = self.a.encode(whole, add_special_tokens=False).ids, self.b.encode(text), whole.encode()
            if any(b"".join([names[i] for i in ids]) != plain for names, ids in ((self.bytes_a, ids_a), (self.bytes_b, ids_b))):
                return []
            self.align([whole], np.array([len(plain)]), np.array(ids_a, np.int64), np.array(ids_b, np.int64))
        return [self.known[whole]]


def aligner(path_a: str, path_b: str) -> Aligner:
    """The one of this process; workers that are used again keep it from task to task."""
    memory, key = worker_memory(), ("aligner", path_a, path_b)
    if key not in memory:
        memory[key] = Aligner(path_a, path_b)
    return memory[key]


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct numbers with the sums of their counts."""
    numbers, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(numbers, kind="stable")
    numbers, counts = numbers[order], counts[order]
    first = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])) if len(numbers) else np.empty(0, np.int64)
    return numbers[first], np.add.reduceat(counts, first) if len(first) else counts


def binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data, np.uint8))])


def pack_postings(keys: np.ndarray, counts: np.ndarray, documents: int) -> dict[str, pa.Array | np.ndarray]:
    """The postings of a block from sorted keys, pair << 16 | document, and numbers of links."""
    pairs, docs = keys >> 16, (keys & 0xFFFF).astype("<u2")
    first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
    n = np.diff(np.append(first, len(keys)))
    row = np.repeat(np.arange(len(first)), n)
    bits = -(-documents // 8)
    dense = 2 * n > bits
    sizes = np.where(dense, bits, 2 * n)
    start = np.cumsum(sizes) - sizes
    data = np.zeros(int(sizes.sum()), np.uint8)
    few = ~dense[row]
    at = start[row[few]] + 2 * ramp(n[~dense])
    data[at], data[at + 1] = docs[few] & 0xFF, docs[few] >> 8
    for k in np.flatnonzero(dense).tolist():
        seen = np.zeros(8 * bits, bool)
        seen[docs[first[k] : first[k] + n[k]]] = True
        data[start[k] : start[k] + bits] = np.packbits(seen)

    more = counts - 1
    widest = np.maximum.reduceat(more, first)
    rank, planes, owners = ramp(n), [], []
    for k in range(int(widest.max()).bit_length()):
        with_plane = widest >> k > 0
        plane_sizes = np.where(with_plane, -(-n // 8), 0)
        plane = np.zeros(8 * int(plane_sizes.sum()), bool)
        on = more >> k & 1 > 0
        plane[(8 * (np.cumsum(plane_sizes) - plane_sizes))[row[on]] + rank[on]] = True
        planes.append(binaries(np.packbits(plane), plane_sizes[with_plane]))
        owners.append(np.flatnonzero(with_plane))
    owner = np.concatenate(owners or [np.empty(0, np.int64)])
    flat = pa.concat_arrays(planes).take(pa.array(np.argsort(owner, kind="stable"))) if planes else pa.array([], pa.binary())
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(n)))]).astype(np.int32)), flat)
    return {"pair": pairs[first], "n": n, "links": np.add.reduceat(counts, first), "dense": dense, "docs": binaries(data, sizes), "planes": lists}


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column, and where each value starts."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.empty(0, np.uint8)
    return data, offsets[:-1].astype(np.int64)


def unpack_postings(dense: np.ndarray, n: np.ndarray, docs: pa.Array, planes: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, document, links) of all documents of some postings."""
    data, start = flat_bytes(docs)
    sizes = np.diff(np.append(start, start[-1] + len(docs[-1].as_py()))) if len(start) else start
    first = np.cumsum(n) - n
    row = np.repeat(np.arange(len(n)), n)
    found = np.empty(int(n.sum()), np.int64)
    few = ~dense[row]
    at = start[row[few]] + 2 * ramp(n[~dense])
    found[few] = data[at].astype(np.int64) | data[at + 1].astype(np.int64) << 8
    for k in np.flatnonzero(dense).tolist():
        found[first[k] : first[k] + n[k]] = np.flatnonzero(np.unpackbits(data[start[k] : start[k] + sizes[k]]))
    links = np.ones(len(found), np.int64)
    per_row = np.diff(np.array(planes.offsets))
    owner, level = np.repeat(np.arange(len(n)), per_row), ramp(per_row)
    if len(owner):
        data, start = flat_bytes(planes.flatten())
        bits = np.unpackbits(data)
        wide = n[owner]
        at = np.repeat(8 * start, wide) + ramp(wide)
        np.add.at(links, np.repeat(first[owner], wide) + ramp(wide), bits[at].astype(np.int64) << np.repeat(level, wide))
    return row, found, links


def align_documents(docs: DataFrame, path_a: str, path_b: str, most: int = 1_000_000) -> DataFrame:
    """A row per document and a row per posting, see BLOCKS; the first have no pair, the second no place."""
    kinds = pa_schema(docs.sparkSession, BLOCKS)

    def rows(columns: dict, count: int) -> pa.RecordBatch:
        arrays = [columns[f.name] if isinstance(columns.get(f.name), pa.Array) else pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(count, f.type) for f in kinds]
        return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, kinds, strict=True)], schema=kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(path_a, path_b)
        block, documents, parts, held = TaskContext.get().partitionId() << 32, 0, [], 0

        def closed() -> Iterator[pa.RecordBatch]:
            keys, counts = merged(parts) if parts else (np.empty(0, np.int64),) * 2
            if len(keys):
                packed = pack_postings(keys, counts, documents)
                packed["block"] = np.full(len(packed["pair"]), block)
                whole = rows(packed, len(packed["pair"]))
                yield from (whole.slice(k, 50_000) for k in range(0, whole.num_rows, 50_000))

        for batch in slices(batches, 2 << 20):
            for start in range(0, batch.num_rows, 16_384):
                part = batch.slice(start, 16_384)
                if documents and (held > most or documents + part.num_rows > MANY):
                    yield from closed()
                    block, documents, parts, held = block + 1, 0, [], 0
                texts = []
                for text in utf8(part):
                    try:
                        texts.append(text.decode())
                    except UnicodeDecodeError:
                        texts.append(None)
                sums, digests, owner, pairs = tool.documents(texts)
                place = np.arange(documents, documents + len(texts))
                columns = dict(zip(("n_a", "n_b", "n_groups", "n_links"), sums.T, strict=True))
                yield rows(columns | {"block": np.full(len(texts), block), "place": place, "doc_id": part.column(0), "groups_sha256": digests}, len(texts))
                parts.append(tuple(np.unique(pairs << 16 | place[owner], return_counts=True)))
                held += len(parts[-1][0])
                if len(parts) > 8:  # OR-merge, so that the same words are held once
                    parts = [merged(parts)]
                documents += len(texts)
        yield from closed()

    return docs.select("doc_id", "text").mapInArrow(run, BLOCKS)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, a, b, documents and links of each linked pair of ids, and whether no other B is in more documents of that A."""
    counts = blocks.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("documents"), F.sum("links").alias("links"))
    split = counts.withColumns({"a": F.shiftright("pair", 16).cast("int"), "b": F.col("pair").bitwiseAND(MANY - 1).cast("int")})
    split = stored(split, "align-counts")
    highest = split.groupBy("a").agg(F.max("documents").alias("highest"))
    return split.join(highest, "a").select("pair", "a", "b", "documents", "links", (F.col("documents") == F.col("highest")).alias("best"))


def score_blocks(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """block, place, n_best and count_sum of each document with links: what its postings return."""
    schema = "block bigint, place int, n_best bigint, count_sum bigint"
    kinds = pa_schema(blocks.sparkSession, schema)

    def score(table: pa.Table) -> pa.Table:
        worker_memory().clear()  # the words are not needed any more
        table = table.combine_chunks()
        one = {name: table[name].chunk(0) for name in table.column_names}
        row, docs, links = unpack_postings(np.array(one["dense"]), np.array(one["n"]), one["docs"], one["planes"])
        sums = np.zeros((int(docs.max()) + 1, 3), np.int64)
        np.add.at(sums[:, 0], docs, 1)
        np.add.at(sums[:, 1], docs, links * np.array(one["best"])[row])
        np.add.at(sums[:, 2], docs, links * np.array(one["documents"])[row])
        place = np.flatnonzero(sums[:, 0])
        columns = [np.full(len(place), one["block"][0].as_py()), place, sums[place, 1], sums[place, 2]]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)

    postings = blocks.where("pair IS NOT NULL").select("block", "pair", "n", "dense", "docs", "planes")
    joined = postings.join(counts.select("pair", "documents", "best"), "pair").drop("pair")
    return joined.groupBy("block").applyInArrow(score, schema)


def align_tokenizers(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, most: int = 1_000_000) -> DataFrame:
    """One row per document: its tokens, groups and links, and what its links are worth in the whole corpus."""
    blocks = stored(align_documents(docs, path_a or vocabulary_path(BYTE_LEVEL), path_b or vocabulary_path(PIECES), most), "align-blocks")
    scores = score_blocks(blocks, pair_counts(blocks))
    known = blocks.where("pair IS NULL").select("block", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = F.lit(0).cast("long")
    found = known.join(scores, ["block", "place"], "left")
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"
    )
