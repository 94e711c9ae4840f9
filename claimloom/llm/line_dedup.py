"""Removal of repeated passages by content-defined chunks of lines.

A text is cut into lines, and long lines behind their marks, since a passage may stand inside a line. From
each line the shortest run of lines that has ``min_words`` words is a window, and so is the shortest one up
to each line. Every run of lines with so many words is the union of the windows inside it, so two texts
share such a run exactly if they share its windows, wherever it stands and whatever stands around it.

A rolling hash over the lines of half a window says where chunks lie: every window takes the place inside
it whose rolling hash is smallest, and the windows that take the same place make up a chunk, looked up by
that hash. Boundaries depend on what stands there only, and texts that share a window share its chunk's
hash, so no repeat is missed. The hashes are dealt to buckets, packed as arrays; a bucket holds those of
about ``bucket_bytes`` of text. Chunks whose hash occurs again are fetched with their bytes and sorted by it,
and their windows grouped by bytes. Every window but the first of its group (by id, then place) is removed; windows next to each
other make up the whole stretch that agrees. Hashes only choose what is compared: equal hashes of different
lines cost time, not text.
Windows of one text that overlap the first are not removed, so that a line that stands again and again
leaves ``min_words`` words.

What is removed stands earlier in the corpus too, so one copy of each line of a passage stays. A passage
itself may be left in parts: of the texts ``X Y``, ``X Y Z`` and ``Y Z`` stay ``X Y`` and ``Z``. Lines are
compared without the white space around them. Null texts stay null; empty texts stay. Rows that agree in
id and text share their fate: none is a repeat of the other. Null ids come first. Extra columns pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import arrow_map, pa_schema, slices, unused, utf8

U = np.uint64
BASE = 0x9E3779B97F4A7C15
MARKS = (b".", b",", b";", b":", b"!", b"?")
CUTS = re.compile(rb"(?<=\n)|(?<=[.,;:!?] )")


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def cut_lines(text: bytes) -> list[bytes]:
    """Lines, and parts of lines that end with a mark; joined they are the text."""
    if b"\0" in text:
        return [u for u in CUTS.split(text) if u]
    for mark in MARKS:
        text = text.replace(mark + b" ", mark + b" \0")
    units = text.replace(b"\n", b"\n\0").split(b"\0")
    return units if units[-1] else units[:-1]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[:1] = 1
    return np.cumprod(out, dtype=U)


def _run_hashes(hashes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Rolling hashes of runs of lines from the hashes of the lines, a polynomial in an odd base modulo 2 ** 64."""
    sums = np.concatenate([np.zeros(1, U), np.cumsum(mixed(hashes ^ U(BASE)) * _powers(BASE, len(hashes)), dtype=U)])
    back = _powers(pow(BASE, -1, 1 << 64), len(hashes))
    return mixed((sums[high] - sums[low]) * back[low] + (high - low).astype(U))


def _windows(units: Sequence[Sequence[bytes]], min_words: int) -> tuple[np.ndarray, ...]:
    """Windows of some texts, by the numbers of all their lines: first line and the one behind the last; how
    many words stand before each line, and the text and first line of the text of each line."""
    sizes = np.array([len(u) for u in units], np.int64)
    n = int(sizes.sum())
    words = np.concatenate([[0], np.cumsum(np.fromiter((len(line.split()) for u in units for line in u), np.int64, n))])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    first = (np.cumsum(sizes) - sizes)[owner]
    line, least = np.arange(n), max(1, min_words)
    # the shortest run from each line, and the shortest run up to each line
    last = np.searchsorted(words[1:], words[:-1] + least)
    ends = last < first + sizes[owner]
    start = np.searchsorted(words, words[1:] - least, "right") - 1
    starts = start >= first
    starts[starts] = last[start[starts]] != line[starts]
    return np.concatenate([line[ends], start[starts]]), np.concatenate([last[ends], line[starts]]) + 1, words, owner, first


def chunk_batch(units: Sequence[Sequence[bytes]], min_words: int) -> tuple[np.ndarray, ...]:
    """Chunks of some texts: text number, first line, the one behind the last, and the hash of each chunk."""
    from xxhash import xxh3_64_intdigest

    low, high, words, owner, first = _windows(units, min_words)
    if not len(low):
        return low, low, low, low.view(U)
    n = len(owner)
    hashes = np.fromiter((xxh3_64_intdigest(line.strip()) for u in units for line in u), U, n)
    # the shortest run from each line with half the words; each window has one, from its first line on
    behind = np.searchsorted(words[1:], words[:-1] + max(1, min_words // 2)) + 1
    value = _run_hashes(hashes, np.arange(n), np.minimum(behind, n))
    # of the runs inside a window the one of the smallest hash, of equal ones the first
    ranked = np.append((value >> U(32) << U(32)) | np.arange(n, dtype=U), U(0))
    until = np.searchsorted(behind, high, "right")
    place = (np.minimum.reduceat(ranked, np.stack([low, until], 1).ravel())[::2] & U(0xFFFFFFFF)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], np.diff(place[order]) > 0]))
    low, high, place = np.minimum.reduceat(low[order], heads), np.maximum.reduceat(high[order], heads), place[order][heads]
    return owner[place], low - first[place], high - first[place], value[place]


PACKED = {"hash": np.uint64, "id": np.int64, "key": np.int64, "low": np.int32, "high": np.int32}


def _packed_chunks(keyed: DataFrame, min_words: int, buckets: int) -> DataFrame:
    """The chunks of each batch of texts, one row for each bucket with their columns as binary."""

    def run(batch: pa.RecordBatch) -> dict | None:
        owner, low, high, value = chunk_batch([cut_lines(t) for t in utf8(batch)], min_words)
        if not len(owner):
            return None
        bucket = (value % U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        ids, keys = (batch.column(k).to_numpy()[owner] for k in (0, 1))
        columns = {"hash": value, "id": ids, "key": keys, "low": low, "high": high}
        bucket = bucket[order]
        new = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        ends = np.append(new[1:], len(bucket)).tolist()
        out: dict = {"bucket": bucket[new]}
        for name, kind in PACKED.items():
            column = columns[name][order].astype(kind)
            out[name] = [column[a:b].tobytes() for a, b in zip(new.tolist(), ends, strict=True)]
        return out

    return arrow_map(keyed, run, "bucket int, " + ", ".join(f"{name} binary" for name in PACKED))


def _again(table: pa.Table) -> pa.Table:
    """The chunks of a bucket whose hashes occur more than once."""
    columns = {name: np.frombuffer(b"".join(table[name].to_pylist()), kind) for name, kind in PACKED.items()}
    order = np.argsort(columns["hash"])
    value = columns["hash"][order]
    same = np.concatenate([[False], value[1:] == value[:-1], [False]])
    order = order[same[1:] | same[:-1]]
    columns["hash"] = columns["hash"].view(np.int64)
    return pa.table({name: columns[name][order] for name in PACKED})


def _asked_chunks(hit: DataFrame, row: str, key: str, chunks: str) -> DataFrame:
    """The chunks that are asked for, with the bytes of their lines."""

    def run(batch: pa.RecordBatch) -> dict | None:
        ids, keys, asked = (batch.column(batch.schema.get_field_index(name)).to_pylist() for name in (row, key, chunks))
        rows = []
        for k, text in enumerate(utf8(batch)):
            lines = [u.strip() for u in cut_lines(text)]
            rows += [(c["hash"], ids[k], keys[k], c["low"], b"\n".join(lines[c["low"] : c["high"]])) for c in asked[k]]
        return dict(zip(("hash", "id", "key", "low", "body"), zip(*rows, strict=True), strict=True)) if rows else None

    return arrow_map(hit, run, "hash bigint, id bigint, key bigint, low int, body binary")


def _repeats(found: DataFrame, min_words: int) -> DataFrame:
    """The ranges of lines that stand earlier too: windows of chunks of one hash, told apart by their bytes.

    The chunks of a hash come one after the other, the first ones first; only its distinct windows are kept.
    """
    spans = "id bigint, key bigint, low int, high int"
    kinds = pa_schema(found.sparkSession, spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, heads = None, {}
        for batch in slices(batches):
            hashes, ids, keys, lows = (batch.column(k).to_pylist() for k in range(4))
            lines = [body.split(b"\n") for body in batch.column(4).to_pylist()]
            low, high, _, owner, first = _windows(lines, min_words)
            order = np.lexsort([high, low])
            low, high = low[order], high[order]
            own, first = owner[low], first[low]
            out: list[list] = []
            for r, a, b in zip(own.tolist(), (low - first).tolist(), (high - first).tolist(), strict=True):
                if hashes[r] != now:
                    now, heads = hashes[r], {}
                i, k, a, b, body = ids[r], keys[r], lows[r] + a, lows[r] + b, b"\n".join(lines[r][a:b])
                head = heads.setdefault(body, (i, k, b))
                if head[0] != i or head[1] != k or a >= head[2]:
                    if out and out[-1][0] == i and out[-1][1] == k and out[-1][2] <= a <= out[-1][3]:
                        out[-1][3] = max(out[-1][3], b)
                    else:
                        out.append([i, k, a, b])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), kinds, strict=True)], schema=kinds)

    return found.repartition("hash").sortWithinPartitions("hash", "id", "key", "low").mapInArrow(run, spans)


def _row_names(docs: DataFrame) -> tuple[Column, Column]:
    """Two numbers that rows share if they agree in id and text, in the order of ids, nulls first."""
    doc_id = F.col("doc_id")
    return F.coalesce(doc_id, F.lit(-(1 << 63))).cast("long"), F.xxhash64(F.col("text"), doc_id.isNull())


def matched_lines(keyed: DataFrame, min_words: int = 20, bucket_bytes: int = 16 << 20, row: str = "id", key: str = "key") -> DataFrame:
    """id, key, spans: per document (named by two columns, see ``_row_names``) the ranges of lines that are repeats."""
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    packed = _packed_chunks(keyed.select(F.col(row).alias("id"), F.col(key).alias("key"), "text"), min_words, 1 + size // bucket_bytes)
    again = packed.groupBy("bucket").applyInArrow(_again, "hash bigint, id bigint, key bigint, low int, high int")
    chunks = unused(keyed, "chunks")
    asked = again.groupBy(F.col("id").alias(row), F.col("key").alias(key)).agg(F.collect_set(F.struct("hash", "low", "high")).alias(chunks))
    # all columns of the texts go along, so that Spark shuffles them once for this join and that of the spans
    spans = _repeats(_asked_chunks(keyed.join(asked, [row, key]), row, key, chunks), min_words)
    return spans.groupBy("id", "key").agg(F.sort_array(F.collect_set(F.struct("low", "high"))).alias("spans"))


def keep_lines(text: bytes, spans: Sequence[dict], min_words: int) -> tuple[bytes, int, int]:
    """A text without its matched runs; how many lines and words have gone."""
    units = cut_lines(text)
    gone = bytearray(len(units))
    for s in spans:
        gone[s["low"] : s["high"]] = b"\1" * (s["high"] - s["low"])
    out, lines, words, k = [], 0, 0, 0
    while k < len(units):
        end = k + 1
        while end < len(units) and gone[end] == gone[k]:
            end += 1
        run = b"".join(units[k:end])
        count = len(run.split()) if gone[k] else 0
        if gone[k] and count >= min_words:
            lines += end - k
            words += count
        else:
            out.append(run)
        k = end
    return b"".join(out), lines, words


def drop_repeated_lines(docs: DataFrame, min_words: int = 20) -> DataFrame:
    """The documents with their repeated passages removed.

    Adds ``removed_lines`` and ``removed_words`` (longs); columns of these names are replaced.
    """
    docs = docs.drop("removed_lines", "removed_words")
    names = docs.columns
    row, key, lines = unused(docs, "row"), unused(docs, "key"), unused(docs, "spans")
    doc_id, text_key = _row_names(docs)
    keyed = docs.withColumns({row: doc_id, key: text_key})
    spans = matched_lines(keyed, min_words, row=row, key=key).select(F.col("id").alias(row), F.col("key").alias(key), F.col("spans").alias(lines))
    both = keyed.join(spans, [row, key], "left").select(*names, lines)
    place = names.index("text")

    def run(batch: pa.RecordBatch) -> dict:
        columns = {n: batch.column(k) for k, n in enumerate(names)}
        spans = batch.column(len(names))
        texts = columns["text"].cast(pa.binary()).to_pylist()
        lines, words = [0] * len(texts), [0] * len(texts)
        for k in np.flatnonzero(spans.is_valid().to_numpy(zero_copy_only=False)).tolist():
            if texts[k] is not None:
                texts[k], lines[k], words[k] = keep_lines(texts[k], spans[k].as_py(), min_words)
        columns["text"] = pa.array(texts, pa.binary()).cast(pa.string())
        return columns | {"removed_lines": lines, "removed_words": words}

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    fields[place] = "text string"
    return arrow_map(both, run, ", ".join([*fields, "removed_lines bigint", "removed_words bigint"]))
