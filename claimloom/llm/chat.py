"""Chat formatting at token level.

Every turn becomes ``TURN role BODY text END``. Roles and texts are encoded separately by a lossless
byte-level tokenizer; TURN, BODY and END are reserved ids above its vocabulary, which no text can give.
In rendered text they are control strings, so those are escaped inside texts: a backslash goes behind
their first character, and backslashes are doubled. The loss mask marks the text of assistant turns: a
marker opens behind BODY, another closes at END, and the prefix sum of the markers is the mask.

Null texts and roles are empty. Turns are ordered by number, nulls first, then by role and token ids;
repeated rows stay, each as a turn. A null conversation id is a conversation of its own. Turns of any
length are encoded whole. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import pa_schema, running_start, slices

VOCABULARY = "byte_bpe_50k.json"
#: Control strings, in the order of the reserved ids.
CONTROL = ("<turn>", "<body>", "</turn>")
TURN, BODY, END = range(3)
TO_ESCAPE = re.compile(r"\\|<(?=turn>|body>|/turn>|\|endoftext\|>)")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return TO_ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else "<\\", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def loss_mask(ids: np.ndarray, first: int, trained: bool) -> np.ndarray:
    """1 for tokens between BODY and END of a trained turn."""
    markers = np.zeros(len(ids) + 1, np.int8)
    if trained:
        markers[1:] += ids == first + BODY
        markers[:-1] -= ids == first + END
    return np.cumsum(markers[:-1], dtype=np.int8)


def format_turns(conversations: DataFrame, tokenizer: str | None = None, trained_role: str = "assistant") -> DataFrame:
    """One row per turn: its token ids, its loss mask and where it starts in its conversation.

    The turns of a conversation, laid end to end by ``start``, are its token sequence. Starts come from
    the sums of ranges of 256 turn numbers, so that a conversation is not sorted by one task.
    """
    path = tokenizer or vocabulary_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load_tokenizer(path)
        first = codec.get_vocab_size()
        for batch in slices(batches, 1 << 20):
            roles = [r or "" for r in batch.column(2).to_pylist()]
            texts = [escape(t or "") for t in batch.column(3).to_pylist()]
            names = {r: codec.encode(escape(r), add_special_tokens=False).ids for r in set(roles)}
            ids, masks = [], []
            for role, encoded in zip(roles, codec.encode_batch(texts, add_special_tokens=False), strict=True):
                ids.append(np.array([first + TURN, *names[role], first + BODY, *encoded.ids, first + END], np.int32))
                masks.append(loss_mask(ids[-1], first, role == trained_role))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(roles), pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int8())), pa.array([len(i) for i in ids], pa.int64())],
                names=["conv_id", "turn", "role", "input_ids", "loss_mask", "n_tokens"],
            )

    rows = conversations.select("conv_id", "turn", "role", "text")
    schema = "conv_id bigint, turn bigint, role string, input_ids array<int>, loss_mask array<tinyint>, n_tokens bigint"
    rows = rows.mapInArrow(encode, schema).select(
        "*",
        F.coalesce(F.concat(F.lit("0"), F.col("conv_id").cast("string")), F.lit("1")).alias("conv_key"),
        F.coalesce(F.floor(F.col("turn") / 256), F.lit(-(1 << 62))).alias("turns"),
    )
    laid = running_start(rows, ["conv_key"], "turns", ["turn", "role", "input_ids"], "n_tokens", "start")
    return laid.select("conv_id", "turn", "start", "n_tokens", "input_ids", "loss_mask")


class _Reader:
    """Digests of one conversation's tokens, fed turn by turn."""

    def __init__(self) -> None:
        self.turns, self.loss, self.n_turns, self.loss_chars, self.formatted = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def add(self, role: str, text: str, masked: str) -> None:
        self.formatted += sum(map(len, CONTROL)) + len(role) + len(text)
        self.n_turns += 1
        self.turns.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
        loss = unescape(masked)
        self.loss_chars += len(loss)
        self.loss.update(loss.encode())

    def row(self, conv_id) -> tuple:
        return conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted


def read_back(turns: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """What the token sequences say, per conversation: turns, loss text and rendered length.

    Tokens are decoded turn by turn as they stream by in order; of a conversation only running digests
    are kept.
    """
    path = tokenizer or vocabulary_path()
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    kinds = pa_schema(turns.sparkSession, schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load_tokenizer(path)
        first = codec.get_vocab_size()
        now, reader = None, None
        for batch in slices(batches, 1 << 20):
            done, parts = [], []
            convs = batch.column(0).to_pylist()
            for ids, mask in zip(batch.column(2), batch.column(3), strict=True):
                ids, mask = ids.values.to_numpy(), mask.values.to_numpy()
                body, end = int(np.flatnonzero(ids == first + BODY)[0]), int(np.flatnonzero(ids == first + END)[-1])
                parts += [ids[1:body].tolist(), ids[body + 1 : end].tolist(), ids[mask == 1].tolist()]
            texts = codec.decode_batch(parts, skip_special_tokens=False)
            for k, conv in enumerate(convs):
                if reader is None or conv != now:
                    if reader is not None:
                        done.append(reader.row(now))
                    now, reader = conv, _Reader()
                reader.add(*texts[3 * k : 3 * k + 3])
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), kinds)], schema=kinds)
        if reader is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(reader.row(now), kinds)], schema=kinds)

    rows = turns.select("conv_id", "start", "input_ids", "loss_mask")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "start").mapInArrow(read, schema)


def render(ids: list[int], tokenizer: str | None = None) -> str:
    """Token ids as text, reserved ids as their control strings; for looking at samples."""
    codec = load_tokenizer(tokenizer or vocabulary_path())
    first, out, part = codec.get_vocab_size(), [], []
    for i in [*ids, None]:
        if i is None or i >= first:
            out.append(codec.decode(part, skip_special_tokens=False))
            out.append("" if i is None else CONTROL[i - first])
            part = []
        else:
            part.append(i)
    return "".join(out)
