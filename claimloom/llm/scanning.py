"""Secret scans with one combined automaton for all rules.

The rules' patterns are compiled into one minimal automaton, and a batch of texts is scanned in one
byte pass for the shortest ends of all rules' matches. Only where a rule has one are its spans read out, by the rule's own automata: a backward
one marks where matches can start, a forward one finds the longest match from there. Matches of a rule
are leftmost and do not overlap; one that is too short is dropped, but keeps its bytes.

Null and empty texts have no spans. Texts of any length are scanned whole. Every row has its own result;
repeated rows have the same one. Null ids stay null. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from claimloom.llm.automaton import Automaton, compile_patterns, longest_match, scan
from claimloom.llm.common import arrow_map, utf8


@dataclass(frozen=True)
class Rule:
    """``head``: what comes before the secret itself. ``least``: characters behind the head at least."""

    kind: str
    pattern: str
    least: int
    fold: bool = False
    head: str = ""


ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
# The kinds of the base scan
BASE_RULES = (
    Rule("assign", ASSIGN + "[A-Za-z0-9+/_.=-]+", 12, True, ASSIGN),
    Rule("access", "AKIA[A-Z0-9]+", 18),
    # counted, so that short runs do not stop the scan; a shorter run would be dropped anyway
    Rule("hex", "[0-9a-f]{16,}", 16),
)
# Published token formats
MORE_RULES = (
    Rule("forge_token", "gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("cloud_key", "AIza[A-Za-z0-9_-]+", 39),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    Rule("key_block", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
)
RULES = BASE_RULES + MORE_RULES


@dataclass
class Scanner:
    rules: tuple[Rule, ...]
    together: Automaton
    backward: list[Automaton]
    forward: list[Automaton]
    heads: list[Automaton | None]


def build_scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    each = [(r.pattern, r.fold) for r in rules]
    scanner = Scanner(
        rules,
        compile_patterns(each, search=True, shortest=True),
        [compile_patterns([p], search=True, reverse=True) for p in each],
        [compile_patterns([p], search=False) for p in each],
        [compile_patterns([(r.head, r.fold)], search=False) if r.head else None for r in rules],
    )
    if not scanner.together.resets[10]:
        raise ValueError("no rule may go beyond the end of a line")
    return scanner


def find(scanner: Scanner, which: int, data: bytes) -> list[tuple[int, int]]:
    """Byte spans of one rule in one text."""
    rule, forward, head = scanner.rules[which], scanner.forward[which], scanner.heads[which]
    backwards = np.frombuffer(data, np.uint8)[::-1]
    starts = sorted(len(data) - scan(scanner.backward[which], backwards)[0])
    spans, place = [], 0
    while (k := bisect_left(starts, place)) < len(starts):
        start = int(starts[k])
        place = longest_match(forward, data, start)
        body = longest_match(head, data, start) if head else start
        if place - body >= rule.least:  # patterns are ASCII, so bytes are characters
            spans.append((start, place))
    return spans


def scan_texts(scanner: Scanner, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
    """(start, rule number, end) in code points for each text, in order."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    ends, kinds = scan(scanner.together, data)
    after = np.cumsum([len(t) + 1 for t in texts])
    owner = np.searchsorted(after, ends - 1, side="right")
    todo: dict[int, int] = {}
    for k in np.unique(np.stack([owner, kinds]), axis=1).T.tolist() if len(ends) else ():
        todo[k[0]] = todo.get(k[0], 0) | k[1]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, mask in todo.items():
        text = texts[k]
        before = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
        for which in range(len(scanner.rules)):
            if mask >> which & 1:
                out[k] += [(int(before[a]), which, int(before[b])) for a, b in find(scanner, which, text)]
        out[k].sort()
    return out


def scan_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Spans of all rules in each document: ``spans array<struct<kind, start, end>>``."""
    scanner = build_scanner(rules)
    kinds = [r.kind for r in rules]

    def run(batch: pa.RecordBatch) -> dict:
        found = scan_texts(scanner, utf8(batch))
        spans = [[{"kind": kinds[w], "start": a, "end": b} for a, w, b in spans] for spans in found]
        return {"doc_id": batch.column(0), "spans": spans}

    schema = "doc_id bigint, spans array<struct<kind: string, start: bigint, end: bigint>>"
    return arrow_map(docs.select("doc_id", "text"), run, schema)


def digest_spans(found: DataFrame) -> DataFrame:
    """Counts, the checksum of the base kinds and all spans as text."""
    base = [r.kind for r in BASE_RULES]

    def run(batch: pa.RecordBatch) -> dict:
        rows = batch.column(1).to_pylist()
        written = [[(s["kind"], f"{s['kind']}:{s['start']}:{s['end']}") for s in row] for row in rows]
        out = {f"n_{kind}": [sum(k == kind for k, _ in row) for row in written] for kind in base}
        out["base_sha256"] = [hashlib.sha256(",".join(t for k, t in row if k in base).encode()).hexdigest() for row in written]
        return out | {"doc_id": batch.column(0), "spans": [",".join(t for _, t in row) for row in written]}

    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return arrow_map(found, run, schema)
