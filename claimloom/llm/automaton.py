"""Regular expressions as minimal deterministic automata over bytes.

Patterns are parsed by the standard library, turned into one nondeterministic automaton, determinised
by subset construction and minimised by partition refinement. The result is a transition array over
byte classes. Patterns may use literals, sets, ``.``, groups, alternatives and repeats; no anchors,
look-around or back references.
"""

from __future__ import annotations

import re._constants as op
import re._parser as parser
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

ALL = (1 << 256) - 1
CATEGORIES = {
    op.CATEGORY_DIGIT: b"0123456789",
    op.CATEGORY_SPACE: b" \t\n\r\v\f",
    op.CATEGORY_WORD: bytes(b for b in range(128) if chr(b).isalnum() or b == 95),
}


def _bits(values) -> int:
    return sum(1 << b for b in set(values))


def _one(b: int, fold: bool) -> int:
    if b > 127:
        raise ValueError("patterns are ASCII")
    return _bits(ord(c) for c in (chr(b).lower(), chr(b).upper())) if fold else 1 << b


def _members(items, fold: bool) -> int:
    found, negate = 0, False
    for kind, value in items:
        if kind is op.NEGATE:
            negate = True
        elif kind is op.LITERAL:
            found |= _one(value, fold)
        elif kind is op.RANGE:
            for b in range(value[0], value[1] + 1):
                found |= _one(b, fold)
        elif kind is op.CATEGORY and value in CATEGORIES:
            found |= _bits(CATEGORIES[value])
        else:
            raise ValueError(f"unsupported in a set: {kind}")
    return ALL & ~found if negate else found


class _Nfa:
    """Thompson construction; ``reverse`` builds the automaton of the mirrored language."""

    def __init__(self, reverse: bool) -> None:
        self.reverse = reverse
        self.free: list[list[int]] = []
        self.edges: list[list[tuple[int, int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.edges.append([])
        return len(self.free) - 1

    def add(self, items, start: int, fold: bool) -> int:
        for kind, value in reversed(list(items)) if self.reverse else items:
            start = self._step(kind, value, start, fold)
        return start

    def _byte(self, allowed: int, start: int) -> int:
        end = self.state()
        self.edges[start].append((allowed, end))
        return end

    def _step(self, kind, value, start: int, fold: bool) -> int:
        if kind is op.LITERAL:
            return self._byte(_one(value, fold), start)
        if kind is op.NOT_LITERAL:
            return self._byte(ALL & ~_one(value, fold), start)
        if kind is op.ANY:
            return self._byte(ALL & ~(1 << 10), start)
        if kind is op.IN:
            return self._byte(_members(value, fold), start)
        if kind is op.SUBPATTERN:
            return self.add(value[3], start, fold)
        if kind is op.BRANCH:
            end = self.state()
            for branch in value[1]:
                first = self.state()
                self.free[start].append(first)
                self.free[self.add(branch, first, fold)].append(end)
            return end
        if kind is op.MAX_REPEAT:
            low, high, body = value
            for _ in range(low):
                start = self.add(body, start, fold)
            if high is op.MAXREPEAT:
                loop = self.state()
                self.free[start].append(loop)
                self.free[self.add(body, loop, fold)].append(loop)
                return loop
            end = self.state()
            for _ in range(high - low):
                self.free[start].append(end)
                start = self.add(body, start, fold)
            self.free[start].append(end)
            return end
        raise ValueError(f"unsupported pattern element: {kind}")

    def closure(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return frozenset(found)


@dataclass
class Automaton:
    """Minimal automaton; accepting states have the highest numbers, ``accepts`` has a bit per pattern."""

    start: int
    classes: np.ndarray  # byte -> class
    moves: np.ndarray  # state, class -> state
    accepts: np.ndarray

    @property
    def first_accepting(self) -> int:
        return int(np.searchsorted(self.accepts != 0, True))

    @property
    def resets(self) -> np.ndarray:
        """Bytes after which the automaton is in its start state, wherever it was."""
        return (self.moves == self.start).all(axis=0)[self.classes]

    @property
    def dead(self) -> int:
        """The state that is never left and accepts nothing; -1 if there is none."""
        own = np.arange(len(self.moves))[:, None]
        found = np.flatnonzero((self.moves == own).all(axis=1) & (self.accepts == 0))
        return int(found[0]) if len(found) else -1


def compile_patterns(patterns: Sequence[tuple[str, bool]], search: bool, reverse: bool = False, shortest: bool = False) -> Automaton:
    """One automaton for all patterns, each given with whether letters match in either case.

    ``search``: find matches that start anywhere, not only at the first byte. ``shortest``: a match is
    not followed beyond its shortest end, which keeps the combination of many rules small.
    """
    nfa = _Nfa(reverse)
    root = nfa.state()
    ends = {}
    for k, (pattern, fold) in enumerate(patterns):
        first = nfa.state()
        nfa.free[root].append(first)
        end = nfa.add(parser.parse(pattern), first, fold)
        ends[end] = 1 << k
        if shortest:
            nfa.free[end], nfa.edges[end] = [], []
    return _minimise(*_subsets(nfa, root, ends, search))


def _byte_classes(nfa: _Nfa) -> tuple[np.ndarray, list[int]]:
    sets = sorted({allowed for edges in nfa.edges for allowed, _ in edges})
    names: dict[tuple, int] = {}
    classes = np.empty(256, np.uint8)
    for b in range(256):
        classes[b] = names.setdefault(tuple(allowed >> b & 1 for allowed in sets), len(names))
    return classes, [int(np.flatnonzero(classes == c)[0]) for c in range(len(names))]


def _subsets(nfa: _Nfa, root: int, ends: dict[int, int], search: bool):
    classes, sample = _byte_classes(nfa)
    start = nfa.closure([root])
    numbers, order, moves = {start: 0}, [start], []
    for states in order:
        row = []
        for b in sample:
            to = {target for s in states for allowed, target in nfa.edges[s] if allowed >> b & 1}
            after = nfa.closure(to | {root}) if search else nfa.closure(to)
            if after not in numbers:
                numbers[after] = len(order)
                order.append(after)
            row.append(numbers[after])
        moves.append(row)
    accepts = np.array([sum(bit for s, bit in ends.items() if s in states) for states in order], np.int64)
    return classes, np.array(moves, np.int32), accepts


def _minimise(classes: np.ndarray, moves: np.ndarray, accepts: np.ndarray) -> Automaton:
    block = np.unique(accepts, return_inverse=True)[1]
    while True:
        seen = np.concatenate([block[:, None], block[moves]], axis=1)
        finer = np.unique(seen, axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    _, member = np.unique(block, return_index=True)
    rank = np.argsort(np.argsort(accepts[member] != 0, kind="stable"), kind="stable")
    least = np.empty((len(member), moves.shape[1]), np.int32)
    least[rank] = rank[block[moves[member]]]
    kinds = np.empty(len(member), np.int64)
    kinds[rank] = accepts[member]
    return Automaton(int(rank[block[0]]), classes, least, kinds)


def scan(found: Automaton, data: np.ndarray, lane: int = 2048, block: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Ends (exclusive) of all matches in some bytes and the patterns that end there, in one pass.

    The bytes are cut behind bytes that reset the automaton, at about every ``lane`` bytes, and all lanes
    are followed at once. A lane may be longer where no such byte comes.
    """
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    width = found.moves.shape[1]
    moves = (found.moves.astype(np.int32) * width).reshape(-1)
    symbols = found.classes[data]
    safe = np.flatnonzero(found.resets[data]) + 1
    wanted = np.arange(lane, len(data), lane)
    cuts = safe[np.minimum(np.searchsorted(safe, wanted), len(safe) - 1)] if len(safe) else wanted[:0]
    starts = np.unique(np.concatenate([[0], cuts[(cuts > 0) & (cuts < len(data))]]))
    lengths = np.diff(np.append(starts, len(data)))
    longest = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[longest], lengths[longest]
    state = np.full(len(starts), found.start * width, np.int32)
    least = found.first_accepting * width
    ends, kinds = [], []
    for t in range(0, int(lengths[0]), block):
        going = int(np.searchsorted(-lengths, -t))
        steps = min(block, int(lengths[0]) - t)
        place = starts[:going] + np.arange(t, t + steps)[:, None]
        own = symbols[np.minimum(place, len(data) - 1)]
        states = np.empty((steps, going), np.int32)
        now = state[:going]
        for k in range(steps):
            now = moves[now + own[k]]
            states[k] = now
        state = now
        hit = np.flatnonzero(states >= least)
        if len(hit):
            step, which = np.divmod(hit, going)
            inside = t + step < lengths[which]
            step, which = step[inside], which[inside]
            ends.append(starts[which] + t + step + 1)
            kinds.append(found.accepts[states[step, which] // width])
    if not ends:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    ends, kinds = np.concatenate(ends), np.concatenate(kinds)
    order = np.argsort(ends, kind="stable")
    return ends[order], kinds[order]


def longest_match(found: Automaton, data: bytes, start: int) -> int:
    """End of the longest match that starts at a place, -1 if none does; for automata without search."""
    rows, classes, accepts, dead = found.moves, found.classes, found.accepts, found.dead
    state, end = found.start, -1
    for k in range(start, len(data)):
        state = rows[state, classes[data[k]]]
        if state == dead:
            break
        if accepts[state]:
            end = k + 1
    return end
