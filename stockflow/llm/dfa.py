"""Deterministic automata over bytes: subset construction of regular expressions, minimised."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np

_ALL = (1 << 256) - 1
_ANY = _ALL & ~(1 << 0x0A)


def _bits(values) -> int:
    return reduce(lambda mask, b: mask | 1 << b, values, 0)


_CATEGORIES = {
    "CATEGORY_DIGIT": _bits(b"0123456789"),
    "CATEGORY_SPACE": _bits(b" \t\n\r\f\v"),
    "CATEGORY_WORD": _bits(b for b in range(128) if chr(b).isalnum() or b == 0x5F),
}


class _Nfa:
    """Thompson's construction; ``backward`` builds the automaton of the reversed expressions."""

    def __init__(self, backward: bool):
        self.backward = backward
        self.moves: list[list[tuple[int, int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def _set(self, mask: int, fold: bool) -> int:
        if not fold:
            return mask
        upper = mask >> 0x41 & (1 << 26) - 1
        lower = mask >> 0x61 & (1 << 26) - 1
        return mask | lower << 0x41 | upper << 0x61

    def _members(self, items, fold: bool) -> int:
        mask, negate = 0, False
        for kind, value in items:
            name = str(kind)
            if name == "NEGATE":
                negate = True
            elif name == "LITERAL":
                mask |= 1 << value
            elif name == "RANGE":
                mask |= _bits(range(value[0], value[1] + 1))
            elif name == "CATEGORY":
                positive = _CATEGORIES.get(str(value).replace("_NOT", ""))
                mask |= _ALL & ~positive if "_NOT_" in str(value) else positive
            else:
                raise ValueError(f"no automaton for {name} in a set")
        mask = self._set(mask, fold)
        return _ALL & ~mask if negate else mask

    def sequence(self, items, at: int, fold: bool) -> int:
        """Add the items after state ``at``; returns the state after them."""
        for item in reversed(list(items)) if self.backward else items:
            at = self._item(item, at, fold)
        return at

    def _item(self, item, at: int, fold: bool) -> int:
        kind, value = item
        name = str(kind)
        if name in ("LITERAL", "NOT_LITERAL", "IN", "ANY"):
            if name == "IN":
                mask = self._members(value, fold)
            elif name == "ANY":
                mask = _ANY
            else:
                mask = self._set(1 << value, fold)
                mask = _ALL & ~mask if name == "NOT_LITERAL" else mask
            end = self.state()
            self.moves[at].append((mask, end))
            return end
        if name == "SUBPATTERN":
            _, added, removed, inner = value
            return self.sequence(inner, at, bool((fold or added & re.I) and not removed & re.I))
        if name == "BRANCH":
            end = self.state()
            for way in value[1]:
                begin = self.state()
                self.empty[at].append(begin)
                self.empty[self.sequence(way, begin, fold)].append(end)
            return end
        if name == "MAX_REPEAT":
            least, most, inner = value
            for _ in range(least):
                at = self.sequence(inner, at, fold)
            if str(most) == "MAXREPEAT":
                loop, end = self.state(), self.state()
                self.empty[at].append(loop)
                self.empty[self.sequence(inner, loop, fold)].append(loop)
                self.empty[loop].append(end)
                return end
            end = self.state()
            self.empty[at].append(end)
            for _ in range(most - least):
                at = self.sequence(inner, at, fold)
                self.empty[at].append(end)
            return end
        raise ValueError(f"no automaton for {name}")


@dataclass
class Dfa:
    """Transition arrays: ``table[state, classes[byte]]``; state 0 begins.

    ``accepts[state]`` has a bit for each expression that ends there; the states from ``first`` on
    are those with a bit. ``dead`` is the state that nothing leaves, or -1.
    """

    table: np.ndarray
    classes: bytes
    accepts: np.ndarray
    first: int
    dead: int
    _flat: list[int] = field(default_factory=list, repr=False)

    def flat(self) -> list[int]:
        """The table as a list of states multiplied by the number of classes, made once a worker."""
        if not self._flat:
            self._flat = (self.table.astype(np.int64) * self.table.shape[1]).ravel().tolist()
        return self._flat

    def __getstate__(self):
        return {**self.__dict__, "_flat": []}


def _byte_classes(nfa: _Nfa) -> tuple[bytes, list[int]]:
    """The class of each byte, and a byte of each class; bytes of a class are in the same sets."""
    masks = sorted({mask for moves in nfa.moves for mask, _ in moves})
    numbers: dict[tuple, int] = {}
    member = []
    classes = bytearray(256)
    for b in range(256):
        key = tuple(mask >> b & 1 for mask in masks)
        if key not in numbers:
            numbers[key] = len(numbers)
            member.append(b)
        classes[b] = numbers[key]
    return bytes(classes), member


def _subsets(nfa: _Nfa, begin: int, ends: dict[int, int], anywhere: bool) -> tuple[list, list[int], bytes]:
    classes, member = _byte_classes(nfa)
    closures: dict[int, frozenset[int]] = {}

    def closure(state: int) -> frozenset[int]:
        if state not in closures:
            seen, todo = {state}, [state]
            while todo:
                for nxt in nfa.empty[todo.pop()]:
                    if nxt not in seen:
                        seen.add(nxt)
                        todo.append(nxt)
            closures[state] = frozenset(s for s in seen if nfa.moves[s] or s in ends)
        return closures[state]

    steps: dict[int, list[frozenset[int]]] = {}

    def step(state: int) -> list[frozenset[int]]:
        if state not in steps:
            moves = nfa.moves[state]
            steps[state] = [
                frozenset().union(*[closure(to) for mask, to in moves if mask >> b & 1]) for b in member
            ]
        return steps[state]

    root = closure(begin)
    numbers = {root: 0}
    table, accepts, order = [], [], [root]
    for current in order:
        row = []
        ways = [step(s) for s in current]
        for c in range(len(member)):
            target = frozenset().union(root if anywhere else (), *[w[c] for w in ways])
            if target not in numbers:
                numbers[target] = len(order)
                order.append(target)
            row.append(numbers[target])
        table.append(row)
        accepts.append(reduce(lambda bits, s: bits | ends.get(s, 0), current, 0))
    return table, accepts, classes


def _minimised(table: np.ndarray, accepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states that no text tells apart, by refining the partition until it stands."""
    group = np.unique(accepts, return_inverse=True)[1].ravel()
    while True:
        rows = np.column_stack([group, group[table]])
        finer = np.unique(rows, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == group.max():
            break
        group = finer
    keep = np.unique(group, return_index=True)[1]
    return group[table[keep]], accepts[keep], int(group[0])


def compile_dfa(patterns: Sequence[bytes], anywhere: bool = False, backward: bool = False) -> Dfa:
    """One minimal automaton for all ``patterns``, regular expressions over bytes.

    ``anywhere`` lets a match begin at every byte; ``backward`` reads the bytes from right to left,
    so that an accepting state says which expressions match from here on.
    """
    nfa = _Nfa(backward)
    begin = nfa.state()
    ends: dict[int, int] = {}
    for number, pattern in enumerate(patterns):
        start = nfa.state()
        nfa.empty[begin].append(start)
        tree = re._parser.parse(pattern)
        ends[nfa.sequence(tree, start, bool(tree.state.flags & re.I))] = 1 << number
    rows, marks, classes = _subsets(nfa, begin, ends, anywhere)
    table, accepts, root = _minimised(np.array(rows, dtype=np.int64), np.array(marks, dtype=np.int64))
    quiet = np.flatnonzero(accepts == 0)
    loud = np.flatnonzero(accepts)
    if accepts[root]:
        raise ValueError("an expression matches nothing at all")
    order = np.concatenate([[root], quiet[quiet != root], loud]).astype(np.int64)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    table, accepts = place[table[order]].astype(np.int32), accepts[order]
    stuck = np.flatnonzero((table == np.arange(len(table))[:, None]).all(axis=1) & (accepts == 0))
    return Dfa(table, classes, accepts, len(quiet), int(stuck[0]) if len(stuck) else -1)


def longest(dfa: Dfa, data: bytes, at: int) -> int:
    """The end of the longest match from ``at`` on; -1 if there is none."""
    step, classes, width = dfa.flat(), dfa.classes, dfa.table.shape[1]
    first, dead = dfa.first * width, dfa.dead * width
    state, end = 0, -1
    for place, byte in enumerate(memoryview(data)[at:], at + 1):
        state = step[state + classes[byte]]
        if state >= first:
            end = place
        elif state == dead:
            break
    return end


def starts(dfa: Dfa, data: bytes) -> list[tuple[int, int]]:
    """(place, bits) of every byte where expressions match from there on, right to left.

    ``dfa`` is compiled with ``anywhere`` and ``backward``; the bytes are read once.
    """
    step, width = dfa.flat(), dfa.table.shape[1]
    first, accepts = dfa.first * width, dfa.accepts.tolist()
    state, found, last = 0, [], len(data) - 1
    for place, kind in enumerate(data.translate(dfa.classes)[::-1]):
        state = step[state + kind]
        if state >= first:
            found.append((last - place, accepts[state // width]))
    return found
