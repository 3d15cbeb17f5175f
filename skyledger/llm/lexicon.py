"""A word lexicon as a minimal acyclic transducer with token ids as output.

States with the same continuations are one state, so words share their endings as well
as their beginnings.  An arc's output is a number; along a path the numbers add up to
the word's row in a table of ids.  The whole lexicon is a few flat arrays in one file,
which readers map into memory.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable

import numpy as np

#: Arrays of the file, in order, with their types; the header has their lengths.
_PARTS = (("keys", "<i8"), ("target", "<i4"), ("output", "<i4"), ("final", "u1"),
          ("first", "<i4"), ("ids", "<i4"))


class _State:
    __slots__ = ("arcs", "final", "number", "words")

    def __init__(self):
        self.arcs: dict[int, _State] = {}
        self.final = False
        self.number = -1
        self.words = 0

    def signature(self) -> tuple:
        return (self.final, *((label, id(state)) for label, state in self.arcs.items()))


def compile_lexicon(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The file's bytes.  Words come distinct and in byte order."""
    root, known, table = _State(), {}, []
    path: list[tuple[_State, int, _State]] = []  # from the root along the last word
    last = b""

    def settle(depth: int) -> None:
        """The last word's states below ``depth`` are final: merge each with its equal."""
        while len(path) > depth:
            parent, label, state = path.pop()
            parent.arcs[label] = known.setdefault(state.signature(), state)

    for word, ids in entries:
        same = os.path.commonprefix([last, word])
        settle(len(same))
        state = path[-1][2] if path else root
        for label in word[len(same) :]:
            parent, state = state, _State()
            parent.arcs[label] = state
            path.append((parent, label, state))
        state.final = True
        table.append(ids)
        last = word
    settle(0)
    states = _numbered(root)
    keys, target, output = [], [], []
    for state in states:
        before = int(state.final)
        for label, following in sorted(state.arcs.items()):
            keys.append(state.number << 8 | label)
            target.append(following.number)
            output.append(before)
            before += following.words
    sizes = np.array([len(ids) for ids in table], np.int64)
    arrays = {
        "keys": keys, "target": target, "output": output, "final": [s.final for s in states],
        "first": np.concatenate([[0], np.cumsum(sizes)]), "ids": [x for ids in table for x in ids],
    }
    parts = [np.asarray(arrays[name], kind).tobytes() for name, kind in _PARTS]
    lengths = [len(p) // np.dtype(kind).itemsize for p, (_, kind) in zip(parts, _PARTS, strict=True)]
    return np.array(lengths, "<i8").tobytes() + b"".join(parts)


def _numbered(root: _State) -> list[_State]:
    """All states, root first, with their numbers and how many words they lead to."""
    order, stack = [], [(root, False)]
    done = set()
    while stack:  # children before parents
        state, entered = stack.pop()
        if entered:
            state.words = state.final + sum(s.words for s in state.arcs.values())
            order.append(state)
        elif id(state) not in done:
            done.add(id(state))
            stack.append((state, True))
            stack += [(s, False) for s in state.arcs.values()]
    order.reverse()
    for number, state in enumerate(order):
        state.number = number
    return order


class Lexicon:
    """Reads a compiled lexicon from a memory-mapped file."""

    def __init__(self, compiled: bytes):
        # The file goes at once; its pages stay mapped as long as this object lives.
        handle, path = tempfile.mkstemp(prefix="lexicon-")
        try:
            with os.fdopen(handle, "wb") as out:
                out.write(compiled)
            held = np.memmap(path, np.uint8, "r")
        finally:
            os.unlink(path)
        lengths = np.frombuffer(held[: 8 * len(_PARTS)], "<i8")
        at = 8 * len(_PARTS)
        for (name, kind), n in zip(_PARTS, lengths, strict=True):
            size = int(n) * np.dtype(kind).itemsize
            setattr(self, name, np.frombuffer(held[at : at + size], kind))
            at += size

    def rows(self, words: list[bytes]) -> np.ndarray:
        """Row of each word in the table of ids, -1 where the lexicon lacks it.  All words
        walk at once, one byte a step."""
        n = len(words)
        row, state, live = np.full(n, -1, np.int64), np.zeros(n, np.int64), np.arange(n)
        if not n or not len(self.keys):
            return row
        size = np.fromiter(map(len, words), np.int64, n)
        start = np.cumsum(size) - size
        data = np.frombuffer(b"".join(words), np.uint8)
        total, step = np.zeros(n, np.int64), 0
        while len(live):
            ended = size[live] == step
            done = live[ended]
            found = done[self.final[state[done]] == 1]
            row[found] = total[found]
            live = live[~ended]
            key = state[live] << 8 | data[start[live] + step]
            arc = np.searchsorted(self.keys, key)
            arc[arc == len(self.keys)] = 0
            there = self.keys[arc] == key
            live, arc = live[there], arc[there]
            total[live] += self.output[arc]
            state[live] = self.target[arc]
            step += 1
        return row

    def of(self, row: int) -> list[int]:
        return self.ids[self.first[row] : self.first[row + 1]].tolist()
