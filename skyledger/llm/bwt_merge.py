"""Merge of Burrows-Wheeler transforms by refining their interleave, with common prefixes.

Each shard of strings has its own transform.  The merged order of all suffixes is found
without comparing suffixes: starting with one shard after the other, every round reads
the transforms in the present order and deals the positions out by symbol, which sorts
the suffixes by one symbol more.  Positions that a round separates have a common prefix
of the rounds before it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Ends every string; symbols are larger.
END = 0


@dataclass
class Shard:
    """A shard's strings, one behind the other, each with its END, and their order."""

    symbols: np.ndarray
    #: Suffix array: where the suffixes start, in order; those of END alone come first.
    order: np.ndarray
    #: The symbol before each suffix, in that order; END before a string's first symbol.
    transform: np.ndarray


def transformed(symbols: np.ndarray) -> Shard:
    """Sort one shard's suffixes, doubling the compared length; ENDs rank by position."""
    n = len(symbols)
    ends = symbols == END
    _, rank = np.unique(symbols, return_inverse=True)
    rank = rank.astype(np.int64) + int(ends.sum())
    rank[ends] = np.arange(int(ends.sum()))
    length = 1
    while True:
        follows = np.full(n, -1, np.int64)
        follows[:-length or n] = rank[length:] if length < n else rank[:0]
        order = np.lexsort((follows, rank))
        new = np.ones(n, bool)
        new[1:] = (np.diff(rank[order]) != 0) | (np.diff(follows[order]) != 0)
        rank[order] = np.cumsum(new) - 1
        if new.all() or length >= n:
            break
        length *= 2
    return Shard(symbols, order, np.where(order > 0, symbols[order - 1], END))


def interleave(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The shard of each suffix in merged order, and each suffix' common prefix with the
    one before it, both by their first ``depth`` symbols (``depth`` if these agree)."""
    of = np.repeat(np.arange(len(shards), dtype=np.uint16), [len(s.order) for s in shards])
    transforms = np.concatenate([s.transform for s in shards])
    n = len(of)
    ends = np.repeat(
        np.arange(len(shards), dtype=np.uint16), [int((s.symbols == END).sum()) for s in shards]
    )
    prefix = np.full(n, depth, np.int32)
    block = np.zeros(n, np.int64)
    before = np.empty(n, transforms.dtype)
    for h in range(depth):
        before[np.argsort(of, kind="stable")] = transforms
        inner = np.flatnonzero(before != END)
        dealt = inner[np.argsort(before[inner], kind="stable")]
        new = np.ones(n, bool)
        symbol, came = before[dealt], block[dealt]
        new[len(ends) + 1 :] = (symbol[1:] != symbol[:-1]) | (came[1:] != came[:-1])
        of = np.concatenate([ends, of[dealt]])
        prefix[new & (prefix == depth)] = h
        block = np.cumsum(new)
    return of, prefix


def merged_suffixes(shards: list[Shard], of: np.ndarray) -> np.ndarray:
    """Where each suffix of the merged order starts in all shards' symbols together."""
    shift = np.cumsum([0] + [len(s.symbols) for s in shards[:-1]])
    starts = np.empty(len(of), np.int64)
    starts[np.argsort(of, kind="stable")] = np.concatenate(
        [s.order + d for s, d in zip(shards, shift, strict=True)]
    )
    return starts
