"""Burrows-Wheeler transforms of string collections and their merge by interleave refinement.

A shard's transform comes from a suffix sort of its own strings. Merging shards
never sorts suffixes again: an interleave of the shards' rows is refined one
character at a time. If it is right for the first L characters, one pass through
it in order, dealing each row's preceding character out stably, makes it right
for L + 1. Rows that agree so far form a block; the round in which a border
appears between two rows is their common prefix, and what is still one block
after ``depth`` rounds is an interval of equal strings of that length.

Where only those intervals are asked for, a round takes the rows that lead to a
whole string of ``depth`` characters, one per place where one starts, and leaves
out rows that agree with no other so far.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Shard:
    """Symbols in the order of their suffixes (0: a string's end, else byte + 1), the suffixes' places, and the row that
    the suffix one character longer has."""

    bwt: np.ndarray
    places: np.ndarray
    longer: np.ndarray
    strings: int


def _changes(x: np.ndarray) -> np.ndarray:
    """Where a value begins that differs from the one before it."""
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return new


def _alone(border: np.ndarray) -> np.ndarray:
    """Rows that are a block of their own."""
    return border & np.append(border[1:], True)


def shard(text: np.ndarray, lengths: np.ndarray) -> Shard:
    """Transform of strings that lie end to end in ``text`` (bytes below 255). Ends are ordered by string."""
    m, n = len(lengths), len(text) + len(lengths)
    symbols = np.zeros(n, np.uint8)
    ends = np.cumsum(lengths + 1) - 1
    inside = np.ones(n, bool)
    inside[ends] = False
    symbols[inside] = text + 1
    key = symbols.astype(np.int64) + m
    key[ends] = np.arange(m)
    order, rank = np.argsort(key, kind="stable"), np.empty(n, np.int64)
    key, at, step = key[order], np.arange(n), 1
    while True:
        new = _changes(key)
        head = at[new][np.cumsum(new) - 1]
        rank[order[at]] = head
        shared = ~_alone(new)  # settled rows are not sorted again
        at, head = at[shared], head[shared]
        if not len(at):
            break
        places = order[at]
        key = head * n + rank[places + step]  # there is a place: suffixes that agree in ``step`` characters are longer
        by = np.argsort(key, kind="stable")
        order[at], key = places[by], key[by]
        step *= 2
    return Shard(symbols[order - 1], order, rank[order - 1], m)


def _laid_out(shards: list[Shard]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, longer, base) of the shards' rows end to end, and where each shard's begin."""
    base = np.cumsum([0, *[len(s.bwt) for s in shards]])
    longer = np.concatenate([s.longer + b for s, b in zip(shards, base, strict=False)]).astype(np.int32)
    return np.concatenate([s.bwt for s in shards]), longer, base


def _refined(bwt: np.ndarray, longer: np.ndarray, rows: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One round: the rows one character longer, in order, and where their blocks begin. Preceding characters are dealt
    out stably."""
    symbol = bwt[rows]
    order = np.argsort(symbol, kind="stable")
    symbol, block = symbol[order], block[order]
    border = np.ones(len(rows), bool)
    border[1:] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
    return longer[rows[order]], border


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, common, borders) of the merged order by the first ``depth`` characters: each row as a place in the shards'
    rows laid end to end, its common prefix with the row before it (``depth``: that or more), and whether a block of rows
    that agree in ``depth`` characters begins with it."""
    bwt, longer, base = _laid_out(shards)
    n, strings = len(bwt), sum(s.strings for s in shards)
    finals = np.concatenate([np.arange(s.strings) + b for s, b in zip(shards, base, strict=False)]).astype(np.int32)
    rows, block = np.arange(n, dtype=np.int32), np.zeros(n, np.int32)
    common, border = np.full(n, depth, np.uint16), np.zeros(n, bool)
    for length in range(1, depth + 1):
        rows, now = _refined(bwt, longer, rows, block)
        rows[:strings] = finals  # every end differs from every other
        now[: strings + 1] = True
        common[now & ~border] = length - 1
        border = now
        block = np.cumsum(now, dtype=np.int32)
        if block[-1] == n:
            break
    return rows, common, border


def agreeing(shards: list[Shard], depth: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, block) of the merged order where blocks of rows that agree in ``depth`` characters have two and more. The
    rounds begin with ``rows``, those of the suffixes ``depth`` characters on from where the asked-for strings start."""
    bwt, longer, _ = _laid_out(shards)
    rows, block = rows.astype(np.int32), np.zeros(len(rows), np.int32)
    for _ in range(depth):
        if not len(rows):
            break
        rows, border = _refined(bwt, longer, rows, block)
        block = np.cumsum(border, dtype=np.int32)
        if 2 * block[-1] > len(rows):  # else the fewer are alone
            shared = ~_alone(border)
            rows, block = rows[shared], block[shared]
    counts = np.bincount(block)
    shared = counts[block] > 1
    return rows[shared], block[shared]


def repeated(text: np.ndarray, lengths: np.ndarray, depth: int, shard_bytes: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``text``, interval number) of all occurrences of strings of ``depth`` bytes that occur twice or more
    inside the strings that lie end to end in ``text``."""
    upto = np.cumsum(lengths)
    cuts = np.unique(np.searchsorted(upto, np.arange(shard_bytes, int(upto[-1]) + shard_bytes, shard_bytes)) + 1)
    shards, places, starts, first, base = [], [], [], 0, 0
    for last in np.minimum(cuts, len(lengths)).tolist():
        if last <= first:
            continue
        begin, size = int(upto[first] - lengths[first]), lengths[first:last]
        made = shard(text[begin : int(upto[last - 1])], size)
        ends = np.cumsum(size + 1) - 1
        shards.append(made)
        places.append(made.places - np.searchsorted(ends, made.places) + begin)  # without the ends before it
        left = np.repeat(ends, size + 1) - np.arange(len(made.places))  # characters from a place to its string's end
        on = np.repeat(size, size + 1) - left >= depth
        starts.append(np.flatnonzero(on[made.places]) + base)
        first, base = last, base + len(made.places)
    rows, block = agreeing(shards, depth, np.concatenate(starts))
    return np.concatenate(places)[rows], block
