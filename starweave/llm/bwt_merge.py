"""Merging Burrows-Wheeler transforms of shards of strings.

A shard is a list of byte strings, each ended by a terminator.  Its suffixes
are sorted once, within the shard; what is kept is the character before each
suffix (the transform).  Shards are merged by refining an interleave: after k
rounds the interleave says from which shard the suffix at every merged
position comes when suffixes are compared on their first k characters.  A
round reads the transforms along the interleave and deals the labels out by
character, stably; suffixes are never compared again.  Block boundaries are
carried along: two neighbours that are first separated in round k share k - 1
characters, so after ``depth`` rounds the blocks are the intervals of suffixes
with equal first ``depth`` characters.
"""

from __future__ import annotations

import numpy as np

SHARD_SYMBOLS = 1 << 16


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array of symbols in which every terminator is a symbol of its
    own (so no two suffixes are equal), by prefix doubling."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)
    srt = text[order]
    rank[order] = np.concatenate(([0], np.cumsum(srt[1:] != srt[:-1])))
    width = 1
    while rank.max(initial=0) < n - 1:
        nxt = np.zeros(n, np.int64)
        nxt[:n - width] = rank[width:] + 1
        key = rank * (n + 1) + nxt
        order = np.argsort(key, kind="stable")
        srt = key[order]
        rank[order] = np.concatenate(([0], np.cumsum(srt[1:] != srt[:-1])))
        width *= 2
    return order


class Shard:
    """The transform of a list of strings: ``bwt`` holds character + 1 before
    each suffix in sorted order (0: the suffix starts a string), ``at`` the
    position of each suffix in the concatenation."""

    def __init__(self, strings: list[bytes]):
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        ends = np.cumsum(lengths + 1) - 1
        flat = np.zeros(int(ends[-1]) + 1, np.int64)
        body = np.ones(len(flat), bool)
        body[ends] = False
        flat[body] = np.frombuffer(b"".join(strings), np.uint8)
        symbols = flat + 1
        m = len(strings)
        distinct = flat + m
        distinct[ends] = np.arange(m)
        self.at = suffix_order(distinct)
        symbols[ends] = 0
        before = np.concatenate(([0], symbols[:-1]))
        self.bwt = before[self.at].astype(np.uint16)
        self.strings, self.size = m, len(flat)


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(labels, block starts) of the merged suffixes after ``depth`` rounds:
    the shard of each merged position (its suffixes come in shard order) and
    True where a position shares fewer than ``depth`` characters with the one
    before it."""
    if len(shards) > 256:
        raise ValueError("at most 256 shards a merge")
    sizes = [s.size for s in shards]
    label = np.repeat(np.arange(len(shards), dtype=np.uint8), sizes)
    n, ends = len(label), sum(s.strings for s in shards)
    head = np.repeat(np.arange(len(shards), dtype=np.uint8), [s.strings for s in shards])
    start = np.zeros(n, bool)
    start[0] = True
    chars = np.empty(n, np.uint16)
    for _ in range(depth):
        for s, shard in enumerate(shards):
            chars[label == s] = shard.bwt
        deal = np.argsort(chars, kind="stable")[ends:]      # 0: starts of strings, terminators stay first
        block = np.cumsum(start, dtype=np.int32)
        c, b = chars[deal], block[deal]
        new = np.ones(n, bool)
        new[ends + 1:] = (c[1:] != c[:-1]) | (b[1:] != b[:-1])
        moved = np.concatenate((head, label[deal]))
        done = np.array_equal(moved, label) and np.array_equal(new, start)
        label, start = moved, new
        if done:
            break
    return label, start


def shard_strings(strings: list[bytes], symbols: int = SHARD_SYMBOLS) -> list[list[int]]:
    """Consecutive strings grouped into shards of about ``symbols``."""
    total = sum(map(len, strings)) + len(strings)
    symbols = max(symbols, -(-total // 200))
    groups, size = [[]], 0
    for i, s in enumerate(strings):
        if size + len(s) + 1 > symbols and groups[-1]:
            groups.append([])
            size = 0
        groups[-1].append(i)
        size += len(s) + 1
    return groups


def least_owner(strings: list[bytes], owner: np.ndarray, depth: int,
                symbols: int = SHARD_SYMBOLS) -> list[np.ndarray]:
    """``least_owners`` string by string."""
    least, windows = least_owners(strings, owner, depth, symbols)
    return np.split(least, np.cumsum(windows)[:-1])


def least_owners(strings: list[bytes], owner: np.ndarray, depth: int,
                 symbols: int = SHARD_SYMBOLS) -> tuple[np.ndarray, np.ndarray]:
    """For every string the least owner of any string that holds the same
    ``depth`` characters, per start of a window of that many characters: one
    array of all, and how many windows each string has."""
    groups = [g for g in shard_strings(strings, symbols) if g]
    shards = [Shard([strings[i] for i in g]) for g in groups]
    label, start = merge(shards, depth)
    block = np.cumsum(start) - 1
    n_blocks = int(block[-1]) + 1
    least = np.full(n_blocks, np.iinfo(np.int64).max, np.int64)
    where = []
    for s, (g, shard) in enumerate(zip(groups, shards)):
        own = block[label == s]
        lengths = np.fromiter((len(strings[i]) for i in g), np.int64, len(g))
        inverse = np.empty(shard.size, np.int64)
        inverse[shard.at] = own                 # block of the suffix at each text position
        first = np.cumsum(lengths + 1) - lengths - 1
        windows = np.maximum(lengths - depth + 1, 0)
        pos = np.repeat(first - np.concatenate(([0], np.cumsum(windows)[:-1])), windows) + np.arange(windows.sum())
        np.minimum.at(least, inverse[pos], np.repeat(owner[g], windows))
        where.append((inverse[pos], windows))
    blocks, windows = (np.concatenate(x) for x in zip(*where))     # groups hold consecutive strings, so this is their order
    return least[blocks], windows
