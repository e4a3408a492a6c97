"""Suffix arrays of byte contexts in numpy: Larsson-Sadakane refinement and Kasai's common prefixes.

``contexts`` are byte strings laid one after the other with a separator (0;
bytes count from 1).
"""

from __future__ import annotations

import numpy as np

PACK = 7  # symbols of 9 bits in one word


def lay_out(contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, start of each context); a separator ends every context."""
    size = np.array([len(c) + 1 for c in contexts], np.int64)
    start = np.cumsum(size) - size
    s = np.frombuffer(b"\x00".join([*contexts, b""]), np.uint8).astype(np.int16) + 1
    s[start + size - 1] = 0
    return s, start


def packed(s: np.ndarray) -> np.ndarray:
    """The next ``PACK`` symbols from each position on, as one number that sorts like them."""
    wide = np.concatenate([s, np.zeros(PACK, s.dtype)]).astype(np.int64)
    out = wide[:len(s)].copy()
    for i in range(1, PACK):
        out <<= 9
        out |= wide[i:i + len(s)]
    return out


def suffix_array(s: np.ndarray, words: np.ndarray | None = None) -> np.ndarray:
    """Positions in the order of their suffixes; each round doubles the sorted depth and sorts only what still ties."""
    n = len(s)
    key = packed(s) if words is None else words
    sa = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    slots, at, key = np.arange(n), sa, key[sa]
    h = PACK
    while True:
        new = np.concatenate([[True], key[1:] != key[:-1]])
        begin = np.flatnonzero(new)
        size = np.diff(np.concatenate([begin, [len(key)]]))
        rank[at] = np.repeat(slots[begin], size)  # a group is named by its first slot
        tied = np.repeat(size > 1, size)
        slots, at = slots[tied], at[tied]
        if not len(at):
            return sa
        after = at + h
        key = rank[at] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)], -1) + 1
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
        sa[slots] = at
        h *= 2


def common_prefixes(s: np.ndarray, start: np.ndarray, sa: np.ndarray, depth: int, words: np.ndarray | None = None) -> np.ndarray:
    """Symbols that each entry of ``sa`` shares with the one before it, counted up to ``depth``.

    Kasai's walk in text order, where the count falls by one at most from a
    position to the next, taken by all contexts in step.
    """
    n = len(s)
    words = packed(s) if words is None else words
    slot = np.empty(n, np.int64)
    slot[sa] = np.arange(n)
    end = np.concatenate([start[1:], [n]])
    out = np.zeros(n, np.int64)
    h = np.zeros(len(start), np.int64)
    longest = int((end - start).max()) if len(start) else 0
    walk = np.arange(len(start))
    for j in range(longest):
        walk = walk[start[walk] + j < end[walk]]
        at = start[walk] + j
        r = slot[at]
        before = sa[r - 1]
        k = np.maximum(h[walk] - 1, 0)
        go = np.flatnonzero(r > 0)
        k[r == 0] = 0
        wide = go
        while len(wide):  # seven symbols at a time
            a, b = at[wide] + k[wide], before[wide] + k[wide]
            wide = wide[(k[wide] < depth) & (np.maximum(a, b) < n)]
            a, b = at[wide] + k[wide], before[wide] + k[wide]
            wide = wide[words[a] == words[b]]
            k[wide] += PACK
        while len(go):
            a, b = at[go] + k[go], before[go] + k[go]
            go = go[(k[go] < depth) & (np.maximum(a, b) < n)]
            a, b = at[go] + k[go], before[go] + k[go]
            go = go[s[a] == s[b]]
            k[go] += 1
        h[walk] = k
        out[r] = np.minimum(k, depth)
    return out
