"""The prefix dynamic programme of `bpe` for many matches side by side.

Matches stand in rows of a byte matrix. For every start, all rows walk along the
tokens that begin there, one byte at a time, through a trie kept as a hash table
of (node, byte); the last token of a prefix is filled in by the first start whose
token may stand after that start's own last token. The answers for pairs of tokens
are kept in a table of fixed size, in which a new pair takes an old one's place.
"""

from __future__ import annotations

import numpy as np

LONGEST = 48  # bytes of a match taken here; longer ones go through `Prefixes`
ROWS = 1 << 15  # matches side by side
PAIRS = 1 << 18  # pairs of tokens remembered
MIX = np.uint64(0x9E3779B97F4A7C15)


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * MIX) >> np.uint64(64 - bits)).astype(np.int64)


class Trie:
    """Children by (node, byte) in an open hash table; node 0 is the root."""

    def __init__(self, opening: dict[bytes, int]):
        number = {prefix: i for i, prefix in enumerate(opening, 1)}
        number[b""] = 0
        self.token = np.fromiter((-1, *opening.values()), np.int32)
        keys = np.fromiter((number[p[:-1]] << 8 | p[-1] for p in opening), np.int64, len(opening))
        self.bits = max(4, len(keys).bit_length() + 1)
        self.keys, self.child = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32)
        at, wait = _slot(keys, self.bits), np.arange(len(keys))
        while len(wait):
            free = self.keys[at[wait]] < 0
            self.keys[at[wait[free]]] = keys[wait[free]]  # one of several for a slot wins
            won = self.keys[at[wait]] == keys[wait]
            self.child[at[wait[won]]] = wait[won] + 1
            wait = wait[~won]
            at[wait] = (at[wait] + 1) & ((1 << self.bits) - 1)

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The child of each node, -1 without one."""
        key = node.astype(np.int64) << 8 | byte
        at = _slot(key, self.bits)
        out = np.where(self.keys[at] == key, self.child[at], -1)
        wait = np.nonzero((out < 0) & (self.keys[at] >= 0))[0]
        while len(wait):
            at[wait] = (at[wait] + 1) & ((1 << self.bits) - 1)
            held = self.keys[at[wait]]
            same = held == key[wait]
            out[wait[same]] = self.child[at[wait[same]]]
            wait = wait[~same & (held >= 0)]
        return out


class Batch:
    def __init__(self, encoder):
        self.encoder, self.trie = encoder, Trie(encoder.opening)
        self.size = np.zeros(max(encoder.bytes_of, default=0) + 1, np.int32)
        for token, data in encoder.bytes_of.items():
            self.size[token] = len(data)
        self.pairs, self.fit = np.full(PAIRS, -1, np.int64), np.zeros(PAIRS, bool)

    def may_stand(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 20 | b
        at = _slot(key, PAIRS.bit_length() - 1)
        known = self.pairs[at] == key
        out = self.fit[at]
        if not known.all():
            fresh, where = np.unique(key[~known], return_inverse=True)
            fits = np.fromiter((self.encoder.fit(k >> 20, k & 0xFFFFF) for k in fresh.tolist()), bool, len(fresh))
            out[~known] = fits[where]
            # of several for a place the last is kept, key and answer alike
            place = _slot(fresh, PAIRS.bit_length() - 1)
            self.pairs[place] = fresh
            kept = self.pairs[place] == fresh
            self.fit[place[kept]] = fits[kept]
        return out

    def last(self, data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths, and by row the last token of every prefix; `data` is ordered from long to short."""
        n = np.fromiter(map(len, data), np.int64, len(data))
        width = int(n.max(initial=0))
        byte = np.frombuffer(b"".join(d.ljust(width, b"\0") for d in data), np.uint8).reshape(len(data), width)
        last = np.full((len(data), width + 1), -1, np.int32)
        for start in range(width):
            rows = np.arange(int((n > start).sum()))
            node = np.zeros(len(rows), np.int32)
            for end in range(start + 1, width + 1):
                more = int((n[rows] >= end).sum())  # rows stay ordered by length
                node = self.trie.step(node[:more], byte[rows[:more], end - 1])
                alive = node >= 0
                rows, node = rows[:more][alive], node[alive]
                if not len(rows):
                    break
                token = self.trie.token[node]
                open_ = np.nonzero((token >= 0) & (last[rows, end] < 0))[0]
                r, t = rows[open_], token[open_]
                if start and len(r):
                    ok = self.may_stand(last[r, start], t)
                    r, t = r[ok], t[ok]
                last[r, end] = t
        return n, last

    def ids(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each match, none of them empty or longer than LONGEST."""
        out: list[list[int]] = [[]] * len(pieces)
        order = sorted(range(len(pieces)), key=lambda i: -len(pieces[i]))
        for at in range(0, len(order), ROWS):
            part = order[at : at + ROWS]
            end, last = self.last([pieces[i] for i in part])
            found = [[] for _ in part]
            rows = np.arange(len(part))
            while len(rows):
                token = last[rows, end[rows]]
                if (token < 0).any():
                    raise ValueError("the ranks lack a single byte")
                for i, t in zip(rows.tolist(), token.tolist()):
                    found[i].append(t)
                end[rows] -= self.size[token]
                rows = rows[end[rows] > 0]
            for i, ids in zip(part, found):
                whole = self.encoder.ranks.get(pieces[i])
                out[i] = [whole] if whole is not None else ids[::-1]
        return out
