"""Fingerprints and their hierarchical index in Gray order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FANOUT = 16
FULL = (1 << 64) - 1
#: Hashes that are mixed at once, about.
PART = 1 << 14
#: Pairs that a search holds at once, about.
HELD = 1 << 18


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes (rows of words) have each bit, most significant first."""
    total = np.zeros(hashes.shape[1] * 64, np.int64)
    for at in range(0, len(hashes), 255 * 64):
        part = hashes[at : at + 255 * 64].astype(">u8").view(np.uint8)
        bits = np.unpackbits(part, axis=1)
        for k in range(0, len(bits), 255):
            total += np.add.reduce(bits[k : k + 255], axis=0, dtype=np.uint8)
    return total


def mixed(hashes: np.ndarray, words: int) -> np.ndarray:
    """Rows of words: the hash, and the hash mixed anew for each other word."""
    out = np.empty((len(hashes), words), np.uint64)
    out[:, 0] = hashes
    for k in range(1, words):
        x = hashes + np.uint64(k * 0x9E3779B97F4A7C15 & FULL)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[:, k] = x ^ (x >> np.uint64(31))
    return out


def fingerprint(hashes: np.ndarray, words: int = 1) -> bytes:
    """Big-endian bits set in over half the hashes; zeros without hashes."""
    return fingerprints([hashes], words)[0]


def fingerprints(sets: list[np.ndarray], words: int = 1) -> list[bytes]:
    """The fingerprint of each set of hashes; several sets are mixed at once."""
    out: list[bytes] = []
    sizes = np.array([len(x) for x in sets], np.int64)
    parts = np.cumsum(sizes) // PART
    for part in np.split(np.arange(len(sets)), np.flatnonzero(parts[1:] != parts[:-1]) + 1):
        held = [sets[k] for k in part.tolist()]
        rows = mixed(np.concatenate(held), words) if held else np.empty((0, words), np.uint64)
        at = 0
        for own in held:
            counts = bit_counts(rows[at : at + len(own)])
            out.append(np.packbits(2 * counts > len(own)).tobytes())
            at += len(own)
    return out


def words_of(values: list[bytes], words: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), ">u8").astype(np.uint64).reshape(-1, words)


def gray_rank(words: np.ndarray) -> np.ndarray:
    """Place of each word in the order of the reflected Gray code."""
    rank = words.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Trees over fingerprints, rows of 64-bit words: one for each group, all searched at once.

    A group's rows share a masked bit pattern, which is part of the pattern of
    its upper node.  Below, rows in Gray order of their first word make nodes of
    ``FANOUT``; a node's pattern is what all rows below agree on, less what its
    parent's pattern already has.
    """

    def __init__(self, rows: np.ndarray, groups: np.ndarray | None = None) -> None:
        """groups: the group of each row, numbered from 0 without gaps; by default all are one."""
        self.words = rows.shape[1]
        self.groups = np.zeros(len(rows), np.int64) if groups is None else groups
        self.order = np.lexsort((gray_rank(rows[:, 0]), self.groups))
        level, of = rows[self.order], self.groups[self.order]
        self.sizes = np.bincount(self.groups, minlength=1 if len(rows) else 0)
        low = high = level
        shared = np.full_like(level, FULL)
        #: Leaves first: for each word values and own masks, then first child, number of children, end of the leaves below.
        self.levels: list[tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]] = []
        first = many = np.zeros(len(level), np.int32)
        ends = np.arange(1, len(level) + 1, dtype=np.int32)

        def keep(mask: np.ndarray) -> None:
            self.levels.append(([np.ascontiguousarray(c) for c in level.T], [np.ascontiguousarray(c) for c in mask.T], first, many, ends))

        while len(level) > len(self.sizes):
            starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            place = np.arange(len(of)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(of)]))))
            firsts = np.flatnonzero(place % FANOUT == 0)
            low, high = np.bitwise_and.reduceat(low, firsts), np.bitwise_or.reduceat(high, firsts)
            above = ~(low ^ high)
            counts = np.diff(np.concatenate((firsts, [len(of)])))
            keep(shared & ~np.repeat(above, counts, axis=0))
            level, shared, of, ends = low & above, above, of[firsts], ends[firsts + counts - 1]
            first, many = firsts.astype(np.int32), counts.astype(np.int32)
        keep(shared)

    def _descend(self, queries: list[np.ndarray], limit: int, node: np.ndarray, after: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of queries, places in order of the rows within the limit, and distances.

        A node is left, with all that lies below it, as soon as the differences from the patterns on the way to it pass
        the limit.  after: for each query the place after which rows count.
        """
        who, apart = np.arange(len(node), dtype=np.int32), np.zeros(len(node), np.int16)
        for depth in range(len(self.levels) - 1, -1, -1):
            values, masks, first, many, ends = self.levels[depth]
            apart = apart.copy()
            for query, value, mask in zip(queries, values, masks, strict=True):
                apart += np.bitwise_count((query[who] ^ value[node]) & mask[node])
            near = apart <= limit
            if after is not None:
                near &= ends[node] > after[who]
            near = np.flatnonzero(near)
            who, node, apart = who[near], node[near], apart[near]
            if depth:
                counts = many[node]
                below = np.cumsum(counts, dtype=np.int32)
                below = np.arange(below[-1] if len(below) else 0, dtype=np.int32) - np.repeat(below - counts - first[node], counts)
                who, apart, node = np.repeat(who, counts), np.repeat(apart, counts), below
        return who, node, apart

    def search(self, queries: np.ndarray, limit: int, groups: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of queries and of rows of their group within the limit, and their distances."""
        top = np.zeros(len(queries), np.int32) if groups is None else groups.astype(np.int32)
        who, found, apart = self._descend([np.ascontiguousarray(c) for c in queries.T], limit, top, None)
        return who, self.order[found], apart

    def pairs(self, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Places of two rows of a group within the limit, each pair once, and their distance; a bounded part at a time."""
        if not len(self.order):
            return
        of = self.groups[self.order]
        asking = np.flatnonzero(self.sizes[of] > 1).astype(np.int32)
        # A part's searches end in about as many rows as it may hold.
        parts = np.cumsum(self.sizes[of[asking]]) // HELD
        leaves = self.levels[0][0]
        for part in np.split(asking, np.flatnonzero(parts[1:] != parts[:-1]) + 1) if len(asking) else ():
            who, found, apart = self._descend([c[part] for c in leaves], limit, of[part].astype(np.int32), part + np.int32(1))
            x, y = self.order[part[who]], self.order[found]
            yield np.minimum(x, y), np.maximum(x, y), apart.astype(np.int64)


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each one's component, from pairs of places."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        np.minimum.at(new, label[a], new[a])
        np.minimum.at(new, label[b], new[b])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal keys begin, and the number of each one's run."""
    changes = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.empty(0, bool)
    return np.flatnonzero(changes), np.cumsum(changes) - 1
