"""Hashes of tokens, the words between ASCII white space with A to Z in lower case, of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of a token that are hashed together with others' in steps of eight; of texts that are cut at once.
LONG, BYTES = 256, 1 << 22
_PRIMES = tuple(np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def chain(seed: np.ndarray, value: np.ndarray) -> np.ndarray:
    """XXH64 of a number with a seed, element by element: what Spark's xxhash64 chains over columns."""
    p1, p2, p3, p4, p5 = _PRIMES

    def turn(x: np.ndarray, bits: int) -> np.ndarray:
        return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))

    with np.errstate(over="ignore"):
        h = seed + p5 + np.uint64(8)
        h = h ^ (turn(value * p2, 31) * p1)
        h = turn(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return h ^ (h >> np.uint64(32))


def distinct(keys: np.ndarray) -> np.ndarray:
    """Each of the keys once, sorted."""
    keys = np.sort(keys)
    return keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def token_hashes(data: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of texts that lie one after another in the bytes, and how many each text has.

    bounds: where each text begins, and the end of the last.
    """
    data = data.translate(_LOWER)
    signs = np.frombuffer(data, np.uint8)
    space = np.concatenate(([True], _SPACE[signs], [True]))
    edge = np.zeros(len(signs) + 1, bool)
    edge[bounds] = True
    word = ~space[1:-1]
    starts = np.flatnonzero(word & (space[:-2] | edge[:-1]))
    ends = np.flatnonzero(word & (space[2:] | edge[1:])) + 1
    counts = np.diff(np.searchsorted(starts, bounds))
    sizes = ends - starts
    # A number from the eight bytes at any place.
    eight = np.lib.stride_tricks.as_strided(np.frombuffer(data + bytes(8), np.uint8)[:8].view(np.uint64), (len(data) + 1,), (1,))
    hashes = sizes.astype(np.uint64)
    here, at = np.flatnonzero(sizes <= LONG), 0
    while len(here):
        left = np.minimum(sizes[here] - at, 8).astype(np.uint64)
        block = eight[starts[here] + at] << (np.uint64(64) - left * np.uint64(8))
        hashes[here] = chain(hashes[here], block)
        at += 8
        here = here[sizes[here] > at]
    for k in np.flatnonzero(sizes > LONG).tolist():
        hashes[k] = xxhash.xxh64_intdigest(data[starts[k] : ends[k]])
    return hashes, counts


def slices(texts: pa.Array) -> Iterator[tuple[bytes, np.ndarray]]:
    """Bytes and bounds of several texts at a time."""
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = memoryview(texts.buffers()[2]) if texts.buffers()[2] is not None else memoryview(b"")
    parts = (bounds[1:] - bounds[0]) // BYTES
    firsts = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(texts)]
    for first, last in zip(firsts, firsts[1:], strict=False):
        yield bytes(data[bounds[first] : bounds[last]]), bounds[first : last + 1] - bounds[first]
