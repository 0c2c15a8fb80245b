"""Hashes of word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from lexmill.llm.tokens import chain, distinct, slices, token_hashes

SEED = 42


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words, in lower case; of all words if fewer."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    return np.fromiter([digest(joined[s:e], SEED) for s, e in spans], np.uint64, len(words) - size + 1)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Each text's set of shingles, as sorted hashes: of runs of ``size`` words, or of all words if fewer.

    The hashes are other ones than ``shingle_hashes``', made for many texts at once.
    """
    step = np.uint64(0x9E3779B97F4A7C15)
    for data, bounds in slices(texts):
        words, counts = token_hashes(data, bounds)
        firsts = np.concatenate(([0], np.cumsum(counts)))
        run = words.copy()
        for k in range(1, size):
            run = run[: len(words) - k] * step + words[k:] if k < len(words) else run[:0]
        run = chain(np.full(1, size, np.uint64), run)
        for first, count in zip(firsts[:-1].tolist(), counts.tolist(), strict=True):
            if count >= size:
                yield distinct(run[first : first + count - size + 1])
            else:
                short = words[first : first + 1]
                for word in words[first + 1 : first + count]:
                    short = short * step + word
                yield chain(np.full(1, count, np.uint64), short[:count])
