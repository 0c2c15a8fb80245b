"""Columns of 64-bit numbers as one small binary value, for shuffles of many sorted keys."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_CODEC = pa.Codec("zstd", 1)


def pack(keys: np.ndarray, *others: np.ndarray) -> bytes:
    """Ascending keys and columns of the same length: differences of keys, and all bytes of one weight together."""
    columns = np.stack([np.diff(keys.astype(np.uint64), prepend=np.uint64(0)), *(np.ascontiguousarray(c).view(np.uint64) for c in others)])
    planes = columns.view(np.uint8).reshape(len(columns), len(keys), 8).transpose(0, 2, 1)
    return _CODEC.compress(np.ascontiguousarray(planes).data.cast("B") if len(keys) else b"", asbytes=True)


def unpack(data: bytes, size: int, columns: int) -> np.ndarray:
    """The columns, as unsigned numbers: a row for each."""
    if not size:
        return np.empty((columns, 0), np.uint64)
    planes = np.frombuffer(_CODEC.decompress(data, size * columns * 8), np.uint8).reshape(columns, 8, size)
    out = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.uint64).reshape(columns, size)
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out
