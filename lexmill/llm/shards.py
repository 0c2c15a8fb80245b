"""Whole groups of sorted rows, many at a time."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: Rows of a shard, about.
ROWS = 200_000


def shards(batches: Iterator[pa.RecordBatch], most: int = ROWS) -> Iterator[list[pa.Array]]:
    """Columns of whole groups, which are runs of equal values of the first column."""
    held: list[pa.RecordBatch] = []
    size = 0

    def columns(parts: list[pa.RecordBatch]) -> list[pa.Array]:
        return [c.combine_chunks() for c in pa.Table.from_batches(parts).columns]

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < most:
            continue
        # Only this batch can hold the last place where a group ends, unless it is all one group.
        keys = batch.column(0).to_numpy()
        cut = batch.num_rows
        while cut and keys[cut - 1] == keys[-1]:
            cut -= 1
        if not cut and (len(held) < 2 or held[-2].column(0)[-1].as_py() == keys[-1]):
            continue  # the group goes on
        yield columns([*held[:-1], batch.slice(0, cut)])
        held, size = [batch.slice(cut)], batch.num_rows - cut
    if held:
        yield columns(held)
