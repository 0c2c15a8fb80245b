"""Names of temporary columns."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like these that are not columns, whatever their case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        found = f"_{name}"
        while found.lower() in taken:
            found = f"_{found}"
        taken.add(found.lower())
        out.append(found)
    return out
