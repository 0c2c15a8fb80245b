"""Errors that name what is wrong and show a few offenders."""

from __future__ import annotations

from collections.abc import Sequence


class LexmillError(Exception):
    """Base of this library's errors."""


class SchemaError(LexmillError):
    """A table lacks columns of its contract or has them in other types."""


class SourceError(LexmillError):
    """Files of a shard are missing or don't belong together."""


class IntegrityError(LexmillError):
    """Rows break a key, a reference or an identity."""

    def __init__(self, check: str, samples: Sequence[str]) -> None:
        super().__init__(f"{check}: {', '.join(map(repr, samples))}")
        self.check, self.samples = check, list(samples)


class PublicationError(LexmillError):
    """What was published differs from what its rows give."""


class CheckpointError(LexmillError):
    """What a run left behind is not of this run or not whole."""
