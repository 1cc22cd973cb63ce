"""Sides of joins that are stored first, so that the planner knows their size."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgermill.sources.paths import stored


def key_set(df: DataFrame, key: str) -> DataFrame:
    """The distinct keys of a frame, stored.

    Joined against, they are a plain scan of known size: broadcast when below
    the session's threshold, else shuffled in a shape whose other side adaptive
    execution can split at a hot key.
    """
    return stored(df.select(key).distinct(), "key-set")
