"""Bounded samples of rows for fitting, the same in every run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_bound(rows: float, total: float) -> int | None:
    """The signed 64-bit number below which about ``rows`` of ``total`` hashes lie; ``None`` if all do."""
    if total <= rows:
        return None
    return -(1 << 63) + max(1, int(rows * (1 << 64) / total))


def in_sample(rows: float, total: float, *columns: str) -> Column:
    """Whether the hash of the columns falls in a share that holds about ``rows`` of ``total`` rows.

    The whole 64-bit hash is compared, so the share may be as small as it likes.
    """
    bound = sample_bound(rows, total)
    return F.lit(True) if bound is None else F.xxhash64(*columns) < F.lit(bound)
