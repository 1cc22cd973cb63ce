"""Repeatable sampling and row repetition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.draws import DRAW_RANGE
from ledgermill.operators.selection import nth_smallest
from ledgermill.sources.paths import stored


def sample_keys(df: DataFrame, key: str, draw: Column, fraction: float) -> DataFrame:
    """Distinct keys kept with the given probability (expected size)."""
    limit = int(fraction * DRAW_RANGE)
    return df.select(key).distinct().filter(draw < limit)


def sample_keys_exact(df: DataFrame, key: str, draw: Column, fraction: float) -> DataFrame:
    """Exactly ``int(fraction * n)`` of the n distinct keys, without replacement.

    The distinct keys are stored once. The cut-off draw comes from slice
    counts, so the keys are never sorted in one task; only keys that share the
    cut-off draw are ranked.
    """
    keys = stored(df.select(key).distinct().withColumn("_draw", draw), "sample-keys")
    size = int(keys.count() * fraction)
    if size == 0:
        return keys.select(key).limit(0)
    draws = keys.select(F.col("_draw").alias("v"), F.lit(1).alias("n"))
    cutoff = nth_smallest(draws, size - 1)
    below = keys.filter(F.col("_draw") < cutoff)
    ties = keys.filter(F.col("_draw") == cutoff).orderBy(key).limit(size - below.count())
    return below.unionByName(ties).select(key)


def sample_rows(df: DataFrame, key: str, draw: Column, n: int) -> DataFrame:
    """A display sample: the ``n`` rows with the smallest draws."""
    return df.withColumn("_draw", draw).orderBy("_draw", key).limit(n).drop("_draw")


def contiguous_sample(
    df: DataFrame, ordinal: str, n: int | None, seed: int = 0, total: int | None = None
) -> DataFrame:
    """``n`` neighbouring rows from a seeded offset; all rows when ``n`` is None.

    ``ordinal`` counts the rows from zero in source order. The filter is a plain
    range on it, so it prunes where the ordinal is stored. ``total`` is the row
    count when the caller knows it.
    """
    if n is None:
        return df
    if total is None:
        total = df.count()
    spare = max(0, total - n)
    start = (seed * 1103515245 + 12345) % (spare + 1)
    return df.filter((F.col(ordinal) >= start) & (F.col(ordinal) < start + n))


def repeat_rows(df: DataFrame, times: Column, index: str = "copy") -> DataFrame:
    """Each row ``times`` times, numbered from one."""
    return df.withColumn(
        index, F.explode(F.when(times > 0, F.sequence(F.lit(1), times.cast("int"))))
    )
