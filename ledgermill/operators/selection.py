"""Exact order statistics of an integer column without sorting the table.

The source is scanned once: its values are counted (combined on the map side)
and the counts are written to the shared folder. The value range is then cut
into at most ``buckets`` slices whose weights are summed, and the slice that
holds the wanted rank becomes the next range. What returns to the driver is one
pass's slice weights, at most ``buckets`` numbers; a 64-bit range needs five
passes over the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.money import paise
from ledgermill.sources.paths import stored

BUCKETS = 8192


def value_counts(df: DataFrame, value: Column) -> DataFrame:
    """Stored table of each non-null value ``v`` and its number of rows ``n``."""
    values = df.select(value.cast("bigint").alias("v")).filter(F.col("v").isNotNull())
    return stored(values.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "value-counts")


def nth_smallest(counts: DataFrame, rank: int, buckets: int = BUCKETS) -> int | None:
    """Value at a zero-based rank, or None beyond the end."""
    low, high, total = counts.agg(F.min("v"), F.max("v"), F.sum("n")).first()
    if total is None or not 0 <= rank < total:
        return None
    while low < high:
        width = -(-(high - low + 1) // buckets)
        v = F.col("v") if high - low < 2**62 else F.col("v").cast("decimal(20,0)")
        position = F.call_function("div", v - F.lit(low), F.lit(width))
        weights = (
            counts.filter(F.col("v").between(low, high))
            .groupBy(position.cast("bigint").alias("slice"))
            .agg(F.sum("n").alias("n"))
            .collect()
        )
        for slice_id, n in sorted((row["slice"], row["n"]) for row in weights):
            if rank < n:
                low, high = low + slice_id * width, min(high, low + (slice_id + 1) * width - 1)
                break
            rank -= n
    return low


def exact_median_money(df: DataFrame, amount: Column | str) -> float | None:
    """Median of an amount; the mean of the middle two when the count is even."""
    counts = value_counts(df, paise(amount))
    total = counts.agg(F.sum("n")).first()[0]
    if total is None:
        return None
    lower = nth_smallest(counts, (total - 1) // 2)
    if total % 2:
        return lower / 100
    at_most, above = counts.agg(
        F.sum(F.when(F.col("v") <= lower, F.col("n"))),
        F.min(F.when(F.col("v") > lower, F.col("v"))),
    ).first()
    upper = lower if at_most > total // 2 else above
    return (lower + upper) / 200
