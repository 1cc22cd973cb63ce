"""Rows dealt into ranges of an id, so that each task sees a stretch of the id order.

The bounds are approximate quantiles of the ids, taken from the id column alone,
and there are ``RANGES_PER_TASK`` ranges for each shuffle partition, so ranges
that meet in one task even out.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGES_PER_TASK = 4
AT = "_range"


def shuffle_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_bounds(df: DataFrame, key: str) -> list[float]:
    """Ascending inner bounds of the ranges of ``key``; at most four for each shuffle partition."""
    count = shuffle_tasks(df) * RANGES_PER_TASK
    shares = [i / count for i in range(1, count)]
    found = df.select(F.percentile_approx(F.col(key).cast("double"), F.array(*map(F.lit, shares)), 10 * count)).first()
    return sorted(set(found[0] or []))


def with_range(df: DataFrame, key: str, bounds: list[float]) -> DataFrame:
    """Add the number of the range that ``key`` falls in; NULL keys are in the first."""
    value = F.coalesce(F.col(key).cast("double"), F.lit(float("-inf")))
    if not bounds:
        return df.withColumn(AT, F.lit(0))
    splits = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="_key", outputCol=AT)
    return splits.transform(df.withColumn("_key", value)).drop("_key").withColumn(AT, F.col(AT).cast("int"))


@dataclass
class Ranges:
    """What is known of the ranges that have rows: numbers, first keys."""

    numbers: list[int]
    firsts: list[object]

    def before(self, number: int) -> int:
        """The range before, with rows; before the first comes the last."""
        return self.numbers[bisect_right(self.numbers, number) - 2]


def ranges_of(df: DataFrame, key: str) -> Ranges:
    """First key of each range of a frame with range numbers: at most one row per range."""
    # NULL comes first in ascending order.
    first = F.when(F.max(F.col(key).isNull()), F.lit(None)).otherwise(F.min(key))
    rows = sorted(df.groupBy(AT).agg(first.alias("first")).collect(), key=lambda r: r[AT])
    return Ranges([r[AT] for r in rows], [r["first"] for r in rows])
