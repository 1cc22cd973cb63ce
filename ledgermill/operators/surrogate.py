"""Dense surrogate ids without a global sort.

Rows are spread over hash buckets of a unique key, numbered inside the bucket,
and shifted by the running total of the bucket sizes. The only single-task step
sums ``buckets`` numbers, and that table of at most ``buckets`` rows is
broadcast. Numbers depend on the keys alone, so a retried task gives the same
ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions.bands import as_column

BUCKETS = 1024
MAX_BUCKETS = 100_000


def sequential_ids(
    df: DataFrame,
    order: list[str],
    bucket: Column,
    buckets: int = BUCKETS,
    name: str = "row_number",
) -> DataFrame:
    """Number rows ``1..n`` by (bucket, order); ``order`` must be unique per row."""
    if buckets > MAX_BUCKETS:
        raise ValueError(f"at most {MAX_BUCKETS} buckets")
    placed = df.withColumn("_bucket", F.pmod(bucket, F.lit(buckets)))
    sizes = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(running), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("_bucket").orderBy(*order)
    return (
        placed.withColumn("_place", F.row_number().over(inside))
        .join(F.broadcast(starts), "_bucket")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_bucket", "_place", "_start")
    )


def padded_id(number: Column | str, prefix: str, width: int) -> Column:
    """``TX_00000001``; a longer number is kept whole."""
    digits = as_column(number).cast("string")
    padded = F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
    return F.concat(F.lit(prefix), padded)


def ids_within_group(
    df: DataFrame,
    group: str,
    order: list[str],
    bucket: Column,
    buckets: int = BUCKETS,
    name: str = "row_number",
) -> DataFrame:
    """Number the rows of each group from zero by (bucket, order).

    A hot group is numbered in ``buckets`` tasks; the bucket starts are joined
    on group and bucket, the partitioning the numbering already has.
    """
    placed = df.withColumn("_bucket", F.pmod(bucket, F.lit(buckets)))
    running = (
        Window.partitionBy("_group").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        placed.groupBy(F.col(group).alias("_group"), F.col("_bucket").alias("_at"))
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_group", "_at", F.coalesce(F.sum("_size").over(running), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(group, "_bucket").orderBy(*order)
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_bucket") == F.col("_at"))
    return (
        placed.withColumn("_place", F.row_number().over(inside))
        .join(starts, same)
        .withColumn(name, F.col("_start") + F.col("_place") - 1)
        .drop("_bucket", "_place", "_start", "_group", "_at")
    )
