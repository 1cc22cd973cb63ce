"""Column profiles and descriptive statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.bands import as_column
from ledgermill.functions.money import number_or, paise, rupees, safe_ratio
from ledgermill.operators.selection import exact_median_money


def column_nulls(df: DataFrame) -> DataFrame:
    """One row per column: total, missing and present rows and their percentages.

    All columns are counted in a single pass and unpivoted afterwards.
    """
    names = df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count(F.col(f"`{name}`")).alias(f"_n{i}") for i, name in enumerate(names)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.col(f"_n{i}").alias("present"))
            for i, name in enumerate(names)
        ]
    )
    present = F.col("c.present")
    return counted.select("_total", F.explode(entries).alias("c")).select(
        F.col("c.column_name").alias("column_name"),
        F.col("_total").alias("total_rows"),
        present.alias("present_rows"),
        (F.col("_total") - present).alias("missing_rows"),
        safe_ratio(present * 100.0, "_total", None).alias("present_pct"),
        safe_ratio((F.col("_total") - present) * 100.0, "_total", None).alias("missing_pct"),
    )


def columns_with_gaps(df: DataFrame) -> DataFrame:
    """Only the columns that miss at least one value."""
    return column_nulls(df).filter("missing_rows > 0")


def amount_statistics(df: DataFrame, amount: str, key: str) -> DataFrame:
    """Row count, distinct keys, rows per key, and statistics of an amount.

    The key is reduced to one row per value first, so the distinct count is
    exact, survives a hot key, and shares the pass with the sums.
    """
    units = paise(number_or(amount, None))
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(units).alias("_sum"),
        F.count(units).alias("_n"),
        F.min(units).alias("_min"),
        F.max(units).alias("_max"),
    )
    numbers = df.select(number_or(amount, None).alias("_amount"))
    median = exact_median_money(numbers, "_amount")
    return per_key.agg(
        F.sum("_rows").alias("total_rows"),
        F.count(as_column(key)).alias("distinct_keys"),
        (F.sum("_rows") / F.count(as_column(key))).alias("rows_per_key"),
        rupees(F.sum("_sum")).alias("total_amount"),
        (F.sum("_sum").cast("double") / (F.sum("_n") * 100)).alias("mean_amount"),
        rupees(F.min("_min")).alias("min_amount"),
        rupees(F.max("_max")).alias("max_amount"),
    ).withColumn("median_amount", F.lit(median).cast("double"))


def approximate_distinct(df: DataFrame, keys: Sequence[str], rsd: float = 0.02) -> DataFrame:
    """Distinct counts of several columns in one pass, within a stated error."""
    return df.agg(*[F.approx_count_distinct(k, rsd).alias(k) for k in keys])
