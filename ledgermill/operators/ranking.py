"""Top-N, first-per-key and label ordering.

Every ranking ends with the key, so ties resolve the same way on every run.
``orderBy().limit(n)`` plans as a per-task heap of ``n`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.functions.bands import as_column


def top_n(df: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(measure), F.asc(key)).limit(n)


def bottom_n(df: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    return df.orderBy(F.asc_nulls_last(measure), F.asc(key)).limit(n)


def top_and_bottom(df: DataFrame, measure: str, key: str, n: int = 5) -> DataFrame:
    """Best and worst ``n``, labelled by their side of the median of those 2n rows."""
    ends = top_n(df, measure, key, n).unionByName(bottom_n(df, measure, key, n))
    middle = F.median(measure).over(Window.partitionBy())
    return ends.withColumn(
        "group_label",
        F.when(F.col(measure) > middle, f"Top {n}").otherwise(f"Bottom {n}"),
    )


def latest_n(df: DataFrame, period: str, n: int) -> DataFrame:
    """The last ``n`` periods, oldest first."""
    return df.orderBy(F.desc(period)).limit(n).orderBy(period)


def restrict_to(df: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the chosen keys."""
    return df.join(chosen.select(key), key, "left_semi")


def first_per_key(df: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """First row of each key in the given order.

    The rank filter is pushed below the shuffle as a group limit: each task
    sends at most one row per key, so a hot key does not gather in one task.
    """
    window = Window.partitionBy(key).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def distinguish_labels(df: DataFrame, label: str, key: str, order: Sequence[Column]) -> DataFrame:
    """Keep the first use of a label; later ones get their key appended.

    Meant for report-sized frames, the output of a top-N.
    """
    window = Window.partitionBy(label).orderBy(*order)
    repeat = F.row_number().over(window) > 1
    name = F.coalesce(F.col(label), F.lit("Branch"))
    suffixed = F.concat(name, F.lit(" ("), F.col(key).cast("string"), F.lit(")"))
    return df.withColumn("display_label", F.when(repeat, suffixed).otherwise(name))


def severity_rank(label: Column | str, order: Sequence[str]) -> Column:
    """Position of a label in a fixed order; unknown labels come last."""
    label = as_column(label)
    chain = F.when(label == order[0], 1)
    for position, name in enumerate(order[1:], start=2):
        chain = chain.when(label == name, position)
    return chain.otherwise(len(order) + 1)


def distinct_sorted(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct().orderBy(key)
