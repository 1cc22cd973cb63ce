"""Windowed transaction volume per branch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.money import paise, rupees, sum_money

WINDOW_MINUTES = 5
SLIDE_MINUTES = 1
LATENESS = "10 minutes"


def _flatten(windowed: DataFrame) -> DataFrame:
    return windowed.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "branch_id",
        "window_total_volume",
        "window_txn_count",
    )


def stream_volume(
    events: DataFrame,
    size: str = f"{WINDOW_MINUTES} minutes",
    slide: str = f"{SLIDE_MINUTES} minute",
    lateness: str = LATENESS,
) -> DataFrame:
    """Sliding volume and count per branch, with a lateness bound."""
    return _flatten(
        events.withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", size, slide), "branch_id")
        .agg(
            sum_money("amount").alias("window_total_volume"),
            F.count("transaction_id").alias("window_txn_count"),
        )
    )


def batch_volume(
    events: DataFrame, size_minutes: int = WINDOW_MINUTES, slide_minutes: int = SLIDE_MINUTES
) -> DataFrame:
    """The same result over a table.

    Events are first summed into panes as long as the slide; only the panes are
    copied into the windows that hold them, so the copying does not multiply
    the fact rows. The size must be a multiple of the slide.
    """
    if size_minutes % slide_minutes:
        raise ValueError("the window size must be a multiple of the slide")
    panes = (
        events.groupBy(
            F.window("event_time", f"{slide_minutes} minutes").alias("pane"), "branch_id"
        )
        .agg(
            F.sum(paise("amount")).alias("units"),
            F.count("transaction_id").alias("txn_count"),
        )
        .select(F.col("pane.start").alias("pane_start"), "branch_id", "units", "txn_count")
    )
    return _flatten(
        panes.groupBy(
            F.window("pane_start", f"{size_minutes} minutes", f"{slide_minutes} minutes"),
            "branch_id",
        ).agg(
            rupees(F.sum("units")).alias("window_total_volume"),
            F.sum("txn_count").alias("window_txn_count"),
        )
    )


def surges(
    volume: DataFrame, lookback: int = 5, factor: float = 3.0, size_minutes: int = WINDOW_MINUTES
) -> DataFrame:
    """Windows whose count exceeds ``factor`` times the mean of the branch's windows before.

    The windows before are the ``lookback`` ones that end where the next begins,
    the last of them at the start of the tested one, so none shares an event with
    it; one without events counts as zero. A window is tested once the branch has
    been seen for as long as the lookback.

    Each window is handed to the later ones that look back on it, so windows meet
    by branch and time and a busy branch is spread over many tasks.
    """
    size = size_minutes * 60
    start = F.unix_timestamp("window_start")
    rows = volume.withColumn("_start", start)
    later = F.array(*[F.col("_start") + F.lit(size * k) for k in range(1, lookback + 1)])
    behind = (
        rows.select("branch_id", F.explode(later).alias("_start"), "window_txn_count")
        .groupBy("branch_id", "_start")
        .agg(F.sum("window_txn_count").alias("_total"))
    )
    seen = rows.groupBy("branch_id").agg(F.min("_start").alias("_first"))
    trailing = (
        rows.join(behind, ["branch_id", "_start"], "left")
        .join(seen, "branch_id")
        .filter(F.col("_start") >= F.col("_first") + size * lookback)
        .withColumn("trailing_total", F.coalesce("_total", F.lit(0).cast("bigint")))
        .withColumn("trailing_windows", F.lit(lookback).cast("bigint"))
        .drop("_start", "_total", "_first")
    )
    return trailing.filter(
        F.col("window_txn_count") * F.col("trailing_windows")
        > F.col("trailing_total") * F.lit(factor)
    )
