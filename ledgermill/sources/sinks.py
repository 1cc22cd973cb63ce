"""Parquet and CSV sinks, and a sink list with a reported outcome."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def overwrite_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), only_given_partitions: bool = False
) -> None:
    """Replace the table, or with ``only_given_partitions`` just the partitions in ``df``.

    A full rebuild leaves nothing of the table before, whatever the session's
    overwrite mode is.

    Partitioned output is rebalanced on the partition columns first: adaptive
    execution gives a hot partition several tasks and merges small ones.
    """
    writer = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    mode = "dynamic" if only_given_partitions else "static"
    writer = writer.write.mode("overwrite").option("partitionOverwriteMode", mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def overwrite_csv(df: DataFrame, path: str) -> None:
    """A folder of header CSV parts, one per task."""
    df.write.mode("overwrite").option("header", True).csv(path)


@dataclass(frozen=True)
class SinkOutcome:
    table: str
    sink: str
    failures: tuple[tuple[str, str], ...] = ()


def write_first(
    df: DataFrame, table: str, sinks: Sequence[tuple[str, Callable[[DataFrame], None]]]
) -> SinkOutcome:
    """Try the sinks in order and report which one took the table.

    Every failure before it is kept in the outcome; if none works, the last
    error is raised.
    """
    failures = []
    for position, (name, write) in enumerate(sinks):
        try:
            write(df)
            return SinkOutcome(table, name, tuple(failures))
        except Exception as error:
            failures.append((name, str(error).splitlines()[0]))
            if position == len(sinks) - 1:
                raise
    raise ValueError(f"{table}: no sink given")


def row_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows of each written table, read back from the files."""
    from ledgermill.operators.integrity import layer_counts

    return layer_counts({name: spark.read.parquet(path) for name, path in paths.items()})


def conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Select and cast to a declared table; a value that does not fit raises."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in columns.items()])
