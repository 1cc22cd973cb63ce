"""JDBC warehouse tables.

The connection is the caller's; no address or password is kept here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgermill.schemas import WAREHOUSE
from ledgermill.sources.sinks import conform


@dataclass(frozen=True)
class Warehouse:
    url: str
    schema: str = "bank_dwh"
    properties: dict[str, str] = field(default_factory=dict)

    def options(self, table: str) -> dict[str, str]:
        return {**self.properties, "url": self.url, "dbtable": f"{self.schema}.{table}"}


def write_table(
    df: DataFrame, warehouse: Warehouse, table: str, connections: int = 16
) -> None:
    """Overwrite the rows and keep the table definition.

    Loading is limited to a fixed number of connections, as a database takes
    few writers, in batches of ten thousand rows.
    """
    ready = conform(df, WAREHOUSE[table]) if table in WAREHOUSE else df
    (
        ready.coalesce(connections)
        .write.format("jdbc")
        .options(**warehouse.options(table))
        .option("truncate", "true")
        .option("batchsize", "10000")
        .mode("overwrite")
        .save()
    )


def read_table(
    spark: SparkSession,
    warehouse: Warehouse,
    table: str,
    *,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    parts: int = 16,
) -> DataFrame:
    """Read a table or view; a numeric column with bounds splits the read."""
    reader = (
        spark.read.format("jdbc")
        .options(**warehouse.options(table))
        .option("fetchsize", "10000")
    )
    if split_column and bounds:
        reader = (
            reader.option("partitionColumn", split_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", parts)
        )
    return reader.load()
