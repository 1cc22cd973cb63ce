"""File readers with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.schemas import CORRUPT, ENTITIES, RAW_TRANSACTIONS
from ledgermill.sources.paths import stored


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV in one pass; a line that does not fit keeps its text."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(full)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", True)
        .csv(path)
    )


def read_entity(spark: SparkSession, base_path: str, entity: str) -> DataFrame:
    """One of the six entity CSVs."""
    return read_csv(spark, f"{base_path}/{entity}.csv", ENTITIES[entity])


def read_entities(spark: SparkSession, base_path: str) -> dict[str, DataFrame]:
    return {entity: read_entity(spark, base_path, entity) for entity in ENTITIES}


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw transaction file as text columns, with the position of every row.

    ``source_file``, ``source_block`` and ``source_row`` sort the rows in file
    order however the file was split. A line with more or fewer fields than the
    file has columns keeps its text in the column ``CORRUPT`` and is to be routed
    by ``raw_lines`` or ``malformed_lines``.
    """
    columns = [F.col(f"`{name}`") for name in RAW_TRANSACTIONS.names]
    # Spark reads a line's text only together with all its columns.
    whole_line = F.length(F.concat_ws("", *columns)) >= 0
    return read_csv(spark, path, RAW_TRANSACTIONS).select(
        *columns,
        F.when(whole_line, F.col(CORRUPT)).alias(CORRUPT),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_block"),
        F.monotonically_increasing_id().alias("source_row"),
    )


def raw_lines(raw: DataFrame) -> DataFrame:
    """The lines that fit the file's columns."""
    return raw.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def malformed_lines(raw: DataFrame) -> DataFrame:
    """Text and place of the lines that do not."""
    return raw.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT, *FILE_ORDER)


FILE_ORDER = ["source_file", "source_block", "source_row"]


def with_ordinal(raw: DataFrame, name: str = "ordinal") -> DataFrame:
    """Count the rows from zero in file order.

    Rows of one block are consecutive within a task, so only the block sizes are
    summed up across tasks. The block list is stored first, so the planner knows
    its size: it is broadcast below the session's threshold, else the join is a
    shuffle.
    """
    blocks = raw.groupBy("source_file", "source_block").agg(
        F.count(F.lit(1)).alias("_size"), F.min("source_row").alias("_first")
    )
    in_file = Window.partitionBy("source_file").orderBy("source_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    files = blocks.groupBy("source_file").agg(F.sum("_size").alias("_file_size"))
    across = Window.orderBy("source_file").rowsBetween(Window.unboundedPreceding, -1)
    file_starts = files.select(
        "source_file", F.coalesce(F.sum("_file_size").over(across), F.lit(0)).alias("_file_start")
    )
    starts = (
        blocks.withColumn("_in_file", F.coalesce(F.sum("_size").over(in_file), F.lit(0)))
        .join(file_starts, "source_file")
        .select(
            "source_file",
            "source_block",
            "_first",
            (F.col("_file_start") + F.col("_in_file")).alias("_start"),
        )
    )
    return (
        raw.join(stored(starts, "block-starts"), ["source_file", "source_block"])
        .withColumn(name, F.col("_start") + F.col("source_row") - F.col("_first"))
        .drop("_start", "_first")
    )
