"""Sinks of the windowed volume.

Update mode emits a window again whenever it changes, so the lake sink keeps
every emission under its batch number and the reader takes the latest. Writing
a batch again replaces it, which makes replays after a failure harmless.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgermill.sources.warehouse import Warehouse

KEYS = ["window_start", "window_end", "branch_id"]

#: For state larger than memory: it lies on local disk, and all stores of an executor share a
#: bounded native memory, which the overhead of the executor must hold.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Else every write looks its key up first, only to report how many rows there are.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def to_console(volume: DataFrame, checkpoint: str) -> StreamingQuery:
    return (
        volume.writeStream.outputMode("update")
        .format("console")
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
        .start()
    )


def keep_events(events: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append events as they are; the file sink's log makes each appear once."""
    writer = (
        events.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return writer.trigger(availableNow=True).start() if available_now else writer.start()


def to_lake(
    volume: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Write every micro-batch to ``path/batch_id=n``.

    The number of state partitions is fixed when a checkpoint is new: the
    session's shuffle partitions, or ``state_partitions`` when given.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return start(volume, save, checkpoint, available_now, state_partitions)


def to_lake_and_warehouse(
    volume: DataFrame,
    path: str,
    warehouse: Warehouse,
    table: str,
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Lake first; the warehouse then takes the same rows, stamped with the batch."""

    def save(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(target)
        stored = batch.sparkSession.read.parquet(target)
        (
            stored.withColumn("batch_id", F.lit(batch_id))
            .coalesce(8)
            .write.format("jdbc")
            .options(**warehouse.options(table))
            .mode("append")
            .save()
        )

    return start(volume, save, checkpoint, available_now)


def start(
    volume: DataFrame,
    save: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool,
    state_partitions: int | None = None,
    state: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Start a query with ``state`` as settings of its state store, else the session's."""
    writer = (
        volume.writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    settings = dict(state or {})
    if state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    # A started query keeps its own copy of the session's settings.
    conf = volume.sparkSession.conf
    before = {key: conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            conf.set(key, value)
        return writer.start()
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def latest_windows(spark: SparkSession, path: str) -> DataFrame:
    """Last emission of every window and branch."""
    emitted = spark.read.parquet(path)
    measures = [c for c in emitted.columns if c not in (*KEYS, "batch_id")]
    newest = F.max_by(F.struct(*measures), "batch_id").alias("m")
    return emitted.groupBy(*KEYS).agg(newest).select(*KEYS, "m.*")


def late_rows_dropped(query: StreamingQuery) -> int:
    """State rows dropped behind the watermark, over the kept progress reports.

    ``late.LateRows`` counts over all reports.
    """
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )
