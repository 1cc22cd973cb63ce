"""Sums of one large array per task, added up in a tree so that no step takes in many."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Arrays, and bytes of arrays, that meet at once.
FAN_IN, FAN_BYTES = 64, 16 << 20
SCHEMA = "part int, body binary"


def task_array(array: np.ndarray) -> pa.RecordBatch:
    """The row that a task hands to ``tree_sum``."""
    return pa.RecordBatch.from_pydict(
        {
            "part": pa.array([TaskContext.get().partitionId()], pa.int32()),
            "body": pa.array([np.ascontiguousarray(array, np.float64).tobytes()], pa.binary()),
        }
    )


def tree_sum(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of the arrays of a frame of ``task_array`` rows; zeros without rows.

    At most ``FAN_IN`` arrays or about ``FAN_BYTES`` of them (two at least) meet in a
    task or come to the driver at once, and each task adds them in the order of
    their numbers, so repeats agree.
    """
    fan_in = max(2, min(FAN_IN, FAN_BYTES // (8 * max(1, size))))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, number = None, None
        for batch in batches:
            for part, body in zip(batch.column("part").to_pylist(), batch.column("body"), strict=True):
                array = np.frombuffer(body.as_buffer(), np.float64)
                if part // fan_in != number:
                    if total is not None:
                        yield pa.RecordBatch.from_pydict({"part": pa.array([number], pa.int32()), "body": [total.tobytes()]})
                    total, number = np.zeros(size), part // fan_in
                total += array
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([number], pa.int32()), "body": [total.tobytes()]})

    count = parts.rdd.getNumPartitions()
    while count > fan_in:
        count = -(-count // fan_in)
        group = F.floor(F.col("part") / fan_in)
        parts = parts.repartition(count, group).sortWithinPartitions("part").mapInArrow(added, SCHEMA)
    total = np.zeros(size)
    for row in sorted(parts.collect(), key=lambda r: r["part"]):
        total += np.frombuffer(row["body"], np.float64)
    return total
