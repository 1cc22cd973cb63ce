"""Rows of a frame chosen by what a task finds in one text column; all columns stay as they are."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgermill.llm.ragged import text_slices


def keep_rows(docs: DataFrame, column: str, wanted: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows for which ``wanted`` of the column's texts is true. Nothing is shuffled.

    Columns pass by place, so their names may clash with any other.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index(column)]

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, text):
            yield part.filter(pa.array(wanted(part.column(text))))

    renamed = docs.toDF(*names)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in renamed.schema.fields])
    return renamed.mapInArrow(chosen, schema).toDF(*docs.columns)
