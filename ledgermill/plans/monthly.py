"""Stored monthly marts that are brought up to date month by month.

A fact table is partitioned by month, and a monthly mart needs nothing beyond its
month. The files of each source month have a fingerprint; only months whose
fingerprint is not the stored one are read. Rows lie under month and fingerprint,
and readers take the pairs that the stored fingerprints name: they see a refresh
when the fingerprints are written, and a month that has left the source is gone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.sources.sinks import overwrite_parquet

MONTH, PRINT = "month", "print"
PRINTS = "month string, print string"


def month_prints(spark: SparkSession, path: str) -> dict[str, str]:
    """A fingerprint of the files of each ``month=`` folder: names, lengths and times of change.

    Only the listing is read: one entry for each file.
    """
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    prints = {}
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if not status.isDirectory() or not name.startswith(f"{MONTH}="):
            continue
        listed = sorted(
            f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()}"
            for f in files.listStatus(status.getPath())
            if not f.getPath().getName().startswith(("_", "."))
        )
        prints[unquote(name.removeprefix(f"{MONTH}="))] = hashlib.sha256("\n".join(listed).encode()).hexdigest()
    return prints


def _stored_prints(spark: SparkSession, path: str) -> dict[str, str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/prints")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return {}
    rows = spark.read.schema(PRINTS).parquet(f"{path}/prints").collect()
    return {row.month: row.print for row in rows}


@dataclass(frozen=True)
class Refresh:
    changed: tuple[str, ...]
    removed: tuple[str, ...]
    unchanged: int


def changed_rows(spark: SparkSession, source_path: str, months: list[str]) -> DataFrame:
    """The rows of some months; the scan reads no other partition."""
    # Month labels as text: partition discovery would turn some into dates.
    fields = spark.read.parquet(source_path).schema.fields
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == MONTH else f.dataType) for f in fields])
    return spark.read.schema(schema).parquet(source_path).where(F.col(MONTH).isin(months))


def refresh_months(
    spark: SparkSession, source_path: str, mart_path: str, build: Callable[[DataFrame], DataFrame]
) -> Refresh:
    """Rebuild the months of a mart whose source files have changed.

    ``build`` maps rows of whole months to mart rows with the column ``month``,
    such as ``marts.monthly_revenue``. Rows without a day have no month, and a
    mart has none of them. The fingerprints are written last: a run that breaks
    off is made good by the next one.
    """
    now, before = month_prints(spark, source_path), _stored_prints(spark, mart_path)
    changed = sorted(m for m, p in now.items() if before.get(m) != p)
    removed = sorted(set(before) - set(now))
    if changed:
        built = build(changed_rows(spark, source_path, changed).drop(MONTH))
        labels = F.create_map(*[F.lit(x) for m in changed for x in (m, now[m])])
        built = built.withColumn(PRINT, F.element_at(labels, F.col(MONTH)))
        overwrite_parquet(built, f"{mart_path}/rows", [MONTH, PRINT], only_given_partitions=True)
    if changed or removed:
        rows = spark.createDataFrame(sorted(now.items()), PRINTS)
        overwrite_parquet(rows.coalesce(1), f"{mart_path}/prints")
    return Refresh(tuple(changed), tuple(removed), len(now) - len(changed))


def stored_months(spark: SparkSession, mart_path: str, schema: str) -> DataFrame:
    """The mart over all months of its source; ``schema`` declares its columns with ``month string``."""
    pairs = [f"{m}/{p}" for m, p in sorted(_stored_prints(spark, mart_path).items())]
    rows = spark.read.schema(f"{schema}, {PRINT} string").parquet(f"{mart_path}/rows")
    return rows.where(F.concat_ws("/", MONTH, PRINT).isin(pairs)).drop(PRINT)
