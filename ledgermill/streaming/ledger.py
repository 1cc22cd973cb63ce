"""A lake table of windows whose readers see each micro-batch whole and once.

Every attempt to write a batch has a folder of its own under ``data``; the batch
counts from the moment an empty file of the same name lies in ``_ledger``, which
is one creation on any file system. A batch that is replayed after its commit is
not written again, and what a crash left between write and commit is never read.

Update mode emits a window many times. ``compact`` folds all emissions into one
row for each window, so a reader reads that and the batches after it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgermill.streaming.sinks import KEYS, start

ENTRY = re.compile(r"(batch|upto)-(\d+)-[0-9a-f]+")


@dataclass(frozen=True)
class Entry:
    name: str
    kind: str
    number: int


class Ledger:
    """The commits of one table; their number is that of the batches since it was last compacted."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._jvm = spark._jvm
        self._folder = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_ledger")
        self._files = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        where = self._jvm.org.apache.hadoop.fs.Path(folder)
        if not self._files.exists(where):
            return []
        return sorted(status.getPath().getName() for status in self._files.listStatus(where))

    def all_entries(self) -> list[Entry]:
        found = (ENTRY.fullmatch(name) for name in self._names(f"{self.path}/_ledger"))
        return [Entry(m[0], m[1], int(m[2])) for m in found if m]

    def compacted(self) -> Entry | None:
        """The newest compaction; of two for one batch the first by name."""
        found = [e for e in self.all_entries() if e.kind == "upto"]
        return min(found, key=lambda e: (-e.number, e.name), default=None)

    def entries(self) -> list[Entry]:
        """What a reader reads: the newest compaction and one entry of each batch after it."""
        base = self.compacted()
        since = base.number if base else -1
        batches: dict[int, Entry] = {}
        for entry in self.all_entries():
            if entry.kind == "batch" and entry.number > since:
                batches.setdefault(entry.number, entry)
        return ([base] if base else []) + [batches[n] for n in sorted(batches)]

    def has(self, batch_id: int) -> bool:
        base = self.compacted()
        if base and batch_id <= base.number:
            return True
        return any(e.kind == "batch" and e.number == batch_id for e in self.all_entries())

    def folder(self, name: str) -> str:
        return f"{self.path}/data/{name}"

    def commit(self, name: str) -> None:
        target = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_ledger/{name}")
        self._files.create(target, False).close()

    def read(self) -> DataFrame | None:
        """All emissions that count, with the number of their batch."""
        folders = [self.folder(e.name) for e in self.entries()]
        if not folders:
            return None
        number = F.regexp_extract(F.col("_metadata.file_path"), r"/(?:batch|upto)-(\d+)-[0-9a-f]+/", 1)
        return self.spark.read.parquet(*folders).withColumn("batch_id", number.cast("bigint"))

    def expire(self) -> int:
        """Remove what the newest compaction stands for; no running batch is among it.

        Call it when no reader that started before the compaction is left.
        """
        base = self.compacted()
        if base is None:
            return 0
        gone = 0
        for folder in ("_ledger", "data"):
            for name in self._names(f"{self.path}/{folder}"):
                match = ENTRY.fullmatch(name)
                if match and int(match[2]) <= base.number and name != base.name:
                    self._files.delete(self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}/{name}"), True)
                    gone += 1
        return gone


def new_name(kind: str, number: int) -> str:
    return f"{kind}-{number:019d}-{uuid.uuid4().hex}"


def save_batch(batch: DataFrame, batch_id: int, path: str) -> bool:
    """Write and commit a batch unless it has been committed; tells whether it was written."""
    ledger = Ledger(batch.sparkSession, path)
    if ledger.has(batch_id):
        return False
    name = new_name("batch", batch_id)
    batch.write.parquet(ledger.folder(name))
    ledger.commit(name)
    return True


def to_ledger(
    volume: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    state_partitions: int | None = None,
    state: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Write every micro-batch of windowed volumes through the ledger of ``path``.

    ``state`` are settings of the state store, as ``ROCKSDB`` for windows that
    stay open long; a checkpoint keeps the store it was begun with.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        save_batch(batch, batch_id, path)

    return start(volume, save, checkpoint, available_now, state_partitions, state)


def _latest(emitted: DataFrame) -> DataFrame:
    measures = [c for c in emitted.columns if c not in (*KEYS, "batch_id")]
    newest = F.max_by(F.struct(*measures), "batch_id").alias("m")
    return emitted.groupBy(*KEYS).agg(newest).select(*KEYS, "m.*")


def windows(spark: SparkSession, path: str) -> DataFrame:
    """The last emission of every window and branch; raises if no batch has been committed."""
    emitted = Ledger(spark, path).read()
    if emitted is None:
        raise ValueError(f"{path}: no batch has been committed")
    return _latest(emitted)


def compact(spark: SparkSession, path: str) -> bool:
    """Fold the committed emissions into one row for each window; tells whether there was anything to fold.

    Batches committed meanwhile come after it and stay as they are.
    """
    ledger = Ledger(spark, path)
    entries = ledger.entries()
    if not any(e.kind == "batch" for e in entries):
        return False
    name = new_name("upto", entries[-1].number)
    _latest(ledger.read()).write.parquet(ledger.folder(name))
    ledger.commit(name)
    return True
