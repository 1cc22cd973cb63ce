"""Late rows counted over the whole life of a query.

``recentProgress`` keeps about the last hundred reports, so a count from it
forgets. A listener gets every report, from the first on.
"""

from __future__ import annotations

import time
from collections import Counter
from threading import Condition

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class LateRows(StreamingQueryListener):
    """Adds up the rows that state operators drop behind the watermark.

    Register it before the query starts. Figures are kept by query id, which a
    query keeps when it is started again from its checkpoint.
    """

    def __init__(self) -> None:
        self._dropped: Counter[str] = Counter()
        self._reports: Counter[str] = Counter()
        self._ended: set[str] = set()
        self._changed = Condition()

    @classmethod
    def of(cls, spark: SparkSession) -> LateRows:
        counter = cls()
        spark.streams.addListener(counter)
        return counter

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._changed:
            self._reports[str(progress.id)] += 1
            self._dropped[str(progress.id)] += sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def reports(self, query: StreamingQuery) -> int:
        return self._reports[str(query.id)]

    def dropped(self, query: StreamingQuery, timeout: float = 60.0) -> int:
        """Rows dropped so far; for a query that has ended, those of all its reports."""
        run, until = str(query.runId), time.monotonic() + timeout
        with self._changed:
            while not query.isActive and run not in self._ended:
                left = until - time.monotonic()
                if left <= 0:
                    raise TimeoutError(f"the end of query {query.id} was not reported")
                self._changed.wait(left)
            return self._dropped[str(query.id)]
