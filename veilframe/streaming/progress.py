"""Counts of streams, taken from what their batches report instead of from what they wrote."""

from __future__ import annotations

import threading
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def observed(stream: DataFrame, name: str, **metrics: Column) -> DataFrame:
    """``stream``, whose every batch reports rows and the sums ``metrics`` under ``name``."""
    return stream.observe(name, F.count(F.lit(1)).alias("rows"), *(F.coalesce(m, F.lit(0)).alias(k) for k, m in metrics.items()))


class Totals(StreamingQueryListener):
    """Sums of the counts under ``name`` over the batches of every run, each batch once; add it to ``spark.streams``.

    A batch that is tried again after a failure reports once, when it ends. Batches that ended before the
    listener was added are not counted.
    """

    def __init__(self, name: str):
        self.name, self._batches, self._ended, self._lock = name, {}, set(), threading.Condition()

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            with self._lock:
                self._batches[str(event.progress.id), event.progress.batchId] = row.asDict()

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def total(self, run_id: str | None = None, timeout: float = 60) -> dict[str, int]:
        """The sums so far; with the id of a run, once it has told its end."""
        with self._lock:
            if run_id is not None and not self._lock.wait_for(lambda: str(run_id) in self._ended, timeout):
                raise TimeoutError(f"run {run_id} has not told its end")
            out: Counter = Counter()
            for row in self._batches.values():
                out.update(row)
            return dict(out)
