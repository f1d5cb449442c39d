"""Supervision of streaming queries: what each has read, dropped and how it ended.

A query keeps only its last 100 progress reports; the listener adds every report up as it comes.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener


@dataclass
class QueryTotals:
    """Sums over all micro-batches of one run of a query."""
    name: str | None
    batches: int = 0                # that read rows
    input_rows: int = 0
    late_rows: int = 0              # dropped behind the watermark by stateful operators
    last_batch: int = -1
    ended: bool = False
    failure: str | None = None


class Supervisor(StreamingQueryListener):
    """Listens to all queries of a session from ``with Supervisor(spark) as s:`` on."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._lock = threading.Lock()
        self._runs: dict[str, QueryTotals] = {}

    def __enter__(self) -> Supervisor:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self._drain()
        self.spark.streams.removeListener(self)

    def _drain(self) -> None:
        # events come on a thread of their own: wait for those already sent
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._runs[str(event.runId)] = QueryTotals(event.name)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._lock:
            t = self._runs.setdefault(str(p.runId), QueryTotals(p.name))
            t.batches += p.numInputRows > 0
            t.input_rows += p.numInputRows
            t.late_rows += sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
            t.last_batch = max(t.last_batch, p.batchId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            t = self._runs.setdefault(str(event.runId), QueryTotals(None))
            t.ended, t.failure = True, event.exception

    def totals(self) -> dict[str, QueryTotals]:
        """Totals by run id."""
        self._drain()
        with self._lock:
            return dict(self._runs)

    def of(self, query) -> QueryTotals:
        """Totals of one query (of its current run)."""
        return self.totals()[str(query.runId)]
