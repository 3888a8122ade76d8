"""What the batches of streams did, kept in a table: rows in, rows dropped as late, state, watermark."""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from wayflux import schemas
from wayflux.sinks import append_table
from wayflux.sources import LAKE_FORMAT


def _instant(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None


class ProgressLog(StreamingQueryListener):
    """Appends a row for each batch of every query of the session to the table at ``path``.

    Rows are gathered and stored ``every`` so many batches and when a query ends, so a stream of short
    batches does not leave a file for each.  ``(run_id, batch_id)`` names a row.
    """

    def __init__(self, spark: SparkSession, path: str, fmt: str = LAKE_FORMAT, every: int = 100):
        self.spark, self.path, self.fmt, self.every = spark, path, fmt, every
        self._rows: list[tuple] = []
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        states = p.stateOperators
        self._rows.append((
            str(p.id), str(p.runId), p.name, p.batchId, _instant(p.timestamp), p.numInputRows,
            sum(s.numRowsDroppedByWatermark for s in states), sum(s.numRowsTotal for s in states),
            sum(s.numRowsRemoved for s in states), _instant(p.eventTime.get("watermark"))))
        if len(self._rows) >= self.every:
            self._store()

    def onQueryTerminated(self, event) -> None:
        self._store()
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def _store(self) -> None:
        rows, self._rows = self._rows, []
        if rows:
            frame = self.spark.createDataFrame(rows, schemas.STREAM_PROGRESS)
            append_table(frame.coalesce(1), self.path, self.fmt)

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all batches of a query that has ended are stored; events reach a listener later."""
        with self._changed:
            if not self._changed.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"the end of {query.runId} was not reported in {seconds} seconds")
