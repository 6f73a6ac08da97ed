"""Progress of running queries: rows so far and rows per second."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

log = logging.getLogger(__name__)


@dataclass
class Progress:
    batches: int = 0
    rows: int = 0
    rows_per_second: float = 0.0
    late_rows: int = 0

    def add(self, report) -> None:
        self.batches += 1
        self.rows += report.numInputRows
        self.rows_per_second = report.processedRowsPerSecond or self.rows_per_second
        self.late_rows += sum(s.numRowsDroppedByWatermark for s in report.stateOperators)


def recent_progress(query: StreamingQuery) -> Progress:
    """Sums over the reports that the query still holds: the last 100 unless
    ``spark.sql.streaming.numRecentProgressUpdates`` says otherwise. For totals
    register a ``ProgressLog``."""
    found = Progress()
    for report in query.recentProgress:
        found.add(report)
    return found


def wait_until_idle(query: StreamingQuery, idle: float = 0.0, timeout: float = 120.0) -> bool:
    """Wait for a batch that began ``idle`` seconds or more after the last one with rows;
    whether there was one in time. Timers of that length have ended by then."""
    end = time.monotonic() + timeout
    while time.monotonic() < end:
        if query.exception() is not None:
            raise query.exception()
        last = None
        for report in query.recentProgress:
            begun = datetime.fromisoformat(report.timestamp.replace("Z", "+00:00")).timestamp()
            if report.numInputRows:
                last = begun
            elif last is not None and begun >= last + idle:
                return True
        time.sleep(0.1)
    return False


class ProgressLog(StreamingQueryListener):
    """Totals of each query from its first batch on, and one log line per batch.

    Register with ``spark.streams.addListener(ProgressLog())`` before the queries
    start.
    """

    def __init__(self) -> None:
        self.totals: dict[str, Progress] = {}

    def total(self, query: StreamingQuery) -> Progress:
        return self.totals.get(str(query.id), Progress())

    def onQueryStarted(self, event) -> None:
        self.totals.setdefault(str(event.id), Progress())

    def onQueryProgress(self, event) -> None:
        report = event.progress
        key = str(report.id)
        total = self.totals.setdefault(key, Progress())
        total.add(report)
        log.info(
            "%s: %d rows in all, %.0f rows/s",
            report.name or key, total.rows, report.processedRowsPerSecond or 0.0,
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info("%s ended", event.id)
