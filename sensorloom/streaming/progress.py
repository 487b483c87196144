"""Progress of running queries: rates and observed counters, batch by batch."""

from __future__ import annotations

from collections import deque

from pyspark.sql.streaming import StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    """Progress of every query: all counters summed up, and the newest entries in detail.

    `limit` bounds the detailed entries only; sums are one number per query, counter and field.
    """

    def __init__(self, limit: int = 1000, log=None):
        self.entries: deque[dict] = deque(maxlen=limit)
        self.sums: dict[tuple[str | None, str], dict] = {}
        self.log = log

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        entry = {
            "query": p.name, "batch": p.batchId, "time": p.timestamp, "rows": p.numInputRows,
            "rows_per_sec": p.processedRowsPerSecond,
            "counters": {k: v.asDict() for k, v in p.observedMetrics.items()},
        }
        self.entries.append(entry)
        for counter, fields in entry["counters"].items():
            total = self.sums.setdefault((p.name, counter), {})
            for field, value in fields.items():
                total[field] = total.get(field, 0) + (value or 0)
        if self.log:
            self.log(entry)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def totals(self, query: str, counter: str) -> dict:
        """Sum of a counter's fields over all batches of a query so far."""
        return dict(self.sums.get((query, counter), {}))
