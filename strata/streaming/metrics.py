"""K8 for streams: rows written per sink and micro-batch.

A stream counts rows as they pass into its sink (``counted``), in the job that
writes them; ``SinkRows`` receives the counts with each micro-batch's progress.
"""

from __future__ import annotations

import threading
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


def counted(df: DataFrame, sink: str) -> DataFrame:
    return df.observe(sink, F.count(F.lit(1)).alias("rows"))


class SinkRows(StreamingQueryListener):
    """Collects ``(sink, batch id, rows)`` of every micro-batch of every query.

    A micro-batch that is run again after a failure reports again; the last
    report of a query's batch counts."""

    def __init__(self) -> None:
        self._rows: dict[tuple[str, str, int], int] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._change:
            for sink, row in progress.observedMetrics.items():
                self._rows[str(progress.id), sink, progress.batchId] = int(row["rows"] or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def wait(self, queries: Iterable[StreamingQuery], seconds: float = 60.0) -> None:
        """Wait until all reports of ended queries have come: they follow the queries' end."""
        wanted = {str(q.runId) for q in queries}
        with self._change:
            if not self._change.wait_for(lambda: wanted <= self._ended, seconds):
                raise TimeoutError("the end of a query was not reported")

    def batches(self) -> list[tuple[str, int, int]]:
        with self._change:
            return sorted((sink, batch, rows) for (_, sink, batch), rows in self._rows.items())

    def totals(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for sink, _, rows in self.batches():
            out[sink] = out.get(sink, 0) + rows
        return out
