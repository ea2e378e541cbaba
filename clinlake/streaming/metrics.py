"""Counters of running queries: rows, batches and times by query, and counts observed in a batch job."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


class Progress(StreamingQueryListener):
    """What the queries of a session report. Add it with spark.streams.addListener."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self.millis: dict[str, list[int]] = {}
        self.ended: dict[str, str | None] = {}
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self.changed:
            self.rows.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self.changed:
            key = str(p.id)
            self.rows[key] = self.rows.get(key, 0) + p.numInputRows
            self.batches[key] = self.batches.get(key, 0) + 1
            self.millis.setdefault(key, []).append(p.batchDuration)
            self.changed.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended[str(event.id)] = event.exception
            self.changed.notify_all()


def observed(events: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The events, and an observation of their number by kind, which is filled by the first action on them."""
    seen = Observation(name)
    kinds = [F.count_if(F.col("op_type") == k).alias(k.lower()) for k in ("INSERT", "UPDATE", "DELETE")]
    return events.observe(seen, F.count("*").alias("events"), *kinds), seen
