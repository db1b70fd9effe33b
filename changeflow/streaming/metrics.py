"""What a running stream did: one row a micro-batch, from Spark's own progress reports."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "query string, batch long, at string, events long, seconds double"


class Progress(StreamingQueryListener):
    """Keeps the last ``keep`` micro-batches of all queries; ``frame`` gives them for ``batches.histogram`` and the like."""

    def __init__(self, keep: int = 10_000):
        self.rows: deque[tuple] = deque(maxlen=keep)
        self.failed: deque[tuple[str, str]] = deque(maxlen=100)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows.append((str(p.id), p.batchId, p.timestamp, p.numInputRows, p.durationMs.get("triggerExecution", 0) / 1000))

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failed.append((str(event.id), event.exception))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), SCHEMA)
