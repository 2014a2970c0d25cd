"""Reader counters of running streams."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQueryListener

METRIC = "reader"


def observed(messages: DataFrame, clusters: list[str]) -> DataFrame:
    """Report messages read and errors per cluster, and the last minute, of every batch."""
    columns = [F.max(F.date_format("minute", "yyyy-MM-dd HH:mm")).alias("last_minute")]
    for cluster in clusters:
        own = F.col("cluster") == cluster
        columns.append(F.count_if(own).alias(f"read:{cluster}"))
        columns.append(F.count_if(own & F.col("corrupt")).alias(f"errors:{cluster}"))
    return messages.observe(METRIC, *columns)


class ReaderStats(StreamingQueryListener):
    """Adds the batch counters up: ``counts["read:<cluster>"]``, ``counts["errors:<cluster>"]``."""

    def __init__(self) -> None:
        self.counts: Counter = Counter()
        self.last_minute: str | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(METRIC)
        if row is None:
            return
        for name, value in row.asDict().items():
            if name == "last_minute":
                self.last_minute = max(filter(None, [self.last_minute, value]), default=None)
            else:
                self.counts[name] += value

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
