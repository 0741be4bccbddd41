"""What a running ingestion reports, and when to stop it."""

from __future__ import annotations

import threading
import time
from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from trailmart.streaming.ingest import RULE_COUNTS

#: Seconds between two looks at a query, and the longest wait for what it reports at its end.
LOOK, LAST_REPORT = 0.05, 60


class IngestionProgress(StreamingQueryListener):
    """The batches that stored something, and how many records each rule refused.

    The counts come from metrics that Spark gathers while a batch is stored, so nothing is
    read again for them. A batch that is repeated is counted again, as its progress is.
    """

    def __init__(self) -> None:
        self.batches: list[tuple[int, int, str]] = []
        self.refused: Counter[str] = Counter()
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get(RULE_COUNTS)
        if counts is not None:
            self.refused.update({rule: n for rule, n in counts.asDict().items() if n})
        if progress.numInputRows:
            self.batches.append((progress.batchId, progress.numInputRows, progress.timestamp))

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


@contextmanager
def watched(spark: SparkSession) -> Iterator[IngestionProgress]:
    """The progress of the query that is run inside, complete when the block ends.

    One query at a time: a session's listeners hear of all its queries.
    """
    progress = IngestionProgress()
    spark.streams.addListener(progress)
    try:
        yield progress
        # Reports come in order, on a thread of their own.
        progress.ended.wait(LAST_REPORT)
    finally:
        spark.streams.removeListener(progress)


def stop_between_batches(query: StreamingQuery) -> None:
    """Stop a query while it waits for its next trigger, so that no batch is cut short."""
    while query.isActive and query.status["isTriggerActive"]:
        time.sleep(LOOK)
    query.stop()


def run_until(query: StreamingQuery, enough: Callable[[], bool]) -> None:
    """Leave a query to its timed triggers until ``enough`` holds, then stop between batches.

    A query that fails raises; none is left running.
    """
    try:
        while not enough() and not query.awaitTermination(LOOK):
            pass
        stop_between_batches(query)
    finally:
        if query.isActive:
            query.stop()
