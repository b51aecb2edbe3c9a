"""Streams that stop in the middle, fail and go on.

A stopped or failed query leaves its checkpoint behind: the offsets of every batch begun and the state of
every batch ended. Started again from there it repeats a batch that was begun but not ended, with the
same files, and goes on with new ones. With a sink that writes a batch over itself, every file counts once.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming.query import StreamingQuery

#: Seconds between two looks at a query.
LOOK = 0.2


def wait_for_batches(query: StreamingQuery, batches: int, seconds: float) -> int:
    """Waits until so many batches with rows have ended, the query has, or the time is up; the batches seen.

    A query that fails raises its error.
    """
    until, seen = time.monotonic() + seconds, set()
    while True:
        ended = query.awaitTermination(LOOK)
        seen |= {progress["batchId"] for progress in query.recentProgress if progress["numInputRows"]}
        if ended or len(seen) >= batches or time.monotonic() > until:
            return len(seen)


def run_batches(query: StreamingQuery, batches: int, seconds: float) -> int:
    """Lets a query run for so many batches, at most so long, and stops it wherever it is then."""
    try:
        return wait_for_batches(query, batches, seconds)
    finally:
        query.stop()


def run_to_end(start: Callable[[], StreamingQuery], seconds: float, attempts: int = 3) -> int:
    """Starts a query that ends by itself, again after each failure; the number of starts it took.

    ``start`` must name the same checkpoint every time. The last failure raises, and so does a query that
    is still running when the time of a start is up.
    """
    for attempt in range(1, attempts + 1):
        query = start()
        try:
            if query.awaitTermination(seconds):
                return attempt
        except StreamingQueryException:
            if attempt == attempts:
                raise
            continue
        finally:
            query.stop()
        raise TimeoutError(f"the query did not end within {seconds} seconds")
    raise ValueError("attempts must be 1 or more")
