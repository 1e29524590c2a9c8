"""Landing job: change feed -> landing zone.

The checkpoint advances only after a batch is stored, and a repeated batch overwrites itself, so
every change is landed at least once and a retry leaves no copy.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from souklake.operators.changes import deduplicate_stream, envelope
from souklake.sources.landing import stream_landing, write_landing

# Fixed value: poll interval. The size of a batch is the source's to bound (files per trigger).
POLL = "1 second"


def land(
    changes: DataFrame,
    root: str,
    checkpoint: str,
    database: str,
    follow: bool = False,
    poll: str = POLL,
    ingested_at: Column | None = None,
    on_batch: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Start landing a stream of (lsn, xid, raw) rows: drain what there is, or follow.

    `on_batch` hears how many changes each stored batch has.
    """
    feed = hashlib.sha256(checkpoint.encode()).hexdigest()[:8]

    def store(batch: DataFrame, number: int) -> None:
        rows = write_landing(batch, root, f"{feed}-{number:012d}")
        if on_batch:
            on_batch(rows)

    writer = (
        envelope(changes, database, ingested_at)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": poll} if follow else {"availableNow": True}
    return writer.trigger(**trigger).start()


def drain(*args, **options) -> int:
    """Land everything available and return; the result is the number of landed changes."""
    landed: list[int] = []
    land(*args, follow=False, on_batch=landed.append, **options).awaitTermination()
    return sum(landed)


def stop_when_idle(query: StreamingQuery, seconds: float) -> None:
    """Stop a following query once it has seen no change for a while; a running batch is no idleness."""
    idle_since, last_batch = time.monotonic(), None
    while query.isActive and time.monotonic() - idle_since < seconds:
        progress = query.lastProgress
        if progress and progress["batchId"] != last_batch and progress["numInputRows"] > 0:
            last_batch, idle_since = progress["batchId"], time.monotonic()
        if query.status["isTriggerActive"] and query.status["isDataAvailable"]:
            idle_since = time.monotonic()
        time.sleep(min(0.2, seconds / 4))
    query.stop()


def distinct_events(
    spark: SparkSession, root: str, delay: str, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of landed envelopes without repeated deliveries within `delay`."""
    return deduplicate_stream(stream_landing(spark, root, files_per_batch), delay)
