"""Deduplicate an event stream with state that expires, and keep what comes too late for it.

``dropDuplicatesWithinWatermark`` forgets an id once the watermark has passed it, and drops
rows that are older than the watermark without a trace.  Here a first query routes the
rows: those that are in time go on to the deduplication, the others to
``audit.late_events``, from where the daily load takes them.

Both queries derive their watermark from the greatest event time of earlier batches.  The
deduplication reads the routed batches in their order, one or several at a time, so its
watermark is never ahead of the router's and it drops nothing more.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators.store import TableStore
from tidemart.schemas import CONTRACTS
from tidemart.streaming.ingest import first_deliveries, ingest_to_table

RAW, LATE, PROGRESS = "raw.events_csv", "audit.late_events", "audit.stream_progress"


def reached(store: TableStore, stream: str, batch_id: int) -> dt.datetime | None:
    """The greatest event time in batches before ``batch_id``; the same for a batch that is replayed."""
    rows = store.read(PROGRESS).filter((F.col("stream") == stream) & (F.col("batch_id") < batch_id))
    return store.scalar(rows.agg(F.max("max_event_ts")))


def in_time(seen: dt.datetime | None, delay: str) -> Column:
    """Whether an event is newer than the watermark; one without a time never is."""
    if seen is None:
        return F.col("event_ts").isNotNull()
    mark = F.lit(seen).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")
    return F.coalesce(F.col("event_ts") > mark, F.lit(False))


def route(events: DataFrame, store: TableStore, folder: str, delay: str = "1 day",
          trigger: dict | None = None) -> StreamingQuery:
    """Send events that are in time to ``folder`` (one subfolder a batch), the others to ``audit.late_events``.

    A replayed batch replaces what it wrote: it sees the same watermark.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        fresh = in_time(reached(store, stream, batch_id), delay)
        batch = batch.persist()
        try:
            batch.filter(fresh).write.mode("overwrite").parquet(f"{folder}/routed/batch={batch_id:08d}")
            store.append(LATE, batch.filter(~fresh), f"stream-{stream}-{batch_id}")
            last = batch.agg(F.max("event_ts").alias("max_event_ts"), F.max("run_date").alias("run_date"))
            store.append(PROGRESS, last.filter("run_date IS NOT NULL").select(
                F.lit(stream).alias("stream"), F.lit(batch_id).cast("bigint").alias("batch_id"), "max_event_ts", "run_date"))
        finally:
            batch.unpersist()

    return (
        events.select(*CONTRACTS[RAW].column_names).writeStream
        .foreachBatch(split)
        .option("checkpointLocation", f"{folder}/checkpoints/route")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def dedup_routed(store: TableStore, folder: str, delay: str = "1 day", trigger: dict | None = None) -> StreamingQuery:
    """Append each event id of the routed batches once to the raw table.

    State holds an id for ``delay`` after its event time, no longer.
    """
    spark = store.spark
    rows = spark.readStream.schema(CONTRACTS[RAW].ddl).parquet(f"{folder}/routed/batch=*")
    once = first_deliveries(rows, delay)
    return ingest_to_table(once, store, RAW, f"{folder}/checkpoints/dedup", trigger)


def ingest_once(events: DataFrame, store: TableStore, folder: str, delay: str = "1 day") -> StreamingQuery:
    """Work off what has landed: route it, then deduplicate what was routed; returns the ended deduplication."""
    route(events, store, folder, delay).awaitTermination()
    query = dedup_routed(store, folder, delay)
    query.awaitTermination()
    return query


def recover_late(store: TableStore, day: dt.date | str) -> int:
    """Bring a day's late events into the raw table, as one delivery that a repetition replaces.

    Staging keeps one row of each id, so late copies of events that were in time do not count twice.
    """
    if not store.exists(LATE):
        return 0
    return store.append(RAW, store.read(LATE).filter(F.col("run_date") == F.lit(str(day)).cast("date")), f"late-{day}")
