"""The event log as a stream: ingest, deduplication and daily revenue.

All three run to the end of what is available and stop; the checkpoint remembers where, so
the next start continues there. The same functions serve a running stream with another trigger.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkmart.functions.exprs import exact_sum
from sparkmart.operators.incremental import _batch_row, daily_totals, publish_batch, write_batch
from sparkmart.sources.bindings import BINDINGS
from sparkmart.sources.schemas import SOURCES
from sparkmart.sources.sinks import overwrite
from sparkmart.sources.state import MarkStore

AVAILABLE_NOW = {"availableNow": True}


def event_stream(spark: SparkSession, folder: str, name: str = "events.parquet", files_per_batch: int = 64) -> DataFrame:
    """Sales events read as a stream from the parquet files of ``folder`` that match ``name``.

    The files hold timestamps without zone, which event-time watermarks do not accept.
    """
    raw = (
        spark.readStream.schema(SOURCES["events"])
        .option("maxFilesPerTrigger", str(files_per_batch))
        .option("pathGlobFilter", name)
        .parquet(folder)
    )
    events = spark.sql(BINDINGS["sales_events"], events=raw)
    return events.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))


def ingest_stream(
    events: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None, after: Callable[[SparkSession], object] | None = None
) -> StreamingQuery:
    """Batch totals per micro-batch into the same log as the batch path, under the log's own numbers.

    Which micro-batch a number stands for is a mark named after the checkpoint. A micro-batch repeated after its mark is
    skipped; one repeated before it, or read again under a new checkpoint, adds only events whose ids the log does
    not hold. Events of any age are taken in. ``after`` runs once a micro-batch is published. Batch and stream runs of one
    folder must not overlap in time: there is one writer.
    """
    name = "stream:" + hashlib.md5(checkpoint.encode()).hexdigest()

    def step(batch: DataFrame, batch_id: int) -> None:
        marks = MarkStore(batch.sparkSession, folder)
        done = marks.row(name)
        if done and int(done["detail"]) >= batch_id:
            return
        mark, _, last = _batch_row(marks)
        n, max_ts = write_batch(batch, folder, last + 1, mark)
        if n:
            publish_batch(marks, n, max_ts)
        marks.set(name, n, at=max_ts, detail=str(batch_id))
        if after is not None:
            after(batch.sparkSession)

    return (
        events.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def first_of_each_event(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Drop repeats of an ``event_id`` that arrive within the lateness; state is dropped after it."""
    return events.withWatermark("event_timestamp", lateness).dropDuplicatesWithinWatermark(["event_id"])


def daily_revenue(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Revenue per event day, emitted once the day can no longer change."""
    day = F.window("event_timestamp", "1 day")
    return (
        events.withWatermark("event_timestamp", lateness)
        .groupBy(day.alias("w"))
        .agg(exact_sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("event_count"))
        .select(F.to_date(F.col("w.start")).alias("event_date"), "revenue", "event_count")
    )


def upsert_daily(events: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Revenue per event day as a table that every micro-batch brings up to date, the open day included.

    The events go through the event log below ``folder``, which keeps their ids by day: an event delivered twice counts
    once, also under a new checkpoint, and one that comes late counts on its day. The published table has a row a
    day and is written anew from the log's parts by day.
    """
    log = os.path.join(folder, "log")

    def publish(spark: SparkSession) -> None:
        days = daily_totals(spark, log)
        if days is not None:
            overwrite(days.select("event_date", "revenue", "event_count"), folder)

    return ingest_stream(events, log, checkpoint, trigger, publish)


def to_parquet(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an available-now query; its error, if any, is raised here."""
    query.awaitTermination()
