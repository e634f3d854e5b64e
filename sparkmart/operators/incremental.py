"""Change detection, upserts and incremental ingest of the event log.

Ingested events are kept as a log of per-product batch totals, one folder per batch. A batch
costs what the batch holds, not what the table holds; writing a batch again replaces exactly
its own folder. Readers take only batches at or below the published mark, which is written
last, so an interrupted run leaves nothing visible behind.

The log holds additive parts (sums and counts) by product and by event day, so it answers all questions: the
row of the latest batch per product, the totals over all batches, and the revenue of every day.

Ids of ingested events are kept by day in segments that are merged by eights, so a batch reads the days it holds from a
few folders however many batches there were. An event is known by its id alone: repeats are dropped and events that
come late are taken in, whichever way they come.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions.exprs import clip, merge_parts, parts_value, round_even, sum_parts
from sparkmart.operators.quality import ValidationError
from sparkmart.session import durable
from sparkmart.sources.sinks import overwrite
from sparkmart.sources.state import MarkStore
from sparkmart.sources.tables import remove_table, table_exists

EVENT_STEP = "event_ingestion"
SNAPSHOT_STEP = "ingest"
BATCHES = "event_batches"
EVENT_IDS = "event_ids"
DAYS = "event_days"
FAN_IN = 8  # segments of ids that become one of the next tier


# --- change detection and snapshots ----------------------------------------------------


def fingerprint(df: DataFrame) -> DataFrame:
    """(row_count, hash_sum): equal content gives equal values in any order. Each row hash is
    summed as two halves, which cannot overflow."""
    h = F.xxhash64(*df.columns)
    low = h.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))
    total = F.coalesce(F.sum(F.shiftright(h, 32)), F.lit(0)).cast("decimal(38,0)") * F.lit(1 << 32) + F.coalesce(
        F.sum(low), F.lit(0)
    )
    return df.agg(F.count(F.lit(1)).alias("row_count"), total.cast("decimal(38,0)").alias("hash_sum"))


def ingest_snapshot(sources: Mapping[str, DataFrame], folder: str) -> int | None:
    """Copy changed catalogue tables to ``raw_<table>``; returns the rows of the source, or None
    when nothing changed since the last run. Unlike a comparison of total row counts this
    notices edits in place and changes that cancel out."""
    spark = next(iter(sources.values())).sparkSession
    marks = MarkStore(spark, folder)
    prints = {t: fingerprint(df).first() for t, df in sources.items()}
    detail = ";".join(f"{t}={p['row_count']}:{p['hash_sum']}" for t, p in sorted(prints.items()))
    total = sum(p["row_count"] for p in prints.values())
    last = marks.row(SNAPSHOT_STEP)
    if last is not None and last["detail"] == detail:
        return None
    for table, df in sources.items():
        if prints[table]["row_count"] < 1:
            raise ValidationError(f"{table}: no rows in the source")
        overwrite(df, os.path.join(folder, f"raw_{table}"))
    marks.set(SNAPSHOT_STEP, total, detail=detail)
    return total


# --- upserts -----------------------------------------------------------------------------


def upsert_latest(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert new keys, replace all other columns of known keys."""
    return target.join(updates, list(keys), "left_anti").unionByName(updates)


def untouched(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows that no update replaces."""
    return target.join(updates, list(keys), "left_anti")


def latest_wins(log: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row with the highest ``order`` per key. An aggregate, so versions of one key combine
    before the shuffle, however many there are."""
    rest = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")


# --- the event log -------------------------------------------------------------------------


def new_events(events: DataFrame, mark: datetime | str | None) -> DataFrame:
    """Events strictly after the mark; all of them on the first run. On a log partitioned by
    ``event_date`` the same bound is put on the partition column, so older days are not read."""
    if mark is None:
        return events
    after = events.where(F.col("event_timestamp") > F.lit(mark).cast("timestamp"))
    if "event_date" in events.columns:
        after = after.where(F.col("event_date") >= F.to_date(F.lit(mark).cast("timestamp")))
    return after


def late_events(events: DataFrame, mark: datetime | str, processed: DataFrame) -> DataFrame:
    """Events at or before the mark that no batch has seen: the strict bound would lose them."""
    old = events.where(F.col("event_timestamp") <= F.lit(mark).cast("timestamp"))
    return old.join(processed.select("event_id"), "event_id", "left_anti")


def batch_parts(events: DataFrame, *keys: str) -> DataFrame:
    """Additive per-product totals of a batch of events."""
    return events.groupBy("product_id", *keys).agg(
        F.count(F.lit(1)).alias("events"),
        *sum_parts("revenue", "rev"),
        *sum_parts("price", "price"),
        F.count("price").alias("price_n"),
        *sum_parts("discount", "disc"),
        F.count("discount").alias("disc_n"),
        F.max("price").alias("max_price"),
    )


def merge_batches(parts: DataFrame) -> DataFrame:
    """Totals over several batches, still additive."""
    return parts.groupBy("product_id").agg(
        F.sum("events").alias("events"),
        *merge_parts("rev"),
        *merge_parts("price"),
        F.sum("price_n").alias("price_n"),
        *merge_parts("disc"),
        F.sum("disc_n").alias("disc_n"),
        F.max("max_price").alias("max_price"),
    )


def finish_parts(parts: DataFrame) -> DataFrame:
    """Revenue, mean and highest price and mean discount from additive parts."""
    mean = lambda n: F.try_divide(parts_value(n), F.col(f"{n}_n").cast("double"))
    return parts.select(
        "product_id",
        round_even(parts_value("rev"), 2).alias("revenue"),
        round_even(mean("price"), 2).alias("sale_price"),
        round_even(F.col("max_price"), 2).alias("listing_price"),
        round_even(clip(mean("disc"), 0.0, 1.0), 4).alias("discount"),
    )


def _segment(folder: str, tier: int, number: int) -> str:
    return os.path.join(folder, EVENT_IDS, f"tier={tier}", f"seg={number}")


def id_segments(spark: SparkSession, folder: str, last: int) -> list[str]:
    """Folders that hold the ids of batches 0 to ``last``: for each stretch of batches the widest segment that is complete.

    Segment n of a tier stands for batches n * 8^tier up to the next one. At most seven folders of a tier are left.
    """
    found, at = [], 0
    while at <= last:
        tier = 0
        while at % FAN_IN ** (tier + 1) == 0 and at + FAN_IN ** (tier + 1) - 1 <= last:
            tier += 1
        for k in range(tier, -1, -1):
            path = _segment(folder, k, at // FAN_IN**k)
            if table_exists(spark, os.path.join(path, "_SUCCESS")):
                found.append(path)
                break
        else:
            k = 0  # a batch without ids
        at += FAN_IN**k
    return found


def kept_ids(spark: SparkSession, folder: str, last: int, kind: str = "bigint") -> DataFrame | None:
    """(event_id, event_day) of all events of batches 0 to ``last``; event_day is the partition column."""
    paths = id_segments(spark, folder, last)
    if not paths:
        return None
    reader = spark.read.schema(f"event_id {kind}, tier int, seg int, event_day date").option("basePath", os.path.join(folder, EVENT_IDS))
    return reader.parquet(*paths).select("event_id", "event_day")


def merge_segments(spark: SparkSession, folder: str, last: int) -> None:
    """Merge eight segments of a tier into one of the next wherever batch ``last`` closes such a group.

    It runs after the mark is set. A merge that stops half way leaves no _SUCCESS, so readers go on with its
    parts, which are removed only afterwards; each id is rewritten once a tier.
    """
    tier = 1
    while (last + 1) % FAN_IN**tier == 0:
        number = (last + 1) // FAN_IN**tier - 1
        parts = [_segment(folder, tier - 1, number * FAN_IN + k) for k in range(FAN_IN)]
        parts = [p for p in parts if table_exists(spark, os.path.join(p, "_SUCCESS"))]
        if parts:
            both = spark.read.option("basePath", os.path.join(folder, EVENT_IDS)).parquet(*parts).select("event_id", "event_day")
            both.hint("rebalance", "event_day").write.mode("overwrite").partitionBy("event_day").parquet(_segment(folder, tier, number))
            for p in parts:
                remove_table(spark, p)
        tier += 1


def _on_days(column: Column, days: Sequence[date | None]) -> Column:
    """Whether a day is one of these, as literals, so that other partitions are not read."""
    known = [d for d in days if d is not None]
    some = column.isin(known) if known else F.lit(False)
    return some | column.isNull() if None in days else some


def unseen_events(events: DataFrame, folder: str, batch_id: int) -> DataFrame:
    """One row per ``event_id`` that no batch before ``batch_id`` holds; rows without an id all stay.

    Ids are kept by day, and only the days of these events are read.
    """
    if "event_id" not in events.columns:
        return events
    named = events.where(F.col("event_id").isNotNull()).dropDuplicates(["event_id"])
    known = kept_ids(events.sparkSession, folder, batch_id - 1, events.schema["event_id"].dataType.simpleString())
    if known is not None:
        days = [r[0] for r in events.select(F.to_date("event_timestamp")).distinct().collect()]  # calendar days
        named = named.join(known.where(_on_days(F.col("event_day"), days)).select("event_id"), "event_id", "left_anti")
    return named.select(events.columns).unionByName(events.where(F.col("event_id").isNull()))


def day_parts(events: DataFrame, mark: datetime | None = None) -> DataFrame:
    """Additive totals of a batch by event day; late events are those at or before the mark the batch found."""
    late = F.lit(0) if mark is None else F.when(F.col("event_timestamp") <= F.lit(mark).cast("timestamp"), 1).otherwise(0)
    return events.groupBy(F.to_date("event_timestamp").alias("event_date")).agg(
        F.count(F.lit(1)).alias("events"), F.sum(late).cast("bigint").alias("late"), *sum_parts("revenue", "rev")
    )


def write_batch(events: DataFrame, folder: str, batch_id: int, mark: datetime | None = None) -> tuple[int, datetime | None]:
    """Aggregate the unseen events of one batch into its folders; returns (events, highest timestamp).

    The events are written once, counted on the way, and checked before anything of them is kept. Ids and totals count only
    from the mark on, and a repeated batch overwrites both. Without unseen events nothing is kept.
    """
    seen = Observation()
    missing = F.col("product_id").isNull() | F.col("revenue").isNull()
    newest = F.max(F.col("event_timestamp").cast("timestamp"))
    facts = F.count(F.lit(1)).alias("n"), newest.alias("max_ts"), F.count_if(missing).alias("bad")
    fresh = durable(unseen_events(events, folder, batch_id).observe(seen, *facts), "batch-events")
    got = seen.get
    if got["bad"]:
        raise ValidationError(f"new events: {got['bad']} rows without product_id or revenue")
    if not got["n"]:
        return 0, None
    if "event_id" in events.columns:
        ids = fresh.where(F.col("event_id").isNotNull()).select("event_id", F.to_date("event_timestamp").alias("event_day"))
        ids.write.mode("overwrite").partitionBy("event_day").parquet(_segment(folder, 0, batch_id))
    day_parts(fresh, mark).write.mode("overwrite").parquet(os.path.join(folder, DAYS, f"batch_id={batch_id}"))
    batch_parts(fresh).write.mode("overwrite").parquet(os.path.join(folder, BATCHES, f"batch_id={batch_id}"))
    return got["n"], got["max_ts"]


def _batch_row(marks: MarkStore):
    row = marks.row(EVENT_STEP)
    return (row["last_successful_at"], row["last_row_count"], int(row["detail"])) if row else (None, 0, -1)


def publish_batch(marks: MarkStore, n: int, newest: datetime | None) -> None:
    """Make the batch after the last one visible, then merge segments of ids where it closes a group."""
    mark, total, last = _batch_row(marks)
    at = newest if mark is None or (newest is not None and newest > mark) else mark
    marks.set(EVENT_STEP, total + n, at=at, detail=str(last + 1))
    merge_segments(marks.spark, os.path.dirname(marks.path), last + 1)


def changed_days(events: DataFrame, folder: str, mark: datetime, last: int) -> list[date | None]:
    """Days up to the mark of which the source has another number of events than the log has ids: late ones came in.

    The log's side counts rows of its day folders, which takes no column; events without an id cannot be told apart and
    count only when they come after the mark.
    """
    old = events.where((F.col("event_timestamp") <= F.lit(mark).cast("timestamp")) & F.col("event_id").isNotNull())
    there = old.groupBy(F.to_date("event_timestamp").alias("event_day")).agg(F.count(F.lit(1)).alias("there"))
    known = kept_ids(events.sparkSession, folder, last, events.schema["event_id"].dataType.simpleString())
    if known is None:
        return [r["event_day"] for r in there.collect()]
    here = known.groupBy("event_day").agg(F.count(F.lit(1)).alias("here"))
    upto = here.where(F.col("event_day") <= F.to_date(F.lit(mark).cast("timestamp")))
    both = there.join(upto, "event_day", "left").where(~F.col("there").eqNullSafe(F.col("here")))
    return [r["event_day"] for r in both.select("event_day").collect()]


def ingest_incremental(events: DataFrame | None, folder: str, late: bool = True) -> int:
    """Ingest the events of ``events`` that the log does not hold; returns how many. Without any nothing is published.

    Events after the mark are new. Events at or before it are taken from the days on which the source has other
    numbers than the log, and told from known ones by their ids, so a late event enters once, as an addition to its
    day and product. ``late=False`` leaves them out and reads nothing before the mark.
    """
    if events is None:
        return 0
    marks = MarkStore(events.sparkSession, folder)
    mark, _, last = _batch_row(marks)
    fresh = new_events(events, mark)
    if late and mark is not None and "event_id" in events.columns:
        days = changed_days(events, folder, mark, last)
        if days:
            old = events.where((F.col("event_timestamp") <= F.lit(mark).cast("timestamp")) & F.col("event_id").isNotNull())
            old = old.where(_on_days(F.col("event_date") if "event_date" in events.columns else F.to_date("event_timestamp"), days))
            fresh = fresh.unionByName(old)
    n, newest = write_batch(fresh, folder, last + 1, mark)
    if n:
        publish_batch(marks, n, newest)
    return n


def _published(spark: SparkSession, folder: str, table: str) -> DataFrame | None:
    _, _, last = _batch_row(MarkStore(spark, folder))
    path = os.path.join(folder, table)
    if last < 0 or not table_exists(spark, path):
        return None
    return spark.read.parquet(path).where(F.col("batch_id") <= last)


def daily_totals(spark: SparkSession, folder: str, lateness: str = "1 hour") -> DataFrame | None:
    """event_date, revenue, event_count, late_count, is_open for every day of the log.

    A day is open while an event of it would be on time: its end is after the newest event less the lateness. Later
    events of it still count, and are counted as late. A repeated event counts once.
    """
    parts = _published(spark, folder, DAYS)
    if parts is None:
        return None
    mark = _batch_row(MarkStore(spark, folder))[0]
    days = parts.groupBy("event_date").agg(F.sum("events").alias("event_count"), F.sum("late").alias("late_count"), *merge_parts("rev"))
    closes = F.date_add("event_date", 1).cast("timestamp") > F.lit(mark).cast("timestamp") - F.expr(f"INTERVAL {lateness}")
    return days.select("event_date", parts_value("rev").alias("revenue"), "event_count", "late_count", closes.alias("is_open"))


def ingested_batches(spark: SparkSession, folder: str) -> DataFrame | None:
    """Rows of all published batches, None before the first."""
    return _published(spark, folder, BATCHES)


def latest_batch_per_product(spark: SparkSession, folder: str) -> DataFrame | None:
    """Each product's totals of the last batch it appeared in (an upsert replaces, it does not add)."""
    log = ingested_batches(spark, folder)
    return None if log is None else finish_parts(latest_wins(log, ["product_id"], "batch_id"))


def cumulative_per_product(spark: SparkSession, folder: str) -> DataFrame | None:
    """Each product's totals over all batches."""
    log = ingested_batches(spark, folder)
    return None if log is None else finish_parts(merge_batches(log))
