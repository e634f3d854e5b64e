"""Physical layout of the event fact, and what a layout saves in scanned data."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from sparkmart.sources.sinks import overwrite

USD_PER_TIB = 6.25  # fixed value: on-demand price per TiB scanned
USD_PER_CREDIT = (2.0, 4.0)  # fixed values: price range of one compute credit
CREDITS_PER_HOUR = 1.0  # fixed value: smallest warehouse size
TIB = 1024**4


def with_event_date(events: DataFrame) -> DataFrame:
    return events.withColumn("event_date", F.to_date("event_timestamp"))


def write_partitioned(events: DataFrame, path: str) -> DataFrame:
    """One folder per day, rows sorted by product inside each file.

    Range partitioning by (day, product, event) keeps each file narrow in day and product, and
    splits a day or product that holds much of the data over several files.
    """
    keys = ["event_date", "product_id", "event_id"]
    arranged = with_event_date(events).repartitionByRange(*keys).sortWithinPartitions(*keys)
    arranged.write.mode("overwrite").partitionBy("event_date").parquet(path)
    return events.sparkSession.read.parquet(path)


def write_flat(events: DataFrame, path: str) -> DataFrame:
    """The same rows without partitions, in arrival order."""
    with_event_date(events).write.mode("overwrite").parquet(path)
    return events.sparkSession.read.parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """A catalogue table bucketed on ``key``: joins and groupings on it need no shuffle later."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def truncate_load(
    df: DataFrame | None, path: str, timestamps: tuple[str, ...] = ("event_timestamp",), partition_by: tuple[str, ...] = ()
) -> int:
    """Replace a warehouse table and return its rows; a missing or empty source writes nothing.

    Text that is not a timestamp becomes NULL. Loading twice leaves the same rows, once.
    """
    if df is None or df.isEmpty():
        return 0
    parsed = df.withColumns(
        {c: F.try_to_timestamp(F.col(c).cast("string")) for c in timestamps if c in df.columns}
    )
    return overwrite(parsed, path, partition_by=partition_by).count()


# --- scan measurements -----------------------------------------------------------------

_METRICS = {"numFiles": "files", "filesSize": "bytes", "numPartitions": "partitions", "numOutputRows": "rows"}


def _scan_nodes(plan) -> list:
    """File-scan nodes of an executed plan, looking through adaptive wrappers and query stages."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _scan_nodes(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return _scan_nodes(plan.plan())
    found = [plan] if kind == "FileSourceScanExec" else []
    children = plan.children()
    for i in range(children.size()):
        found += _scan_nodes(children.apply(i))
    return found


def scan_stats(df: DataFrame) -> dict:
    """Run ``df`` (a small result) and read what its file scans touched, with the wall time."""
    start = time.time()
    df.collect()
    stats = dict.fromkeys(_METRICS.values(), 0)
    for node in _scan_nodes(df._jdf.queryExecution().executedPlan()):
        metrics = node.metrics()
        for metric, name in _METRICS.items():
            found = metrics.get(metric)
            if found.isDefined():
                stats[name] += int(found.get().value())
    stats["elapsed_s"] = time.time() - start
    return stats


def compare_scans(partitioned: DataFrame, flat: DataFrame) -> DataFrame:
    """The same query on both layouts: one row with bytes, partitions and the reduction in percent."""
    a, b = scan_stats(partitioned), scan_stats(flat)
    spark = partitioned.sparkSession
    record = Row(
        partitioned_bytes=a["bytes"],
        flat_bytes=b["bytes"],
        partitions_scanned=a["partitions"],
        partitioned_rows=a["rows"],
        flat_rows=b["rows"],
        partitioned_s=float(a["elapsed_s"]),
        flat_s=float(b["elapsed_s"]),
    )
    schema = (
        "partitioned_bytes bigint, flat_bytes bigint, partitions_scanned bigint, partitioned_rows bigint, "
        "flat_rows bigint, partitioned_s double, flat_s double"
    )
    return with_reduction(spark.createDataFrame([record], schema))


def with_reduction(scans: DataFrame) -> DataFrame:
    """Percent of bytes saved; 0 when the flat copy has none."""
    saved = (F.col("flat_bytes") - F.col("partitioned_bytes")) * F.lit(100.0)
    pct = F.coalesce(F.try_divide(saved, F.col("flat_bytes").cast("double")), F.lit(0.0))
    return scans.withColumn("reduction_pct", F.round(pct, 2))


def cost_estimate(scans: DataFrame, scanned: str = "bytes", elapsed: str = "elapsed_s") -> DataFrame:
    """Price of scanned bytes, and the price range of the elapsed time."""
    hours = F.col(elapsed) / F.lit(3600.0)
    low, high = (F.round(hours * F.lit(CREDITS_PER_HOUR * p), 6) for p in USD_PER_CREDIT)
    return scans.withColumns(
        {
            "scan_usd": F.round(F.col(scanned) / F.lit(float(TIB)) * F.lit(USD_PER_TIB), 6),
            "credit_usd_low": low,
            "credit_usd_high": high,
        }
    )
