"""Writers. A table is a folder of versions plus a log of which one is current."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.session import new_folder
from sparkmart.sources.tables import table_exists

_LOG = "_current"


def _version_log(path: str) -> str:
    return os.path.join(path, _LOG)


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the version published last, None when nothing was published."""
    if not table_exists(spark, _version_log(path)):
        return None
    newest = (
        spark.read.schema("seq bigint, version string")
        .parquet(_version_log(path))
        .agg(F.max_by("version", "seq").alias("version"), F.max("seq").alias("seq"))
        .first()
    )
    return os.path.join(path, newest["version"]) if newest["version"] else None


def read_current(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    version = current_version(spark, path)
    if version is None:
        return None
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(version)


def publish(spark: SparkSession, path: str, version: str) -> None:
    """Make a written version current. One small appended row, after the data is complete, so a
    reader sees the old version or the new one and never half of either."""
    log = _version_log(path)
    last = -1
    if table_exists(spark, log):
        last = spark.read.schema("seq bigint, version string").parquet(log).agg(F.max("seq")).first()[0]
        last = -1 if last is None else last
    row = spark.range(1).select(F.lit(last + 1).cast("bigint").alias("seq"), F.lit(version).alias("version"))
    row.coalesce(1).write.mode("append").parquet(log)


def overwrite(
    df: DataFrame,
    path: str,
    gate: Callable[[DataFrame], object] | None = None,
    partition_by: Sequence[str] = (),
    version: str | None = None,
) -> DataFrame:
    """Replace a table: write a new version, check the written copy, then publish it.

    The table may be read while it is replaced, also by the plan of ``df`` itself. The same
    ``version`` written twice overwrites itself, which makes a repeated run harmless.
    """
    spark = df.sparkSession
    version = version or f"v-{uuid.uuid4().hex}"
    target = os.path.join(path, version)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
    written = spark.read.parquet(target)
    if gate is not None:
        gate(written)
    publish(spark, path, version)
    return written


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def append_events(events: DataFrame, path: str) -> None:
    """Append to the event log, one folder per event day."""
    append(events.withColumn("event_date", F.to_date("event_timestamp")), path, ["event_date"])


def export_csv(df: DataFrame, path: str) -> str:
    """CSV with a header; one file per partition, so nothing is gathered on one machine."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def new_version_copy(df: DataFrame, name: str, min_rows: int = 1) -> DataFrame:
    """A raw copy in the shared work folder, published only if the written copy has enough rows."""
    from sparkmart.operators.quality import enforce, row_count

    return overwrite(
        df, new_folder(df.sparkSession, f"raw-{name}"), lambda written: enforce(row_count(written, name, min_rows))
    )
