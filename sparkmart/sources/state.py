"""High-water marks of pipeline steps, kept as an append-only table.

A mark is set by appending one row and read as the row with the highest sequence number per
step, so a mark is never half-written and its history stays readable.
"""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.sources.tables import table_exists

SCHEMA = (
    "step_name string, seq bigint, last_successful_at timestamp, last_row_count bigint, "
    "detail string, updated_at timestamp"
)


class MarkStore:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.path = os.path.join(folder, "pipeline_watermarks")

    def history(self) -> DataFrame:
        if not table_exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def current(self) -> DataFrame:
        """The newest row of every step."""
        row = F.struct("seq", "last_successful_at", "last_row_count", "detail", "updated_at")
        return self.history().groupBy("step_name").agg(F.max_by(row, "seq").alias("r")).select("step_name", "r.*")

    def row(self, step: str):
        return self.current().where(F.col("step_name") == step).first()

    def get(self, step: str) -> tuple[datetime | None, int | None]:
        """(last_successful_at, last_row_count), or (None, None) before the first run."""
        row = self.row(step)
        return (row["last_successful_at"], row["last_row_count"]) if row else (None, None)

    def set(self, step: str, count: int, at: datetime | None = None, detail: str | None = None) -> None:
        """Record a successful run; the time is now unless given."""
        row = self.row(step)
        seq = row["seq"] + 1 if row else 0
        now = F.current_timestamp()
        self.spark.range(1).select(
            F.lit(step).alias("step_name"),
            F.lit(seq).cast("bigint").alias("seq"),
            (F.lit(at).cast("timestamp") if at is not None else now).alias("last_successful_at"),
            F.lit(count).cast("bigint").alias("last_row_count"),
            F.lit(detail).cast("string").alias("detail"),
            now.alias("updated_at"),
        ).coalesce(1).write.mode("append").parquet(self.path)
