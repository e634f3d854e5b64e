"""Readers for catalogue tables, event logs and JDBC sources."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, folder: str, name: str, schema: StructType | str | None = None) -> DataFrame:
    """One parquet table below ``folder``; a schema, when given, is enforced."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    path = os.path.join(folder, name)
    return reader.parquet(path if name.endswith(".parquet") else f"{path}.parquet")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
    **options: str,
) -> DataFrame:
    """A relational source, read in parallel ranges when a numeric or date column is named.

    Without one the database hands over a single stream, so name one for large tables.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column:
        low, high = bounds
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(low))
            .option("upperBound", str(high))
            .option("numPartitions", str(partitions))
        )
    return reader.load()


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists on whatever file system the path names."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def remove_table(spark: SparkSession, path: str) -> None:
    """Remove a table folder on whatever file system the path names."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def table_row_counts(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """(table, row_count) for every table; 0 for a table that is missing (None)."""
    known = [t for t in tables.values() if t is not None]
    spark = known[0].sparkSession
    frames = [
        spark.range(1).select(F.lit(name).alias("table"), F.lit(0).cast("bigint").alias("row_count"))
        if df is None
        else df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table"), "row_count")
        for name, df in tables.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
