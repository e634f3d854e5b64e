"""Session defaults and the shared work folder for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "sparkmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; any of them can be overridden."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A folder of this machine is used only in local mode, where nothing is set and
    every executor is this process anyway.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="sparkmart-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path for one written table, grouped by application so it can be expired together."""
    app = spark.sparkContext.applicationId
    return os.path.join(work_folder(spark), "sparkmart", app, f"{label}-{uuid.uuid4().hex[:12]}")


def durable(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage in a way that survives lost executors. Unlike an RDD checkpoint the
    result is columnar, so later steps still prune columns, count from the footers and
    let the optimizer pick join sides from real file sizes.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def durable_counted(df: DataFrame, label: str = "table") -> tuple[DataFrame, int]:
    """``durable`` and the number of rows, observed by the job that writes."""
    seen = Observation()
    written = durable(df.observe(seen, F.count(F.lit(1)).alias("n")), label)
    return written, seen.get["n"]
