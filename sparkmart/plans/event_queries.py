"""Incremental ingest, streaming, layout and scan cost over the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators import incremental as I
from sparkmart.operators import layout as L
from sparkmart.operators import marts as M
from sparkmart.plans.mart_queries import FRAGMENTS, MONEY
from sparkmart.plans.registry import Registry, Tables
from sparkmart.session import new_folder
from sparkmart.sources.sinks import export_csv, read_current
from sparkmart.streaming import events as S

CUTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")  # three batches of ten days

_TOTALS = """
    SELECT {key}product_id,
           round_even(CAST(SUM(CAST(revenue AS DECIMAL(18,4))) AS DOUBLE), 2) AS revenue,
           round_even(CAST(SUM(CAST(price AS DECIMAL(18,4))) AS DOUBLE) / COUNT(price), 2) AS sale_price,
           round_even(MAX(price), 2) AS listing_price,
           round_even(GREATEST(LEAST(CAST(SUM(CAST(discount AS DECIMAL(18,4))) AS DOUBLE) / COUNT(discount), 1e0), 0e0), 4) AS discount
    FROM {source} GROUP BY {key}product_id"""


def _totals(source: str, key: str = "") -> str:
    return _TOTALS.replace("{key}", key).replace("{source}", source)


R = Registry(
    {
        **FRAGMENTS,
        "batched": f"""SELECT *, CASE WHEN event_timestamp < TIMESTAMP '{CUTS[0]}' THEN 0
                                      WHEN event_timestamp < TIMESTAMP '{CUTS[1]}' THEN 1 ELSE 2 END AS batch_id
                       FROM {{sales_events}}""",
        "batch_totals": _totals("{batched}", "batch_id, "),
        "replayed": """SELECT * EXCLUDE (batch_id, rn) FROM (
                           SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY batch_id DESC) AS rn
                           FROM {batch_totals}) WHERE rn = 1""",
    }
)


def _batched(t: Tables) -> DataFrame:
    ts = F.col("event_timestamp")
    cut = [F.lit(c).cast("timestamp") for c in CUTS]
    return t.sales_events.withColumn("batch_id", F.when(ts < cut[0], 0).when(ts < cut[1], 1).otherwise(2))


def _batch(t: Tables, n: int) -> DataFrame:
    return I.finish_parts(I.batch_parts(_batched(t).where(F.col("batch_id") == n)))


# --- incremental ------------------------------------------------------------------------

R.add(
    "q_new_events",
    lambda t: I.new_events(t.sales_events, CUTS[1]).select("event_id", "product_id", "revenue"),
    f"SELECT event_id, product_id, revenue FROM {{sales_events}} WHERE event_timestamp > TIMESTAMP '{CUTS[1]}'",
)
R.add(
    "q_upsert_latest",
    lambda t: I.upsert_latest(_batch(t, 0), _batch(t, 1), ["product_id"]),
    """SELECT * EXCLUDE (batch_id) FROM {batch_totals} WHERE batch_id = 1 UNION ALL
       SELECT * EXCLUDE (batch_id) FROM {batch_totals} WHERE batch_id = 0
           AND product_id NOT IN (SELECT product_id FROM {batch_totals} WHERE batch_id = 1)""",
)
R.add(
    "q_anti_upsert",
    lambda t: I.untouched(_batch(t, 0), _batch(t, 1), ["product_id"]),
    """SELECT * EXCLUDE (batch_id) FROM {batch_totals} WHERE batch_id = 0
       AND product_id NOT IN (SELECT product_id FROM {batch_totals} WHERE batch_id = 1)""",
)
R.add(
    "q_incremental_replay",
    lambda t: I.finish_parts(I.latest_wins(I.batch_parts(_batched(t), "batch_id"), ["product_id"], "batch_id")),
    "SELECT * FROM {replayed}",
)
R.add(
    "q_cumulative_events",
    lambda t: I.finish_parts(I.merge_batches(I.batch_parts(_batched(t), "batch_id"))),
    _totals("{sales_events}"),
)


def _late_report(t: Tables) -> DataFrame:
    """Nine of ten events up to the mark are ingested; the ids that the log kept tell the others."""
    folder = new_folder(t.spark, "late")
    I.ingest_incremental(t.sales_events.where((F.col("event_id") % 10 != 0) & (F.col("event_timestamp") <= F.lit(CUTS[1]).cast("timestamp"))), folder)
    return I.late_events(t.sales_events, CUTS[1], I.kept_ids(t.spark, folder, 0)).select("event_id", "product_id")


R.add(
    "q_late_report",
    _late_report,
    f"""SELECT event_id, product_id FROM {{sales_events}}
        WHERE event_timestamp <= TIMESTAMP '{CUTS[1]}' AND event_id % 10 = 0""",
)


def _ingest_late(t: Tables) -> str:
    """Nine of ten events of the first ten days; then the first twenty days, with what was late; then all events, twice."""
    folder = new_folder(t.spark, "ingest-late")
    batches = _batched(t)
    I.ingest_incremental(batches.where((F.col("batch_id") < 1) & (F.col("event_id") % 10 != 0)), folder)
    I.ingest_incremental(batches.where(F.col("batch_id") < 2), folder)
    I.ingest_incremental(batches.unionByName(batches), folder)
    return folder


def _ingest_in_steps(t: Tables) -> str:
    """The log grows by one batch before each run; a last run finds nothing new."""
    folder = new_folder(t.spark, "ingest")
    for step in (0, 1, 2, 2):
        I.ingest_incremental(_batched(t).where(F.col("batch_id") <= step), folder)
    return folder


R.add(
    "q_ingest_incremental",
    lambda t: I.latest_batch_per_product(t.spark, _ingest_in_steps(t)),
    "SELECT * FROM {replayed}",
)
R.add(
    "q_ingest_cumulative",
    lambda t: I.cumulative_per_product(t.spark, _ingest_in_steps(t)),
    _totals("{sales_events}"),
)


R.add(
    "q_ingest_late",
    lambda t: I.cumulative_per_product(t.spark, _ingest_late(t)),
    _totals("{sales_events}"),
)
R.add(
    "q_daily_late",
    lambda t: I.daily_totals(t.spark, _ingest_late(t)),
    f"""SELECT CAST(event_timestamp AS DATE) AS event_date, {MONEY} AS revenue, COUNT(*) AS event_count,
               CAST(COUNT(*) FILTER (event_id % 10 = 0 AND event_timestamp <= (
                   SELECT MAX(event_timestamp) FROM {{sales_events}}
                   WHERE event_timestamp < TIMESTAMP '{CUTS[0]}' AND event_id % 10 <> 0)) AS BIGINT) AS late_count,
               CAST(event_timestamp AS DATE) + INTERVAL 1 DAY
                   > (SELECT MAX(event_timestamp) - INTERVAL 1 HOUR FROM {{sales_events}}) AS is_open
        FROM {{sales_events}} GROUP BY 1, is_open""",
)


def _snapshot_runs(t: Tables) -> DataFrame:
    """First run copies, second finds no change, third sees edits that keep the row count."""
    folder = new_folder(t.spark, "snapshot")
    sources = {"brands": t.raw_brands, "info": t.raw_info}
    edited = {**sources, "info": t.raw_info.withColumn("description", F.lit("edited"))}
    runs = [I.ingest_snapshot(s, folder) for s in (sources, sources, edited)]
    copied = read_current(t.spark, f"{folder}/raw_info")
    return copied.agg(F.count_if(F.col("description") == "edited").alias("edited_rows")).select(
        *(F.lit(n).cast("bigint").alias(f"run_{i + 1}") for i, n in enumerate(runs)), "edited_rows"
    )


R.add(
    "q_ingest_snapshot",
    _snapshot_runs,
    """SELECT 2 * COUNT(*) AS run_1, CAST(NULL AS BIGINT) AS run_2, 2 * COUNT(*) AS run_3, COUNT(*) AS edited_rows
       FROM {raw_info}""",
)

# --- streaming -----------------------------------------------------------------------------


def _stream_ingest(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "stream-ingest")
    S.run_to_end(S.ingest_stream(S.event_stream(t.spark, t.folder), f"{folder}/table", f"{folder}/checkpoint"))
    return I.cumulative_per_product(t.spark, f"{folder}/table")


def _stream_to_table(t: Tables, make) -> DataFrame:
    folder = new_folder(t.spark, "stream")
    stream = make(S.event_stream(t.spark, t.folder))
    S.run_to_end(S.to_parquet(stream, f"{folder}/out", f"{folder}/checkpoint"))
    return t.spark.read.schema(stream.schema).parquet(f"{folder}/out")


def _stream_dedup(t: Tables) -> DataFrame:
    """Every event arrives twice."""
    twice = lambda e: S.first_of_each_event(e.unionByName(S.event_stream(t.spark, t.folder)))
    return _stream_to_table(t, twice).select("event_id", "product_id", "revenue")


R.add("q_stream_ingest", _stream_ingest, _totals("{sales_events}"))
R.add("q_stream_dedup", _stream_dedup, "SELECT event_id, product_id, revenue FROM {sales_events}")


def _stream_daily(t: Tables) -> DataFrame:
    """Every event is delivered twice, the second time under a new checkpoint."""
    folder = new_folder(t.spark, "stream-days")
    for k in range(2):
        S.run_to_end(S.ingest_stream(S.event_stream(t.spark, t.folder), f"{folder}/log", f"{folder}/checkpoint-{k}"))
    return I.daily_totals(t.spark, f"{folder}/log").select("event_date", "revenue", "event_count", "is_open")


R.add(
    "q_stream_daily",
    _stream_daily,
    f"""SELECT CAST(event_timestamp AS DATE) AS event_date, {MONEY} AS revenue, COUNT(*) AS event_count,
               CAST(event_timestamp AS DATE) + INTERVAL 1 DAY
                   > (SELECT MAX(event_timestamp) - INTERVAL 1 HOUR FROM {{sales_events}}) AS is_open
        FROM {{sales_events}} GROUP BY 1, is_open""",
)


def _stream_daily_all(t: Tables) -> DataFrame:
    """Every day of the log, the last one, which is still open, too."""
    folder = new_folder(t.spark, "stream-daily")
    S.run_to_end(S.upsert_daily(S.event_stream(t.spark, t.folder), f"{folder}/table", f"{folder}/checkpoint"))
    return read_current(t.spark, f"{folder}/table", "event_date date, revenue double, event_count bigint")


R.add(
    "q_stream_daily_all",
    _stream_daily_all,
    f"""SELECT CAST(event_timestamp AS DATE) AS event_date, {MONEY} AS revenue, COUNT(*) AS event_count
        FROM {{sales_events}} GROUP BY 1""",
)

# --- layout and cost -------------------------------------------------------------------------


def _layout(t: Tables) -> DataFrame:
    return L.write_partitioned(t.sales_events, new_folder(t.spark, "fact"))


R.add(
    "q_partitioned_layout",
    lambda t: _layout(t).select("event_id", "product_id", "event_date"),
    "SELECT event_id, product_id, CAST(event_timestamp AS DATE) AS event_date FROM {sales_events}",
)
R.add(
    "q_partitioned_filter",
    lambda t: M.product_revenue_between(_layout(t), 7, "2024-01-05", "2024-01-25"),
    f"""SELECT {MONEY} AS revenue, COUNT(*) AS event_count FROM {{sales_events}}
        WHERE product_id = 7 AND CAST(event_timestamp AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""",
)


def _scan_compare(t: Tables) -> DataFrame:
    """The three-day revenue of the best-selling product on both layouts."""
    by_day = _layout(t)
    flat = L.write_flat(t.sales_events, new_folder(t.spark, "flat"))
    first, last = M.anchored_window(flat, 3).first()
    best = flat.groupBy("product_id").agg(M.exact_sum("revenue").alias("r")).orderBy(F.desc("r"), "product_id").first()[0]
    ask = lambda df: M.product_revenue_between(df, best, first, last)
    return L.cost_estimate(L.compare_scans(ask(by_day), ask(flat)), "partitioned_bytes", "partitioned_s")


R.add("q_scan_compare", _scan_compare)
R.add(
    "q_cost_estimate",
    lambda t: L.cost_estimate(
        t.sales_events.groupBy(F.to_date("event_timestamp").alias("event_date")).agg(
            (F.sum("event_id") * 1_000_003).alias("bytes"), (F.count(F.lit(1)) * 7.5).cast("double").alias("elapsed_s")
        )
    ),
    """SELECT *, ROUND(bytes / 1099511627776e0 * 6.25e0, 6) AS scan_usd,
              ROUND(elapsed_s / 3600e0 * 2e0, 6) AS credit_usd_low, ROUND(elapsed_s / 3600e0 * 4e0, 6) AS credit_usd_high
       FROM (SELECT CAST(event_timestamp AS DATE) AS event_date, CAST(SUM(event_id) * 1000003 AS BIGINT) AS bytes,
                    COUNT(*) * 7.5e0 AS elapsed_s FROM {sales_events} GROUP BY 1)""",
)


def _load_twice(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "warehouse")
    text = F.when(F.col("event_id") % 10 == 0, "not a time").otherwise(F.col("event_timestamp").cast("string"))
    source = t.sales_events.withColumn("event_timestamp", text)
    for _ in range(2):
        L.truncate_load(source, path)
    L.truncate_load(source.where(F.lit(False)), path)
    return read_current(t.spark, path).select(
        "event_id", F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss").alias("event_time")
    )


R.add(
    "q_truncate_load",
    _load_twice,
    """SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') END AS event_time
       FROM {sales_events}""",
)


def _csv_round_trip(t: Tables) -> DataFrame:
    mart = M.brand_revenue(t.finance_lines, t.brands)
    path = export_csv(mart, new_folder(t.spark, "csv"))
    return t.spark.read.schema(mart.schema).option("header", True).csv(path)


R.add(
    "q_csv_export",
    _csv_round_trip,
    f"""SELECT brand, {MONEY} AS total_revenue, COUNT(DISTINCT product_id) AS product_count,
               ROUND({MONEY} * 100.0 / SUM({MONEY}) OVER (), 2) AS revenue_share_pct
        FROM {{line_brand}} GROUP BY brand""",
)
