"""Marts, reports, rankings and joins over the bound retail tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.functions.exprs import exact_sum
from sparkmart.operators import marts as M
from sparkmart.plans.registry import Registry
from sparkmart.sources.tables import table_row_counts

MONEY = "CAST(SUM(CAST(revenue AS DECIMAL(18,4))) AS DOUBLE)"
MEAN = f"{MONEY} / COUNT(revenue)"

FRAGMENTS = {
    "line_brand": "SELECT f.*, b.brand FROM {finance_lines} f JOIN {brands} b USING (product_id)",
    "line_name": "SELECT f.*, i.product_name FROM {finance_lines} f JOIN {info} i USING (product_id)",
    "line_review": "SELECT f.*, r.rating, r.review_count FROM {finance_lines} f JOIN {reviews} r USING (product_id)",
    "brand_totals": f"SELECT brand, {MONEY} AS total_revenue FROM {{line_brand}} GROUP BY brand",
    "name_totals": f"SELECT product_name, {MONEY} AS total_revenue FROM {{line_name}} GROUP BY product_name",
    "visits": "SELECT product_id, strftime(last_visited, '%Y-%m') AS month, last_visited FROM {traffic}",
    "monthly": "SELECT month, COUNT(*) AS visit_count FROM {visits} GROUP BY month",
    "event_totals": """
        SELECT product_id,
               round_even(CAST(SUM(CAST(revenue AS DECIMAL(18,4))) AS DOUBLE), 2) AS revenue,
               round_even(CAST(SUM(CAST(price AS DECIMAL(18,4))) AS DOUBLE) / COUNT(price), 2) AS sale_price,
               round_even(MAX(price), 2) AS listing_price,
               round_even(GREATEST(LEAST(CAST(SUM(CAST(discount AS DECIMAL(18,4))) AS DOUBLE) / COUNT(discount), 1.0), 0.0), 4)
                   AS discount
        FROM {sales_events} GROUP BY product_id""",
    "event_days": "SELECT MAX(CAST(event_timestamp AS DATE)) AS last_day FROM {sales_events}",
}

R = Registry(FRAGMENTS)

# --- scans ------------------------------------------------------------------------

R.add(
    "q_scan_project",
    lambda t: t.lineitem.select("l_partkey", "l_discount"),
    "SELECT l_partkey, l_discount FROM lineitem",
)
R.add(
    "q_table_row_counts",
    lambda t: table_row_counts(
        {"finance": t.lineitem, "brands": t.part, "info": t.part, "traffic": t.lineitem, "absent": None}
    ),
    """SELECT 'finance' AS "table", COUNT(*) AS row_count FROM lineitem UNION ALL
       SELECT 'brands', COUNT(*) FROM part UNION ALL SELECT 'info', COUNT(*) FROM part UNION ALL
       SELECT 'traffic', COUNT(*) FROM lineitem UNION ALL SELECT 'absent', 0""",
)

# --- revenue ----------------------------------------------------------------------

R.add(
    "q_total_revenue",
    lambda t: M.total_revenue(t.finance_lines),
    f"SELECT {MONEY} AS total_revenue FROM {{finance_lines}}",
)
R.add(
    "q_brand_revenue",
    lambda t: M.brand_revenue(t.finance_lines, t.brands),
    f"""SELECT brand, {MONEY} AS total_revenue, COUNT(DISTINCT product_id) AS product_count,
               ROUND({MONEY} * 100.0 / SUM({MONEY}) OVER (), 2) AS revenue_share_pct
        FROM {{line_brand}} GROUP BY brand""",
)
R.add(
    "q_product_revenue",
    lambda t: M.product_revenue(t.finance_lines, t.info, t.brands),
    f"""SELECT product_name, brand, {MONEY} AS total_revenue,
               CAST(RANK() OVER (ORDER BY {MONEY} DESC) AS BIGINT) AS revenue_rank
        FROM {{line_brand}} JOIN {{info}} USING (product_id) GROUP BY product_name, brand""",
)
R.add(
    "q_product_revenue_by_name",
    lambda t: M.product_revenue(t.finance_lines, t.info, t.brands, by_name_only=True),
    f"""SELECT product_name, MIN(brand) AS brand, {MONEY} AS total_revenue,
               CAST(RANK() OVER (ORDER BY {MONEY} DESC) AS BIGINT) AS revenue_rank
        FROM {{line_brand}} JOIN {{info}} USING (product_id) GROUP BY product_name""",
)
R.add(
    "q_product_rank",
    lambda t: M.product_rank(t.finance_lines, t.info),
    """SELECT *, CAST(RANK() OVER (ORDER BY total_revenue DESC) AS BIGINT) AS revenue_rank FROM {name_totals}""",
)
R.add(
    "q_rank_min",
    lambda t: M.rank_rows(M.product_totals(t.finance_lines, t.info), "total_revenue", "rank_min"),
    """SELECT a.product_name, a.total_revenue, 1 + COUNT(b.product_name) AS rank_min
       FROM {name_totals} a LEFT JOIN {name_totals} b ON b.total_revenue > a.total_revenue GROUP BY ALL""",
)
R.add(
    "q_rank_le_k",
    lambda t: M.ranked_up_to(t.finance_lines, t.info, 15),
    """SELECT * FROM (SELECT *, CAST(RANK() OVER (ORDER BY total_revenue DESC) AS BIGINT) AS revenue_rank
                      FROM {name_totals}) WHERE revenue_rank <= 15""",
)
R.add(
    "q_brand_share_cte",
    lambda t: M.brand_share(t.finance_lines, t.brands),
    """SELECT brand, total_revenue,
              ROUND(total_revenue * 100.0 / SUM(total_revenue) OVER (), 2) AS revenue_share_percentage
       FROM {brand_totals}""",
)
R.add(
    "q_brand_share_nested",
    lambda t: M.brand_share(t.finance_lines, t.brands, "revenue_share_percent"),
    f"""SELECT brand, {MONEY} AS total_revenue,
               ROUND({MONEY} * 100.0 / SUM({MONEY}) OVER (), 2) AS revenue_share_percent
        FROM {{line_brand}} GROUP BY brand""",
)
R.add(
    "q_brand_share_unknown",
    lambda t: M.brand_share_with_unknown(t.finance_lines, t.brands_with_gaps),
    f"""SELECT COALESCE(b.brand, 'Unknown') AS brand, {MONEY} AS total_revenue,
               ROUND({MONEY} * 100.0 / SUM({MONEY}) OVER (), 6) AS share_percent
        FROM {{finance_lines}} f JOIN {{brands_with_gaps}} b USING (product_id)
        GROUP BY COALESCE(b.brand, 'Unknown')""",
)
R.add(
    "q_top_brand",
    lambda t: M.top_brand(t.finance_lines, t.brands),
    """SELECT brand, total_revenue,
              ROUND(total_revenue * 100.0 / (SELECT SUM(total_revenue) FROM {brand_totals}), 2)
                  AS revenue_share_percentage
       FROM {brand_totals} ORDER BY total_revenue DESC, brand DESC LIMIT 1""",
)

# --- joins ---------------------------------------------------------------------------

R.add(
    "q_join_finance_brand",
    lambda t: M.join_finance_brand(t.finance_lines, t.brands),
    "SELECT product_id, discount, revenue, brand FROM {line_brand}",
)
R.add(
    "q_raw_data_export",
    lambda t: M.line_export(t.finance_lines, t.brands, t.info, t.price_list),
    """SELECT product_id, product_name, brand, listing_price, discount, revenue
       FROM {finance} JOIN {brands} USING (product_id) JOIN {info} USING (product_id)""",
)
R.add(
    "q_traffic_finance_join",
    lambda t: M.traffic_finance_join(t.traffic, t.finance_lines),
    f"""SELECT month, product_id, {MONEY} AS total_revenue
        FROM {{visits}} JOIN {{finance_lines}} USING (product_id)
        WHERE last_visited IS NOT NULL GROUP BY month, product_id""",
)
R.add(
    "q_monthly_revenue",
    lambda t: M.monthly_revenue(t.traffic, t.finance_lines),
    f"""SELECT month, {MONEY} AS total_revenue
        FROM {{visits}} JOIN {{finance_lines}} USING (product_id)
        WHERE last_visited IS NOT NULL GROUP BY month""",
)

# --- traffic -------------------------------------------------------------------------

R.add("q_monthly_traffic", lambda t: M.monthly_traffic(t.traffic), "SELECT * FROM {monthly}")
R.add(
    "q_monthly_traffic_nonnull",
    lambda t: M.monthly_traffic_nonnull(t.traffic),
    """SELECT month, COUNT(product_id) AS visit_count FROM {visits}
       WHERE last_visited IS NOT NULL GROUP BY month""",
)
R.add(
    "q_traffic_mom",
    lambda t: M.traffic_change(M.monthly_traffic(t.traffic)),
    "SELECT *, visit_count - LAG(visit_count) OVER (ORDER BY month) AS mom_change FROM {monthly}",
)
_MOST_VISITED = """
    SELECT i.product_name, COUNT(DISTINCT month(t.last_visited)) AS year_month, COUNT(*) AS visit_count
    FROM {traffic} t JOIN {info} i USING (product_id) GROUP BY i.product_name"""
R.add(
    "q_distinct_months_visited",
    lambda t: M.most_visited(t.traffic, t.info, 10),
    _MOST_VISITED + " ORDER BY visit_count DESC, product_name LIMIT 10",
)
R.add(
    "q_top_visited",
    lambda t: M.most_visited(t.traffic, t.info, 10).select("product_name", "visit_count"),
    f"SELECT product_name, visit_count FROM ({_MOST_VISITED}) ORDER BY visit_count DESC, product_name LIMIT 10",
)

# --- discounts -----------------------------------------------------------------------

_CATEGORY = "CASE WHEN discount > 0 THEN 'Discounted' ELSE 'No Discount' END"
R.add(
    "q_discount_impact",
    lambda t: M.discount_impact(t.finance_lines),
    f"""SELECT {_CATEGORY} AS category, {MONEY} AS total_revenue, {MEAN} AS avg_revenue,
               COUNT(*) AS product_count FROM {{finance_lines}} GROUP BY 1""",
)
R.add(
    "q_discount_share",
    lambda t: M.discount_share(t.finance_lines),
    f"""SELECT {_CATEGORY} AS category, {MONEY} AS total_revenue,
               ROUND({MONEY} * 100.0 / SUM({MONEY}) OVER (), 1) AS revenue_share_pct
        FROM {{finance_lines}} GROUP BY 1""",
)
# Driver discounts stop at 0.10; five times as much reaches every band and its holes.
_STRETCHED = "SELECT product_id, CASE WHEN discount = 0.05 THEN NULL ELSE discount * 6.15e0 END AS discount, revenue FROM {finance_lines}"
_stretch = lambda t: t.finance_lines.withColumn(
    "discount", F.when(F.col("discount") == 0.05, None).otherwise(F.col("discount") * 6.15)
)
R.add(
    "q_discount_range",
    lambda t: M.discount_range(_stretch(t)),
    f"""SELECT CASE WHEN discount BETWEEN 0 AND 0.20 THEN 'Low Discount'
                    WHEN discount BETWEEN 0.21 AND 0.50 THEN 'Medium Discount'
                    WHEN discount > 0.50 THEN 'High Discount' ELSE 'No Discount' END AS discount_range,
               {MONEY} AS total_revenue FROM ({_STRETCHED}) GROUP BY 1""",
)
R.add(
    "q_discount_range_strict",
    lambda t: M.discount_range(_stretch(t), strict=True),
    f"""SELECT CASE WHEN discount IS NULL THEN 'Unknown' WHEN discount <= 0 THEN 'No Discount'
                    WHEN discount <= 0.20 THEN 'Low Discount' WHEN discount <= 0.50 THEN 'Medium Discount'
                    ELSE 'High Discount' END AS discount_range,
               {MONEY} AS total_revenue FROM ({_STRETCHED}) GROUP BY 1""",
)
R.add(
    "q_discount_range_pct",
    lambda t: M.discount_range_by_thresholds(_stretch(t), 10, 30),
    f"""SELECT CASE WHEN discount < 10 THEN 'Low Discount' WHEN discount BETWEEN 10 AND 30 THEN 'Medium Discount'
                    ELSE 'High Discount' END AS discount_range,
               {MONEY} AS total_revenue FROM ({_STRETCHED}) GROUP BY 1""",
)
R.add(
    "q_discount_summary",
    lambda t: M.discount_summary(t.finance_lines),
    f"""SELECT CASE WHEN discount > 0 THEN 'Discounted' WHEN discount = 0 THEN 'Full Price' END AS category,
               {MEAN} AS avg_revenue, ROUND(MEDIAN(revenue), 6) AS median_revenue, COUNT(revenue) AS product_count
        FROM {{finance_lines}} WHERE discount >= 0 GROUP BY 1""",
)

# --- reviews ---------------------------------------------------------------------------

R.add(
    "q_review_volume",
    lambda t: M.review_volume(t.finance_lines, t.reviews),
    f"""SELECT CASE WHEN review_count < 100 THEN 'Low Reviews' WHEN review_count BETWEEN 100 AND 500
                    THEN 'Medium Reviews' ELSE 'High Reviews' END AS review_volume,
               {MONEY} AS total_revenue FROM {{line_review}} GROUP BY 1""",
)
R.add(
    "q_review_volume_avg",
    lambda t: M.review_volume_average(t.finance_lines, t.reviews),
    f"""SELECT CASE WHEN review_count < 50 THEN 'Low Reviews' WHEN review_count BETWEEN 50 AND 200
                    THEN 'Medium Reviews' ELSE 'High Reviews' END AS review_group,
               {MEAN} AS avg_revenue FROM {{line_review}} GROUP BY 1""",
)
R.add(
    "q_revenue_by_rating",
    lambda t: M.revenue_by_rating(t.finance_lines, t.reviews),
    f"SELECT rating, {MONEY} AS total_revenue FROM {{line_review}} GROUP BY rating",
)
R.add(
    "q_rating_group_avg",
    lambda t: M.rating_group_average(t.finance_lines, t.reviews),
    f"SELECT ROUND(rating, 1) AS rating_group, {MEAN} AS avg_revenue FROM {{line_review}} GROUP BY 1",
)

# --- prices, top lists --------------------------------------------------------------------

_PRICES = f"""
    SELECT i.product_name,
           CAST(SUM(CAST(listing_price AS DECIMAL(18,4))) AS DOUBLE) / COUNT(listing_price) AS avg_listing_price,
           {MONEY} AS total_revenue
    FROM {{finance}} f JOIN {{info}} i USING (product_id) GROUP BY i.product_name"""
R.add("q_price_vs_revenue", lambda t: M.price_vs_revenue(t.finance_lines, t.info, t.price_list), _PRICES)
R.add(
    "q_price_top10",
    lambda t: M.price_vs_revenue(t.finance_lines, t.info, t.price_list).limit(10),
    _PRICES + " ORDER BY avg_listing_price DESC, product_name LIMIT 10",
)
R.add(
    "q_top_products",
    lambda t: M.top_products(t.finance_lines, t.info),
    "SELECT * FROM {name_totals} ORDER BY total_revenue DESC, product_name LIMIT 10",
)
R.add(
    "q_top_avg_revenue",
    lambda t: M.top_average_revenue(t.finance_lines, t.info),
    f"""SELECT product_name, {MEAN} AS avg_revenue, substring(product_name, 1, 25) AS label
        FROM {{line_name}} GROUP BY product_name ORDER BY avg_revenue DESC, product_name LIMIT 10""",
)
R.add(
    "q_top_catalogue_count",
    lambda t: M.top_catalogue_count(t.info),
    """SELECT product_name, COUNT(product_id) AS count_of_products FROM {info}
       GROUP BY product_name ORDER BY count_of_products DESC, product_name LIMIT 10""",
)
R.add(
    "q_top_reviewed",
    lambda t: M.top_reviewed(t.info, t.reviews),
    """SELECT i.product_name, CAST(SUM(r.review_count) AS DOUBLE) AS count_reviews
       FROM {info} i JOIN {reviews} r USING (product_id)
       GROUP BY i.product_name ORDER BY count_reviews DESC, product_name LIMIT 10""",
)
R.add(
    "q_top_rated",
    lambda t: M.top_rated(t.info, t.reviews),
    """SELECT i.product_name,
              CAST(SUM(CAST(r.rating AS DECIMAL(18,4))) AS DOUBLE) / COUNT(r.rating) AS avg_rating
       FROM {info} i JOIN {reviews} r USING (product_id)
       GROUP BY i.product_name ORDER BY avg_rating DESC, product_name LIMIT 10""",
)
R.add(
    "q_dedup_keep_best",
    lambda t: M.keep_best(t.info.join(t.reviews, "product_id").select("product_id", "product_name", "review_count"),
                          "product_name", "review_count", "product_id", 20),
    """SELECT product_id, product_name, review_count FROM (
           SELECT *, ROW_NUMBER() OVER (PARTITION BY product_name ORDER BY review_count DESC, product_id) AS rn
           FROM {info} JOIN {reviews} USING (product_id)) WHERE rn = 1
       ORDER BY review_count DESC, product_id LIMIT 20""",
)

# --- distributions --------------------------------------------------------------------------


def _bins(bins: int, group: str | None) -> str:
    g = f"{group}, " if group else ""
    over = f"PARTITION BY {group}" if group else ""
    return f"""
        SELECT {g}bin, ROUND(ANY_VALUE(lo) + bin * ANY_VALUE(w), 6) AS bin_start, COUNT(*) AS row_count FROM (
            SELECT *, LEAST(CAST(FLOOR((revenue - lo) / w) AS BIGINT), {bins - 1}) AS bin FROM (
                SELECT *, (hi - lo) / {float(bins)}e0 AS w FROM (
                    SELECT {g}revenue, MIN(revenue) OVER ({over}) AS lo, MAX(revenue) OVER ({over}) AS hi
                    FROM (SELECT *, {_CATEGORY} AS category FROM {{finance_lines}}))))
        GROUP BY {g}bin"""


R.add("q_revenue_histogram", lambda t: M.histogram(t.finance_lines, "revenue", 20), _bins(20, None))
R.add(
    "q_revenue_histogram_by_discount",
    lambda t: M.histogram(
        t.finance_lines.select(M.discount_category().alias("category"), "revenue"), "revenue", 30, ["category"]
    ),
    _bins(30, "category"),
)

# --- events -----------------------------------------------------------------------------------

R.add("q_event_product_agg", lambda t: M.event_product_totals(t.sales_events), "SELECT * FROM {event_totals}")
_ENRICHED = """SELECT e.product_id, i.product_name, b.brand, e.revenue AS event_revenue,
                      e.sale_price AS avg_price, e.discount AS avg_discount
               FROM {event_totals} e LEFT JOIN {info} i USING (product_id) LEFT JOIN {brands_with_gaps} b USING (product_id)"""
R.add(
    "q_event_revenue_enriched",
    lambda t: M.event_revenue_enriched(M.event_product_totals(t.sales_events), t.info, t.brands_with_gaps),
    _ENRICHED,
)
R.add(
    "q_event_revenue",
    lambda t: M.event_revenue(M.event_product_totals(t.sales_events), t.info, t.brands_with_gaps),
    f"SELECT *, CAST(RANK() OVER (ORDER BY event_revenue DESC) AS BIGINT) AS revenue_rank FROM ({_ENRICHED})",
)
R.add(
    "q_event_daily_revenue",
    lambda t: M.event_daily_revenue(t.sales_events),
    f"""SELECT CAST(event_timestamp AS DATE) AS event_date, {MONEY} AS revenue, COUNT(*) AS event_count
        FROM {{sales_events}} GROUP BY 1""",
)
R.add(
    "q_parametrised_filter",
    lambda t: M.product_revenue_between(t.sales_events, 7, "2024-01-05", "2024-01-25"),
    f"""SELECT {MONEY} AS revenue, COUNT(*) AS event_count FROM {{sales_events}}
        WHERE product_id = 7 AND CAST(event_timestamp AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""",
)
R.add(
    "q_anchored_date_window",
    lambda t: M.in_anchored_window(t.sales_events, 3).groupBy("product_id").agg(exact_sum("revenue").alias("revenue")),
    f"""SELECT product_id, {MONEY} AS revenue FROM {{sales_events}}
        WHERE CAST(event_timestamp AS DATE) >= (SELECT last_day FROM {{event_days}}) - 2 GROUP BY product_id""",
)
R.add(
    "q_anchored_window_bounds",
    lambda t: M.anchored_window(t.sales_events, 3),
    "SELECT CAST(last_day - 2 AS DATE) AS window_start, last_day AS window_end FROM {event_days}",
)

# --- projections ----------------------------------------------------------------------------

R.add(
    "q_non_null_projection",
    lambda t: M.distinct_ids(t.raw_reviews),
    "SELECT DISTINCT product_id FROM {raw_reviews} WHERE product_id IS NOT NULL AND trim(product_id) <> ''",
)
R.add(
    "q_distinct_product_names",
    lambda t: M.distinct_names(t.info),
    "SELECT DISTINCT product_name FROM {info} WHERE product_name IS NOT NULL",
)
