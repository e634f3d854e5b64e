"""Business marts and ad-hoc reports.

Facts may be far larger than dimensions and one product may hold a third of all sales
lines. Reports whose measures are sums therefore reduce the fact to one row per product
*before* the join: the partial aggregation runs ahead of the shuffle, and a hot product is a
single row from then on. Join sides are left to the optimizer, which broadcasts by size.

Frames: finance(product_id, revenue, discount[, listing_price]), brands(product_id, brand),
info(product_id, product_name), reviews(product_id, rating, review_count),
traffic(product_id, last_visited).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions.exprs import (
    case_when,
    clip,
    exact_avg,
    exact_sum,
    month_key,
    month_label,
    month_number,
    parts_decimal,
    round_even,
    share_pct,
    merge_parts,
    sum_of_parts,
    sum_parts,
)
from sparkmart.operators.ordering import ROWS_PER_RANGE, exact_quantiles, join_groups, rank_rows
from sparkmart.session import durable

def _rows() -> Column:
    return F.count(F.lit(1))


# --- building blocks ------------------------------------------------------------


def per_product(finance: DataFrame, *more: Column) -> DataFrame:
    """One row per product: revenue in exact parts, ``n`` non-null revenues and further aggregates."""
    return finance.groupBy("product_id").agg(
        *sum_parts("revenue", "rev"), F.count("revenue").alias("n"), *more
    )


def _total(name: str = "total_revenue") -> Column:
    return sum_of_parts("rev").alias(name)


def _mean(name: str) -> Column:
    """Mean over the original rows from per-product parts."""
    return F.try_divide(sum_of_parts("rev"), F.sum("n").cast("double")).alias(name)


def with_share(df: DataFrame, measure: str, name: str, digits: int = 2) -> DataFrame:
    """Share of the grand total, as a scalar subquery; a window without partitions would
    move every row into one task."""
    total = df.agg(exact_sum(measure)).scalar()
    return df.withColumn(name, share_pct(F.col(measure), total, digits))


# --- headline figures -------------------------------------------------------------


def total_revenue(finance: DataFrame) -> DataFrame:
    return finance.agg(exact_sum("revenue").alias("total_revenue"))


def join_finance_brand(finance: DataFrame, brands: DataFrame) -> DataFrame:
    """Sales lines with their brand (inner)."""
    return finance.join(brands, "product_id")


def line_export(finance: DataFrame, brands: DataFrame, info: DataFrame, prices: DataFrame) -> DataFrame:
    """Row-level export with name, brand and list price. The dimensions meet first and the fact joins
    them once, with nothing above that reuses its partitioning, so the adaptive skew join can split a hot product."""
    products = info.select("product_id", "product_name").join(brands, "product_id").join(prices, "product_id")
    return finance.join(products, "product_id").select(
        "product_id", "product_name", "brand", "listing_price", "discount", "revenue"
    )


# --- brand and product revenue -----------------------------------------------------


def _brand_totals(finance: DataFrame, brands: DataFrame, label: Column | None = None) -> DataFrame:
    brand = F.col("brand") if label is None else label
    return (
        per_product(finance)
        .join(brands, "product_id")
        .groupBy(brand.alias("brand"))
        .agg(_total(), F.count_distinct("product_id").alias("product_count"))
    )


def brand_revenue(finance: DataFrame, brands: DataFrame) -> DataFrame:
    """brand, total_revenue, product_count, revenue_share_pct; largest first."""
    out = with_share(_brand_totals(finance, brands), "total_revenue", "revenue_share_pct")
    return out.orderBy(F.desc("total_revenue"), "brand")


def brand_share(finance: DataFrame, brands: DataFrame, name: str = "revenue_share_percentage") -> DataFrame:
    """brand, total_revenue and its share of all revenue."""
    totals = per_product(finance).join(brands, "product_id").groupBy("brand").agg(_total())
    return with_share(totals, "total_revenue", name).orderBy(F.desc("total_revenue"), "brand")


def brand_share_with_unknown(finance: DataFrame, brands: DataFrame) -> DataFrame:
    """Missing brands reported as 'Unknown'; grouped by the label, not by the input column."""
    label = F.coalesce("brand", F.lit("Unknown"))
    totals = per_product(finance).join(brands, "product_id").groupBy(label.alias("brand")).agg(_total())
    return with_share(totals, "total_revenue", "share_percent", 6).orderBy("brand")


def top_brand(finance: DataFrame, brands: DataFrame) -> DataFrame:
    """The brand with the largest revenue and its share: one row, no sort."""
    totals = per_product(finance).join(brands, "product_id").groupBy("brand").agg(_total())
    shares = with_share(totals, "total_revenue", "revenue_share_percentage")
    best = F.max_by(
        F.struct("brand", "total_revenue", "revenue_share_percentage"),
        F.struct(F.col("total_revenue"), F.col("brand")),
    )
    return shares.agg(best.alias("b")).select("b.*")


def product_totals(finance: DataFrame, info: DataFrame) -> DataFrame:
    """product_name, total_revenue."""
    return per_product(finance).join(info, "product_id").groupBy("product_name").agg(_total())


def product_revenue(
    finance: DataFrame,
    info: DataFrame,
    brands: DataFrame,
    by_name_only: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Revenue and rank per (name, brand), or per name with its first brand in text order."""
    joined = per_product(finance).join(info, "product_id").join(brands, "product_id")
    if by_name_only:
        grouped = joined.groupBy("product_name").agg(F.min("brand").alias("brand"), _total())
    else:
        grouped = joined.groupBy("product_name", "brand").agg(_total())
    ranked = rank_rows(grouped, "total_revenue", "revenue_rank", rows_per_range=rows_per_range)
    return ranked.orderBy("revenue_rank", "product_name", "brand")


def product_rank(finance: DataFrame, info: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Every product name ranked by revenue."""
    ranked = rank_rows(product_totals(finance, info), "total_revenue", "revenue_rank", rows_per_range=rows_per_range)
    return ranked.orderBy("revenue_rank", "product_name")


def ranked_up_to(finance: DataFrame, info: DataFrame, k: int = 15) -> DataFrame:
    """Names ranked k or better. Every such name has at least the k-th largest revenue, so
    only those few rows (k and its ties) are ranked."""
    totals = product_totals(finance, info)
    best = totals.select("total_revenue").orderBy(F.desc("total_revenue")).limit(k)
    cut = best.agg(F.min("total_revenue")).scalar()
    ranked = rank_rows(totals.where(F.col("total_revenue") >= cut), "total_revenue", "revenue_rank")
    return ranked.where(F.col("revenue_rank") <= k).orderBy("revenue_rank", "product_name")


# --- traffic -------------------------------------------------------------------------


def _visits_by_month(traffic: DataFrame, count: Column) -> DataFrame:
    months = traffic.groupBy(month_key(traffic, "last_visited").alias("month")).agg(count.alias("visit_count"))
    return months.withColumn("month", month_label(months, "month")).orderBy("month")


def monthly_traffic(traffic: DataFrame) -> DataFrame:
    return _visits_by_month(traffic, _rows())


def monthly_traffic_nonnull(traffic: DataFrame) -> DataFrame:
    """Counts rows with a product among rows with a date."""
    return _visits_by_month(traffic.where(F.col("last_visited").isNotNull()), F.count("product_id"))


def traffic_change(monthly: DataFrame) -> DataFrame:
    """Month-over-month change. One row per calendar month, so a single ordered window is bounded."""
    previous = F.lag("visit_count").over(Window.orderBy("month"))
    return monthly.select("month", "visit_count", (F.col("visit_count") - previous).alias("mom_change"))


def monthly_product_revenue(traffic: DataFrame, finance: DataFrame) -> DataFrame:
    """(month key, product_id, units, rest) of the many-to-many join traffic x finance.

    Both sides are reduced first; the pairs of the fan-out are a multiplication, not rows.
    """
    visits = (
        traffic.where(F.col("last_visited").isNotNull())
        .groupBy("product_id", month_key(traffic, "last_visited").alias("month"))
        .agg(_rows().alias("visits"))
    )
    revenue = per_product(finance).select(
        "product_id", (parts_decimal(F.col("rev_hi"), F.col("rev_lo"))).alias("units"), F.col("rev_rest").alias("rest")
    )
    return visits.join(revenue, "product_id").select(
        "month",
        "product_id",
        (F.col("units") * F.col("visits")).cast("decimal(38,0)").alias("units"),
        (F.col("rest") * F.col("visits")).alias("rest"),
    )


def traffic_finance_join(traffic: DataFrame, finance: DataFrame) -> DataFrame:
    """Revenue per month and product over the fan-out."""
    units = monthly_product_revenue(traffic, finance)
    return units.select(
        month_label(units, "month").alias("month"), "product_id", (F.col("units").cast("double") / F.lit(10000.0) + F.col("rest")).alias("total_revenue")
    )


def monthly_revenue(traffic: DataFrame, finance: DataFrame) -> DataFrame:
    """Revenue by visit month."""
    units = monthly_product_revenue(traffic, finance)
    totals = units.groupBy("month").agg((F.sum("units").cast("double") / F.lit(10000.0) + F.sum("rest")).alias("total_revenue"))
    return totals.withColumn("month", month_label(totals, "month")).orderBy("month")


def most_visited(traffic: DataFrame, info: DataFrame, k: int = 10) -> DataFrame:
    """Names with the most visits, and in how many months of the year they were seen.

    Per product at most 12 months; a bit per month is kept and combined instead of a
    distinct count over all visits.
    """
    seen = (
        traffic.withColumn("_m", month_number(traffic, "last_visited"))
        .groupBy("product_id")
        .agg(_rows().alias("n"), F.expr("bit_or(shiftleft(1, _m))").alias("months"))
    )
    return (
        seen.join(info, "product_id")
        .groupBy("product_name")
        .agg(
            F.coalesce(F.bit_count(F.bit_or("months")), F.lit(0)).cast("bigint").alias("year_month"),
            F.sum("n").alias("visit_count"),
        )
        .orderBy(F.desc("visit_count"), "product_name")
        .limit(k)
    )


# --- discounts ------------------------------------------------------------------------

# Category names of the discount reports.
DISCOUNT_LABELS = ("Discounted", "No Discount")


def discount_category(discount: Column | str = "discount") -> Column:
    d = F.col(discount) if isinstance(discount, str) else discount
    return case_when((d > 0, DISCOUNT_LABELS[0]), otherwise=DISCOUNT_LABELS[1])


def discount_impact(finance: DataFrame) -> DataFrame:
    """category, total_revenue, avg_revenue, product_count (rows, as the name is historical)."""
    return finance.groupBy(discount_category().alias("category")).agg(
        exact_sum("revenue").alias("total_revenue"),
        exact_avg("revenue").alias("avg_revenue"),
        _rows().alias("product_count"),
    )


def discount_share(finance: DataFrame) -> DataFrame:
    """Revenue share per discount category, one decimal."""
    totals = finance.groupBy(discount_category().alias("category")).agg(exact_sum("revenue").alias("total_revenue"))
    return with_share(totals, "total_revenue", "revenue_share_pct", 1)


def discount_range(finance: DataFrame, strict: bool = False) -> DataFrame:
    """Revenue per discount band.

    The default bands keep their historical holes: values between 0.20 and 0.21 and missing
    discounts count as 'No Discount', zero as 'Low Discount'. ``strict`` closes the bands.
    """
    d = F.col("discount")
    if strict:
        band = case_when(
            (d.isNull(), "Unknown"),
            (d <= 0, "No Discount"),
            (d <= 0.20, "Low Discount"),
            (d <= 0.50, "Medium Discount"),
            otherwise="High Discount",
        )
    else:
        band = case_when(
            (d.between(0, 0.20), "Low Discount"),
            (d.between(0.21, 0.50), "Medium Discount"),
            (d > 0.50, "High Discount"),
            otherwise="No Discount",
        )
    return (
        finance.groupBy(band.alias("discount_range"))
        .agg(exact_sum("revenue").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "discount_range")
    )


def discount_range_by_thresholds(
    finance: DataFrame, low: float = 10, high: float = 30, strict: bool = False
) -> DataFrame:
    """Three bands by two thresholds; without ``strict`` a missing discount lands in 'High Discount'."""
    d = F.col("discount")
    branches = [(d < low, "Low Discount"), (d.between(low, high), "Medium Discount")]
    if strict:
        branches.insert(0, (d.isNull(), "Unknown"))
    return (
        finance.groupBy(case_when(*branches, otherwise="High Discount").alias("discount_range"))
        .agg(exact_sum("revenue").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "discount_range")
    )


def discount_summary(finance: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Average, exact median and row count per group; rows with a discount are 'Discounted',
    rows at exactly zero 'Full Price'."""
    d = F.col("discount")
    rows = finance.select(
        F.when(d > 0, F.lit("Discounted")).when(d == 0, F.lit("Full Price")).alias("category"), "revenue"
    ).where(F.col("category").isNotNull())
    averages = rows.groupBy("category").agg(
        exact_avg("revenue").alias("avg_revenue"), F.count("revenue").alias("product_count")
    )
    medians = exact_quantiles(rows, "revenue", {"median": 0.5}, ["category"], rows_per_range)
    return averages.join(medians, "category").select(
        "category", "avg_revenue", F.round("median", 6).alias("median_revenue"), "product_count"
    )


# --- reviews and ratings -----------------------------------------------------------------


def _band(thresholds: tuple[float, float], strict: bool) -> Column:
    low, high = thresholds
    r = F.col("review_count")
    branches = [(r < low, "Low Reviews"), (r.between(low, high), "Medium Reviews")]
    if strict:
        branches.insert(0, (r.isNull(), "Unknown"))
    return case_when(*branches, otherwise="High Reviews")


def _with_reviews(finance: DataFrame, reviews: DataFrame, pre_aggregate: bool) -> DataFrame:
    """Per-product parts next to each review row. A product with several review rows counts its
    revenue once per row (historical); ``pre_aggregate`` reduces reviews to one row per product."""
    if pre_aggregate:
        reviews = reviews.groupBy("product_id").agg(
            exact_avg("rating").alias("rating"), exact_sum("review_count").alias("review_count")
        )
    return per_product(finance).join(reviews, "product_id")


def review_volume(
    finance: DataFrame,
    reviews: DataFrame,
    thresholds: tuple[float, float] = (100, 500),
    strict: bool = False,
    pre_aggregate: bool = False,
) -> DataFrame:
    """Revenue per review-count band."""
    return (
        _with_reviews(finance, reviews, pre_aggregate)
        .groupBy(_band(thresholds, strict).alias("review_volume"))
        .agg(_total())
        .orderBy(F.desc("total_revenue"), "review_volume")
    )


def review_volume_average(
    finance: DataFrame,
    reviews: DataFrame,
    thresholds: tuple[float, float] = (50, 200),
    strict: bool = False,
    pre_aggregate: bool = False,
) -> DataFrame:
    """Average revenue per review-count band."""
    return (
        _with_reviews(finance, reviews, pre_aggregate)
        .groupBy(_band(thresholds, strict).alias("review_group"))
        .agg(_mean("avg_revenue"))
    )


def revenue_by_rating(finance: DataFrame, reviews: DataFrame, keep_missing: bool = True) -> DataFrame:
    """Revenue per cleaned rating, best first."""
    if not keep_missing:
        reviews = reviews.where(F.col("rating").isNotNull())
    joined = per_product(finance).join(reviews, "product_id")
    return joined.groupBy("rating").agg(_total()).orderBy(F.desc_nulls_last("rating"))


def rating_group_average(finance: DataFrame, reviews: DataFrame) -> DataFrame:
    """Average revenue per rating rounded to one decimal."""
    joined = per_product(finance).join(reviews, "product_id")
    return (
        joined.groupBy(F.round("rating", 1).alias("rating_group"))
        .agg(_mean("avg_revenue"))
        .orderBy(F.desc_nulls_last("rating_group"))
    )


# --- prices and top lists -----------------------------------------------------------------


def price_vs_revenue(finance: DataFrame, info: DataFrame, prices: DataFrame) -> DataFrame:
    """Average list price over sales lines, and revenue, per name, dearest first.

    A product has one list price, so lines are reduced to one row per product before the price joins, weighted
    by their number.
    """
    lines = per_product(finance, F.count(F.lit(1)).alias("lines")).join(prices, "product_id")
    weighted = lines.withColumn("_price", F.col("listing_price") * F.col("lines"))
    parts = weighted.groupBy("product_id").agg(
        *merge_parts("rev"), F.sum("n").alias("n"), *sum_parts("_price", "price"),
        F.sum(F.when(F.col("listing_price").isNotNull(), F.col("lines"))).alias("n_price"),
    )
    mean_price = F.try_divide(sum_of_parts("price"), F.sum("n_price").cast("double"))
    return (
        parts.join(info, "product_id")
        .groupBy("product_name")
        .agg(mean_price.alias("avg_listing_price"), _total())
        .orderBy(F.desc("avg_listing_price"), "product_name")
    )


def top_products(finance: DataFrame, info: DataFrame, k: int = 10) -> DataFrame:
    return product_totals(finance, info).orderBy(F.desc("total_revenue"), "product_name").limit(k)


def top_average_revenue(finance: DataFrame, info: DataFrame, k: int = 10, label_length: int = 25) -> DataFrame:
    """Names by average revenue, with a shortened label for display."""
    means = per_product(finance).join(info, "product_id").groupBy("product_name").agg(_mean("avg_revenue"))
    top = means.orderBy(F.desc("avg_revenue"), "product_name").limit(k)
    return top.withColumn("label", F.substring("product_name", 1, label_length))


def top_catalogue_count(info: DataFrame, k: int = 10) -> DataFrame:
    """Names listed under the most product ids."""
    counts = info.groupBy("product_name").agg(F.count("product_id").alias("count_of_products"))
    return counts.orderBy(F.desc("count_of_products"), "product_name").limit(k)


def top_reviewed(info: DataFrame, reviews: DataFrame, k: int = 10) -> DataFrame:
    counts = info.join(reviews, "product_id").groupBy("product_name").agg(exact_sum("review_count").alias("count_reviews"))
    return counts.orderBy(F.desc("count_reviews"), "product_name").limit(k)


def top_rated(info: DataFrame, reviews: DataFrame, k: int = 10) -> DataFrame:
    means = info.join(reviews, "product_id").groupBy("product_name").agg(exact_avg("rating").alias("avg_rating"))
    return means.orderBy(F.desc_nulls_last("avg_rating"), "product_name").limit(k)


def keep_best(df: DataFrame, key: str, score: str, tie: str, k: int | None = None) -> DataFrame:
    """One row per key: the highest score, then the smallest tie column; then the first k of them.

    An aggregate rather than a window, so rows of one key combine before the shuffle.
    """
    row = F.struct(*df.columns)
    # min_by over (-score, tie) picks the best score first and the smallest id among equals.
    best = df.groupBy(key).agg(F.min_by(row, F.struct((-F.col(score)).alias("s"), F.col(tie).alias("t"))).alias("r"))
    out = best.select("r.*")
    return out if k is None else out.orderBy(F.desc(score), tie).limit(k)


# --- distributions -----------------------------------------------------------------------


def histogram(df: DataFrame, value: str, bins: int = 20, groups: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram over each group's own range; the last bin is closed."""
    groups = list(groups)
    df = df.where(F.col(value).isNotNull())
    lo, hi = F.min(value).alias("_lo"), F.max(value).alias("_hi")
    if groups:
        # Written first, so the optimizer knows its real size and broadcasts only when small.
        rows = join_groups(df, durable(df.groupBy(*groups).agg(lo, hi), "limits"), groups)
    else:
        limits = df.agg(F.struct(lo, hi)).scalar()
        rows = df.withColumn("_l", limits).select("*", "_l.*")
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    place = F.floor(F.try_divide(F.col(value) - F.col("_lo"), width))
    bin_no = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("bigint")
    return (
        rows.groupBy(*groups, bin_no.alias("bin"))
        .agg(F.first("_lo").alias("_lo"), F.first(width).alias("_w"), _rows().alias("row_count"))
        .select(
            *groups,
            "bin",
            F.round(F.col("_lo") + F.col("bin") * F.col("_w"), 6).alias("bin_start"),
            "row_count",
        )
    )


# --- events ------------------------------------------------------------------------------


def event_product_totals(events: DataFrame) -> DataFrame:
    """One row per product from its events: summed revenue, mean and highest price, mean discount."""
    return events.groupBy("product_id").agg(
        round_even(exact_sum("revenue"), 2).alias("revenue"),
        round_even(exact_avg("price"), 2).alias("sale_price"),
        round_even(F.max("price"), 2).alias("listing_price"),
        round_even(clip(exact_avg("discount"), 0.0, 1.0), 4).alias("discount"),
    )


def event_revenue_enriched(totals: DataFrame, info: DataFrame, brands: DataFrame) -> DataFrame:
    """Event totals with name and brand where the catalogue has them."""
    return (
        totals.join(info.select("product_id", "product_name"), "product_id", "left")
        .join(brands, "product_id", "left")
        .select(
            "product_id",
            "product_name",
            "brand",
            F.col("revenue").alias("event_revenue"),
            F.col("sale_price").alias("avg_price"),
            F.col("discount").alias("avg_discount"),
        )
    )


EVENT_REVENUE_SCHEMA = (
    "product_id {key}, product_name string, brand string, event_revenue double, "
    "avg_price double, avg_discount double, revenue_rank bigint"
)


def event_revenue(totals: DataFrame | None, info: DataFrame, brands: DataFrame) -> DataFrame:
    """Ranked event revenue; empty when no events were ever ingested."""
    if totals is None:
        key = info.schema["product_id"].dataType.simpleString()
        return info.sparkSession.createDataFrame([], EVENT_REVENUE_SCHEMA.format(key=key))
    ranked = rank_rows(event_revenue_enriched(totals, info, brands), "event_revenue", "revenue_rank")
    return ranked.orderBy("revenue_rank", "product_id")


def event_daily_revenue(events: DataFrame) -> DataFrame:
    return (
        events.groupBy(F.to_date("event_timestamp").alias("event_date"))
        .agg(exact_sum("revenue").alias("revenue"), _rows().alias("event_count"))
        .orderBy("event_date")
    )


# --- filters -----------------------------------------------------------------------------


def product_revenue_between(events: DataFrame, product_id, first_day, last_day) -> DataFrame:
    """Revenue of one product over whole days, both ends included. When the table carries the
    partition column ``event_date`` the same range is put on it, so other days are not read."""
    day = F.col("event_date") if "event_date" in events.columns else F.to_date("event_timestamp")
    rows = events.where(day.between(first_day, last_day) & (F.col("product_id") == F.lit(product_id)))
    return rows.agg(exact_sum("revenue").alias("revenue"), _rows().alias("event_count"))


def anchored_window(events: DataFrame, days: int = 3) -> DataFrame:
    """(window_start, window_end): the last ``days`` days present in the data, not of the calendar."""
    last = F.max(F.to_date("event_timestamp"))
    return events.agg(last.alias("window_end")).select(
        F.date_sub("window_end", days - 1).alias("window_start"), "window_end"
    )


def in_anchored_window(events: DataFrame, days: int = 3) -> DataFrame:
    """Rows inside the anchored window."""
    last = events.agg(F.max(F.to_date("event_timestamp"))).scalar()
    day = F.to_date("event_timestamp")
    return events.where((day >= F.date_sub(last, days - 1)) & (day <= last))


def distinct_ids(df: DataFrame) -> DataFrame:
    """Distinct product ids that are neither missing nor blank."""
    keep = F.col("product_id").isNotNull() & (F.trim(F.col("product_id").cast("string")) != "")
    return df.where(keep).select("product_id").distinct()


def distinct_names(info: DataFrame) -> DataFrame:
    return info.where(F.col("product_name").isNotNull()).select("product_name").distinct().orderBy("product_name")
