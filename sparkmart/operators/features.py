"""Product features: one row per product, imputed, filtered, log-scaled and encoded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sparkmart.functions.exprs import exact_avg, exact_sum
from sparkmart.operators.ordering import ROWS_PER_RANGE, exact_quantiles, rank_rows
from sparkmart.operators.quality import check_table, enforce, feature_checks
from sparkmart.session import durable
from sparkmart.sources.sinks import export_csv, overwrite

# The columns similarity is computed on.
FEATURE_COLS = ["brand_encoded", "listing_price", "discount", "revenue", "rating", "review_count"]
OUTPUT_COLS = [
    "product_id",
    "product_name",
    "brand",
    "brand_encoded",
    "listing_price",
    "discount",
    "revenue",
    "rating",
    "review_count",
]


def feature_base(finance: DataFrame, info: DataFrame, brands: DataFrame, reviews: DataFrame) -> DataFrame:
    """Facts reduced to one row per product first, then joined. A missing rating stays missing
    (it is imputed later), a missing review count is zero."""
    sales = finance.groupBy("product_id").agg(
        exact_avg("listing_price").alias("listing_price"),
        exact_avg("discount").alias("discount"),
        exact_sum("revenue").alias("revenue"),
    )
    opinions = reviews.groupBy("product_id").agg(
        exact_avg("rating").alias("rating"), exact_sum("review_count").alias("review_count")
    )
    return (
        sales.join(info.select("product_id", "product_name"), "product_id")
        .join(brands, "product_id")
        .join(opinions, "product_id", "left")
        .select(
            "product_id",
            "product_name",
            "brand",
            "listing_price",
            "discount",
            "revenue",
            "rating",
            F.coalesce("review_count", F.lit(0.0)).alias("review_count"),
        )
    )


def medians(df: DataFrame, columns: Sequence[str], rows_per_range: int = ROWS_PER_RANGE) -> dict[str, float]:
    """Exact median of each column's non-null values: one number per column reaches the driver."""
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns))
    long = df.select(F.inline(pairs))
    found = exact_quantiles(long, "value", {"median": 0.5}, ["column"], rows_per_range)
    return {r["column"]: r["median"] for r in found.collect()}


def zero_as_missing(df: DataFrame, column: str = "rating") -> DataFrame:
    return df.withColumn(column, F.nullif(F.col(column), F.lit(0.0)))


def impute_medians(
    df: DataFrame,
    columns: Sequence[str] = ("listing_price", "review_count", "rating"),
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Missing values become the median of the column; a missing discount becomes 0."""
    fill = {c: m for c, m in medians(df, columns, rows_per_range).items() if m is not None}
    return df.fillna({**fill, "discount": 0.0})


def drop_nonpositive_price(df: DataFrame, counter: Observation | None = None) -> DataFrame:
    """After imputation a price of zero or less is a corrupt row. ``counter`` receives how many
    rows there were, as ``dropped``, from the job that evaluates the result."""
    if counter is not None:
        df = df.observe(counter, F.count_if(F.col("listing_price") <= 0).alias("dropped"))
    return df.where(F.col("listing_price") > 0)


def log_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue", F.log1p("revenue"))


def label_codes(df: DataFrame, column: str, code: str) -> DataFrame:
    """Distinct values with codes 0..n-1 in text order."""
    labels = df.select(column).where(F.col(column).isNotNull()).distinct()
    return rank_rows(labels, column, code, descending=False).withColumn(code, F.col(code) - 1)


def label_encode(df: DataFrame, column: str = "brand", code: str = "brand_encoded") -> DataFrame:
    return df.join(label_codes(df, column, code), column)


def features_products(
    finance: DataFrame,
    info: DataFrame,
    brands: DataFrame,
    reviews: DataFrame,
    counter: Observation | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """All feature steps. The joined base is written once, as the medians read it before the rest does."""
    base = durable(feature_base(finance, info, brands, reviews), "feature-base")
    filled = impute_medians(zero_as_missing(base), rows_per_range=rows_per_range)
    kept = drop_nonpositive_price(filled, counter)
    return label_encode(log_revenue(kept)).select(*OUTPUT_COLS)


def build_features(
    finance: DataFrame, info: DataFrame, brands: DataFrame, reviews: DataFrame, path: str, csv_path: str | None = None
) -> DataFrame:
    """Write the checked feature table, and optionally its CSV export."""

    def gate(written: DataFrame) -> None:
        enforce(feature_checks(written))
        enforce(check_table(written, "features_products", critical=["product_id", "product_name"]))

    written = overwrite(features_products(finance, info, brands, reviews), path, gate)
    if csv_path:
        export_csv(written, csv_path)
    return written


def complete_rows(df: DataFrame, columns: Sequence[str] = tuple(FEATURE_COLS)) -> DataFrame:
    """Rows with every feature present."""
    return df.dropna(subset=list(columns))


def standard_scale(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """z-scores with the population deviation; a constant column becomes 0.

    The parameters are one row, read as a scalar subquery.
    """
    stats = df.agg(
        F.struct(*(F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns))
    ).scalar()
    scaled = df.withColumn("_stats", stats)
    for c in columns:
        mean, spread = F.col(f"_stats.{c}.m"), F.col(f"_stats.{c}.s")
        z = F.when(spread > 0, (F.col(c) - mean) / spread).when(F.col(c).isNotNull(), F.lit(0.0))
        scaled = scaled.withColumn(c + suffix, z)
    return scaled.drop("_stats")
