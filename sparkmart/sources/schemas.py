"""Declared column types of every layer, and the check that a frame still has them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Tables the bindings read. Declared, so that no job opens files to infer them.
SOURCES = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Raw numbers are text: a source may hold "n/a" or a decimal comma.
RAW = {
    "finance": "product_id string, listing_price string, sale_price string, discount string, revenue double",
    "brands": "product_id string, brand string",
    "info": "product_id string, product_name string, description string",
    "reviews": "product_id string, rating string, review_count string",
    "traffic": "product_id string, last_visited string",
}
CLEAN = {
    "finance": "product_id string, listing_price double, sale_price double, discount double, revenue double",
    "brands": "product_id string, brand string",
    "info": "product_id string, product_name string, description string",
    "reviews": "product_id string, rating double, review_count double",
    "traffic": "product_id string, last_visited string",
}
EVENTS = (
    "event_id bigint, product_id bigint, price double, discount double, quantity bigint, "
    "revenue double, event_timestamp timestamp"
)
MARTS = {
    "brand_revenue": "brand string, total_revenue double, product_count bigint, revenue_share_pct double",
    "product_revenue": "product_name string, brand string, total_revenue double, revenue_rank bigint",
    "monthly_traffic": "month string, visit_count bigint",
    "discount_impact": "category string, total_revenue double, avg_revenue double, product_count bigint",
    "features_products": (
        "product_id string, product_name string, brand string, brand_encoded bigint, listing_price double, "
        "discount double, revenue double, rating double, review_count double"
    ),
    "product_clusters": "product_id string, cluster_label string, cluster_id bigint, log_revenue double",
}
WATERMARKS = "step_name string, last_successful_at timestamp, last_row_count bigint, fingerprint decimal(38,0), updated_at timestamp"

# Column names of catalogue exports that prefix edited columns, and the names used here.
SOURCE_NAMES = {
    "modified_listing_price": "listing_price",
    "modified_sale_price": "sale_price",
    "modified_discount": "discount",
    "modified_revenue": "revenue",
    "modified_brand": "brand",
    "modified_product_name": "product_name",
    "modified_description": "description",
    "real_rating": "rating",
    "real_reviews": "review_count",
    "modified_last_visited": "last_visited",
}


class SchemaDrift(ValueError):
    pass


def from_source(df: DataFrame, table: str) -> DataFrame:
    """A source table under our column names and raw types, without its unedited twin columns."""
    wanted = StructType.fromDDL(RAW[table])
    edited = {SOURCE_NAMES[c]: c for c in df.columns if c in SOURCE_NAMES}
    taken = {f.name: edited.get(f.name, f.name) for f in wanted}
    missing = [c for c in taken.values() if c not in df.columns]
    if missing:
        raise SchemaDrift(f"{table}: missing columns {missing}")
    return df.select(*(F.col(taken[f.name]).cast(f.dataType).alias(f.name) for f in wanted))


def conform(df: DataFrame, ddl: str, name: str = "table") -> DataFrame:
    """Exactly the declared columns in their order; anything else is an error, never a silent cast."""
    wanted = StructType.fromDDL(ddl)
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f.dataType.simpleString() for f in wanted}
    if have != want:
        raise SchemaDrift(f"{name}: have {have}, declared {want}")
    return df.select(*want)
