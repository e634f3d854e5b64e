"""Cleaning rules, raw to clean. Pure column work: no shuffle in any of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sparkmart.functions.exprs import clip, is_blank, no_nan, number, title_case
from sparkmart.operators.quality import check_table, enforce
from sparkmart.sources.sinks import overwrite


@dataclass(frozen=True)
class Rules:
    """Why rows are dropped (in this order) and how the columns of the kept rows are made."""

    drop: Callable[[], dict[str, Column]]
    columns: Callable[[], dict[str, Column]]


def _finance() -> Rules:
    revenue = lambda: no_nan(F.col("revenue").cast("double"))
    return Rules(
        lambda: {
            "missing product_id": F.col("product_id").isNull(),
            "missing revenue": revenue().isNull(),
            "negative revenue": revenue() < 0,
        },
        lambda: {
            "product_id": F.col("product_id"),
            "listing_price": F.coalesce(number("listing_price"), F.lit(0.0)),
            "sale_price": F.coalesce(number("sale_price"), F.lit(0.0)),
            "discount": clip(F.coalesce(number("discount"), F.lit(0.0)), 0.0, 1.0),
            "revenue": revenue(),
        },
    )


def _brands() -> Rules:
    return Rules(
        lambda: {
            "missing product_id": F.col("product_id").isNull(),
            "missing brand": F.col("brand").isNull(),
        },
        lambda: {"product_id": F.col("product_id"), "brand": title_case("brand")},
    )


def _info() -> Rules:
    return Rules(
        lambda: {
            "missing product_id": F.col("product_id").isNull(),
            "missing product_name": F.col("product_name").isNull(),
        },
        lambda: {
            "product_id": F.col("product_id"),
            "product_name": F.trim("product_name"),
            "description": F.coalesce("description", F.lit("")),
        },
    )


def _reviews() -> Rules:
    return Rules(
        lambda: {
            "missing product_id": F.col("product_id").isNull(),
            "blank product_id": is_blank("product_id"),
        },
        lambda: {
            "product_id": F.col("product_id"),
            "rating": clip(number("rating", decimal_comma=True), 0.0, 5.0),
            "review_count": clip(F.coalesce(number("review_count"), F.lit(0.0)), 0.0),
        },
    )


def _traffic() -> Rules:
    return Rules(
        lambda: {
            "missing product_id": F.col("product_id").isNull(),
            "missing last_visited": F.col("last_visited").isNull(),
            "blank last_visited": is_blank("last_visited"),
        },
        lambda: {"product_id": F.col("product_id"), "last_visited": F.trim("last_visited")},
    )


RULES: dict[str, Rules] = {
    "finance": _finance(),
    "brands": _brands(),
    "info": _info(),
    "reviews": _reviews(),
    "traffic": _traffic(),
}


def _reason(table: str) -> Column:
    """The first rule a row breaks, NULL for a row to keep."""
    return F.coalesce(*(F.when(broken, F.lit(rule)) for rule, broken in RULES[table].drop().items()))


def clean(df: DataFrame, table: str) -> DataFrame:
    """The clean form of one raw table."""
    made = RULES[table].columns()
    return df.where(_reason(table).isNull()).select(*(c.alias(n) for n, c in made.items()))


def clean_rejects(df: DataFrame, table: str) -> DataFrame:
    """(table, rule, dropped_rows): rows dropped, each counted under the first rule it breaks. One pass."""
    rules = list(RULES[table].drop())
    counts = df.select(_reason(table).alias("reason")).agg(
        *(F.count_if(F.col("reason") == rule).alias(rule) for rule in rules)
    )
    rows = F.array(*(F.struct(F.lit(r).alias("rule"), F.col(f"`{r}`").alias("dropped_rows")) for r in rules))
    return counts.select(F.lit(table).alias("table"), F.inline(rows))


def clean_all(raw: Mapping[str, DataFrame], folder: str) -> dict[str, tuple[int, int]]:
    """Clean, write, check and publish every table; returns {table: (rows before, rows after)}.

    Both counts are observed by the job that writes; the checks read the written copy, and
    only a copy that passes becomes the current version.
    """
    counts = {}
    for table, df in raw.items():
        before, after = Observation(), Observation()
        counted = df.observe(before, F.count(F.lit(1)).alias("n"))
        cleaned = clean(counted, table).observe(after, F.count(F.lit(1)).alias("n"))

        def gate(written: DataFrame, table: str = table) -> None:
            enforce(check_table(written, f"clean_{table}", critical=["product_id"], keys=["product_id"]))

        overwrite(cleaned, f"{folder}/clean_{table}", gate)
        counts[table] = (before.get["n"], after.get["n"])
    return counts


def register_views(raw: Mapping[str, DataFrame]) -> None:
    """The clean layer as views over the raw tables, for SQL users; nothing is stored."""
    for table, df in raw.items():
        clean(df, table).createOrReplaceTempView(f"clean_{table}")
