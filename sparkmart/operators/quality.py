"""Data-quality checks as rows, and the gate that turns failing rows into an error.

Every check returns (table, check, column, failing_rows, total_rows, severity, passed). Counts of
one table come from a single pass over it; only duplicate checks need a shuffle, on the key.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger("sparkmart.quality")

ERROR, WARN = "error", "warn"


class ValidationError(Exception):
    pass


def _count(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _row(table: str, check: str, column: Column, failing: Column, total: Column, severity: Column, passed: Column):
    return F.struct(
        F.lit(table).alias("table"),
        F.lit(check).alias("check"),
        column.alias("column"),
        failing.cast("bigint").alias("failing_rows"),
        total.cast("bigint").alias("total_rows"),
        severity.alias("severity"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def condition_checks(
    df: DataFrame, name: str, checks: Sequence[tuple[str, str, Column, str]], min_rows: int | None = None
) -> DataFrame:
    """Count the rows breaking each (check, column, broken, severity) in one pass; optionally also
    require a number of rows."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *(_count(broken).alias(f"c{i}") for i, (_, _, broken, _) in enumerate(checks)),
    )
    total = F.col("total")
    rows = [
        _row(name, check, F.lit(column), F.col(f"c{i}"), total, F.lit(severity), F.col(f"c{i}") == 0)
        for i, (check, column, _, severity) in enumerate(checks)
    ]
    if min_rows is not None:
        short = F.greatest(F.lit(min_rows) - total, F.lit(0))
        rows.insert(0, _row(name, "row_count", F.lit("*"), short, total, F.lit(ERROR), total >= min_rows))
    return counts.select(F.inline(F.array(*rows)))


def row_count(df: DataFrame, name: str, min_rows: int = 1) -> DataFrame:
    """``failing_rows`` is how many rows are missing to reach the minimum."""
    return condition_checks(df, name, [], min_rows)


def missing_values(df: DataFrame, name: str, critical: Sequence[str] = ()) -> DataFrame:
    """Missing values per column: an error in critical columns, otherwise a warning."""
    return condition_checks(
        df, name, [("missing", c, F.col(c).isNull(), ERROR if c in critical else WARN) for c in df.columns]
    )


def duplicates(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key; missing keys equal each other. A warning."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    sums = per_key.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")
    )
    row = _row(
        name, "duplicates", F.lit(",".join(keys)), F.col("extra"), F.col("total"), F.lit(WARN), F.col("extra") == 0
    )
    return sums.select(F.inline(F.array(row)))


def require_unique(df: DataFrame, name: str, keys: Sequence[str]) -> None:
    """Stop unless every key occurs once: what a unique index would refuse. Use it as a write gate."""
    enforce(duplicates(df, name, keys).withColumn("severity", F.lit(ERROR)))


def check_table(
    df: DataFrame, name: str, critical: Sequence[str] = (), keys: Sequence[str] = (), min_rows: int = 1
) -> DataFrame:
    """Row count, missing values and duplicates of one table."""
    checks = [("missing", c, F.col(c).isNull(), ERROR if c in critical else WARN) for c in df.columns]
    out = condition_checks(df, name, checks, min_rows)
    return out.unionByName(duplicates(df, name, keys)) if keys else out


def enforce(results: DataFrame) -> list[dict]:
    """Run the checks (a handful of rows), log warnings, raise on errors."""
    rows = [r.asDict() for r in results.collect()]
    for r in rows:
        if not r["passed"] and r["severity"] == WARN:
            log.warning("%s: %s on %s, %d of %d rows", r["table"], r["check"], r["column"], r["failing_rows"], r["total_rows"])
    failed = [r for r in rows if not r["passed"] and r["severity"] == ERROR]
    if failed:
        raise ValidationError(
            "; ".join(
                f"{r['table']}: {r['check']} on {r['column']} ({r['failing_rows']} of {r['total_rows']} rows)"
                for r in failed
            )
        )
    return rows


# --- declarative column tests --------------------------------------------------------


def not_null(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    return condition_checks(df, name, [("not_null", c, F.col(c).isNull(), ERROR) for c in columns])


def unique(df: DataFrame, name: str, column: str) -> DataFrame:
    """Values that occur more than once (missing values are not compared)."""
    per_value = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    sums = per_value.agg(F.count_if(F.col("n") > 1).alias("bad"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    row = _row(name, "unique", F.lit(column), F.col("bad"), F.col("total"), F.lit(ERROR), F.col("bad") == 0)
    return sums.select(F.inline(F.array(row)))


def accepted_values(df: DataFrame, name: str, column: str, values: Sequence[str]) -> DataFrame:
    broken = F.col(column).isNotNull() & ~F.col(column).isin(*values)
    return condition_checks(df, name, [("accepted_values", column, broken, ERROR)])


@dataclass(frozen=True)
class Constraint:
    """A declared test of one column; ``values`` are for accepted_values."""

    table: str
    column: str
    test: str
    severity: str = ERROR
    values: tuple[str, ...] = ()


def declare(table: str, required: Sequence[str], key: str | None = None, key_severity: str = ERROR) -> list[Constraint]:
    """Columns that must hold a value, and one whose values must differ."""
    found = [Constraint(table, c, "not_null") for c in required]
    return found + ([Constraint(table, key, "unique", key_severity)] if key else [])


# The tests declared for the clean layer and the marts. A product has several lines in these
# tables and a name several brands, so their uniqueness is reported and stops nothing.
CLEAN_CONSTRAINTS = (
    *declare("clean_finance", ["product_id", "revenue", "discount"], "product_id", WARN),
    *declare("clean_brands", ["product_id", "brand"], "product_id", WARN),
    *declare("clean_info", ["product_id", "product_name"], "product_id", WARN),
    *declare("clean_reviews", ["product_id", "review_count"], "product_id", WARN),
    Constraint("clean_reviews", "rating", "not_null", WARN),
    *declare("clean_traffic", ["product_id", "last_visited"]),
)
MART_CONSTRAINTS = (
    *declare("brand_revenue", ["brand", "total_revenue", "revenue_share_pct"], "brand"),
    *declare("product_revenue", ["product_name", "total_revenue", "revenue_rank"], "product_name", WARN),
    *declare("monthly_traffic", ["month", "visit_count"], "month"),
    *declare("discount_impact", ["category", "total_revenue"], "category"),
    Constraint("discount_impact", "category", "accepted_values", ERROR, ("Discounted", "No Discount")),
)


def accepted_brands(table: str, brands: Sequence[str], severity: str = WARN) -> Constraint:
    return Constraint(table, "brand", "accepted_values", severity, tuple(brands))


def _broken(c: Constraint) -> Column:
    if c.test == "not_null":
        return F.col(c.column).isNull()
    if c.test == "accepted_values":
        return F.col(c.column).isNotNull() & ~F.col(c.column).isin(*c.values)
    raise ValueError(f"{c.table}.{c.column}: unknown test {c.test}")


def _one_pass(df: DataFrame, name: str, by_row: Sequence[Constraint], key: Constraint | None) -> DataFrame:
    """All row tests, and the uniqueness of one column, from one scan; the shuffle carries one row per key and task."""
    broken = [_count(_broken(c)).alias(f"c{i}") for i, c in enumerate(by_row)]
    if key:
        groups = df.withColumn("_key", F.col(key.column)).groupBy("_key").agg(F.count(F.lit(1)).alias("n"), *broken)
        known = F.when(F.col("_key").isNotNull(), F.col("n"))
        sums = {"total": F.sum("n"), "keyed": F.sum(known), "repeated": F.count_if(known > 1)}
        sums |= {f"c{i}": F.sum(f"c{i}") for i in range(len(by_row))}
        counts = groups.agg(*(F.coalesce(v, F.lit(0)).alias(k) for k, v in sums.items()))
    else:
        counts = df.agg(F.count(F.lit(1)).alias("total"), *broken)
    rows = [
        _row(name, c.test, F.lit(c.column), F.col(f"c{i}"), F.col("total"), F.lit(c.severity), F.col(f"c{i}") == 0)
        for i, c in enumerate(by_row)
    ]
    if key:
        bad = F.col("repeated")
        rows.append(_row(name, key.test, F.lit(key.column), bad, F.col("keyed"), F.lit(key.severity), bad == 0))
    return counts.select(F.inline(F.array(*rows)))


def constraint_suite(tables: Mapping[str, DataFrame], constraints: Sequence[Constraint]) -> DataFrame:
    """Every declared test of every given table as rows.

    A table is scanned once: row tests are counted along with the grouping by its unique column. Only a second unique
    column would scan it again. Tests of tables that are not given are an error.
    """
    missing = {c.table for c in constraints} - set(tables)
    if missing:
        raise ValueError(f"no table for the tests of {', '.join(sorted(missing))}")
    frames = []
    for name, df in tables.items():
        mine = [c for c in constraints if c.table == name]
        by_row = [c for c in mine if c.test != "unique"]
        keys = [c for c in mine if c.test == "unique"]
        if mine:
            frames.append(_one_pass(df, name, by_row, keys[0] if keys else None))
        frames += [_one_pass(df, name, [], k) for k in keys[1:]]
    return _union(frames)


# --- gates ------------------------------------------------------------------------------


def null_rate_gate(
    df: DataFrame, name: str, column: str, min_rows: int, max_null_rate: float = 0.05, severity: str = ERROR
) -> DataFrame:
    """A minimum of rows, and at most a given rate of missing values in one column."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(column).isNull()).alias("nulls"))
    total, nulls = F.col("total"), F.col("nulls")
    rate = F.coalesce(F.try_divide(nulls.cast("double"), total.cast("double")), F.lit(0.0))
    rows = [_row(name, "null_rate", F.lit(column), nulls, total, F.lit(severity), rate <= max_null_rate)]
    if min_rows:
        short = F.greatest(F.lit(min_rows) - total, F.lit(0))
        rows.insert(0, _row(name, "row_count", F.lit("*"), short, total, F.lit(ERROR), total >= min_rows))
    return counts.select(F.inline(F.array(*rows)))


def raw_gate(raw: Mapping[str, DataFrame], events: DataFrame | None = None, min_rows: int = 100) -> DataFrame:
    """All raw tables: enough rows, few missing ids; more than 1 % missing revenue is a warning.
    The event log, when there is one, is reported with its row count."""
    frames = [null_rate_gate(df, f"raw_{t}", "product_id", min_rows) for t, df in raw.items()]
    if "finance" in raw:
        frames.append(null_rate_gate(raw["finance"], "raw_finance", "revenue", 0, 0.01, WARN))
    if events is not None:
        frames.append(row_count(events, "sales_events", 0))
    return _union(frames)


MART_MINIMUM = {"brand_revenue": ("brand", 1), "product_revenue": ("product_name", 10), "monthly_traffic": ("month", 5)}


def mart_gate(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Marts hold data before features are built from them."""
    return _union([null_rate_gate(marts[m], m, c, n) for m, (c, n) in MART_MINIMUM.items()])


def feature_checks(features: DataFrame) -> DataFrame:
    """Invariants of the feature table."""
    missing = lambda c: F.col(c).isNull()
    return condition_checks(
        features,
        "features_products",
        [
            ("positive", "listing_price", F.col("listing_price") <= 0, ERROR),
            ("not_null", "listing_price", missing("listing_price"), ERROR),
            ("not_null", "review_count", missing("review_count"), ERROR),
            ("not_null", "rating", missing("rating"), ERROR),
        ],
        min_rows=1,
    )
