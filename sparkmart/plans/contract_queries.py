"""What writing promises: declared tests of both layers, published clean tables, appends, unique keys, marks."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators import quality as Q
from sparkmart.operators.clean import clean_all, register_views
from sparkmart.operators.marts import discount_impact
from sparkmart.plans.layer_queries import _MART_SQL, CATALOGUE, CLEAN_SQL, _check_sql, _marts, _null_count, clean_of, raw_of
from sparkmart.plans.registry import Registry, Tables
from sparkmart.session import durable, new_folder
from sparkmart.sources.sinks import append, overwrite, read_current
from sparkmart.sources.state import MarkStore

R = Registry(CLEAN_SQL)

BRANDS = ("Brand#1", "Brand#2")
_SUITE = (*Q.CLEAN_CONSTRAINTS, Q.accepted_brands("clean_brands", BRANDS), *Q.MART_CONSTRAINTS)


def _suite(t: Tables) -> DataFrame:
    layer = {f"clean_{x}": clean_of(t, x) for x in CATALOGUE}
    marts = {**_marts(t), "discount_impact": durable(discount_impact(t.finance_lines), "mart-discount_impact")}
    return Q.constraint_suite({**layer, **marts}, _SUITE)


#: The marts as far as their tests need them; their other columns are never missing.
_SUITE_SQL = {
    **{f"clean_{x}": f"{{clean_{x}}}" for x in CATALOGUE},
    "brand_revenue": f"(SELECT *, 0 AS total_revenue, 0 AS revenue_share_pct FROM {_MART_SQL['brand_revenue']})",
    "product_revenue": f"(SELECT *, 0 AS total_revenue, 0 AS revenue_rank FROM {_MART_SQL['product_revenue']})",
    "monthly_traffic": f"(SELECT *, 0 AS visit_count FROM {_MART_SQL['monthly_traffic']})",
    "discount_impact": """(SELECT DISTINCT CASE WHEN discount > 0 THEN 'Discounted' ELSE 'No Discount' END AS category,
                                  0 AS total_revenue FROM {finance_lines})""",
}


def _constraint_sql(c: Q.Constraint) -> str:
    source = _SUITE_SQL[c.table]
    if c.test == "not_null":
        return _check_sql(c.table, source, c.test, c.column, _null_count(c.column), c.severity)
    if c.test == "unique":
        grouped = f"(SELECT {c.column}, COUNT(*) AS n FROM {source} WHERE {c.column} IS NOT NULL GROUP BY {c.column})"
        return _check_sql(c.table, grouped, c.test, c.column, "COUNT(*) FILTER (WHERE n > 1)", c.severity, total="COALESCE(SUM(n), 0)")
    listed = ", ".join(f"'{v}'" for v in c.values)
    return _check_sql(c.table, source, c.test, c.column, f"COUNT(*) FILTER (WHERE {c.column} NOT IN ({listed}))", c.severity)


R.add("q_dq_suite", _suite, " UNION ALL ".join(_constraint_sql(c) for c in _SUITE))


def _clean_all(t: Tables) -> DataFrame:
    """Rows of every raw table against rows of its published clean copy."""
    folder = new_folder(t.spark, "clean-layer")
    counts = clean_all({x: raw_of(t, x) for x in CATALOGUE}, folder)
    rows = []
    for x, (before, _) in counts.items():
        published = read_current(t.spark, os.path.join(folder, f"clean_{x}"))
        after = F.count(F.lit(1)).alias("rows_after")
        rows.append(published.agg(after).select(F.lit(x).alias("table"), F.lit(before).cast("bigint").alias("rows_before"), "rows_after"))
    return reduce(DataFrame.unionByName, rows)


R.add(
    "q_clean_all",
    _clean_all,
    " UNION ALL ".join(
        f"""SELECT '{x}' AS "table", (SELECT COUNT(*) FROM {{raw_{x}}}) AS rows_before, COUNT(*) AS rows_after
            FROM {{clean_{x}}}"""
        for x in CATALOGUE
    ),
)


def _view_vs_table(t: Tables) -> DataFrame:
    """Rows by brand of the clean layer as a view and as a published table."""
    register_views({"brands": raw_of(t, "brands")})
    stored = overwrite(clean_of(t, "brands"), new_folder(t.spark, "clean_brands"))
    both = t.spark.table("clean_brands").select("brand", F.lit(1).alias("v"), F.lit(0).alias("s"))
    both = both.unionByName(stored.select("brand", F.lit(0).alias("v"), F.lit(1).alias("s")))
    return both.groupBy("brand").agg(F.sum("v").alias("rows_view"), F.sum("s").alias("rows_table"))


R.add(
    "q_view_vs_table",
    _view_vs_table,
    "SELECT brand, COUNT(*) AS rows_view, COUNT(*) AS rows_table FROM {clean_brands} GROUP BY brand",
)


def _append(t: Tables) -> DataFrame:
    """A table that grew by two appends: rows with and rows without a rating."""
    path = new_folder(t.spark, "appended")
    for part in (F.col("rating").isNotNull(), F.col("rating").isNull()):
        append(raw_of(t, "reviews").where(part), path)
    return t.spark.read.schema(raw_of(t, "reviews").schema).parquet(path)


R.add("q_append", _append, "SELECT * FROM {raw_reviews}")
R.add(
    "q_unique_key",
    lambda t: overwrite(
        clean_of(t, "info"), new_folder(t.spark, "unique"), lambda df: Q.require_unique(df, "clean_info", ["product_id"])
    ),
    "SELECT * FROM {clean_info}",
)


def _marks(t: Tables) -> DataFrame:
    """Marks of two runs over every table; the later one, with the rows kept, is current."""
    store = MarkStore(t.spark, new_folder(t.spark, "marks"))
    for x in ("brands", "reviews"):
        store.set(f"clean_{x}", raw_of(t, x).count(), detail="raw")
        store.set(f"clean_{x}", clean_of(t, x).count(), detail="clean")
    return store.current().select("step_name", "seq", "last_row_count", "detail")


R.add(
    "q_marks",
    _marks,
    " UNION ALL ".join(
        f"""SELECT 'clean_{x}' AS step_name, CAST(1 AS BIGINT) AS seq, COUNT(*) AS last_row_count, 'clean' AS detail
            FROM {{clean_{x}}}"""
        for x in ("brands", "reviews")
    ),
)
