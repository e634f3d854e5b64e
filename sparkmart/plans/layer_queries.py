"""Cleaning, quality checks and feature engineering over the damaged raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators import features as FE
from sparkmart.operators import quality as Q
from sparkmart.operators.clean import clean, clean_rejects
from sparkmart.operators.marts import brand_revenue, discount_impact, monthly_traffic, product_revenue
from sparkmart.plans.registry import Registry, Tables
from sparkmart.session import durable
from sparkmart.sources.sinks import new_version_copy

NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _num(x: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({x}), '{NUMBER}') THEN TRY_CAST(trim({x}) AS DOUBLE) END"


def _mean(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,4))) AS DOUBLE) / COUNT({c})"


def _sum(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,4))) AS DOUBLE)"


CLEAN_SQL = {
    "clean_finance": f"""
        SELECT product_id, COALESCE({_num('listing_price')}, 0e0) AS listing_price,
               COALESCE({_num('sale_price')}, 0e0) AS sale_price,
               LEAST(GREATEST(COALESCE({_num('discount')}, 0e0), 0e0), 1e0) AS discount, revenue
        FROM {{raw_finance}} WHERE product_id IS NOT NULL AND revenue >= 0""",
    "clean_brands": """
        SELECT product_id, upper(substr(trim(brand), 1, 1)) || lower(substr(trim(brand), 2)) AS brand
        FROM {raw_brands} WHERE product_id IS NOT NULL AND brand IS NOT NULL""",
    "clean_info": """
        SELECT product_id, trim(product_name) AS product_name, COALESCE(description, '') AS description
        FROM {raw_info} WHERE product_id IS NOT NULL AND product_name IS NOT NULL""",
    "clean_reviews": f"""
        SELECT product_id,
               CASE WHEN rating IS NOT NULL THEN LEAST(GREATEST(rating, 0e0), 5e0) END AS rating,
               GREATEST(COALESCE(review_count, 0e0), 0e0) AS review_count
        FROM (SELECT product_id, {_num("replace(rating, ',', '.')")} AS rating,
                     {_num('review_count')} AS review_count FROM {{raw_reviews}})
        WHERE product_id IS NOT NULL AND trim(product_id) <> ''""",
    "clean_traffic": """
        SELECT product_id, trim(last_visited) AS last_visited FROM {raw_traffic}
        WHERE product_id IS NOT NULL AND trim(last_visited) <> ''""",
}
FEATURE_SQL = {
    "base": f"""
        SELECT s.product_id, i.product_name, b.brand, s.listing_price, s.discount, s.revenue, o.rating,
               COALESCE(o.review_count, 0e0) AS review_count
        FROM (SELECT product_id, {_mean('listing_price')} AS listing_price, {_mean('discount')} AS discount,
                     {_sum('revenue')} AS revenue FROM {{clean_finance}} GROUP BY product_id) s
        JOIN {{clean_info}} i USING (product_id) JOIN {{clean_brands}} b USING (product_id)
        LEFT JOIN (SELECT product_id, {_mean('rating')} AS rating, {_sum('review_count')} AS review_count
                   FROM {{clean_reviews}} GROUP BY product_id) o USING (product_id)""",
    "gaps": """
        SELECT product_id, product_name, brand,
               CASE WHEN CAST(product_id AS BIGINT) % 13 <> 0 THEN listing_price END AS listing_price,
               CASE WHEN CAST(product_id AS BIGINT) % 17 <> 0 THEN discount END AS discount, revenue, rating,
               CASE WHEN CAST(product_id AS BIGINT) % 19 <> 0 THEN review_count END AS review_count
        FROM {base}""",
    "unrated": """
        SELECT product_id, product_name, brand, listing_price, discount, revenue, nullif(rating, 0e0) AS rating,
               review_count FROM {base}""",
    "filled": """
        SELECT product_id, product_name, brand,
               COALESCE(listing_price, (SELECT MEDIAN(listing_price) FROM {unrated})) AS listing_price,
               COALESCE(discount, 0e0) AS discount, revenue,
               COALESCE(rating, (SELECT MEDIAN(rating) FROM {unrated})) AS rating,
               COALESCE(review_count, (SELECT MEDIAN(review_count) FROM {unrated})) AS review_count
        FROM {unrated}""",
    "kept": "SELECT * FROM {filled} WHERE listing_price > 0",
    "codes": """SELECT brand, CAST(DENSE_RANK() OVER (ORDER BY brand) - 1 AS BIGINT) AS brand_encoded
                FROM (SELECT DISTINCT brand FROM {kept})""",
    "features": """
        SELECT k.product_id, k.product_name, k.brand, c.brand_encoded, k.listing_price, k.discount,
               ln(1 + k.revenue) AS revenue, k.rating, k.review_count
        FROM {kept} k JOIN {codes} c USING (brand)""",
    "scaled": """
        SELECT f.*, """
    + ", ".join(
        f"CASE WHEN s.{c}_s > 0 THEN (f.{c} - s.{c}_m) / s.{c}_s ELSE 0e0 END AS {c}_z"
        for c in FE.FEATURE_COLS
    )
    + " FROM {features} f, (SELECT "
    + ", ".join(f"AVG({c}) AS {c}_m, STDDEV_POP({c}) AS {c}_s" for c in FE.FEATURE_COLS)
    + " FROM {features}) s",
}

R = Registry({**CLEAN_SQL, **FEATURE_SQL})

CATALOGUE = ("finance", "brands", "info", "reviews", "traffic")


def raw_of(t: Tables, table: str):
    return getattr(t, f"raw_{table}")


def clean_of(t: Tables, table: str):
    return clean(raw_of(t, table), table)


def base_of(t: Tables):
    return FE.feature_base(*(clean_of(t, x) for x in ("finance", "info", "brands", "reviews")))


def features_of(t: Tables):
    return FE.features_products(*(clean_of(t, x) for x in ("finance", "info", "brands", "reviews")))


# --- cleaning --------------------------------------------------------------------------

for _table in CATALOGUE:
    R.add(f"q_clean_{_table}", lambda t, x=_table: clean_of(t, x), f"SELECT * FROM {{clean_{_table}}}")


def _rejects(t: Tables):
    out = clean_rejects(raw_of(t, CATALOGUE[0]), CATALOGUE[0])
    for table in CATALOGUE[1:]:
        out = out.unionByName(clean_rejects(raw_of(t, table), table))
    return out


def _reject_sql(table: str, *rules: tuple[str, str]) -> str:
    earlier, parts = [], []
    for rule, broken in rules:
        condition = " AND ".join([f"NOT COALESCE({e}, FALSE)" for e in earlier] + [f"COALESCE({broken}, FALSE)"])
        parts.append(
            f"""SELECT '{table}' AS "table", '{rule}' AS rule, COUNT(*) FILTER (WHERE {condition}) AS dropped_rows
                FROM {{raw_{table}}}"""
        )
        earlier.append(broken)
    return " UNION ALL ".join(parts)


_NO_ID = ("missing product_id", "product_id IS NULL")
R.add(
    "q_clean_rejects",
    _rejects,
    " UNION ALL ".join(
        [
            _reject_sql("finance", _NO_ID, ("missing revenue", "revenue IS NULL"), ("negative revenue", "revenue < 0")),
            _reject_sql("brands", _NO_ID, ("missing brand", "brand IS NULL")),
            _reject_sql("info", _NO_ID, ("missing product_name", "product_name IS NULL")),
            _reject_sql("reviews", _NO_ID, ("blank product_id", "trim(product_id) = ''")),
            _reject_sql(
                "traffic",
                _NO_ID,
                ("missing last_visited", "last_visited IS NULL"),
                ("blank last_visited", "trim(last_visited) = ''"),
            ),
        ]
    ),
)
R.add("q_validated_raw", lambda t: new_version_copy(t.raw_brands, "brands"), "SELECT * FROM {raw_brands}")

# --- quality ---------------------------------------------------------------------------


def _check_sql(table: str, source: str, check: str, column: str, failing: str, severity: str = "error",
               total: str = "COUNT(*)", passed: str | None = None) -> str:
    passed = passed or f"{failing} = 0"
    return f"""SELECT '{table}' AS "table", '{check}' AS "check", '{column}' AS "column",
                      CAST({failing} AS BIGINT) AS failing_rows, CAST({total} AS BIGINT) AS total_rows,
                      '{severity}' AS severity, {passed} AS passed FROM {source}"""


def _null_count(c: str) -> str:
    return f"COUNT(*) FILTER (WHERE {c} IS NULL)"


R.add(
    "q_dq_row_count",
    lambda t: Q.row_count(t.raw_brands, "raw_brands", 1_000_000),
    _check_sql("raw_brands", "{raw_brands}", "row_count", "*", "GREATEST(1000000 - COUNT(*), 0)",
               passed="COUNT(*) >= 1000000"),
)
R.add(
    "q_dq_missing",
    lambda t: Q.missing_values(t.raw_finance, "raw_finance", ["product_id"]),
    " UNION ALL ".join(
        _check_sql("raw_finance", "{raw_finance}", "missing", c, _null_count(c),
                   "error" if c == "product_id" else "warn")
        for c in ("product_id", "listing_price", "sale_price", "discount", "revenue")
    ),
)
R.add(
    "q_dq_duplicates",
    lambda t: Q.duplicates(t.raw_reviews, "raw_reviews", ["product_id"]),
    _check_sql("raw_reviews", "(SELECT product_id, COUNT(*) AS n FROM {raw_reviews} GROUP BY product_id)",
               "duplicates", "product_id", "SUM(n - 1)", "warn", total="SUM(n)"),
)


def _rate_sql(table: str, source: str, column: str, min_rows: int, rate: float = 0.05, severity: str = "error") -> str:
    count = _check_sql(table, source, "row_count", "*", f"GREATEST({min_rows} - COUNT(*), 0)",
                       passed=f"COUNT(*) >= {min_rows}")
    nulls = _check_sql(table, source, "null_rate", column, _null_count(column), severity,
                       passed=f"COALESCE({_null_count(column)} / nullif(COUNT(*), 0), 0) <= {rate}e0")
    return f"{count} UNION ALL {nulls}" if min_rows else nulls


R.add(
    "q_dq_null_rate_gate",
    lambda t: Q.null_rate_gate(t.raw_traffic, "raw_traffic", "product_id", 100)
    .unionByName(Q.null_rate_gate(t.raw_traffic, "raw_traffic", "last_visited", 0, 0.001)),
    _rate_sql("raw_traffic", "{raw_traffic}", "product_id", 100)
    + " UNION ALL "
    + _rate_sql("raw_traffic", "{raw_traffic}", "last_visited", 0, 0.001),
)
R.add(
    "q_dq_raw_gate",
    lambda t: Q.raw_gate({x: raw_of(t, x) for x in CATALOGUE}, t.sales_events),
    " UNION ALL ".join(_rate_sql(f"raw_{x}", f"{{raw_{x}}}", "product_id", 100) for x in CATALOGUE)
    + " UNION ALL "
    + _rate_sql("raw_finance", "{raw_finance}", "revenue", 0, 0.01, "warn")
    + " UNION ALL "
    + _check_sql("sales_events", "{sales_events}", "row_count", "*", "GREATEST(0 - COUNT(*), 0)",
                 passed="COUNT(*) >= 0"),
)
R.add(
    "q_dq_not_null",
    lambda t: Q.not_null(clean_of(t, "reviews"), "clean_reviews", ["product_id", "rating", "review_count"]),
    " UNION ALL ".join(
        _check_sql("clean_reviews", "{clean_reviews}", "not_null", c, _null_count(c))
        for c in ("product_id", "rating", "review_count")
    ),
)
R.add(
    "q_dq_unique",
    lambda t: Q.unique(clean_of(t, "reviews"), "clean_reviews", "product_id"),
    _check_sql("clean_reviews", "(SELECT product_id, COUNT(*) AS n FROM {clean_reviews} GROUP BY product_id)",
               "unique", "product_id", "COUNT(*) FILTER (WHERE n > 1)", total="SUM(n)"),
)
R.add(
    "q_dq_accepted_values",
    lambda t: Q.accepted_values(clean_of(t, "brands"), "clean_brands", "brand", ["Brand#1", "Brand#2"]).unionByName(
        Q.accepted_values(discount_impact(t.finance_lines), "discount_impact", "category", ["Discounted", "No Discount"])
    ),
    _check_sql("clean_brands", "{clean_brands}", "accepted_values", "brand",
               "COUNT(*) FILTER (WHERE brand NOT IN ('Brand#1', 'Brand#2'))")
    + " UNION ALL "
    + _check_sql("discount_impact", "(SELECT DISTINCT discount > 0 FROM {finance_lines})", "accepted_values",
                 "category", "0", passed="TRUE"),
)
R.add(
    "q_dq_feature_asserts",
    lambda t: Q.feature_checks(durable(features_of(t), "features")),
    _check_sql("features_products", "{features}", "row_count", "*", "GREATEST(1 - COUNT(*), 0)", passed="COUNT(*) >= 1")
    + " UNION ALL "
    + _check_sql("features_products", "{features}", "positive", "listing_price",
                 "COUNT(*) FILTER (WHERE listing_price <= 0)")
    + "".join(
        " UNION ALL " + _check_sql("features_products", "{features}", "not_null", c, _null_count(c))
        for c in ("listing_price", "review_count", "rating")
    ),
)
R.add(
    "q_dq_mart_gate",
    lambda t: Q.null_rate_gate(brand_revenue(t.finance_lines, t.brands), "brand_revenue", "brand", 1),
    _rate_sql("brand_revenue", "(SELECT DISTINCT brand FROM {brands})", "brand", 1),
)


def _marts(t: Tables) -> dict[str, DataFrame]:
    """The marts that must hold data before features are built."""
    built = {
        "brand_revenue": brand_revenue(t.finance_lines, t.brands),
        "product_revenue": product_revenue(t.finance_lines, t.info, t.brands),
        "monthly_traffic": monthly_traffic(t.traffic),
    }
    return {name: durable(df, f"mart-{name}") for name, df in built.items()}


_MART_SQL = {
    "brand_revenue": "(SELECT DISTINCT brand FROM {finance_lines} JOIN {brands} USING (product_id))",
    "product_revenue": """(SELECT DISTINCT product_name, brand FROM {finance_lines}
                           JOIN {info} USING (product_id) JOIN {brands} USING (product_id))""",
    "monthly_traffic": "(SELECT DISTINCT strftime(last_visited, '%Y-%m') AS month FROM {traffic})",
}
R.add(
    "q_dq_mart_gate_all",
    lambda t: Q.mart_gate(_marts(t)),
    " UNION ALL ".join(_rate_sql(m, _MART_SQL[m], c, n) for m, (c, n) in Q.MART_MINIMUM.items()),
)

# --- features ----------------------------------------------------------------------------


def _with_gaps(df):
    key = F.col("product_id").cast("bigint")
    keep = lambda c, m: F.when(key % m != 0, F.col(c))
    return (
        df.withColumn("listing_price", keep("listing_price", 13))
        .withColumn("discount", keep("discount", 17))
        .withColumn("review_count", keep("review_count", 19))
    )


def _rounded(df, *columns: str, digits: int = 9):
    return df.withColumns({c: F.round(c, digits) for c in columns})


R.add("q_feature_join", base_of, "SELECT * FROM {base}")
R.add(
    "q_feature_base",
    lambda t: base_of(t).select("product_id", "brand", "listing_price", "revenue", "rating"),
    "SELECT product_id, brand, listing_price, revenue, rating FROM {base}",
)
R.add(
    "q_median_impute",
    lambda t: FE.impute_medians(durable(_with_gaps(base_of(t)), "base"), ["listing_price", "review_count"]),
    """SELECT product_id, product_name, brand,
              COALESCE(listing_price, (SELECT MEDIAN(listing_price) FROM {gaps})) AS listing_price,
              COALESCE(discount, 0e0) AS discount, revenue, rating,
              COALESCE(review_count, (SELECT MEDIAN(review_count) FROM {gaps})) AS review_count FROM {gaps}""",
)
R.add(
    "q_zero_as_missing",
    lambda t: FE.impute_medians(durable(FE.zero_as_missing(base_of(t)), "base"), ["rating"]).select("product_id", "rating"),
    "SELECT product_id, COALESCE(rating, (SELECT MEDIAN(rating) FROM {unrated})) AS rating FROM {unrated}",
)
R.add(
    "q_drop_nonpositive_price",
    lambda t: FE.drop_nonpositive_price(base_of(t)),
    "SELECT * FROM {base} WHERE listing_price > 0",
)
R.add(
    "q_log_revenue",
    lambda t: _rounded(FE.log_revenue(base_of(t)).select("product_id", "revenue"), "revenue"),
    "SELECT product_id, ROUND(ln(1 + revenue), 9) AS revenue FROM {base}",
)
R.add(
    "q_label_encode",
    lambda t: FE.label_encode(FE.drop_nonpositive_price(base_of(t))).select("product_id", "brand", "brand_encoded"),
    "SELECT product_id, brand, brand_encoded FROM {features}",
)
R.add(
    "q_features_products",
    lambda t: _rounded(features_of(t), "revenue"),
    "SELECT * REPLACE (ROUND(revenue, 9) AS revenue) FROM {features}",
)
R.add(
    "q_complete_rows",
    lambda t: FE.complete_rows(_with_gaps(base_of(t)), ["listing_price", "discount", "rating", "review_count"]),
    """SELECT * FROM {gaps} WHERE listing_price IS NOT NULL AND discount IS NOT NULL
       AND rating IS NOT NULL AND review_count IS NOT NULL""",
)
_Z = [f"{c}_z" for c in FE.FEATURE_COLS]
R.add(
    "q_standard_scale",
    lambda t: _rounded(
        FE.standard_scale(durable(features_of(t), "features"), FE.FEATURE_COLS).select("product_id", *_Z), *_Z, digits=6
    ),
    "SELECT product_id, " + ", ".join(f"ROUND({z}, 6) + 0e0 AS {z}" for z in _Z) + " FROM {scaled}",
)
