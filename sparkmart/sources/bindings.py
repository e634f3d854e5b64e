"""Retail tables defined over the generic star-schema tables.

Each binding is one SELECT whose inputs are named in braces. Spark receives the inputs as
DataFrames, other engines as names in a WITH clause, so both read the same definition.
``raw_*`` bindings carry deterministic damage, so that the cleaning rules have work to do.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from sparkmart.sources.schemas import SOURCES
from sparkmart.sources.tables import read_table

BINDINGS: dict[str, str] = {
    # One sales line per row; no list price, so no join is paid where it is not needed.
    "finance_lines": """
        SELECT l_partkey AS product_id, l_discount AS discount,
               l_extendedprice * (1 - l_discount) AS revenue
        FROM {lineitem}""",
    "finance": """
        SELECT l.l_partkey AS product_id, p.p_retailprice AS listing_price,
               l.l_extendedprice / l.l_quantity AS sale_price, l.l_discount AS discount,
               l.l_extendedprice * (1 - l.l_discount) AS revenue
        FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey""",
    "price_list": "SELECT p_partkey AS product_id, p_retailprice AS listing_price FROM {part}",
    "brands": "SELECT p_partkey AS product_id, p_brand AS brand FROM {part}",
    "brands_with_gaps": """
        SELECT p_partkey AS product_id, CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_brand END AS brand
        FROM {part}""",
    "info": "SELECT p_partkey AS product_id, p_name AS product_name, p_type AS description FROM {part}",
    "reviews": """
        SELECT p_partkey AS product_id,
               CAST(p_size % 6 AS DOUBLE) + CAST(p_partkey % 10 AS DOUBLE) / 1e1 AS rating,
               CAST((p_partkey * 37) % 900 AS DOUBLE) AS review_count
        FROM {part}""",
    "traffic": "SELECT l_partkey AS product_id, l_shipdate AS last_visited FROM {lineitem}",
    "sales_events": """
        SELECT event_id, user_id AS product_id, value AS price,
               CAST(event_id % 56 AS DOUBLE) / 1e2 AS discount, event_id % 5 + 1 AS quantity,
               value * (1 - CAST(event_id % 56 AS DOUBLE) / 1e2) * (event_id % 5 + 1) AS revenue,
               ts AS event_timestamp
        FROM {events} WHERE event_type = 'purchase'""",
    "raw_finance": """
        SELECT CASE WHEN l.l_orderkey % 97 = 0 THEN NULL ELSE CAST(l.l_partkey AS STRING) END AS product_id,
               CASE WHEN l.l_partkey % 83 = 0 THEN 'n/a' WHEN l.l_partkey % 50 = 0 THEN '0.0'
                    WHEN l.l_orderkey % 61 = 0 THEN NULL
                    ELSE CAST(p.p_retailprice AS STRING) END AS listing_price,
               CASE WHEN l.l_partkey % 89 = 0 THEN '5d' WHEN l.l_orderkey % 31 = 0 THEN NULL
                    ELSE CAST(l.l_extendedprice / l.l_quantity AS STRING) END AS sale_price,
               CASE WHEN l.l_partkey % 37 = 0 THEN CAST(l.l_discount + 1.5e0 AS STRING)
                    WHEN l.l_orderkey % 41 = 0 THEN '-0.5' WHEN l.l_orderkey % 43 = 0 THEN NULL
                    ELSE CAST(l.l_discount AS STRING) END AS discount,
               CASE WHEN l.l_orderkey % 41 = 0 THEN -l.l_extendedprice WHEN l.l_orderkey % 47 = 0 THEN NULL
                    ELSE l.l_extendedprice * (1 - l.l_discount) END AS revenue
        FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey""",
    "raw_brands": """
        SELECT CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE CAST(p_partkey AS STRING) END AS product_id,
               CASE WHEN p_partkey % 79 = 0 THEN NULL ELSE '  ' || lower(p_brand) || ' ' END AS brand
        FROM {part}""",
    "raw_info": """
        SELECT CASE WHEN p_partkey % 101 = 0 THEN NULL ELSE CAST(p_partkey AS STRING) END AS product_id,
               CASE WHEN p_partkey % 71 = 0 THEN NULL ELSE '  ' || p_name || ' ' END AS product_name,
               CASE WHEN p_partkey % 53 = 0 THEN NULL ELSE p_type END AS description
        FROM {part}""",
    "raw_reviews": """
        SELECT CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey % 89 = 0 THEN '  '
                    ELSE CAST(p_partkey AS STRING) END AS product_id,
               CASE WHEN p_partkey % 83 = 0 THEN 'n/a' WHEN p_partkey % 73 = 0 THEN NULL
                    WHEN p_partkey % 67 = 0 THEN '-1,0' WHEN p_partkey % 59 = 0 THEN '9,5'
                    ELSE ' ' || CAST(p_size % 6 AS STRING) || ',' || CAST(p_partkey % 10 AS STRING) END AS rating,
               CASE WHEN p_partkey % 61 = 0 THEN 'bad' WHEN p_partkey % 47 = 0 THEN '-5'
                    WHEN p_partkey % 43 = 0 THEN NULL
                    ELSE CAST((p_partkey * 37) % 900 AS STRING) END AS review_count
        FROM {part}
        UNION ALL
        SELECT CAST(p_partkey AS STRING), '4,5', '10' FROM {part} WHERE p_partkey % 20 = 0""",
    "raw_traffic": """
        SELECT CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE CAST(l_partkey AS STRING) END AS product_id,
               CASE WHEN l_orderkey % 89 = 0 THEN NULL WHEN l_orderkey % 83 = 0 THEN ''
                    WHEN l_orderkey % 79 = 0 THEN '   '
                    ELSE '  ' || CAST(l_shipdate AS STRING) END AS last_visited
        FROM {lineitem}""",
}

_INPUT = re.compile(r"{(\w+)}")


def inputs_of(sql: str) -> list[str]:
    return list(dict.fromkeys(_INPUT.findall(sql)))


def bind(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A bound table, or a table of ``folder`` as it is."""
    if name not in BINDINGS:
        return read_table(spark, folder, name, SOURCES.get(name))
    sql = BINDINGS[name]
    return spark.sql(sql, **{i: bind(spark, folder, i) for i in inputs_of(sql)})


def with_clause(query: str, extra: dict[str, str] | None = None) -> str:
    """``query`` with a WITH clause in front that defines every {name} it uses, in order."""
    definitions = {**BINDINGS, **(extra or {})}
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in inputs_of(sql):
            if name in definitions and name not in ordered:
                visit(definitions[name])
                ordered.append(name)

    visit(query)
    plain = {n: _INPUT.sub(r"\1", definitions[n]) for n in ordered}
    body = _INPUT.sub(r"\1", query)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({plain[n]})" for n in ordered) + "\n" + body
