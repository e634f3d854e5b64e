"""What the optimizer makes of the operators: pruning, pushdown, reuse, no single task for rows."""

import re

import pytest

from sparkmart.operators import marts as M
from sparkmart.plans.registry import Tables
from tests.conftest import SF


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SF)


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def read_schemas(text: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<(.*?)>", text)


def test_column_pruning_reaches_the_scan(t):
    assert read_schemas(plan(M.total_revenue(t.finance_lines))) == ["l_extendedprice:double,l_discount:double"]
    schemas = read_schemas(plan(M.brand_revenue(t.finance_lines, t.brands)))
    assert "l_partkey:bigint,l_extendedprice:double,l_discount:double" in schemas
    assert "p_partkey:bigint,p_brand:string" in schemas


def test_filters_reach_the_scan(t):
    text = plan(M.product_revenue_between(t.sales_events, 7, "2024-01-05", "2024-01-25"))
    assert "EqualTo(event_type,purchase)" in text and "EqualTo(user_id,7)" in text


def test_share_reuses_the_aggregation(t):
    text = final_plan(M.brand_share(t.finance_lines, t.brands))
    assert "ReusedExchange" in text


def test_fact_is_reduced_before_the_join(t):
    text = plan(M.top_products(t.finance_lines, t.info))
    tree = text[: text.index("\n\n(1)")]
    above, below = tree.split("Join", 1)
    assert below.count("HashAggregate") == 2  # partial and final aggregation of the fact, under the join


def test_top_k_is_not_a_sort(t):
    text = plan(M.top_products(t.finance_lines, t.info))
    assert "TakeOrderedAndProject" in text and not re.search(r"\bSort \(", text)


@pytest.mark.parametrize(
    "make",
    [
        lambda t: M.brand_revenue(t.finance_lines, t.brands),
        lambda t: M.discount_impact(t.finance_lines),
        lambda t: M.monthly_revenue(t.traffic, t.finance_lines),
        lambda t: M.join_finance_brand(t.finance_lines, t.brands),
    ],
)
def test_no_rows_pass_one_task(t, make):
    """One task only ever receives partial aggregates of a scalar subquery."""
    text = plan(make(t))
    main = text.split("===== Subqueries =====")[0]
    assert "SinglePartition" not in main and "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
