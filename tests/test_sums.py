"""Sums of doubles: no value is lost and none stops the job."""

import math

import pytest
from pyspark.sql import functions as F

from sparkmart.functions import exprs as E


def total(frame, values):
    df = frame([(v,) for v in values], "v double").repartition(3)
    return df.agg(E.exact_sum("v").alias("s"), E.exact_avg("v").alias("m")).first()


def test_small_values_count(spark):
    df = spark.range(10_000).select(F.lit(0.00004).alias("v"))
    r = df.agg(E.exact_sum("v").alias("s"), E.exact_avg("v").alias("m")).first()
    assert r["s"] == pytest.approx(0.4) and r["m"] == pytest.approx(0.00004)


def test_money_is_exact(frame):
    assert total(frame, [0.1] * 10 + [1e9, -1e9])["s"] == 1.0


@pytest.mark.parametrize("values, want", [([1e15, 1.0], 1e15 + 1), ([1e300, 1.0], 1e300), ([math.inf, 1.0], math.inf)])
def test_large_values(frame, values, want):
    assert total(frame, values)["s"] == want


def test_nan_null_and_empty(frame):
    assert math.isnan(total(frame, [math.nan, 1.0])["s"])
    assert total(frame, [None, 2.5])["s"] == 2.5 and total(frame, [None])["s"] is None
    assert total(frame, [])["s"] is None


def test_parts_merge(frame):
    df = frame([(k % 3, k * 0.00001 + 2**41 * (k % 5)) for k in range(50)], "g int, v double")
    parts = df.groupBy("g").agg(*E.sum_parts("v", "p"))
    merged = parts.agg(*E.merge_parts("p")).select(E.parts_value("p")).first()[0]
    assert merged == pytest.approx(df.agg(E.exact_sum("v")).first()[0], rel=1e-15)


@pytest.mark.parametrize("text", ["1e400", "-1e400", "Infinity", "NaN", "5d", "0x1p3"])
def test_text_that_is_no_finite_number(frame, text):
    assert frame([(text,)], "t string").select(E.number("t")).first()[0] is None


def test_shares_of_small_and_infinite_totals(frame):
    import math

    from sparkmart.operators import marts

    def shares(revenues):
        finance = frame([(k, r) for k, r in enumerate(revenues)], "product_id int, revenue double")
        brands = frame([(k, f"b{k}") for k in range(len(revenues))], "product_id int, brand string")
        return [r["revenue_share_percentage"] for r in marts.brand_share(finance, brands).orderBy("brand").collect()]

    assert shares([0.00004, 0.00004]) == [50.0, 50.0]
    assert shares([1e300, 3e300]) == [25.0, 75.0]
    endless = shares([math.inf, 5.0])
    assert math.isnan(endless[0]) and endless[1] == 0.0
    assert shares([0.0, 0.0]) == [None, None]
