import pytest
from pyspark.sql import functions as F

from sparkmart.functions import exprs as E
from sparkmart.operators import marts as M


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture
def shop(frame):
    finance = frame(
        [("p1", 0.1, 0.1, 10.0), ("p1", 0.0, 0.2, 10.0), ("p2", 0.205, 0.3, 20.0), ("p3", None, 0.0, 30.0)],
        "product_id string, discount double, revenue double, listing_price double",
    )
    brands = frame([("p1", "A"), ("p2", "A"), ("p3", None)], "product_id string, brand string")
    info = frame([("p1", "x"), ("p2", "y"), ("p3", "y")], "product_id string, product_name string")
    return finance, brands, info


def test_exact_sum_does_not_drift(frame):
    df = frame([(0.1,)] * 1000 + [(-0.3,)] * 7 + [(None,)], "v double")
    assert df.agg(E.exact_sum("v"), E.exact_avg("v")).first()[0] == 97.9
    assert frame([(None,)], "v double").agg(E.exact_sum("v")).first()[0] is None


def test_exact_sum_beyond_long(frame):
    df = frame([(9e10,)] * 20000, "v double")  # 1.8e15, in units beyond 2^63
    assert df.agg(E.exact_sum("v")).first()[0] == 1.8e15


def test_brand_revenue_shares(shop):
    finance, brands, _ = shop
    got = rows(M.brand_revenue(finance, brands))
    assert got == [("A", 0.6, 2, 100.0), (None, 0.0, 1, 0.0)]
    assert [r[0] for r in rows(M.brand_share_with_unknown(finance, brands))] == ["A", "Unknown"]
    assert rows(M.top_brand(finance, brands)) == [("A", 0.6, 100.0)]


def test_share_of_zero_total_is_null(frame):
    assert rows(M.with_share(frame([("a", 0.0)], "b string, v double"), "v", "s")) == [("a", 0.0, None)]


def test_duplicate_dimension_rows_count_products_once(frame, shop):
    finance, _, _ = shop
    twice = frame([("p1", "A"), ("p1", "A")], "product_id string, brand string")
    assert rows(M.brand_revenue(finance, twice)) == [("A", 0.6, 1, 100.0)]


def test_discount_bands(shop):
    finance = shop[0]
    bands = dict(rows(M.discount_range(finance)))
    assert bands == {"Low Discount": 0.3, "No Discount": 0.3}  # 0.205 falls into the hole
    strict = dict(rows(M.discount_range(finance, strict=True)))
    assert strict == {"Low Discount": 0.1, "No Discount": 0.2, "Medium Discount": 0.3, "Unknown": 0.0}
    assert dict(rows(M.discount_range_by_thresholds(finance))) == {"Low Discount": 0.6, "High Discount": 0.0}


def test_review_fan_out_and_pre_aggregate(frame, shop):
    finance = shop[0]
    reviews = frame([("p1", 4.0, 20.0), ("p1", 4.0, 90.0)], "product_id string, rating double, review_count double")
    assert dict(rows(M.review_volume(finance, reviews))) == {"Low Reviews": 0.6}
    assert dict(rows(M.review_volume(finance, reviews, pre_aggregate=True))) == {"Medium Reviews": 0.3}


def test_ranking(shop):
    finance, brands, info = shop
    assert rows(M.product_rank(finance, info)) == [("x", 0.3, 1), ("y", 0.3, 1)]
    assert rows(M.ranked_up_to(finance, info, 1)) == [("x", 0.3, 1), ("y", 0.3, 1)]
    assert [r[3] for r in rows(M.product_revenue(finance, info, brands))] == [1, 1, 3]


def test_text_dates(frame):
    traffic = frame([("p1", "2019-01-05 10:00:00"), ("p1", "2020-01-01"), ("p2", "odd")], "product_id string, last_visited string")
    assert rows(M.monthly_traffic(traffic)) == [("2019-01", 1), ("2020-01", 1), ("odd", 1)]
    info = frame([("p1", "x"), ("p2", "y")], "product_id string, product_name string")
    assert rows(M.most_visited(traffic, info)) == [("x", 1, 2), ("y", 0, 1)]


def test_traffic_change(frame):
    monthly = frame([("2020-02", 5), ("2020-01", 8)], "month string, visit_count bigint")
    assert rows(M.traffic_change(monthly)) == [("2020-01", 8, None), ("2020-02", 5, -3)]


def test_histogram_edges(frame):
    df = frame([(float(i),) for i in range(11)] + [(None,)], "v double")
    assert [r[2] for r in rows(M.histogram(df, "v", 5).orderBy("bin"))] == [2, 2, 2, 2, 3]
    same = frame([(3.0,), (3.0,)], "v double")
    assert rows(M.histogram(same, "v", 5)) == [(0, 3.0, 2)]


def test_keep_best(frame):
    df = frame([("n", 0.5, "b"), ("n", 0.5, "a"), ("m", 0.9, "c")], "name string, s double, id string")
    assert rows(M.keep_best(df, "name", "s", "id", 5)) == [("m", 0.9, "c"), ("n", 0.5, "a")]


def test_event_revenue_without_events(frame, shop):
    _, brands, info = shop
    empty = M.event_revenue(None, info, brands)
    assert empty.count() == 0 and empty.columns[-1] == "revenue_rank"


def test_anchored_window_ignores_the_clock(frame):
    events = frame([("p", "2026-04-30 23:59:00"), ("p", "2026-04-01 00:00:00")], "product_id string, event_timestamp string")
    events = events.withColumn("event_timestamp", F.to_timestamp("event_timestamp"))
    start, end = M.anchored_window(events, 3).first()
    assert (str(start), str(end)) == ("2026-04-28", "2026-04-30")
    assert M.in_anchored_window(events, 3).count() == 1


def test_formats(frame):
    df = frame([(12345.4, 0.973)], "a double, b double").select(E.money_text("a"), E.percent_text("b"))
    assert rows(df) == [("12,345", "97.3%")]
