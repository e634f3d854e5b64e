import pytest

from sparkmart.functions.exprs import clip, number
from sparkmart.operators.clean import clean, clean_all, clean_rejects, register_views
from sparkmart.operators.quality import ValidationError
from sparkmart.sources.schemas import CLEAN, RAW, SchemaDrift, conform, from_source
from sparkmart.sources.sinks import read_current


def rows(df):
    return [tuple(r) for r in df.collect()]


def finance(frame, *records):
    return clean(frame(list(records), RAW["finance"]), "finance")


def test_finance_keeps_a_good_row(frame):
    out = finance(frame, ("P001", "100.0", "80.0", "0.2", 500.0))
    assert rows(out) == [("P001", 100.0, 80.0, 0.2, 500.0)]
    assert conform(out, CLEAN["finance"]).columns == out.columns


@pytest.mark.parametrize("revenue, kept", [(-100.0, 0), (0.0, 1), (None, 0), (float("nan"), 0)])
def test_finance_revenue_rule(frame, revenue, kept):
    assert finance(frame, ("P", "1", "1", "0", revenue)).count() == kept


def test_finance_missing_id(frame):
    assert rows(finance(frame, (None, "1", "1", "0", 1.0), ("P001", "1", "1", "0", 1.0)))[0][0] == "P001"


@pytest.mark.parametrize("discount, expected", [("1.8", 1.0), ("-0.5", 0.0), (None, 0.0), ("n/a", 0.0), ("0.3", 0.3)])
def test_finance_discount(frame, discount, expected):
    assert rows(finance(frame, ("P", "1", "1", discount, 1.0)))[0][3] == expected


@pytest.mark.parametrize("price", [None, "n/a", "5d", "NaN"])
def test_finance_bad_price_is_zero(frame, price):
    assert rows(finance(frame, ("P", price, "1", "0", 1.0)))[0][1] == 0.0


@pytest.mark.parametrize(
    "rating, expected",
    [("3,3", 3.3), ("4.5", 4.5), ("4", 4.0), (" 2,5 ", 2.5), ("6.0", 5.0), ("-1.0", 0.0), (None, None), ("n/a", None), ("5d", None), ("1e0", 1.0)],
)
def test_ratings(frame, rating, expected):
    assert rows(clean(frame([("P", rating, "1")], RAW["reviews"]), "reviews"))[0][1] == expected


@pytest.mark.parametrize("count, expected", [("-5.0", 0.0), (None, 0.0), ("bad", 0.0), ("12", 12.0)])
def test_review_counts(frame, count, expected):
    assert rows(clean(frame([("P", "1", count)], RAW["reviews"]), "reviews"))[0][2] == expected


def test_reviews_drop_blank_ids_and_keep_duplicates(frame):
    raw = frame([("P1", "1", "1"), ("", "1", "1"), ("  ", "1", "1"), (None, "1", "1"), ("P1", "2", "2")], RAW["reviews"])
    assert [r[0] for r in rows(clean(raw, "reviews"))] == ["P1", "P1"]


def test_brands_info_traffic(frame):
    brands = clean(frame([("P1", "  alba  "), ("P2", None), (None, "x"), ("P3", " Nova ")], RAW["brands"]), "brands")
    assert rows(brands) == [("P1", "Alba"), ("P3", "Nova")]
    info = clean(frame([("P1", "  Runner ", None), ("P2", None, "d")], RAW["info"]), "info")
    assert rows(info) == [("P1", "Runner", "")]
    traffic = clean(frame([("P1", None), ("P2", " 2019-01-01 10:00:00"), ("P3", ""), ("P4", "  ")], RAW["traffic"]), "traffic")
    assert rows(traffic) == [("P2", "2019-01-01 10:00:00")]


def test_rejects_count_each_row_once(frame):
    raw = frame([(None, "1", "1", "0", None), ("P", "1", "1", "0", None), ("P", "1", "1", "0", -1.0), ("P", "1", "1", "0", 1.0)], RAW["finance"])
    assert {r[1]: r[2] for r in rows(clean_rejects(raw, "finance"))} == {
        "missing product_id": 1, "missing revenue": 1, "negative revenue": 1,
    }


def test_clean_all_publishes_and_counts(spark, frame, tmp_path):
    raw = {"brands": frame([("P1", " a "), ("P2", None)], RAW["brands"])}
    assert clean_all(raw, str(tmp_path)) == {"brands": (2, 1)}
    assert rows(read_current(spark, f"{tmp_path}/clean_brands")) == [("P1", "A")]
    with pytest.raises(ValidationError):  # nothing left: the old version stays current
        clean_all({"brands": frame([("P2", None)], RAW["brands"])}, str(tmp_path))
    assert rows(read_current(spark, f"{tmp_path}/clean_brands")) == [("P1", "A")]


def test_source_names_and_drift(frame):
    source = frame([("P1", "Alba", "ALBA")], "product_id string, modified_brand string, brand string")
    assert rows(from_source(source, "brands")) == [("P1", "Alba")]
    with pytest.raises(SchemaDrift):
        from_source(source, "info")
    with pytest.raises(SchemaDrift):
        conform(source, RAW["brands"])


def test_clip_keeps_null_and_number_is_tolerant(frame):
    df = frame([(None,), (9.0,)], "x double").select(clip("x", 0.0, 5.0))
    assert rows(df) == [(None,), (5.0,)]
    text = frame([("1e3",), (".5",), ("Infinity",), ("+2",), ("",)], "s string").select(number("s"))
    assert [r[0] for r in rows(text)] == [1000.0, 0.5, None, 2.0, None]


def test_views(spark, frame):
    register_views({"brands": frame([("P1", " a "), ("P2", None)], RAW["brands"])})
    assert rows(spark.sql("SELECT brand FROM clean_brands")) == [("A",)]
