import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sparkmart.operators import features as FE
from sparkmart.operators.quality import ValidationError

BASE = (
    "product_id string, product_name string, brand string, listing_price double, discount double, "
    "revenue double, rating double, review_count double"
)
#: Seven products with known gaps: g2 has no rating, g5 neither price nor review count, g6 no discount.
ROWS = [
    (
        f"g{k}", f"Item {k}", ("Kestrel", "Wren")[k % 2], None if k == 5 else 12.5 * k, None if k == 6 else k / 20,
        31.0 * k * k, None if k == 2 else 1.0 + k / 2, None if k == 5 else 7.0 * k,
    )
    for k in range(1, 8)
]


def by_id(df):
    return {r["product_id"]: r for r in df.collect()}


def test_impute(frame):
    got = by_id(FE.impute_medians(FE.zero_as_missing(frame(ROWS, BASE))))
    assert got["g5"]["listing_price"] == 43.75 and got["g5"]["review_count"] == 24.5
    assert got["g2"]["rating"] == 3.25 and got["g6"]["discount"] == 0.0


def test_zero_rating_is_missing(frame):
    rows = [list(r) for r in ROWS]
    rows[1][6] = 0.0
    got = by_id(FE.impute_medians(FE.zero_as_missing(frame([tuple(r) for r in rows], BASE))))
    assert got["g2"]["rating"] == 3.25


def test_all_missing_column_stays_missing(frame):
    got = by_id(FE.impute_medians(frame([("P", "n", "b", None, 0.1, 1.0, 2.0, 3.0)], BASE)))
    assert got["P"]["listing_price"] is None


def test_corrupt_price_dropped_and_counted(frame):
    rows = [list(r) for r in ROWS]
    rows[0][3] = 0.0
    seen = Observation()
    kept = FE.drop_nonpositive_price(FE.impute_medians(frame([tuple(r) for r in rows], BASE)), seen)
    assert sorted(by_id(kept)) == ["g2", "g3", "g4", "g5", "g6", "g7"] and seen.get["dropped"] == 1


def test_label_encoding(frame):
    got = by_id(FE.label_encode(frame(ROWS, BASE)))
    assert {r["brand"]: r["brand_encoded"] for r in got.values()} == {"Kestrel": 0, "Wren": 1}


def test_standard_scale(frame):
    df = frame([(1.0, 7.0), (3.0, 7.0), (None, 7.0)], "a double, b double")
    got = [tuple(r) for r in FE.standard_scale(df, ["a", "b"]).select("a_z", "b_z").collect()]
    assert got == [(-1.0, 0.0), (1.0, 0.0), (None, 0.0)]


def sources(frame):
    finance = frame(
        [("P1", 100.0, 90.0, 0.1, 10.0), ("P1", 100.0, 90.0, 0.3, 20.0), ("P2", 50.0, 50.0, 0.0, 5.0)],
        "product_id string, listing_price double, sale_price double, discount double, revenue double",
    )
    info = frame([("P1", "a", ""), ("P2", "b", "")], "product_id string, product_name string, description string")
    brands = frame([("P1", "X"), ("P2", "Y")], "product_id string, brand string")
    reviews = frame([("P1", 4.0, 2.0), ("P1", 5.0, 3.0)], "product_id string, rating double, review_count double")
    return finance, info, brands, reviews


def test_build_features(frame, tmp_path):
    written = FE.build_features(*sources(frame), str(tmp_path / "f"), str(tmp_path / "csv"))
    got = by_id(written)
    assert written.columns == FE.OUTPUT_COLS
    assert got["P1"]["rating"] == 4.5 and got["P1"]["review_count"] == 5.0
    assert got["P2"]["rating"] == 4.5 and got["P2"]["review_count"] == 0.0
    assert got["P1"]["revenue"] == pytest.approx(3.4339872)
    assert written.sparkSession.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2


def test_build_features_refuses_an_empty_result(frame, tmp_path):
    finance, info, brands, reviews = sources(frame)
    with pytest.raises(ValidationError):
        FE.build_features(finance.withColumn("listing_price", F.lit(0.0)), info, brands, reviews, str(tmp_path))


@pytest.mark.parametrize("rows_per_range", [2, 1000])
def test_large_and_small_inputs_agree(frame, rows_per_range):
    got = by_id(FE.features_products(*sources(frame), rows_per_range=rows_per_range))
    assert got["P2"]["rating"] == 4.5 and got["P1"]["brand_encoded"] == 0
