import pytest

from sparkmart.operators.quality import ValidationError
from sparkmart.plans import daily
from sparkmart.sources.bindings import bind
from sparkmart.sources.sinks import read_current
from tests.conftest import SF


def test_daily_run_and_gate(spark, tmp_path):
    sources = {t: bind(spark, SF, f"raw_{t}") for t in daily.CATALOGUE}
    events = bind(spark, SF, "sales_events")
    folder = str(tmp_path)
    done = daily.run(spark, sources, events, folder, neighbours=3, restarts=1)
    assert done["features"] == done["clusters"] == done["neighbour_pairs"] / 3
    assert len(done["marts"]) == 5
    shares = read_current(spark, f"{folder}/analytics_brand_revenue").selectExpr("sum(revenue_share_pct)").first()[0]
    assert shares == pytest.approx(100, abs=0.5)
    again = daily.run(spark, sources, events, folder, neighbours=3, restarts=1)
    assert again["raw_rows"] is None and again["new_events"] == 0 and again["features"] == done["features"]
    with pytest.raises(ValidationError):
        daily.run(spark, {**sources, "brands": sources["brands"].limit(3)}, events, folder)
