import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.functions import distributions as D
from sparkmart.functions.exprs import p_text
from sparkmart.operators import experiments as X
from sparkmart.operators import statistics as S


def values(frame, first, second):
    data = [("discounted", float(v)) for v in first] + [("full_price", float(v)) for v in second]
    return frame(data, "group string, value double")


def test_probabilities_against_tables():
    assert D.normal_two_sided(np.array([1.959963985]))[0] == pytest.approx(0.05, abs=1e-9)
    # two-sided 5 % points of Student's t
    for df, t in ((1, 12.706205), (5, 2.570582), (10, 2.228139), (30, 2.042272), (1000, 1.962339)):
        assert D.t_two_sided(np.array([t]), np.array([float(df)]))[0] == pytest.approx(0.05, abs=1e-6)
        assert D.t_critical(np.array([0.05]), np.array([float(df)]))[0] == pytest.approx(t, abs=1e-5)
    below, above = (D.t_two_sided(np.array([2.0]), np.array([d]))[0] for d in (0.999e6, 1.001e6))
    assert below == pytest.approx(above, abs=1e-8)
    assert np.isnan(D.t_two_sided(np.array([np.nan]), np.array([3.0]))[0])


def test_split(frame):
    """A product is discounted if any line is; lines without a discount say nothing."""
    rng = np.random.default_rng(17)
    data = [(None if k % 9 == 0 else float(k % 4) / 8, float(v)) for k, v in enumerate(rng.uniform(1, 9, 72).round(3))]
    got = {(r["group"], r["value"]) for r in S.revenue_groups(frame(data, "discount double, revenue double")).collect()}
    assert got == {("discounted" if d else "full_price", v) for d, v in data if d is not None}


def test_moments(frame):
    rng = np.random.default_rng(0)
    a, b = rng.exponential(50, 200), rng.normal(10, 2, 100)
    r = S.group_moments(values(frame, a, b)).first()
    assert r["n_discounted"] == 200 and r["std_full_price"] == pytest.approx(b.std(ddof=1))
    z = (a - a.mean()) / a.std()
    assert r["skew_discounted"] == pytest.approx((z**3).mean()) and r["kurtosis_discounted"] == pytest.approx((z**4).mean() - 3)


def test_cohens_d(frame):
    r = S.welch_test(S.group_moments(values(frame, range(10, 51, 10), range(20, 61, 10)))).first()
    assert r["cohens_d"] == pytest.approx(-0.63245553)
    assert r["df"] == pytest.approx(8.0) and r["t"] == pytest.approx(-1.0)
    assert r["t_p"] == pytest.approx(0.3466, abs=1e-4)


@pytest.mark.parametrize("first, second, r", [(range(10, 15), range(1, 6), 1.0), (range(1, 6), range(10, 15), -1.0)])
def test_rank_biserial(frame, first, second, r):
    got = S.mann_whitney(S.rank_sums(values(frame, first, second))).first()
    assert got["rank_biserial"] == r and got["approximate"]
    assert got["u_p"] == pytest.approx(0.0122, abs=1e-4)


@pytest.mark.parametrize("rows_per_range", [3, 1_000_000])
def test_u_and_medians_with_ties(frame, rows_per_range):
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 12, 60).astype(float), rng.integers(0, 12, 45).astype(float)
    r = S.rank_sums(values(frame, a, b), rows_per_range=rows_per_range).first()
    assert r["u"] == sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert (r["median_discounted"], r["median_full_price"]) == (np.median(a), np.median(b))
    _, t = np.unique(np.concatenate([a, b]), return_counts=True)
    assert r["ties"] == float((t**3 - t).sum())


@pytest.mark.parametrize(
    "make, test",
    [(lambda g, m: g.normal(m, 6, 410), "welch_t"), (lambda g, m: g.lognormal(np.log(m), 1, 410), "mann_whitney")],
)
def test_choice_of_test(frame, make, test):
    g = np.random.default_rng(2718)
    r = S.hypothesis_test(values(frame, make(g, 31), make(g, 47))).first()
    assert r["test"] == test and r["significant"] and r["effect_size"] < 0


def test_equal_groups_and_summary(frame):
    same = np.random.default_rng(3).normal(7, 1, 25)
    result = S.hypothesis_test(values(frame, same, same))
    r = S.result_summary(result).first()
    assert not r["significant"] and "no significant difference" in r["summary"]


def test_summary_of_a_difference(frame):
    skewed = [1, 1, 1, 1, 1, 1, 1, 1, 1, 5000]
    r = S.result_summary(S.hypothesis_test(values(frame, range(10, 40), skewed * 3))).first()
    assert r["significant"] and "higher for discounted products" in r["summary"] and "Caution" in r["summary"]


def test_small_probabilities_keep_their_digits(frame):
    df = frame([(0.04,), (1e-4,), (2.01e-5,), (1.0,), (None,)], "p double")
    assert [r[0] for r in df.select(p_text("p")).collect()] == ["0.0400", "0.0001", "2.01e-05", "1.0000", "null"]


def test_group_summary_has_medians(frame):
    rng = np.random.default_rng(8)
    a, b = rng.exponential(30, 151), rng.normal(4, 3, 90)
    for per_range in (1_000_000, 20):
        r = S.group_summary(values(frame, a, b), rows_per_range=per_range).first()
        assert r["median_discounted"] == pytest.approx(np.median(a)) and r["median_full_price"] == pytest.approx(np.median(b))
        assert r["n_discounted"] == 151 and r["mean_full_price"] == pytest.approx(b.mean())


def test_segments_side_by_side(frame):
    df = values(frame, range(10, 30), range(40)).withColumn("s", F.lit("a")).unionByName(
        values(frame, range(5), range(5, 10)).withColumn("s", F.lit("b"))
    )
    got = {r["s"]: r for r in S.hypothesis_test(df, segments=["s"], rows_per_range=4).collect()}
    assert got["a"]["n_discounted"] == 20 and got["b"]["n_full_price"] == 5
    assert got["a"]["median_discounted"] == 19.5


def test_magnitude(frame):
    df = frame([(0.1,), (-0.3,), (0.6,), (0.9,)], "e double")
    labels = [tuple(r) for r in df.select(S.magnitude(F.col("e"), F.lit("welch_t")), S.magnitude(F.col("e"), F.lit("x"))).collect()]
    assert [a for a, _ in labels] == ["negligible", "small", "medium", "large"]
    assert [b for _, b in labels] == ["small", "medium", "large", "large"]


def test_assignment(spark):
    df = spark.range(5000, 8500)
    split = lambda seed: {r["id"] for r in X.assign(df, "id", seed).where("group = 'treatment'").collect()}
    assert abs(len(split(17)) - 1750) < 150
    assert split(17) == split(17) and split(17) != split(903)


def test_required_sample_size(spark):
    one = spark.range(1)
    need = lambda *a: one.select(X.required_sample_size(*a)).first()[0]
    assert [need(d) for d in (0.2, 0.5, 0.8)] == [394, 64, 26]
    assert need(0.5, 0.05, 0.9) > 64 and need(0.0) is None


def arms(frame, a, b):
    return frame([("treatment", float(v)) for v in a] + [("control", float(v)) for v in b], "group string, value double")


def test_ab_large_effect_and_wording(frame):
    g = np.random.default_rng(31)
    low = g.normal(12, 2, 73)
    result = X.ab_test(arms(frame, low + 3.5, low))  # a known shift
    r = X.ab_summary(result, required_n=10).first()
    assert r["p_value"] < 0.001 and r["effect_size"] > 0.8 and r["ci_low"] < 3.5 < r["ci_high"]
    assert "meets" in r["summary"] and "SIMULATED" in r["summary"] and "false positive" in r["summary"]
    assert "falls short of" in X.ab_summary(result, required_n=10_000).first()["summary"]


def test_ab_equal_groups(frame):
    same = np.random.default_rng(4).uniform(10, 11, 31)
    r = X.ab_summary(X.ab_test(arms(frame, same, same))).first()
    assert not r["significant"] and r["required_n"] == 64 and "no significant" in r["summary"]


def test_pricing_scenario(frame):
    one = frame([(900.0, 400.0, 30)], "median_discounted double, median_full_price double, n_full_price bigint")
    got = {r["share"]: r for r in X.pricing_scenario(one).collect()}
    assert got[0.2]["annual_impact"] == pytest.approx(3000.0) and got[0.2]["monthly_impact"] == pytest.approx(250.0)
