"""Distributed ranks and quantiles against brute force, with ranges small enough to be many."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sparkmart.operators import ordering as O


def skewed(n, seed=1):
    rng = random.Random(seed)
    return [(i, 0.0 if i % 3 == 0 else round(rng.uniform(-5, 5), 1)) for i in range(n)]


@pytest.mark.parametrize("descending", [True, False])
def test_rank_over_many_ranges(frame, descending):
    data = skewed(300) + [(900, None), (901, None)]
    df = frame(data, "id int, v double")
    got = {r["id"]: r["rank"] for r in O.rank_rows(df, "v", "rank", descending, rows_per_range=20).collect()}
    known = [v for _, v in data if v is not None]
    want = {
        i: 1 + (sum(x > v for x in known) if descending else sum(x < v for x in known)) if v is not None else len(known) + 1
        for i, v in data
    }
    assert got == want
    assert {r["id"]: r["rank"] for r in O.rank_rows(df, "v", "rank", descending).collect()} == want


def test_rank_has_one_plan_at_every_size(frame):
    """Few rows and many go through ranges, and no window runs over the whole table."""
    df = frame(skewed(60), "id int, v double")
    few, many = (O.rank_rows(df, "v", "rank", rows_per_range=n) for n in (1_000_000, 7))
    plans = [d._jdf.queryExecution().optimizedPlan().toString() for d in (few, many)]
    assert all("Window" not in p for p in plans)
    assert plans[0].count("Join") == plans[1].count("Join") == 3
    assert sorted(few.collect()) == sorted(many.collect())


def test_rank_of_text(frame):
    df = frame([(f"b{i % 50:02d}",) for i in range(50)], "b string")
    got = {r["b"]: r["c"] for r in O.rank_rows(df, "b", "c", descending=False, rows_per_range=7).collect()}
    assert got == {f"b{i:02d}": i + 1 for i in range(50)}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([0.0, 0.0, 1.5, 2.25, -3.0, 8.0])), min_size=1, max_size=40))
def test_quantiles_match_numpy(frame, data):
    df = frame(data, "g string, v double")
    got = O.exact_quantiles(df, "v", {"m": 0.5, "p": 0.9}, ["g"], rows_per_range=3).collect()
    groups = {g for g, _ in data}
    assert {r["g"] for r in got} == groups
    for r in got:
        values = [v for g, v in data if g == r["g"]]
        assert r["m"] == pytest.approx(np.median(values))
        assert r["p"] == pytest.approx(np.quantile(values, 0.9))


def test_running_totals_many_ranges(frame):
    data = sorted(Counter(v for _, v in skewed(400)).items())
    df = frame(data, "v double, n bigint")
    got = O.running_totals(df, "v", ["n"], rows_per_range=5).collect()
    assert len(got) == len(data)
    for r in got:
        assert r["before_n"] == sum(n for v, n in data if v < r["v"])
        assert r["total_n"] == 400


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_bracketed_quantiles_are_exact(frame, accuracy):
    values = [v for _, v in skewed(900)] + [float(i) for i in range(100, 400)]
    random.Random(4).shuffle(values)
    got = O.exact_quantiles(
        frame([(v,) for v in values], "v double"), "v", {"a": 0.5, "b": 0.25, "c": 0.99, "d": 0.0, "e": 1.0},
        rows_per_range=50, accuracy=accuracy,
    ).first()
    assert list(got) == pytest.approx([float(np.quantile(values, p)) for p in (0.5, 0.25, 0.99, 0.0, 1.0)])


def test_quantile_outside_its_bracket_falls_back(frame, monkeypatch):
    merge_all = lambda rows, groups, probabilities, accuracy: (
        rows.agg(O.F.count("*").alias("_n"), O.F.min("_v").alias("_v")).withColumn("_kept", O.F.lit(False))
    )
    monkeypatch.setattr(O, "_bracketed", merge_all)
    got = O.exact_quantiles(frame([(float(i),) for i in range(10)], "v double"), "v", {"m": 0.5}).first()
    assert got["m"] == 4.5
