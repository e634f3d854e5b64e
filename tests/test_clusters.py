import numpy as np
import pytest

from sparkmart.operators import clusters as C
from sparkmart.sources.sinks import read_current

SCHEMA = (
    "product_id string, brand string, listing_price double, discount double, revenue double, "
    "rating double, review_count double"
)


@pytest.fixture
def products(frame):
    """Three planted groups of 4, 5 and 6 products, each near a centre of its own."""
    rng = np.random.default_rng(8)
    centres = [(4, (20.0, 0.05, 1.0, 1.5, 5.0)), (5, (60.0, 0.25, 3.5, 3.0, 40.0)), (6, (140.0, 0.45, 7.5, 4.5, 90.0))]
    data = [
        (f"c{n}-{k}", "XYZ"[k % 3], *(float(v) for v in np.array(c) * rng.uniform(0.98, 1.02, 5)))
        for n, c in centres
        for k in range(n)
    ]
    return frame(data, SCHEMA)


def test_three_ordered_tiers_twice_the_same(products):
    runs = [sorted(tuple(r) for r in C.product_clusters(products, restarts=2).collect()) for _ in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) == 15
    means = {}
    for _, label, number, revenue in runs[0]:
        means.setdefault((number, label), []).append(revenue)
    assert [k for k in sorted(means)] == [(0, "Low Performer"), (1, "Mid Tier"), (2, "Premium")]
    ordered = [sum(v) / len(v) for _, v in sorted(means.items())]
    assert ordered == sorted(ordered)
    assert [len(v) for _, v in sorted(means.items())] == [4, 5, 6]


def test_empty_input_writes_nothing(spark, products, tmp_path):
    path = str(tmp_path / "clusters")
    assert C.build_clusters(products.limit(0), path).count() == 0
    assert read_current(spark, path) is None
    assert C.cluster_counts(C.build_clusters(products, path, restarts=1)).count() == 3


def test_tuning_and_registry(spark, products, tmp_path):
    runs = C.tune_k(products, range(2, 5), model_folder=str(tmp_path / "runs"))
    found = runs.collect()
    assert [r["n_clusters"] for r in found] == [2, 3, 4]
    assert all(-1 <= r["silhouette_score"] <= 1 for r in found)
    assert C.best_run(runs)["n_clusters"] == 3
    folder = str(tmp_path / "models")
    assert [C.save_best_model(runs, folder)["version"] for _ in range(2)] == [1, 2]
    assert C.production_model(spark, folder).getK() == 3
    with pytest.raises(FileNotFoundError):
        C.production_model(spark, str(tmp_path / "none"))


def test_compare_runs(frame):
    runs = frame([("a", 2, 0.3, 1.0, None), ("b", 5, 0.7, 1.0, None), ("c", 7, 0.5, 1.0, None)], C.RUNS)
    assert C.best_run(runs)["n_clusters"] == 5
    with pytest.raises(ValueError):
        C.best_run(runs.limit(0))


def test_elbow_falls(products):
    inertia = [r["inertia"] for r in C.elbow(products, range(2, 5), restarts=2).orderBy("k").collect()]
    assert inertia == sorted(inertia, reverse=True)


def test_fits_overlap_and_choose_as_one_by_one(products, monkeypatch):
    points = C.cluster_input(products)
    plain = [C.KMeans(k=3, seed=42 + i, featuresCol="scaled", predictionCol="_raw").fit(points) for i in range(4)]
    running, most, fit = [], [], C.KMeans.fit

    def watched(self, df):
        running.append(1)
        most.append(len(running))
        model = fit(self, df)
        running.pop()
        return model

    monkeypatch.setattr(C.KMeans, "fit", watched)
    models = C.best_models(points, [2, 3], restarts=4)
    assert list(models) == [2, 3] and len(most) == 8 and max(most) > 1
    assert models[3].summary.trainingCost == min(m.summary.trainingCost for m in plain)
