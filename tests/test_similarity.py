"""Neighbours against brute force, with cells and chunks small enough to be many."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.operators import similarity as S


def brute(data, k, blocks=None):
    x = np.array([v for _, v in data], dtype=float)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    u = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
    scores = np.round(u @ u.T, 6) + 0.0
    out = set()
    for i, (a, _) in enumerate(data):
        others = [j for j in range(len(data)) if j != i and (blocks is None or blocks[i] == blocks[j])]
        others.sort(key=lambda j: (-scores[i, j], data[j][0]))
        out |= {(a, data[j][0], scores[i, j], r + 1) for r, j in enumerate(others[:k])}
    return out


def found(df):
    return {tuple(r) for r in df.collect()}


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 4)) * 4
    data = [(i, (centres[i % 6] + rng.normal(size=4)).round(2).tolist()) for i in range(120)]
    data += [(200 + i, data[0][1]) for i in range(60)]  # a third of all rows are copies
    data += [(300, [0.0] * 4), (301, [0.0] * 4), (302, [2 * v for v in data[1][1]])]
    return data


@pytest.mark.parametrize("pivots, chunk", [(1, 4096), (1, 16), (9, 4096), (9, 8), (40, 16)])
def test_exact_topk(frame, vectors, pivots, chunk):
    df = frame(vectors, "id bigint, v array<double>")
    assert found(S.cosine_topk(df, 4, "id", "v", pivots=pivots, chunk=chunk)) == brute(vectors, 4)


def test_exact_topk_within_blocks(frame, vectors):
    df = frame(vectors, "id bigint, v array<double>").withColumn("b", F.col("id") % 3)
    got = S.cosine_topk(df, 3, "id", "v", within=F.col("b"), pivots=5, chunk=16)
    assert found(got) == brute(vectors, 3, [i % 3 for i, _ in vectors])


def test_written_tables_grow_with_the_rows(frame, monkeypatch):
    """In spread-out vectors no cell is ruled out; what is written still holds no row for each pair of a row and a cell."""
    rng = np.random.default_rng(5)
    data = [(i, rng.normal(size=12).tolist()) for i in range(300)]
    sizes, durable = {}, S.durable
    monkeypatch.setattr(S, "durable", lambda df, label="table": sizes.setdefault(label, durable(df, label)))
    assert found(S.cosine_topk(frame(data, "id bigint, v array<double>"), 3, "id", "v", pivots=16, chunk=32)) == brute(data, 3)
    assert max(df.count() for df in sizes.values()) <= len(data)


def test_text_ids_and_few_rows(frame):
    data = [("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [0.0, 1.0])]
    got = found(S.cosine_topk(frame(data, "id string, v array<double>"), 10, "id", "v"))
    assert got == {("a", "b", 1.0, 1), ("a", "c", 0.0, 2), ("b", "a", 1.0, 1), ("b", "c", 0.0, 2), ("c", "a", 0.0, 1), ("c", "b", 0.0, 2)}


def test_lsh_recall(frame):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 24))
    data = [(i, (centres[i % 40] + rng.normal(size=24) * 0.2).tolist()) for i in range(600)]
    df = frame(data, "id bigint, v array<double>")
    near = S.cosine_topk_lsh(df, 5, "id", "v")
    assert S.recall(near, S.cosine_topk(df, 5, "id", "v"), "id").first()["recall"] >= 0.9
    assert near.count() <= 5 * 600


def test_lsh_holds_a_vector_once(frame, vectors, monkeypatch):
    """No table has a row for each hash table, and the pairs are those found bucket by bucket, with few or many in one bucket."""
    rng = np.random.default_rng(8)
    for data in (vectors, [(i, rng.normal(size=10).tolist()) for i in range(300)]):
        df = frame(data, "id bigint, v array<double>")
        for tables, projections in ((16, 8), (3, 4), (2, 12)):
            sizes, durable = {}, S.durable
            with monkeypatch.context() as m:
                m.setattr(S, "durable", lambda df, label="table": sizes.setdefault(label, durable(df, label)))
                near = found(S.cosine_topk_lsh(df, 4, "id", "v", tables=tables, projections=projections, chunk=32))
                assert max(t.count() for t in sizes.values()) <= len(data)
            with monkeypatch.context() as m:
                m.setattr(S, "MEETS", -1, raising=False)
                m.setattr(S, "max", min, raising=False)
                assert near == found(S.cosine_topk_lsh(df, 4, "id", "v", tables=tables, projections=projections, chunk=32))
            assert near


def test_lsh_recall_query_places_vectors_once(spark, monkeypatch):
    from sparkmart.plans.catalog import all_queries

    labels, durable = [], S.durable
    monkeypatch.setattr(S, "durable", lambda df, label="table": labels.append(label) or durable(df, label))
    assert 0.9 <= all_queries()["q_lsh_recall"].run(spark, "/root/testdata/sf0.001").first()["recall"] <= 1.0
    assert labels.count("placed") == 1 and labels.count("opened-blocks") == 2


FEATURES = (
    "product_id string, product_name string, brand string, brand_encoded bigint, listing_price double, "
    "discount double, revenue double, rating double, review_count double, cluster_label string"
)


@pytest.fixture
def scaled(frame):
    rows = [
        ("P001", "Shoe A", "A", 0, 100.0, 0.2, 8.0, 4.5, 50.0, "x"),
        ("P002", "Shoe B", "B", 1, 150.0, 0.0, 5.0, 3.0, 30.0, "y"),
        ("P003", "Shoe C", "A", 0, 101.0, 0.2, 8.1, 4.4, 52.0, "x"),
        ("P004", "Shoe D", "B", 1, 80.0, 0.5, 2.0, 2.0, 5.0, "z"),
        ("P005", "Shoe C", "A", 0, 104.0, 0.2, 8.2, 4.3, 49.0, "y"),
        ("P005", "Shoe C", "A", 0, 104.0, 0.2, 8.2, 4.3, 49.0, "y"),
        ("P006", "Shoe E", "A", 0, None, 0.2, 8.2, 4.3, 49.0, "y"),
    ]
    return S.scaled_features(frame(rows, FEATURES))


def names(df):
    return [r["product_name"] for r in df.collect()]


def test_recommend(scaled):
    got = S.recommend(scaled, "P001", 2)
    assert names(got) == ["Shoe C", "Shoe C"]
    assert S.recommend(scaled, "P001", 100).count() == 4
    assert S.recommend(scaled, "unknown", 5).count() == 0
    assert "P001" not in [r["product_id"] for r in S.recommend(scaled, "P001", 100).collect()]
    scores = [r["similarity_score"] for r in S.recommend(scaled, "P001", 100).collect()]
    assert scores == sorted(scores, reverse=True)


def test_recommend_in_cluster(scaled):
    assert names(S.recommend(scaled, "P001", 5, within="cluster_label")) == ["Shoe C"]
    assert S.recommend(scaled, "P004", 5, within="cluster_label").count() == 0
    assert S.recommend(scaled, "P001", 5, within="no_such_column").count() == 4


def test_recommend_names(scaled):
    got = S.recommend_names(scaled, "P001", 3).collect()
    assert [r["product_name"] for r in got] == ["Shoe C", "Shoe B", "Shoe D"]
    assert got[0]["similarity"].endswith("%") and got[0]["price"] == "101"


def test_stored_neighbours(spark, scaled, tmp_path):
    path = str(tmp_path / "n")
    with pytest.raises(FileNotFoundError):
        S.stored_neighbours(spark, path, "P001", scaled)
    S.save_neighbours(S.feature_neighbours(scaled, 3), path, buckets=4)
    served = S.stored_neighbours(spark, path, "P001", scaled, 2, buckets=4)
    assert [r["neighbour_id"] for r in served.collect()] == [r["product_id"] for r in S.recommend(scaled, "P001", 2).collect()]
    assert "PartitionFilters: [isnotnull(bucket" in served._jdf.queryExecution().toString()


def test_cluster_label_default(frame):
    f = frame([("a",), ("b",)], "product_id string")
    c = frame([("a", "Premium")], "product_id string, cluster_label string")
    assert {tuple(r) for r in S.with_cluster_label(f, c).collect()} == {("a", "Premium"), ("b", "Unknown")}
    assert {r["cluster_label"] for r in S.with_cluster_label(f, None).collect()} == {"Unknown"}
