"""Clusters, similarity and recommendations over features and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators import clusters as C
from sparkmart.operators import features as FE
from sparkmart.operators import similarity as S
from sparkmart.operators.marts import keep_best
from sparkmart.plans.layer_queries import CLEAN_SQL, FEATURE_SQL, features_of
from sparkmart.plans.registry import Registry, Tables
from sparkmart.session import durable, new_folder

_Z = [f"{c}_z" for c in FE.FEATURE_COLS]
_VECTOR = f"[{', '.join(_Z)}]"
TIER = "CASE WHEN brand_encoded % 3 = 0 THEN 'a' WHEN brand_encoded % 3 = 1 THEN 'b' ELSE 'c' END"


def _cosine(a: str, b: str) -> str:
    return f"COALESCE(list_cosine_similarity({a}, {b}), 0e0)"


def _nearest_sql(source: str, key: str, vector: str, k: int, same: str = "TRUE") -> str:
    return f"""
        SELECT {key}, neighbour_id, score, rank FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY score DESC, neighbour_id) AS rank FROM (
                SELECT a.{key}, b.{key} AS neighbour_id, ROUND({_cosine(f'a.{vector}', f'b.{vector}')}, 6) + 0e0 AS score
                FROM {source} a JOIN {source} b ON a.{key} <> b.{key} AND {same})) WHERE rank <= {k}"""


R = Registry(
    {
        **CLEAN_SQL,
        **FEATURE_SQL,
        "once": """SELECT * FROM {scaled} QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY product_name) = 1""",
        "points": f"SELECT *, {_VECTOR} AS v, {TIER} AS cluster_label FROM {{once}}",
        "vectors": "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings",
        "asked": "SELECT * FROM {points} ORDER BY revenue DESC, product_id LIMIT 1",
        "alike": f"""
            SELECT p.*, ROUND({_cosine('p.v', 'a.v')}, 9) + 0e0 AS similarity, a.cluster_label AS asked_label
            FROM {{points}} p, {{asked}} a WHERE p.product_id <> a.product_id""",
        "tiers": """
            SELECT f.product_id, f.revenue, f.listing_price, t.cluster_id, t.cluster_label
            FROM {features} f JOIN (
                SELECT raw, cluster_id, ['Low Performer', 'Mid Tier', 'Premium'][cluster_id + 1] AS cluster_label
                FROM (SELECT brand_encoded % 3 AS raw, ROW_NUMBER() OVER (ORDER BY AVG(revenue)) - 1 AS cluster_id
                      FROM {features} GROUP BY 1)) t ON f.brand_encoded % 3 = t.raw""",
    }
)


def _features(t: Tables) -> DataFrame:
    return durable(features_of(t), "features")


def _scaled(t: Tables, label: bool = False) -> DataFrame:
    scaled = S.scaled_features(_features(t))
    if not label:
        return scaled
    code = F.col("brand_encoded") % 3
    return scaled.withColumn("cluster_label", F.when(code == 0, "a").when(code == 1, "b").otherwise("c"))


def _top_seller(scaled: DataFrame):
    return scaled.orderBy(F.desc("revenue"), "product_id").first()["product_id"]


def _tiers(t: Tables) -> DataFrame:
    """Tier names for a given assignment (brand code modulo 3)."""
    return C.stable_labels(_features(t).withColumn("_raw", F.col("brand_encoded") % 3))


# --- clusters ------------------------------------------------------------------------------

R.add(
    "q_stable_cluster_label",
    lambda t: _tiers(t).withColumn("log_revenue", F.round("log_revenue", 9)),
    "SELECT product_id, cluster_label, cluster_id, ROUND(revenue, 9) AS log_revenue FROM {tiers}",
)
R.add(
    "q_cluster_counts",
    lambda t: C.cluster_counts(_tiers(t)),
    "SELECT cluster_label, COUNT(*) AS product_count FROM {tiers} GROUP BY cluster_label",
)


def _cluster_feature_join(t: Tables) -> DataFrame:
    features = _features(t)
    tiers = C.stable_labels(features.withColumn("_raw", F.col("brand_encoded") % 3))
    return C.cluster_features(tiers, features).select("product_id", "cluster_label", "listing_price")


R.add(
    "q_cluster_feature_join",
    _cluster_feature_join,
    "SELECT product_id, cluster_label, listing_price FROM {tiers}",
)


def _left_merge(t: Tables) -> DataFrame:
    features = _features(t)
    tiers = C.stable_labels(features.withColumn("_raw", F.col("brand_encoded") % 3))
    known = S.with_cluster_label(features, tiers.where(F.col("cluster_id") > 0))
    unknown = S.with_cluster_label(features, None)
    return known.groupBy("cluster_label").count().unionByName(unknown.groupBy("cluster_label").count()).select(
        "cluster_label", F.col("count").alias("product_count")
    )


R.add(
    "q_left_merge_default",
    _left_merge,
    """SELECT CASE WHEN cluster_id > 0 THEN cluster_label ELSE 'Unknown' END AS cluster_label, COUNT(*) AS product_count
       FROM {tiers} GROUP BY 1 UNION ALL SELECT 'Unknown', COUNT(*) FROM {features}""",
)
R.add("q_build_clusters", lambda t: C.product_clusters(_features(t)))
R.add("q_elbow", lambda t: C.elbow(_features(t)))
R.add("q_tune_k", lambda t: C.compare_runs(C.tune_k(_features(t))))


def _given_runs(t: Tables) -> DataFrame:
    """Trials derived from the data: one per brand code below 7, scored by its mean discount."""
    f = _features(t).where(F.col("brand_encoded") < 7)
    return f.groupBy("brand_encoded").agg(F.round(F.avg("discount"), 6).alias("silhouette_score")).select(
        F.concat(F.lit("run-"), F.col("brand_encoded").cast("string")).alias("run_name"),
        (F.col("brand_encoded") + 2).cast("int").alias("n_clusters"),
        "silhouette_score",
    )


R.add(
    "q_runs_compare",
    lambda t: C.compare_runs(_given_runs(t)),
    """SELECT 'run-' || brand_encoded AS run_name, CAST(brand_encoded + 2 AS INTEGER) AS n_clusters,
              ROUND(AVG(discount), 6) AS silhouette_score FROM {features} WHERE brand_encoded < 7 GROUP BY brand_encoded""",
)

# --- similarity -----------------------------------------------------------------------------

R.add(
    "q_cosine_topk",
    lambda t: S.cosine_topk(t.embeddings, 5, "vec_id", "embedding"),
    _nearest_sql("{vectors}", "vec_id", "v", 5),
)
R.add(
    "q_cosine_topk_by_label",
    lambda t: S.cosine_topk(t.embeddings, 5, "vec_id", "embedding", within=F.col("label")),
    _nearest_sql("{vectors}", "vec_id", "v", 5, "a.label = b.label"),
)
R.add(
    "q_feature_neighbours",
    lambda t: S.feature_neighbours(_scaled(t), 5),
    _nearest_sql("{points}", "product_id", "v", 5),
)


def _vectors(t: Tables) -> DataFrame:
    return durable(_scaled(t).select("product_id", F.array(*_Z).alias("v")), "vectors")


def _lsh_recall(t: Tables) -> DataFrame:
    rows = _vectors(t)
    once = S.prepare(rows, 5, "product_id", "v")
    exact = durable(S.cosine_topk(rows, 5, "product_id", "v", prepared=once), "exact")
    return S.recall(S.cosine_topk_lsh(rows, 5, "product_id", "v", prepared=once), exact, "product_id")


R.add("q_cosine_topk_lsh", lambda t: S.cosine_topk_lsh(_vectors(t), 5, "product_id", "v"))
R.add("q_lsh_recall", _lsh_recall)

# --- recommendations for the best-selling product ------------------------------------------------


def _ask(t: Tables, make, label: bool = False) -> DataFrame:
    scaled = _scaled(t, label)
    return make(scaled, _top_seller(scaled))


_SHOWN = """product_id, product_name, brand, ROUND(listing_price, 2) AS listing_price, ROUND(rating, 2) AS rating,
            ROUND(revenue, 2) AS revenue, ROUND(similarity, 4) AS similarity_score"""
R.add(
    "q_recommend",
    lambda t: _ask(t, lambda s, p: S.recommend(s, p, 5)),
    f"SELECT {_SHOWN} FROM {{alike}} ORDER BY similarity DESC, product_id LIMIT 5",
)
R.add(
    "q_recommend_in_cluster",
    lambda t: _ask(t, lambda s, p: S.recommend(s, p, 5, within="cluster_label"), label=True),
    f"SELECT {_SHOWN} FROM {{alike}} WHERE cluster_label = asked_label ORDER BY similarity DESC, product_id LIMIT 5",
)
R.add(
    "q_recommend_dedup",
    lambda t: _ask(t, lambda s, p: S.recommend_names(s, p, 5)),
    """SELECT product_name, brand, printf('%.0f', listing_price) AS price, printf('%.2f', rating) AS rating,
              format('{:,.0f}', exp(revenue) - 1) AS revenue, printf('%.1f', similarity * 100) || '%' AS similarity
       FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_name ORDER BY similarity DESC, product_id) AS rn
             FROM {alike})
       WHERE rn = 1 ORDER BY similarity DESC, product_id LIMIT 5""",
)


def _stored(t: Tables) -> DataFrame:
    scaled = _scaled(t)
    path = new_folder(t.spark, "neighbours")
    S.save_neighbours(S.feature_neighbours(scaled, 10), path)
    return S.stored_neighbours(t.spark, path, _top_seller(scaled), scaled, 5)


R.add(
    "q_stored_neighbours",
    _stored,
    """SELECT product_id AS neighbour_id, product_name, brand, ROUND(similarity, 6) AS score,
              ROW_NUMBER() OVER (ORDER BY ROUND(similarity, 6) DESC, product_id) AS rank
       FROM {alike} ORDER BY rank LIMIT 5""",
)
