"""The whole job: snapshot and event ingest, gates, clean layer, marts, features, models.

Every step reads what the step before published and publishes its own tables after their
checks, so a failed run leaves the last good version in place and can be started again.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from sparkmart.operators import clusters, features, incremental, marts, quality, similarity
from sparkmart.operators.clean import clean_all
from sparkmart.session import durable
from sparkmart.sources.sinks import overwrite, read_current

CATALOGUE = ("finance", "brands", "info", "reviews", "traffic")


def _current(spark: SparkSession, folder: str, name: str) -> DataFrame:
    table = read_current(spark, os.path.join(folder, name))
    if table is None:
        raise FileNotFoundError(f"no published version of {name} below {folder}")
    return table


def build_marts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All marts from the clean layer: written, checked together, and only then published as tables of their own."""
    finance, brands, info, traffic = (
        _current(spark, folder, f"clean_{t}") for t in ("finance", "brands", "info", "traffic")
    )
    built = {
        "brand_revenue": marts.brand_revenue(finance, brands),
        "product_revenue": marts.product_revenue(finance, info, brands),
        "monthly_traffic": marts.monthly_traffic(traffic),
        "discount_impact": marts.discount_impact(finance),
    }
    totals = incremental.cumulative_per_product(spark, folder)
    if totals is not None:
        totals = totals.withColumn("product_id", totals["product_id"].cast(info.schema["product_id"].dataType))
        built["event_revenue"] = marts.event_revenue(totals, info, brands)
    written = {name: durable(df, f"mart-{name}") for name, df in built.items()}
    quality.enforce(quality.mart_gate(written).unionByName(quality.constraint_suite(written, quality.MART_CONSTRAINTS)))
    return {name: overwrite(df, os.path.join(folder, f"analytics_{name}")) for name, df in written.items()}


def run(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    events: DataFrame | None,
    folder: str,
    min_rows: int = 100,
    neighbours: int = 10,
    restarts: int = 10,
) -> dict[str, object]:
    """Run all steps in order; an exception ends the run. Returns what each step did."""
    done: dict[str, object] = {}
    done["raw_rows"] = incremental.ingest_snapshot(sources, folder)
    done["new_events"] = incremental.ingest_incremental(events, folder)

    raw = {t: _current(spark, folder, f"raw_{t}") for t in CATALOGUE}
    quality.enforce(quality.raw_gate(raw, events, min_rows))
    done["clean_rows"] = clean_all(raw, folder)
    layer = {f"clean_{t}": _current(spark, folder, f"clean_{t}") for t in CATALOGUE}
    quality.enforce(quality.constraint_suite(layer, quality.CLEAN_CONSTRAINTS))

    built = build_marts(spark, folder)
    done["marts"] = sorted(built)

    clean = {t: _current(spark, folder, f"clean_{t}") for t in CATALOGUE}
    table = features.build_features(
        clean["finance"], clean["info"], clean["brands"], clean["reviews"],
        os.path.join(folder, "features_products"), os.path.join(folder, "exports", "features_products"),
    )
    done["features"] = table.count()
    tiers = clusters.build_clusters(table, os.path.join(folder, "product_clusters"), restarts=restarts)
    done["clusters"] = tiers.count()
    scaled = similarity.scaled_features(table)
    pairs = similarity.feature_neighbours(scaled, neighbours)
    done["neighbour_pairs"] = similarity.save_neighbours(pairs, os.path.join(folder, "neighbours")).count()
    return done
