"""Global order statistics without a global sort in one task.

Ranks, quantiles and rank tests all need "how much weight lies below this value". Here
that is a running total over *distinct* values: equal values are combined before the
shuffle, so a value held by a third of all rows is one row, not a hot task. Values are cut
into ranges of a bounded number of rows, a window runs inside each range, and the totals
of the ranges (a table as long as the number of ranges) supply the offsets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.session import durable, durable_counted

ROWS_PER_RANGE = 1_000_000
SKETCH_ACCURACY = 10_000


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on group columns where a missing value is a group like any other."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same).drop(*(f"_right_{k}" for k in keys))


def _ranged(counts: DataFrame, value: str, n_rows: int, rows_per_range: int) -> DataFrame:
    """Add ``_range``, ascending with ``value``, each of about ``rows_per_range`` rows.

    The range number is the shuffle partition and is written along with the row: it is taken
    once, and a task that runs again reads it instead of drawing new range bounds.
    """
    n = max(1, math.ceil(n_rows / rows_per_range))
    ranged = counts.repartitionByRange(n, value).withColumn("_range", F.spark_partition_id())
    return durable(ranged, "ranges")


def running_totals(
    counts: DataFrame,
    value: str,
    weights: Sequence[str],
    groups: Sequence[str] = (),
    descending: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """For one row per (groups, value) and every weight column w: ``before_w`` = weight ahead of the
    row, ``total_w`` = weight of its group.

    ``counts`` is written first, because its size decides the ranges and the ranges are read twice.
    """
    counts, n_rows = durable_counted(counts, "value-counts")
    ranged = _ranged(counts, value, n_rows, rows_per_range)
    groups, weights = list(groups), list(weights)
    direction = F.desc if descending else F.asc

    within = Window.partitionBy(*groups, "_range")
    ahead = within.orderBy(direction(value)).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.withColumns({f"before_{w}": F.coalesce(F.sum(w).over(ahead), F.lit(0)) for w in weights})
    # At most one row per range and group.
    per_group = Window.partitionBy(*groups)
    earlier = per_group.orderBy(direction("_range")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*groups, "_range")
        .agg(*(F.sum(w).alias(w) for w in weights))
        .select(
            *groups,
            "_range",
            *(F.coalesce(F.sum(w).over(earlier), F.lit(0)).alias(f"_offset_{w}") for w in weights),
            *(F.sum(w).over(per_group).alias(f"total_{w}") for w in weights),
        )
    )
    joined = join_groups(out, offsets, [*groups, "_range"])
    return joined.withColumns(
        {f"before_{w}": F.col(f"before_{w}") + F.col(f"_offset_{w}") for w in weights}
    ).drop("_range", *(f"_offset_{w}" for w in weights))


def attach_by_value(rows: DataFrame, table: DataFrame, key: str, count: str, hot_over: int) -> DataFrame:
    """Join ``table`` (one row per key, ``count`` = rows holding it) to ``rows`` without a hot task.

    Keys with more than ``hot_over`` rows are broadcast: there are at most rows / hot_over of
    them. All other keys are, by the same count, too small to be hot and are shuffled. ``table``
    is read several times and should be a written one.
    """
    hot = F.broadcast(table.where(F.col(count) > hot_over))
    cold = table.where(F.col(count) <= hot_over)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key))


def rank_rows(
    df: DataFrame,
    value: str,
    name: str,
    descending: bool = True,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``rank()`` over the whole table (equal values share the lowest rank, NULLs come last)."""
    base = durable(df, "rank-input")
    known = base.where(F.col(value).isNotNull())
    counts = known.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    ranks = running_totals(counts, value, ["_n"], descending=descending, rows_per_range=rows_per_range).select(
        value, "_n", (F.col("before__n") + 1).alias(name)
    )
    ranks = durable(ranks, "ranks")
    ranked = attach_by_value(known, ranks, value, "_n", rows_per_range).drop("_n")
    missing = base.where(F.col(value).isNull()).withColumn(
        name, (known.agg(F.count(F.lit(1))).scalar() + F.lit(1)).cast("bigint")
    )
    return ranked.select(*df.columns, name).unionByName(missing)


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    groups: Sequence[str] = (),
    rows_per_range: int = ROWS_PER_RANGE,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Exact quantiles per group with linear interpolation; one column per named probability.

    The built-in ``percentile`` keeps every distinct value of a group in one task. Here a sketch
    first brackets each quantile; then all rows are counted, but only values inside a bracket
    (about 4 / accuracy of them) stay apart, and the rest collapse to one count per side. So two
    scans and a small shuffle replace a sort of the data. Should a quantile lie outside its
    bracket, all values are counted instead.
    """
    groups = list(groups)
    rows = df.select(*groups, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
    result = durable(_quantiles(_bracketed(rows, groups, probabilities, accuracy), groups, probabilities, rows_per_range), "quantiles")
    if not result.where(~F.col("_exact")).isEmpty():
        counts = rows.groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("_n")).withColumn("_kept", F.lit(True))
        result = _quantiles(counts, groups, probabilities, rows_per_range)
    return result.drop("_exact")


def _bracketed(rows: DataFrame, groups: list[str], probabilities: dict[str, float], accuracy: int) -> DataFrame:
    """Counts of (groups, value) that keep values inside the brackets and merge those between."""
    margin = 2.0 / accuracy
    asked = [q for p in probabilities.values() for q in (max(p - margin, 0.0), min(p + margin, 1.0))]
    sketch = rows.groupBy(*groups).agg(F.percentile_approx("_v", asked, accuracy).alias("_b"))
    sketch = durable(sketch, "brackets")  # one row per group; its real size decides how it is joined
    joined = join_groups(rows, sketch, groups) if groups else rows.withColumn("_b", sketch.select("_b").scalar())
    # Brackets may overlap, so regions are counted over all bounds; both are ascending in the value.
    v, m = F.col("_v"), len(probabilities)
    low, high = (lambda i: F.col("_b")[2 * i]), (lambda i: F.col("_b")[2 * i + 1])
    inside = reduce(or_, [v.between(low(i), high(i)) for i in range(m)])
    region = reduce(add, [(v >= low(i)).cast("int") + (v > high(i)).cast("int") for i in range(m)])
    kept = F.when(inside, v)
    return (
        joined.groupBy(*groups, region.alias("_region"), kept.alias("_k"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_v"))
        .select(*groups, "_v", "_n", F.col("_k").isNotNull().alias("_kept"))
    )


def _quantiles(counts: DataFrame, groups: list[str], probabilities: dict[str, float], rows_per_range: int) -> DataFrame:
    totals = running_totals(counts, "_v", ["_n"], groups, rows_per_range=rows_per_range)
    picks, outs = quantile_columns("_v", "_n", probabilities)
    # Exact when no quantile position falls into a merged region.
    hit = [
        (F.col("before__n") <= f(F.lit(p) * (F.col("total__n") - 1)))
        & (f(F.lit(p) * (F.col("total__n") - 1)) < F.col("before__n") + F.col("_n"))
        for p in probabilities.values()
        for f in (F.floor, F.ceil)
    ]
    exact = F.bool_and(F.col("_kept") | ~reduce(or_, hit)).alias("_exact")
    return totals.groupBy(*groups).agg(*picks, exact).select(*groups, *outs, "_exact")


def quantile_columns(value: str, weight: str, probabilities: dict[str, float]) -> tuple[list[Column], list[Column]]:
    """Aggregates over running totals that pick the two values around each quantile, and the
    columns that interpolate between them afterwards."""
    before, n, total = F.col(f"before_{weight}"), F.col(weight), F.col(f"total_{weight}")

    def at(position: Column) -> Column:
        return F.max(F.when((before <= position) & (position < before + n), F.col(value).cast("double")))

    picks, outs = [], []
    for name, p in probabilities.items():
        position = F.lit(p) * (total - 1)
        picks += [
            at(F.floor(position)).alias(f"_{name}_lo"),
            at(F.ceil(position)).alias(f"_{name}_hi"),
            F.max(position - F.floor(position)).alias(f"_{name}_f"),
        ]
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        outs.append((low + (high - low) * F.col(f"_{name}_f")).alias(name))
    return picks, outs
