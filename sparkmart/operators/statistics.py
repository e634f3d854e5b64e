"""Comparison of two groups of values, for any number of segments at once.

Moments come from one aggregation, ranks and medians from one sorted pass over distinct
values; neither needs a group in one task. Only the final rows, one per segment, meet the
probability functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions.distributions import normal_p, normal_quantile, t_p
from sparkmart.functions.exprs import case_when, exact_avg, p_text
from sparkmart.operators.ordering import ROWS_PER_RANGE, exact_quantiles, join_groups, quantile_columns, running_totals

ALPHA = 0.05
SKEW_LIMIT = 0.5
# Conventional effect-size limits (negligible, small, medium; above is large).
MAGNITUDES = {"welch_t": (0.2, 0.5, 0.8), "mann_whitney": (0.1, 0.3, 0.5)}
GROUPS = ("discounted", "full_price")


def revenue_groups(finance: DataFrame, *segments: str) -> DataFrame:
    """(segments, group, value): rows with a discount against rows at exactly zero."""
    d = F.col("discount")
    group = F.when(d > 0, F.lit(GROUPS[0])).when(d == 0, F.lit(GROUPS[1]))
    rows = finance.select(*segments, group.alias("group"), F.col("revenue").alias("value"))
    return rows.where(F.col("group").isNotNull() & F.col("value").isNotNull())


def _per_group(values: DataFrame, groups: Sequence[str], segments: Sequence[str], make) -> DataFrame:
    """Conditional aggregates of both groups in one pass; ``make(value)`` gives {name: aggregate}."""
    aggregates = []
    for g in groups:
        x = F.when(F.col("group") == g, F.col("value"))
        aggregates += [a.alias(f"{name}_{g}") for name, a in make(x).items()]
    return values.groupBy(*segments).agg(*aggregates)


def group_moments(values: DataFrame, groups: Sequence[str] = GROUPS, segments: Sequence[str] = ()) -> DataFrame:
    """n, mean, sample deviation, population skew and excess kurtosis of both groups."""
    return _per_group(
        values,
        groups,
        segments,
        lambda x: {
            "n": F.count(x),
            "mean": exact_avg(x),
            "std": F.stddev_samp(x),
            "skew": F.skewness(x),
            "kurtosis": F.kurtosis(x),
        },
    )


def rank_sums(
    values: DataFrame,
    groups: Sequence[str] = GROUPS,
    segments: Sequence[str] = (),
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Per segment: medians of both groups, U of the first group and the tie term sum(t^3 - t).

    Equal values are counted first; a value with t rows and w rows below it has the average
    rank w + (t + 1) / 2. Ranks are doubled to stay whole and summed as decimals.
    """
    a, b = groups
    is_first = F.col("group") == a
    counts = values.groupBy(*segments, "value").agg(
        F.count_if(is_first).alias("n1"), F.count_if(~is_first).alias("n2")
    )
    totals = running_totals(counts, "value", ["n1", "n2"], segments, rows_per_range=rows_per_range)
    whole = lambda c: c.cast("decimal(38,0)")
    t = F.col("n1") + F.col("n2")
    doubled_rank = F.lit(2) * (F.col("before_n1") + F.col("before_n2")) + t + 1
    td = t.cast("double")
    picks1, (median1,) = quantile_columns("value", "n1", {"m1": 0.5})
    picks2, (median2,) = quantile_columns("value", "n2", {"m2": 0.5})
    sums = totals.groupBy(*segments).agg(
        F.sum((whole(F.col("n1")) * whole(doubled_rank)).cast("decimal(38,0)")).alias("r2"),
        F.sum(td * td * td - td).alias("ties"),
        F.max("total_n1").alias("n1"),
        F.max("total_n2").alias("n2"),
        *picks1,
        *picks2,
    )
    n1 = whole(F.col("n1"))
    return sums.select(
        *segments,
        median1.alias(f"median_{a}"),
        median2.alias(f"median_{b}"),
        ((F.col("r2") - (n1 * (n1 + 1)).cast("decimal(38,0)")).cast("double") / 2.0).alias("u"),
        "ties",
        F.col("n1").cast("bigint").alias("n1"),
        F.col("n2").cast("bigint").alias("n2"),
    )


def group_summary(
    values: DataFrame,
    groups: Sequence[str] = GROUPS,
    segments: Sequence[str] = (),
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``group_moments`` with the exact median of each group beside them."""
    medians = rank_sums(values, groups, segments, rows_per_range).select(*segments, *(f"median_{g}" for g in groups))
    return _joined(group_moments(values, groups, segments), medians, segments)


def _joined(left: DataFrame, right: DataFrame, segments: Sequence[str]) -> DataFrame:
    """Two frames with one row per segment, side by side."""
    if segments:
        return join_groups(left, right, segments)
    row = right.select(F.struct("*")).scalar()  # one row without segments
    return left.withColumn("_r", row).select("*", "_r.*").drop("_r")


# --- columns over one row per comparison ------------------------------------------------


def jarque_bera(n: Column, skew: Column, kurtosis: Column) -> Column:
    return n / 6.0 * (skew * skew + kurtosis * kurtosis / 4.0)


def welch(n1, m1, s1, n2, m2, s2) -> tuple[Column, Column]:
    """t and its degrees of freedom."""
    v1, v2 = s1 * s1 / n1, s2 * s2 / n2
    t = F.try_divide(m1 - m2, F.sqrt(v1 + v2))
    return t, F.try_divide((v1 + v2) * (v1 + v2), v1 * v1 / (n1 - 1) + v2 * v2 / (n2 - 1))


def cohens_d(n1, m1, s1, n2, m2, s2) -> Column:
    pooled = F.sqrt(F.try_divide((n1 - 1) * s1 * s1 + (n2 - 1) * s2 * s2, n1 + n2 - 2))
    return F.try_divide(m1 - m2, pooled)


def rank_biserial(u, n1, n2) -> Column:
    return F.try_divide(u * 2.0, n1 * n2) - 1.0


def mann_whitney_z(u, n1, n2, ties) -> Column:
    """Normal score of the larger U with tie and continuity correction."""
    n = n1 + n2
    larger = F.greatest(u, n1 * n2 - u)
    variance = n1 * n2 / 12.0 * ((n + 1) - F.try_divide(ties, n * (n - 1)))
    return F.try_divide(larger - n1 * n2 / 2.0 - 0.5, F.sqrt(variance))


def magnitude(effect: Column, test: Column) -> Column:
    def labels(limits: Sequence[float]) -> Column:
        a = F.abs(effect)
        return case_when(
            (a < limits[0], "negligible"), (a < limits[1], "small"), (a < limits[2], "medium"), otherwise="large"
        )

    return F.when(test == "welch_t", labels(MAGNITUDES["welch_t"])).otherwise(labels(MAGNITUDES["mann_whitney"]))


# --- reports ------------------------------------------------------------------------------


def _d(name: str) -> Column:
    return F.col(name).cast("double")


def normality_profile(moments: DataFrame, groups: Sequence[str] = GROUPS) -> DataFrame:
    """Adds jb_, normal_p_ and is_normal_ for each group, over all its rows.

    A group passes when its Jarque-Bera probability exceeds 5 % and it is close to symmetric.
    """
    out = moments
    for g in groups:
        jb = jarque_bera(_d(f"n_{g}"), _d(f"skew_{g}"), _d(f"kurtosis_{g}"))
        out = out.withColumn(f"jb_{g}", jb)
        out = out.withColumn(f"normal_p_{g}", F.exp(-F.col(f"jb_{g}") / 2.0))
        passed = (F.col(f"normal_p_{g}") > ALPHA) & (F.abs(F.col(f"skew_{g}")) < SKEW_LIMIT)
        out = out.withColumn(f"is_normal_{g}", F.coalesce(passed, F.lit(False)))
    return out


def choose_test(profile: DataFrame, groups: Sequence[str] = GROUPS) -> DataFrame:
    a, b = groups
    return profile.withColumn(
        "test", case_when((F.col(f"is_normal_{a}") & F.col(f"is_normal_{b}"), "welch_t"), otherwise="mann_whitney")
    )


def welch_test(moments: DataFrame, groups: Sequence[str] = GROUPS, with_p: bool = True) -> DataFrame:
    """Adds t, df, cohens_d and, with ``with_p``, the two-sided p."""
    a, b = groups
    args = [_d(f"{x}_{g}") for g in (a, b) for x in ("n", "mean", "std")]
    t, df = welch(*args)
    out = moments.withColumns({"t": t, "df": df, "cohens_d": cohens_d(*args)})
    return out.withColumn("t_p", t_p(F.col("t"), F.col("df"))) if with_p else out


def mann_whitney(ranks: DataFrame, with_p: bool = True) -> DataFrame:
    """Adds z, rank_biserial, whether the normal approximation is rough (8 rows or fewer), and p."""
    n1, n2 = _d("n1"), _d("n2")
    out = ranks.withColumns(
        {
            "z": mann_whitney_z(F.col("u"), n1, n2, F.col("ties")),
            "rank_biserial": rank_biserial(F.col("u"), n1, n2),
            "approximate": F.least(n1, n2) <= 8,
        }
    )
    if not with_p:
        return out
    # Below zero the larger U lies within the continuity correction: no evidence at all.
    return out.withColumn("u_p", F.when(F.col("z") <= 0, F.lit(1.0)).otherwise(normal_p(F.col("z"))))


def hypothesis_test(
    values: DataFrame,
    groups: Sequence[str] = GROUPS,
    segments: Sequence[str] = (),
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """One row per segment: Welch's t when both groups look normal, otherwise Mann-Whitney U."""
    a, b = groups
    profile = choose_test(normality_profile(group_moments(values, groups, segments), groups), groups)
    both = _joined(
        welch_test(profile, groups), mann_whitney(rank_sums(values, groups, segments, rows_per_range)), segments
    )
    is_t = F.col("test") == "welch_t"
    pick = lambda x, y: F.when(is_t, F.col(x)).otherwise(F.col(y))
    out = both.withColumns({"statistic": pick("t", "u"), "p_value": pick("t_p", "u_p")})
    return out.select(
        *segments,
        "test",
        "statistic",
        "p_value",
        (F.col("p_value") < ALPHA).alias("significant"),
        pick("cohens_d", "rank_biserial").alias("effect_size"),
        case_when((is_t, "cohens_d"), otherwise="rank_biserial_r").alias("effect_size_type"),
        *(f"{x}_{g}" for x in ("n", "mean", "median", "is_normal") for g in (a, b)),
    )


def result_summary(result: DataFrame, groups: Sequence[str] = GROUPS, measure: str = "revenue") -> DataFrame:
    """Adds ``summary``: one sentence per row that states the outcome and its limits."""
    a, b = groups
    named = {g: g.replace("_", "-") for g in groups}
    first, second = F.lit(named[a]), F.lit(named[b])
    label = case_when((F.col("test") == "welch_t", "Welch's t-test"), otherwise="Mann-Whitney U test")
    stat = F.when(F.col("test") == "welch_t", F.format_string("t = %.3f", "statistic")).otherwise(
        F.format_string("U = %.1f", "statistic")
    )
    evidence = F.concat(F.lit("p = "), p_text("p_value"), F.lit(", "), stat)
    mean_first = F.col(f"mean_{a}") > F.col(f"mean_{b}")
    median_first = F.col(f"median_{a}") > F.col(f"median_{b}")
    side = lambda c: F.when(c, first).otherwise(second)
    caveat = F.when(
        mean_first != median_first,
        F.concat(
            F.lit(" Caution: the mean is higher for "), side(mean_first), F.lit(" and the median for "),
            side(median_first), F.lit(" products, so a few large values drive the mean."),
        ),
    ).otherwise(F.lit(""))
    found = F.concat(
        label, F.lit(" finds a significant difference in "), F.lit(measure), F.lit(" ("),
        magnitude(F.col("effect_size"), F.col("test")), F.lit(" effect, "), evidence, F.lit("): typical "),
        F.lit(measure), F.lit(" per product is higher for "), side(F.col("effect_size") > 0), F.lit(" products."), caveat,
    )
    not_found = F.concat(
        label, F.lit(" finds no significant difference in "), F.lit(measure), F.lit(" between "), first, F.lit(" and "),
        second, F.lit(" products ("), evidence, F.lit("). A gap in totals comes from the number of products."),
    )
    return result.withColumn("summary", F.when(F.col("significant"), found).otherwise(not_found))


def qq_points(
    values: DataFrame, points: int = 19, segments: Sequence[str] = ("group",), rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """(segments, point, theoretical, observed): exact quantiles against normal quantiles."""
    at = {f"q{i}": (i + 0.5) / points for i in range(points)}
    wide = exact_quantiles(values, "value", at, segments, rows_per_range)
    pairs = F.array(
        *(
            F.struct(
                F.lit(i).cast("bigint").alias("point"),
                F.lit(normal_quantile(p)).alias("theoretical"),
                F.col(name).alias("observed"),
            )
            for i, (name, p) in enumerate(at.items())
        )
    )
    return wide.select(*segments, F.inline(pairs))
