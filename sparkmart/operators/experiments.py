"""Simulated A/B tests, sample sizes and pricing scenarios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.distributions import normal_quantile, t_crit
from sparkmart.functions.exprs import case_when, p_text
from sparkmart.operators.statistics import ALPHA, GROUPS, group_moments, welch_test

POWER = 0.8
SEED = 42
TARGET_EFFECT = 0.5  # fixed value: conventional "medium" effect
ARMS = ("treatment", "control")


def assign(df: DataFrame, id_column: str, seed: int = SEED) -> DataFrame:
    """Adds ``group``: an independent coin per id. A hash instead of ``rand()``, so the split does
    not depend on partitioning and a recomputed task repeats it."""
    digest = F.md5(F.concat(F.col(id_column).cast("string"), F.lit(f":{seed}")))
    heads = F.substring(digest, 1, 1) < "8"
    return df.withColumn("group", F.when(heads, F.lit(ARMS[0])).otherwise(F.lit(ARMS[1])))


def required_sample_size(effect: Column | float = TARGET_EFFECT, alpha: float = ALPHA, power: float = POWER) -> Column:
    """Rows per group a two-sided two-sample t-test needs to find the effect (closed form)."""
    za, zb = normal_quantile(1 - alpha / 2), normal_quantile(power)
    d = effect if isinstance(effect, Column) else F.lit(float(effect))
    return F.ceil(F.try_divide(F.lit(2 * (za + zb) ** 2), d * d) + F.lit(za * za / 4)).cast("bigint")


def ab_test(values: DataFrame, segments: Sequence[str] = (), confidence: float = 0.95) -> DataFrame:
    """Welch's t with a confidence interval of the mean difference, per segment.

    ``values`` carries (segments, group, value).
    """
    a, b = ARMS
    out = welch_test(group_moments(values, ARMS, segments), ARMS)
    n1, n2, s1, s2 = (F.col(f"{x}_{g}") for x in ("n", "std") for g in (a, b))
    half = t_crit(F.lit(1 - confidence), F.col("df")) * F.sqrt(s1 * s1 / n1 + s2 * s2 / n2)
    difference = F.col(f"mean_{a}") - F.col(f"mean_{b}")
    out = out.withColumn("_half", half)
    return out.select(
        *segments,
        F.col("t").alias("statistic"),
        F.col("t_p").alias("p_value"),
        (F.col("t_p") < ALPHA).alias("significant"),
        (difference - F.col("_half")).alias("ci_low"),
        (difference + F.col("_half")).alias("ci_high"),
        F.col("cohens_d").alias("effect_size"),
        *(f"{x}_{g}" for x in ("n", "mean") for g in (a, b)),
    )


def ab_summary(result: DataFrame, effect: float = TARGET_EFFECT, required_n: int | None = None) -> DataFrame:
    """Adds required_n and a sentence that names the experiment as simulated. As chance alone
    assigned the groups, a significant outcome is a false positive."""
    a, b = ARMS
    needed = F.lit(required_n).cast("bigint") if required_n is not None else required_sample_size(effect)
    out = result.withColumn("required_n", needed)
    achieved = F.least(f"n_{a}", f"n_{b}")
    size = F.concat(
        F.lit("The smaller group has "), achieved.cast("string"), F.lit(" rows, which "),
        case_when((achieved >= F.col("required_n"), "meets"), otherwise="falls short of"),
        F.lit(" the "), F.col("required_n").cast("string"), F.lit(f" needed for {POWER:.0%} power."),
    )
    figures = F.concat(F.lit("p = "), p_text("p_value"), F.format_string(", t = %.3f", "statistic"))
    outcome = F.when(
        F.col("significant"),
        F.concat(F.lit("a significant difference ("), figures, F.lit("), which can only be a false positive. ")),
    ).otherwise(F.concat(F.lit("no significant difference ("), figures, F.lit("), as random groups should show. ")))
    return out.withColumn("summary", F.concat(F.lit("SIMULATED A/B test: "), outcome, size))


def run_ab_simulation(
    df: DataFrame, id_column: str, value: str, seed: int = SEED, effect: float = TARGET_EFFECT
) -> DataFrame:
    """Assignment, test and summary in one plan."""
    values = assign(df, id_column, seed).select("group", F.col(value).alias("value"))
    return ab_summary(ab_test(values), effect)


SHARES = (0.1, 0.2, 0.3, 0.5)  # modelling assumption; 0.2 is the base case


def pricing_scenario(medians: DataFrame, shares: Sequence[float] = SHARES, groups: Sequence[str] = GROUPS) -> DataFrame:
    """Projected revenue if a share of full-price rows sold like discounted ones, one row per share.

    ``medians`` is one row with median_<group> of both groups and n_<full price group>.
    """
    a, b = groups
    uplift = F.col(f"median_{a}") - F.col(f"median_{b}")
    rows = medians.select(
        F.col(f"n_{b}").alias("full_price_count"),
        F.col(f"median_{b}").alias("full_price_median"),
        F.col(f"median_{a}").alias("discounted_median"),
        uplift.alias("uplift"),
        F.explode(F.array(*(F.lit(float(s)) for s in shares))).alias("share"),
    )
    annual = F.col("uplift") * F.col("full_price_count") * F.col("share")
    return rows.withColumn("annual_impact", annual).withColumn("monthly_impact", F.col("annual_impact") / 12.0)


def executive_summary(top_brand: DataFrame, result: DataFrame) -> DataFrame:
    """One sentence from the top-brand row and a test result row."""
    test = result.select(F.struct("p_value", "significant", "effect_size")).scalar()
    row = top_brand.withColumn("_t", test)
    verdict = F.when(
        F.col("_t.significant") & (F.col("_t.effect_size") > 0), F.lit("sell significantly better than")
    ).when(F.col("_t.significant"), F.lit("sell significantly worse than")).otherwise(F.lit("do not sell differently from"))
    text = F.concat(
        F.col("brand"), F.lit(" brings "), F.format_string("%.1f", F.col("revenue_share_percentage")),
        F.lit("% of revenue. Discounted items "), verdict, F.lit(" full-price items (p = "),
        p_text(F.col("_t.p_value")), F.lit(")."),
    )
    return row.select(text.alias("summary"))
