"""Group comparison, experiments and scenarios over the sales lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.distributions import normal_quantile
from sparkmart.operators import experiments as X
from sparkmart.operators import statistics as S
from sparkmart.operators.marts import per_product, top_brand
from sparkmart.functions.exprs import parts_value
from sparkmart.plans.mart_queries import FRAGMENTS, MONEY
from sparkmart.plans.registry import Registry, Tables

A, B = S.GROUPS


def _moment_sql(source: str, groups: tuple[str, str], segment: str | None = None) -> str:
    """Moments spelled out, one row per segment."""
    seg = f"{segment}, " if segment else ""
    by = f"GROUP BY {segment}" if segment else ""
    join = f"USING ({segment})" if segment else "ON TRUE"

    def per(g: str) -> str:
        return f"""
            (SELECT {seg}COUNT(*) AS n_{g}, ANY_VALUE(m) AS mean_{g},
                    SQRT(SUM((value - m) * (value - m)) / (COUNT(*) - 1)) AS std_{g},
                    AVG((value - m) ** 3) / POWER(AVG((value - m) ** 2), 1.5e0) AS skew_{g},
                    AVG((value - m) ** 4) / POWER(AVG((value - m) ** 2), 2) - 3 AS kurtosis_{g}
             FROM (SELECT *, {f"CAST(SUM(CAST(value AS DECIMAL(18,4))) OVER (PARTITION BY {segment}) AS DOUBLE) / COUNT(*) OVER (PARTITION BY {segment})" if segment else "CAST(SUM(CAST(value AS DECIMAL(18,4))) OVER () AS DOUBLE) / COUNT(*) OVER ()"} AS m
                   FROM {source} WHERE "group" = '{g}') {by})"""

    return f"SELECT * FROM {per(groups[0])} a JOIN {per(groups[1])} b {join}"


def _rank_sql(source: str, groups: tuple[str, str], segment: str | None = None) -> str:
    """U, medians and tie term from average ranks."""
    seg = f"{segment}, " if segment else ""
    part = f"PARTITION BY {segment}" if segment else ""
    by = f"GROUP BY {segment}" if segment else ""
    a, b = groups
    return f"""
        SELECT *, 2 * u / (n1 * n2) - 1 AS rank_biserial,
               (GREATEST(u, n1 * n2 - u) - n1 * n2 / 2e0 - 0.5e0)
                   / SQRT(n1 * n2 / 12e0 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1e0)))) AS z
        FROM (SELECT {seg}SUM(avg_rank) FILTER (WHERE "group" = '{a}')
                         - COUNT(*) FILTER (WHERE "group" = '{a}') * (COUNT(*) FILTER (WHERE "group" = '{a}') + 1) / 2e0 AS u,
                     SUM(CAST(t AS DOUBLE) * t - 1) AS ties,
                     COUNT(*) FILTER (WHERE "group" = '{a}') AS n1, COUNT(*) FILTER (WHERE "group" = '{b}') AS n2,
                     MEDIAN(value) FILTER (WHERE "group" = '{a}') AS median_{a},
                     MEDIAN(value) FILTER (WHERE "group" = '{b}') AS median_{b}
              FROM (SELECT *, RANK() OVER ({part} ORDER BY value) + (t - 1) / 2e0 AS avg_rank
                    FROM (SELECT *, COUNT(*) OVER (PARTITION BY {seg}value) AS t FROM {source}))
              {by})"""


_INTEGRAL = """list_sum(list_transform(range(0, 4001), lambda i:
    (CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * {density})) * abs({x}) / 12000e0"""


def _normal_p_sql(z: str) -> str:
    density = f"exp(-power({z} * i / 4000e0, 2) / 2)"
    return f"1 - 2 * ({_INTEGRAL.format(density=density, x=z)}) / sqrt(2 * pi())"


def _t_p_sql(t: str, df: str) -> str:
    density = f"exp(-({df} + 1) / 2 * ln(1 + power({t} * i / 4000e0, 2) / {df}))"
    front = f"exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt({df} * pi())"
    return f"1 - 2 * ({_INTEGRAL.format(density=density, x=t)}) * {front}"


def _welch_sql(a: str, b: str) -> str:
    v = lambda g: f"(std_{g} * std_{g} / n_{g})"
    return f"""(mean_{a} - mean_{b}) / SQRT({v(a)} + {v(b)}) AS t,
        ({v(a)} + {v(b)}) ** 2 / ({v(a)} ** 2 / (n_{a} - 1) + {v(b)} ** 2 / (n_{b} - 1)) AS df,
        (mean_{a} - mean_{b}) / SQRT(((n_{a} - 1) * std_{a} ** 2 + (n_{b} - 1) * std_{b} ** 2) / (n_{a} + n_{b} - 2)) AS cohens_d"""


def _profile_sql(source: str) -> str:
    cols = ", ".join(f"n_{g} / 6e0 * (skew_{g} ** 2 + kurtosis_{g} ** 2 / 4e0) AS jb_{g}" for g in S.GROUPS)
    normal = ", ".join(f"exp(-jb_{g} / 2e0) AS normal_p_{g}" for g in S.GROUPS)
    passed = ", ".join(f"(normal_p_{g} > 0.05e0 AND abs(skew_{g}) < 0.5e0) AS is_normal_{g}" for g in S.GROUPS)
    return f"SELECT *, {passed} FROM (SELECT *, {normal} FROM (SELECT *, {cols} FROM {source}))"


_GROUP = f"CASE WHEN discount > 0 THEN '{A}' WHEN discount = 0 THEN '{B}' END"

R = Registry(
    {
        **FRAGMENTS,
        "grouped": f"""SELECT {_GROUP} AS "group", revenue AS value FROM {{finance_lines}} WHERE discount >= 0""",
        "brand_grouped": f"""SELECT brand, {_GROUP} AS "group", revenue AS value FROM {{line_brand}} WHERE discount >= 0""",
        "moments": _moment_sql("{grouped}", S.GROUPS),
        "brand_moments": _moment_sql("{brand_grouped}", S.GROUPS, "brand"),
        "ranks": _rank_sql("{grouped}", S.GROUPS),
        "brand_ranks": _rank_sql("{brand_grouped}", S.GROUPS, "brand"),
        "profile": _profile_sql("{moments}"),
        "brand_profile": _profile_sql("{brand_moments}"),
        "product_money": f"SELECT product_id, {MONEY} AS revenue FROM {{finance_lines}} GROUP BY product_id",
        "arms": f"""SELECT product_id, revenue AS value,
                           CASE WHEN substr(md5(CAST(product_id AS VARCHAR) || ':42'), 1, 1) < '8'
                                THEN 'treatment' ELSE 'control' END AS "group" FROM {{product_money}}""",
        "arm_moments": _moment_sql("{arms}", X.ARMS),
        "tested": f"""
            SELECT *, test = 'welch_t' AS is_t FROM (
                SELECT *, CASE WHEN is_normal_{A} AND is_normal_{B} THEN 'welch_t' ELSE 'mann_whitney' END AS test,
                       {_welch_sql(A, B)}
                FROM {{brand_profile}} JOIN {{brand_ranks}} USING (brand))""",
        "results": f"""
            SELECT brand, test, CASE WHEN is_t THEN t ELSE u END AS statistic,
                   CASE WHEN is_t THEN {_t_p_sql('t', 'df')} WHEN z <= 0 THEN 1e0 ELSE {_normal_p_sql('z')} END AS p_value,
                   CASE WHEN is_t THEN cohens_d ELSE rank_biserial END AS effect_size,
                   CASE WHEN is_t THEN 'cohens_d' ELSE 'rank_biserial_r' END AS effect_size_type,
                   n_{A}, n_{B}, mean_{A}, mean_{B}, median_{A}, median_{B}, is_normal_{A}, is_normal_{B}
            FROM {{tested}}""",
        "ab": f"SELECT *, {_welch_sql(*X.ARMS)} FROM {{arm_moments}}",
    }
)


def _groups(t: Tables) -> DataFrame:
    return S.revenue_groups(t.finance_lines)


def _brand_groups(t: Tables) -> DataFrame:
    return S.revenue_groups(t.finance_lines.join(t.brands, "product_id"), "brand")


def _product_money(t: Tables) -> DataFrame:
    return per_product(t.finance_lines).select("product_id", parts_value("rev").alias("revenue"))


def _arms(t: Tables) -> DataFrame:
    return X.assign(_product_money(t), "product_id").select("product_id", "group", F.col("revenue").alias("value"))


def _round(df: DataFrame, /, **digits: int) -> DataFrame:
    """Engines differ in the last bits of a moment; compare what is meaningful."""
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def _round_sql(inner: str, /, **digits: int) -> str:
    return "SELECT * REPLACE (" + ", ".join(f"ROUND({c}, {d}) AS {c}" for c, d in digits.items()) + f") FROM ({inner})"


_MOMENT_DIGITS = {f"{x}_{g}": d for g in S.GROUPS for x, d in (("std", 3), ("skew", 6), ("kurtosis", 6))}
_MOMENT_COLS = [f"{x}_{g}" for g in S.GROUPS for x in ("n", "mean", "std", "skew", "kurtosis")]

R.add("q_revenue_groups", _groups, "SELECT * FROM {grouped}")
R.add(
    "q_group_moments",
    lambda t: _round(S.group_moments(_groups(t)), **_MOMENT_DIGITS),
    _round_sql("SELECT * FROM {moments}", **_MOMENT_DIGITS),
)
R.add(
    "q_group_moments_by_brand",
    lambda t: _round(S.group_moments(_brand_groups(t), segments=["brand"]), **_MOMENT_DIGITS),
    _round_sql("SELECT * FROM {brand_moments}", **_MOMENT_DIGITS),
)
_SUMMARY_DIGITS = {**_MOMENT_DIGITS, **{f"median_{g}": 6 for g in S.GROUPS}}
R.add(
    "q_group_summary_by_brand",
    lambda t: _round(S.group_summary(_brand_groups(t), segments=["brand"]), **_SUMMARY_DIGITS),
    _round_sql(
        f"SELECT m.*, {', '.join(f'median_{g}' for g in S.GROUPS)} FROM {{brand_moments}} m JOIN {{brand_ranks}} USING (brand)",
        **_SUMMARY_DIGITS,
    ),
)
_PROFILE_COLS = [f"{x}_{g}" for g in S.GROUPS for x in ("n", "skew", "kurtosis", "jb", "normal_p", "is_normal")]
_PROFILE_DIGITS = {f"{x}_{g}": d for g in S.GROUPS for x, d in (("skew", 6), ("kurtosis", 6), ("jb", 4), ("normal_p", 6))}
R.add(
    "q_normality_profile",
    lambda t: _round(S.normality_profile(S.group_moments(_groups(t))).select(*_PROFILE_COLS), **_PROFILE_DIGITS),
    _round_sql(f"SELECT {', '.join(_PROFILE_COLS)} FROM {{profile}}", **_PROFILE_DIGITS),
)
R.add(
    "q_test_select",
    lambda t: S.choose_test(S.normality_profile(S.group_moments(_brand_groups(t), segments=["brand"]))).select("brand", "test"),
    "SELECT brand, test FROM {tested}",
)
_WELCH_DIGITS = {"t": 6, "df": 1, "cohens_d": 6, "t_p": 6}
R.add(
    "q_welch_t",
    lambda t: _round(
        S.welch_test(S.group_moments(_brand_groups(t), segments=["brand"])).select("brand", "t", "df", "cohens_d", "t_p"),
        **_WELCH_DIGITS,
    ),
    _round_sql(f"SELECT brand, t, df, cohens_d, {_t_p_sql('t', 'df')} AS t_p FROM {{tested}}", **_WELCH_DIGITS),
)
R.add(
    "q_cohens_d",
    lambda t: _round(S.welch_test(S.group_moments(_groups(t)), with_p=False).select("cohens_d"), cohens_d=6),
    f"SELECT ROUND(cohens_d, 6) AS cohens_d FROM (SELECT {_welch_sql(A, B)} FROM {{moments}})",
)
_RANK_COLS = ["u", "n1", "n2", f"median_{A}", f"median_{B}", "rank_biserial", "z"]
_RANK_DIGITS = {f"median_{A}": 6, f"median_{B}": 6, "rank_biserial": 9, "z": 6}
R.add(
    "q_mann_whitney",
    lambda t: _round(S.mann_whitney(S.rank_sums(_groups(t))).select(*_RANK_COLS, "u_p"), **_RANK_DIGITS, u_p=6),
    _round_sql(
        f"SELECT {', '.join(_RANK_COLS)}, CASE WHEN z <= 0 THEN 1e0 ELSE {_normal_p_sql('z')} END AS u_p FROM {{ranks}}",
        **_RANK_DIGITS,
        u_p=6,
    ),
)
R.add(
    "q_mann_whitney_by_brand",
    lambda t: _round(
        S.mann_whitney(S.rank_sums(_brand_groups(t), segments=["brand"]), with_p=False).select("brand", *_RANK_COLS),
        **_RANK_DIGITS,
    ),
    _round_sql(f"SELECT brand, {', '.join(_RANK_COLS)} FROM {{brand_ranks}}", **_RANK_DIGITS),
)
R.add(
    "q_rank_biserial",
    lambda t: _round(S.mann_whitney(S.rank_sums(_groups(t)), with_p=False).select("rank_biserial"), rank_biserial=9),
    "SELECT ROUND(rank_biserial, 9) AS rank_biserial FROM {ranks}",
)
_LABELS = "CASE WHEN abs({e}) < {a} THEN 'negligible' WHEN abs({e}) < {b} THEN 'small' WHEN abs({e}) < {c} THEN 'medium' ELSE 'large' END"
_D_LABEL = _LABELS.format(e="20 * cohens_d", a="0.2e0", b="0.5e0", c="0.8e0")
_R_LABEL = _LABELS.format(e="20 * rank_biserial", a="0.1e0", b="0.3e0", c="0.5e0")


def _magnitudes(t: Tables) -> DataFrame:
    """Effects are tiny in this data; twenty times as large they reach every label."""
    both = S.welch_test(S.group_moments(_brand_groups(t), segments=["brand"]), with_p=False).join(
        S.mann_whitney(S.rank_sums(_brand_groups(t), segments=["brand"]), with_p=False), "brand"
    )
    return both.select(
        "brand",
        S.magnitude(F.col("cohens_d") * 20, F.lit("welch_t")).alias("d_label"),
        S.magnitude(F.col("rank_biserial") * 20, F.lit("mann_whitney")).alias("r_label"),
    )


R.add("q_effect_magnitude", _magnitudes, f"SELECT brand, {_D_LABEL} AS d_label, {_R_LABEL} AS r_label FROM {{tested}}")
_RESULT_DIGITS = {"statistic": 6, "p_value": 6, "effect_size": 6, f"median_{A}": 6, f"median_{B}": 6}
R.add(
    "q_hypothesis_test",
    lambda t: _round(S.hypothesis_test(_brand_groups(t), segments=["brand"]), **_RESULT_DIGITS),
    _round_sql("SELECT *, p_value < 0.05e0 AS significant FROM {results}", **_RESULT_DIGITS),
)
R.add(
    "q_hypothesis_test_overall",
    lambda t: _round(
        S.hypothesis_test(_groups(t)).select("test", "statistic", "p_value", f"n_{A}", f"n_{B}"), statistic=6, p_value=6
    ),
    _round_sql(
        f"""SELECT 'mann_whitney' AS test, u AS statistic,
                   CASE WHEN z <= 0 THEN 1e0 ELSE {_normal_p_sql('z')} END AS p_value, n1 AS n_{A}, n2 AS n_{B}
            FROM {{ranks}}""",
        statistic=6,
        p_value=6,
    ),
)
_EFFECT_LABEL = (
    "CASE WHEN test = 'welch_t' THEN "
    + _LABELS.format(e="effect_size", a="0.2e0", b="0.5e0", c="0.8e0")
    + " ELSE "
    + _LABELS.format(e="effect_size", a="0.1e0", b="0.3e0", c="0.5e0")
    + " END"
)


def _p_text_sql(p: str) -> str:
    return f"CASE WHEN {p} < 1e-4 THEN printf('%.2e', {p}) ELSE printf('%.4f', {p}) END"


_EVIDENCE = f"""'p = ' || {_p_text_sql('p_value')} || ', ' ||
    CASE WHEN test = 'welch_t' THEN printf('t = %.3f', statistic) ELSE printf('U = %.1f', statistic) END"""
_TEST_NAME = "CASE WHEN test = 'welch_t' THEN 'Welch''s t-test' ELSE 'Mann-Whitney U test' END"


def _side(c: str) -> str:
    return f"CASE WHEN {c} THEN 'discounted' ELSE 'full-price' END"


R.add(
    "q_result_summary",
    lambda t: S.result_summary(S.hypothesis_test(_brand_groups(t), segments=["brand"])).select("brand", "summary"),
    f"""SELECT brand, CASE WHEN p_value < 0.05e0 THEN
            {_TEST_NAME} || ' finds a significant difference in revenue (' || {_EFFECT_LABEL} || ' effect, ' || {_EVIDENCE}
            || '): typical revenue per product is higher for ' || {_side('effect_size > 0')} || ' products.'
            || CASE WHEN (mean_{A} > mean_{B}) <> (median_{A} > median_{B}) THEN ' Caution: the mean is higher for '
                || {_side(f'mean_{A} > mean_{B}')} || ' and the median for ' || {_side(f'median_{A} > median_{B}')}
                || ' products, so a few large values drive the mean.' ELSE '' END
        ELSE {_TEST_NAME} || ' finds no significant difference in revenue between discounted and full-price products ('
            || {_EVIDENCE} || '). A gap in totals comes from the number of products.' END AS summary
        FROM {{results}}""",
)
_POINTS = 19
R.add(
    "q_qq_points",
    lambda t: _round(S.qq_points(_groups(t), _POINTS), theoretical=9, observed=6),
    " UNION ALL ".join(
        f"""SELECT "group", CAST({i} AS BIGINT) AS point, {normal_quantile((i + 0.5) / _POINTS):.9f}e0 + 0e0 AS theoretical,
                   ROUND(quantile_cont(value, {(i + 0.5) / _POINTS!r}), 6) AS observed
            FROM {{grouped}} GROUP BY "group" """
        for i in range(_POINTS)
    ),
)
# --- experiments ---------------------------------------------------------------------------

R.add("q_ab_assign", _arms, 'SELECT product_id, "group", value FROM {arms}')
R.add(
    "q_required_sample_size",
    lambda t: S.welch_test(S.group_moments(_brand_groups(t), segments=["brand"]), with_p=False).select(
        "brand", X.required_sample_size(F.round("cohens_d", 6)).alias("required_n")
    ),
    f"""SELECT brand, CAST(ceil({2 * (normal_quantile(0.975) + normal_quantile(0.8)) ** 2!r}e0
                   / (ROUND(cohens_d, 6) * ROUND(cohens_d, 6)) + {normal_quantile(0.975) ** 2 / 4!r}e0) AS BIGINT) AS required_n
        FROM {{tested}}""",
)
_Z = normal_quantile(0.975)
# Student's quantile as a series in 1/df (Abramowitz and Stegun 26.7.5).
_SERIES = (
    (_Z**3 + _Z) / 4,
    (5 * _Z**5 + 16 * _Z**3 + 3 * _Z) / 96,
    (3 * _Z**7 + 19 * _Z**5 + 17 * _Z**3 - 15 * _Z) / 384,
    (79 * _Z**9 + 776 * _Z**7 + 1482 * _Z**5 - 1920 * _Z**3 - 945 * _Z) / 92160,
)
_CRITICAL = f"({_Z!r}e0" + "".join(f" + {g!r}e0 / df ** {i + 1}" for i, g in enumerate(_SERIES)) + ")"
_ARM = lambda x: ", ".join(f"{x}_{g}" for g in X.ARMS)
_AB_DIGITS = {"statistic": 6, "p_value": 6, "ci_low": 2, "ci_high": 2, "effect_size": 6}
_SPREAD = " + ".join(f"std_{g} * std_{g} / n_{g}" for g in X.ARMS)
_AB_SQL = f"""
    SELECT t AS statistic, {_t_p_sql('t', 'df')} AS p_value,
           mean_treatment - mean_control - {_CRITICAL} * SQRT({_SPREAD}) AS ci_low,
           mean_treatment - mean_control + {_CRITICAL} * SQRT({_SPREAD}) AS ci_high,
           cohens_d AS effect_size, {_ARM('n')}, {_ARM('mean')} FROM {{ab}}"""
R.add(
    "q_ab_test",
    lambda t: _round(X.ab_test(_arms(t)), **_AB_DIGITS),
    _round_sql(f"SELECT *, p_value < 0.05e0 AS significant FROM ({_AB_SQL})", **_AB_DIGITS),
)
R.add(
    "q_ab_summary",
    lambda t: X.run_ab_simulation(_product_money(t), "product_id", "revenue").select("required_n", "summary"),
    f"""SELECT CAST(64 AS BIGINT) AS required_n, 'SIMULATED A/B test: ' || CASE WHEN p_value < 0.05e0
            THEN 'a significant difference (' || 'p = ' || {_p_text_sql('p_value')} || printf(', t = %.3f', statistic)
                 || '), which can only be a false positive. '
            ELSE 'no significant difference (' || 'p = ' || {_p_text_sql('p_value')} || printf(', t = %.3f', statistic)
                 || '), as random groups should show. ' END
            || 'The smaller group has ' || LEAST(n_treatment, n_control) || ' rows, which '
            || CASE WHEN LEAST(n_treatment, n_control) >= 64 THEN 'meets' ELSE 'falls short of' END
            || ' the 64 needed for 80% power.' AS summary FROM ({_AB_SQL})""",
)
R.add(
    "q_pricing_scenario",
    lambda t: _round(
        X.pricing_scenario(S.rank_sums(_groups(t)).withColumnRenamed("n2", f"n_{B}")),
        full_price_median=6, discounted_median=6, uplift=6, annual_impact=2, monthly_impact=2,
    ),
    f"""SELECT full_price_count, ROUND(full_price_median, 6) AS full_price_median,
               ROUND(discounted_median, 6) AS discounted_median, ROUND(uplift, 6) AS uplift, share,
               ROUND(uplift * full_price_count * share, 2) AS annual_impact,
               ROUND(uplift * full_price_count * share / 12, 2) AS monthly_impact
        FROM (SELECT n2 AS full_price_count, median_{B} AS full_price_median, median_{A} AS discounted_median,
                     median_{A} - median_{B} AS uplift, unnest([{', '.join(f'{s!r}e0' for s in X.SHARES)}]) AS share
              FROM {{ranks}})""",
)
R.add(
    "q_exec_summary",
    lambda t: X.executive_summary(top_brand(t.finance_lines, t.brands), S.hypothesis_test(_groups(t))),
    f"""SELECT brand || ' brings ' || printf('%.1f', share) || '% of revenue. Discounted items ' ||
               CASE WHEN p < 0.05e0 AND rank_biserial > 0 THEN 'sell significantly better than'
                    WHEN p < 0.05e0 THEN 'sell significantly worse than' ELSE 'do not sell differently from' END
               || ' full-price items (p = ' || {_p_text_sql('p')} || ').' AS summary
        FROM (SELECT brand, ROUND(total_revenue * 100.0 / (SELECT SUM(total_revenue) FROM {{brand_totals}}), 2) AS share
              FROM {{brand_totals}} ORDER BY total_revenue DESC, brand DESC LIMIT 1),
             (SELECT rank_biserial, CASE WHEN z <= 0 THEN 1e0 ELSE {_normal_p_sql('z')} END AS p FROM {{ranks}})""",
)
