"""Univariate F-test feature scoring and regression metrics, per group.

Both are single grouped aggregates with mergeable moments (count, covariance,
standard deviation), so every map task pre-aggregates and a hot group is
combined from partial results instead of being sent to one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Steps by which a gamma ratio's argument is raised before its series is used.
GAMMA_STEPS = 20
#: Terms of the continued fraction: at least this many, and more with the
#: square root of the degrees of freedom, on which its convergence depends.
FRACTION_TERMS = 60
FRACTION_PER_ROOT = 6

# Coefficients of Gamma(x + 1/2) / Gamma(x) / sqrt(x) in powers of 1/x.
HALF_GAMMA = (1.0, -1 / 8, 1 / 128, 5 / 1024, -21 / 32768, -399 / 262144, 869 / 4194304)


def _half_gamma_ratio(x: Column) -> Column:
    """Gamma(x + 1/2) / Gamma(x) for x >= 1/2: the series at x + GAMMA_STEPS,
    carried down by the recurrence of the gamma function."""
    at = x + GAMMA_STEPS
    series = reduce(lambda acc, c: acc / at + F.lit(c), reversed(HALF_GAMMA), F.lit(0.0))
    steps = F.transform(F.sequence(F.lit(0), F.lit(GAMMA_STEPS - 1)), lambda i: (x + i) / (x + i + 0.5))
    return F.sqrt(at) * series * F.aggregate(steps, F.lit(1.0), lambda a, b: a * b)


def _beta_fraction(a: Column, b: Column, x: Column, terms: Column) -> Column:
    """1 / (1 + d1 / (1 + d2 / ...)), the continued fraction of the incomplete
    beta function, from its last term to its first."""

    def term(k: Column) -> Column:
        m = F.floor(k / 2)
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return F.when(k % 2 == 0, even).otherwise(odd)

    return 1.0 / F.aggregate(F.sequence(2 * terms, F.lit(1), F.lit(-1)), F.lit(1.0), lambda acc, k: 1.0 + term(k) / acc)


def f_pvalue(f: Column, dof: Column) -> Column:
    """P(F(1, dof) > f) as one expression of built-in functions.

    The upper tail is the regularized incomplete beta I_x(dof / 2, 1 / 2) at
    x = dof / (dof + f), by its continued fraction on the side where that
    converges; the number of terms follows from dof. Null for a null or NaN
    statistic or dof <= 0."""
    dof = dof.cast("double")
    a, half = dof / 2, F.lit(0.5)
    x, rest = dof / (dof + f), f / (dof + f)
    # x^a (1 - x)^(1/2) / B(a, 1/2)
    front = F.exp(-a * F.log1p(f / dof)) * F.sqrt(rest) * _half_gamma_ratio(a) / F.sqrt(F.pi())
    terms = F.ceil(F.greatest(F.lit(FRACTION_TERMS), FRACTION_PER_ROOT * F.sqrt(a))).cast("int")
    low = front * _beta_fraction(a, half, x, terms) / a
    high = 1.0 - front * _beta_fraction(half, a, rest, terms) / half
    tail = F.when(f <= 0, 1.0).when(x < (a + 1) / (a + 2.5), low).otherwise(high)
    return F.when((dof > 0) & ~F.isnan(f), tail)


def f_regression(df: DataFrame, target: str, features: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Per (group, feature): n, Pearson r with the target, F = r^2/(1-r^2)*(n-2).

    A constant feature (or target) has no correlation: r and F are NULL, no
    error is raised. Rows with a NULL target or feature are not used.
    """
    by = list(by)
    y = F.col(target)
    aggs = []
    for c in features:
        x = F.col(c)
        both = x.isNotNull() & y.isNotNull()
        xx, yy = F.when(both, x), F.when(both, y)
        aggs += [
            F.count(xx).alias(f"__n_{c}"),
            F.covar_pop(xx, yy).alias(f"__cov_{c}"),
            F.stddev_pop(xx).alias(f"__sx_{c}"),
            F.stddev_pop(yy).alias(f"__sy_{c}"),
        ]
    wide = df.groupBy(*by).agg(*aggs)
    long = wide.select(
        *by,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("feature"),
                        F.col(f"__n_{c}").alias("n"),
                        F.try_divide(F.col(f"__cov_{c}"), F.col(f"__sx_{c}") * F.col(f"__sy_{c}")).alias("r"),
                    )
                    for c in features
                ]
            )
        ),
    )
    r2 = F.col("r") * F.col("r")
    return long.withColumn("f_stat", F.try_divide(r2, F.lit(1.0) - r2) * (F.col("n") - F.lit(2)))


def with_pvalues(scores: DataFrame) -> DataFrame:
    """Add ``p_value`` = P(F(1, n-2) > f_stat)."""
    return scores.withColumn("p_value", f_pvalue(F.col("f_stat"), F.col("n") - F.lit(2)))


def select_features(scores: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Features with p < alpha, ranked by p within the group."""
    scored = scores if "p_value" in scores.columns else with_pvalues(scores)
    return scored.where(F.col("p_value") < F.lit(alpha))


def regression_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str]) -> DataFrame:
    """Per group: n, RMSE and R2 in one aggregate pass.

    R2 = 1 - SS_res / SS_tot with SS_tot = n * var_pop(label); NULL when the
    label is constant.
    """
    err = F.col(label) - F.col(prediction)
    m = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull()).groupBy(*by).agg(
        F.count("*").alias("n"),
        F.sum(err * err).alias("__ss_res"),
        F.var_pop(label).alias("__var"),
    )
    return m.select(
        *by,
        "n",
        F.sqrt(F.col("__ss_res") / F.col("n")).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.col("__ss_res"), F.col("n") * F.col("__var"))).alias("r2"),
    )


def metric_gaps(metrics: DataFrame, by: Sequence[str], split_col: str = "split") -> DataFrame:
    """Train and test RMSE / R2 side by side per group, with their differences
    (train - test), from the long (group, split, n, rmse, r2) table."""
    by = list(by)
    def pick(name, split):
        return F.max(F.when(F.col(split_col) == split, F.col(name)))
    wide = metrics.groupBy(*by).agg(
        pick("rmse", "train").alias("rmse_train"), pick("rmse", "test").alias("rmse_test"),
        pick("r2", "train").alias("r2_train"), pick("r2", "test").alias("r2_test"),
    )
    return wide.withColumns(
        {"rmse_diff": F.col("rmse_train") - F.col("rmse_test"), "r2_diff": F.col("r2_train") - F.col("r2_test")}
    )
