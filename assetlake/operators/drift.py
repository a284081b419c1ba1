"""Drift statistics between a reference and a current sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.functions.numeric import RATIO_EPSILON, count_where, equal_width_bucket, safe_divide
from assetlake.functions.tiers import drift_severity
from assetlake.operators.ordering import match_on, running_totals

KS_TERMS = 100
KS_MINIMUM = 30  # fixed value: a sample must be larger than this for the test


def bucket_shares(df: DataFrame, column: str, low: float, high: float, bins: int, scale: float, name: str) -> DataFrame:
    counts = df.groupBy(equal_width_bucket(column, low, high, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("_total", total).select("bin", (safe_divide("n", "_total") * scale).alias(name))


def histogram_pair(reference, current, column, low=-5.0, high=5.0, bins=10, scale=1.0) -> DataFrame:
    """Both shares per bucket (full outer join; a bucket may exist on one side only)."""
    if column not in reference.columns or column not in current.columns:
        raise ValueError(f"unknown feature: {column}")
    ref = bucket_shares(reference, column, low, high, bins, scale, "ref_share")
    cur = bucket_shares(current, column, low, high, bins, scale, "cur_share")
    return ref.join(cur, ref["bin"].eqNullSafe(cur["bin"]), "full_outer").select(
        F.coalesce(ref["bin"], cur["bin"]).alias("bin"), "ref_share", "cur_share"
    )


def stability_index(reference, current, column, low=-5.0, high=5.0, bins=10, scale=1.0) -> DataFrame:
    """Population stability index; one-sided buckets are skipped, ``scale`` 100 works on percentages."""
    pair = histogram_pair(reference, current, column, low, high, bins, scale)
    ref, cur = F.col("ref_share"), F.col("cur_share")
    term = F.when((ref > 0) & (cur > 0), (cur - ref) * F.ln(cur / ref))
    return pair.agg(F.coalesce(F.sum(term), F.lit(0.0)).alias("psi"))


def mean_drift(df: DataFrame, keys: Sequence[str], column: str, in_current, absolute: bool = False) -> DataFrame:
    """Relative change of the mean per key; ``in_current`` tells the current period from the reference."""
    means = df.groupBy(*keys).agg(
        F.avg(F.when(~in_current, F.col(column))).alias("reference_mean"),
        F.avg(F.when(in_current, F.col(column))).alias("current_mean"),
    )
    base = F.abs("reference_mean") if absolute else F.col("reference_mean")
    drift = F.abs(F.col("current_mean") - F.col("reference_mean")) / (base + F.lit(RATIO_EPSILON))
    return means.withColumn("mean_drift", drift)


def ks_test(df: DataFrame, keys: Sequence[str], column: str, in_current, alpha: float = 0.05) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per key with the asymptotic p-value.

    Samples of 30 rows or fewer give statistic 0, p-value 1 and no drift.
    """
    values = (
        df.filter(F.col(column).isNotNull())
        .groupBy(*keys, F.col(column).alias("v"))
        .agg(count_where(~in_current).alias("a"), count_where(in_current).alias("b"))
    )
    sizes = values.groupBy(*keys).agg(F.sum("a").alias("n_reference"), F.sum("b").alias("n_current"))
    cumulated = running_totals(values, "v", ["a", "b"], keys)
    if keys:
        steps = match_on(cumulated, sizes, keys)
    else:
        steps = cumulated.withColumn("_s", sizes.select(F.struct("*")).scalar()).select("*", "_s.*").drop("_s")
    gap = F.abs(safe_divide("cum_a", "n_reference") - safe_divide("cum_b", "n_current"))
    found = steps.groupBy(*keys, "n_reference", "n_current").agg(F.max(gap).alias("_d"))
    enough = (F.col("n_reference") > KS_MINIMUM) & (F.col("n_current") > KS_MINIMUM)
    scaled = F.col("_d") * F.sqrt(safe_divide(F.col("n_reference") * F.col("n_current"), F.col("n_reference") + F.col("n_current")))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * F.col("_x") * F.col("_x")),
    )
    p_value = F.when(F.col("_x") < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))
    return (
        found.withColumn("_x", scaled)
        .withColumn("ks_statistic", F.when(enough, F.col("_d")).otherwise(F.lit(0.0)))
        .withColumn("p_value", F.when(enough, p_value).otherwise(F.lit(1.0)))
        .withColumn("drift_detected", F.col("p_value") < alpha)
        .drop("_x", "_d")
    )


def drift_report(drift: DataFrame, since) -> DataFrame:
    """Recent drift checks with their severity."""
    return drift.filter(F.col("check_date") >= since).withColumn(
        "drift_severity", drift_severity("drift_score", "drift_threshold")
    )
