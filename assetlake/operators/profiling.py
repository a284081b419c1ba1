"""Table profiles: counts, nulls, descriptive statistics, correlations, outliers, histograms."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.functions.numeric import count_where, equal_width_bucket, percent, safe_divide
from assetlake.operators.features import iqr_bounds
from assetlake.operators.ordering import exact_quantiles, match_on, wide_quantiles


def layer_statistics(df: DataFrame, layer: str, key: str, flagged: Column, ts_col: str) -> DataFrame:
    """One row: size, distinct keys, flagged rows and time span of a layer table."""
    return df.agg(
        F.lit(layer).alias("layer"),
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct(key).alias("unique_records"),
        count_where(flagged).alias("flagged_records"),
        F.min(ts_col).alias("earliest_record"),
        F.max(ts_col).alias("latest_record"),
    )


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def failure_distribution(df: DataFrame, by: str = "equipment_type") -> DataFrame:
    failed = count_where(F.col("target") == 1)
    return (
        df.filter(F.col("is_valid"))
        .groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            failed.alias("failure_count"),
            percent(failed, F.count(F.lit(1))).alias("failure_rate_percent"),
            F.avg("tool_wear_min").alias("avg_tool_wear"),
            F.avg("torque_nm").alias("avg_torque"),
        )
    )


def _stack(one_row: DataFrame, columns: Sequence[str], measures: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Rows (column_name, measures...) from aggregates named ``<measure>__<column>``."""
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), *[F.col(f"{m}__{c}").alias(m) for m in measures])
            for c in columns
        ]
    )
    return one_row.select(*keys, F.inline(entries))


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing count and share per column from one pass over the table."""
    aggs = []
    for c in columns:
        missing = count_where(F.col(c).isNull())
        aggs.append(missing.alias(f"null_count__{c}"))
        aggs.append(percent(missing, F.count(F.lit(1))).alias(f"null_percent__{c}"))
    return _stack(df.agg(*aggs), columns, ["null_count", "null_percent"])


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of every group of equal rows."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def dataset_profile(df: DataFrame) -> DataFrame:
    """One row: rows, columns, missing values, duplicate rows and the kinds of columns."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    missing = sum((F.col(c).isNull().cast("long") for c in df.columns), F.lit(0))
    numeric = [n for n, t in df.dtypes if t.split("(")[0] in ("int", "bigint", "double", "float", "decimal", "smallint")]
    textual = [n for n, t in df.dtypes if t == "string"]
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.lit(len(df.columns)).alias("total_columns"),
        F.coalesce(F.sum(missing * F.col("_n")), F.lit(0)).alias("missing_values"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
        F.lit(len(numeric)).alias("numeric_columns"),
        F.lit(len(textual)).alias("categorical_columns"),
    )


def value_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    aggs = []
    for c in columns:
        aggs += [F.min(c).cast("double").alias(f"min__{c}"), F.max(c).cast("double").alias(f"max__{c}")]
    return _stack(df.agg(*aggs), columns, ["min", "max"])


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, min, exact quartiles and max per numeric column."""
    simple = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    aggs = [fn(F.col(c).cast("double")).alias(f"{m}__{c}") for c in columns for m, fn in simple.items()]
    base = _stack(df.agg(*aggs), columns, list(simple))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    pivoted = quartiles.groupBy(F.col("column").alias("column_name")).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"q{int(p * 100)}") for p in (0.25, 0.5, 0.75)]
    )
    return base.join(pivoted, "column_name", "left")


def correlation_pairs(df: DataFrame, columns: Sequence[str], minimum: float | None = None) -> DataFrame:
    """Pearson correlation of every column pair in one aggregate; optionally only abs(r) > ``minimum``."""
    pairs = list(combinations(columns, 2))
    one_row = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    entries = F.array(
        *[
            F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"r{i}").alias("correlation"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    out = one_row.select(F.inline(entries))
    return out if minimum is None else out.filter(F.abs("correlation") > minimum)


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Count and share of every value; the total is a scalar subquery, not a one-partition window."""
    total = df.agg(F.count(F.lit(1))).scalar()
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("_total", total).select(
        column, "count", safe_divide("count", "_total").alias("share")
    )


def grouped_summary(df: DataFrame, by: str, target: str = "target", scale: int = 3) -> DataFrame:
    return df.groupBy(by).agg(
        F.count(target).alias("count"),
        F.bround(F.avg(target), scale).alias("mean"),
        F.sum(target).alias("sum"),
    )


def outlier_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows outside the quartile fences and their share, per column."""
    fences = iqr_bounds(df, columns).select(F.struct("*")).scalar()
    marked = df.withColumn("_f", fences)
    aggs = []
    for c in columns:
        outside = count_where((F.col(c) < F.col(f"_f.low_{c}")) | (F.col(c) > F.col(f"_f.high_{c}")))
        aggs.append(outside.alias(f"outlier_count__{c}"))
        aggs.append(percent(outside, F.count(F.lit(1))).alias(f"outlier_percent__{c}"))
    return _stack(marked.agg(*aggs), columns, ["outlier_count", "outlier_percent"])


def class_histogram(df: DataFrame, column: str, class_col: str, low: float, high: float, bins: int) -> DataFrame:
    """Equal-width bin counts per class together with the class mean."""
    counts = df.groupBy(F.col(class_col), equal_width_bucket(column, low, high, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("count"), F.sum(column).alias("_sum"), F.count(column).alias("_n")
    )
    means = counts.groupBy(class_col).agg(safe_divide(F.sum("_sum"), F.sum("_n")).alias("class_mean"))
    return match_on(counts.drop("_sum", "_n"), means, [class_col])


def history_statistics(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """Statistics of a history sample; the deviation is the population form."""
    return df.groupBy(*keys).agg(
        F.avg(column).alias("mean"),
        F.stddev_pop(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
        F.count(column).alias("count"),
    )


def failure_medians(df: DataFrame, by: str = "equipment_type") -> DataFrame:
    """Exact medians of wear and torque and the mean temperature difference among valid failures."""
    failed = df.filter((F.col("target") == 1) & F.col("is_valid"))
    medians = wide_quantiles(
        exact_quantiles(failed, ["tool_wear_min", "torque_nm"], [0.5], [by]),
        {("tool_wear_min", 0.5): "median_tool_wear", ("torque_nm", 0.5): "median_torque"},
        [by],
    )
    counts = failed.groupBy(by).agg(
        F.avg(F.col("process_temperature_k") - F.col("air_temperature_k")).alias("avg_temp_diff"),
        F.count(F.lit(1)).alias("failure_count"),
    )
    return match_on(counts, medians, [by])
