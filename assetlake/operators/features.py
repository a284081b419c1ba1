"""Engineered, calendar, encoded and scaled feature columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.functions.numeric import POWER_DIVISOR, ratio_with_epsilon, safe_divide
from assetlake.functions.tiers import encode_ordinal, wear_category
from assetlake.operators.ordering import exact_quantiles, match_on, recent_rows, row_numbers, wide_quantiles


def engineered_columns() -> dict[str, Column]:
    air, process = F.col("air_temperature_k"), F.col("process_temperature_k")
    speed, torque, wear = F.col("rotational_speed_rpm"), F.col("torque_nm"), F.col("tool_wear_min")
    return {
        "temperature_difference": process - air,
        "torque_speed_ratio": F.when(speed > 0, safe_divide(torque, speed)).otherwise(F.lit(0.0)),
        "power_estimate": torque * speed / F.lit(POWER_DIVISOR),
        "temp_wear_interaction": (process - air) * wear,
    }


def category_columns(type_col: str = "equipment_type", wear_col: str = "tool_wear_min") -> dict[str, Column]:
    wear = wear_category(wear_col)
    return {
        "equipment_type_encoded": encode_ordinal(type_col, ("L", "M", "H"), 0),
        "wear_category": wear,
        "wear_category_encoded": encode_ordinal(wear, ("low", "medium", "high")),
    }


def one_hot(column: str, categories: Sequence[str], prefix: str) -> dict[str, Column]:
    return {f"{prefix}_{c}": F.coalesce(F.col(column) == c, F.lit(False)).cast("int") for c in categories}


def binary_target(failure_type: str = "failure_type") -> Column:
    return F.when(F.col(failure_type) == "No Failure", 0).otherwise(1)


def calendar_columns(ts_col: str) -> dict[str, Column]:
    ts = F.col(ts_col)
    return {
        "hour": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "month": F.month(ts),
        "is_weekend": (F.weekday(ts) >= 5).cast("int"),
    }


def sensor_ratio_columns(temperature="temperature", vibration="vibration", pressure="pressure") -> dict[str, Column]:
    return {
        "temperature_pressure_ratio": ratio_with_epsilon(temperature, pressure),
        "vibration_energy": F.pow(F.col(vibration), F.lit(2.0)),
    }


def simulator_ratio_columns(scale: int | None = 4) -> dict[str, Column]:
    ratios = {
        "efficiency": ratio_with_epsilon("rotation_speed", "power_consumption"),
        "temperature_vibration_ratio": ratio_with_epsilon("temperature", "vibration"),
    }
    return ratios if scale is None else {name: F.round(ratio, scale) for name, ratio in ratios.items()}


def select_model_columns(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    return df.select(*features, target)


# --- scaling ---------------------------------------------------------------------------------------------


def scale_statistics(df: DataFrame, columns: Sequence[str], ddof: int = 1) -> DataFrame:
    """One row of mean and standard deviation per column (``ddof`` 1: sample, 0: population)."""
    spread = F.stddev_samp if ddof else F.stddev_pop
    return df.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns], *[spread(c).alias(f"std_{c}") for c in columns]
    )


def apply_scaling(
    df: DataFrame, statistics: DataFrame, columns: Sequence[str], suffix: str = "", zero_std_as_one: bool = False
) -> DataFrame:
    """(x - mean) / std with the fitted one-row statistics; a zero deviation gives NULL, or x - mean."""
    fitted = statistics.select(F.struct("*")).scalar()
    out = df.withColumn("_fit", fitted)
    scaled = {}
    for c in columns:
        std = F.nullif(F.col(f"_fit.std_{c}"), F.lit(0.0))
        if zero_std_as_one:
            std = F.coalesce(std, F.lit(1.0))
        scaled[f"{c}{suffix}"] = (F.col(c) - F.col(f"_fit.mean_{c}")) / std
    return out.withColumns(scaled).drop("_fit")


def z_score(df: DataFrame, columns: Sequence[str], suffix: str = "_normalized") -> DataFrame:
    return apply_scaling(df, scale_statistics(df, columns, 1), columns, suffix)


def standard_scale(train: DataFrame, columns: Sequence[str], other: DataFrame | None = None) -> DataFrame:
    """Population-deviation scaling fitted on ``train`` and applied to ``other`` (default: train itself)."""
    fitted = scale_statistics(train, columns, 0)
    return apply_scaling(train if other is None else other, fitted, columns, zero_std_as_one=True)


def min_max_scale(df: DataFrame, column: str, out: str) -> DataFrame:
    edges = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    return (
        df.withColumn("_edges", edges)
        .withColumn(out, safe_divide(F.col(column) - F.col("_edges.lo"), F.col("_edges.hi") - F.col("_edges.lo")))
        .drop("_edges")
    )


# --- cleaning --------------------------------------------------------------------------------------------


def impute_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill NULLs with the exact column median; reads one small row of medians back to the driver."""
    medians = {r["column"]: r["value"] for r in exact_quantiles(df, columns, [0.5]).collect()}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(medians[c])) for c in columns if c in medians})


def iqr_bounds(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), factor: float = 1.5) -> DataFrame:
    """Per key: low_<c> and high_<c> fences of each column."""
    names = {(c, p): f"q{int(p * 100)}_{c}" for c in columns for p in (0.25, 0.75)}
    quartiles = wide_quantiles(exact_quantiles(df, columns, [0.25, 0.75], keys), names, keys)
    fences = []
    for c in columns:
        spread = F.col(f"q75_{c}") - F.col(f"q25_{c}")
        fences.append((F.col(f"q25_{c}") - factor * spread).alias(f"low_{c}"))
        fences.append((F.col(f"q75_{c}") + factor * spread).alias(f"high_{c}"))
    return quartiles.select(*keys, *fences)


def outside_fence(column: str, low: str, high: str) -> Column:
    return F.coalesce((F.col(column) < F.col(low)) | (F.col(column) > F.col(high)), F.lit(False))


def drop_iqr_outliers(df: DataFrame, columns: Sequence[str], sequential: bool = True) -> DataFrame:
    """Drop rows outside the fences; sequentially the fences of a column see only the rows kept so far.

    The fences are read back as literals, so the result is one scan with plain filters.
    """
    rounds = [[c] for c in columns] if sequential else [list(columns)]
    out = df
    for group in rounds:
        fences = iqr_bounds(out, group).first()
        for c in group if fences else []:
            low, high = fences[f"low_{c}"], fences[f"high_{c}"]
            out = out.filter(~F.coalesce((F.col(c) < low) | (F.col(c) > high), F.lit(False)))
    return out


# --- sequences -------------------------------------------------------------------------------------------


def moving_average(df, keys, order_by, column, window=10, out="moving_average", full_only=False):
    """Mean over the last ``window`` rows; partial at the start unless ``full_only``."""

    def build(w):
        frame = w.rowsBetween(-(window - 1), 0)
        mean = F.avg(column).over(frame)
        return {out: F.when(F.count(column).over(frame) == window, mean) if full_only else mean}

    return recent_rows(df, keys, order_by, window - 1, [column], build)


def rolling_features(df, keys, order_by, columns, window=3):
    """Per column: rolling mean and sample deviation (NULL until full) and the ``window``-step difference."""

    def build(w):
        frame = w.rowsBetween(-(window - 1), 0)
        new = {}
        for c in columns:
            full = F.count(c).over(frame) == window
            new[f"{c}_rolling_mean"] = F.when(full, F.avg(c).over(frame))
            new[f"{c}_rolling_std"] = F.when(full, F.stddev_samp(c).over(frame))
            new[f"{c}_trend"] = F.col(c) - F.lag(c, window).over(w)
        return new

    return recent_rows(df, keys, order_by, window, columns, build)


def lag_features(df, keys, order_by, column, lags=(1, 3, 7), prefix="target_lag"):
    def build(w):
        return {f"{prefix}_{k}": F.lag(column, k).over(w) for k in lags}

    return recent_rows(df, keys, order_by, max(lags), [column], build)


def history_features(df, keys, order_by, columns, depth=10, minimum=3):
    """Mean of the last three readings and first-to-last change over the last ``depth``, from three readings on."""

    def build(w):
        recent = w.rowsBetween(-(depth - 1), 0)
        new = {}
        for c in columns:
            enough = F.count(F.lit(1)).over(recent) >= minimum
            new[f"{c}_rolling_mean_3"] = F.when(enough, F.avg(c).over(w.rowsBetween(-2, 0)))
            new[f"{c}_trend"] = F.when(enough, F.col(c) - F.first(c).over(recent))
        return new

    return recent_rows(df, keys, order_by, depth - 1, columns, build)


def rolling_pair(df, keys, order_by, columns, window=10):
    """Rolling mean and sample deviation over ``window`` rows with partial frames at the start."""

    def build(w):
        frame = w.rowsBetween(-(window - 1), 0)
        new = {}
        for c in columns:
            new[f"rolling_mean_{c}_{window}"] = F.avg(c).over(frame)
            new[f"rolling_std_{c}_{window}"] = F.stddev_samp(c).over(frame)
        return new

    return recent_rows(df, keys, order_by, window - 1, columns, build)


def linear_trend(df, keys, order_by, column, since: Column | None = None):
    """Least-squares slope and intercept of the column against the row's position within its key."""
    recent = df if since is None else df.filter(since)
    numbered = row_numbers(recent, order_by, keys, "day_number")
    return numbered.groupBy(*keys).agg(
        F.regr_slope(column, "day_number").alias("slope"),
        F.regr_intercept(column, "day_number").alias("intercept"),
        F.count(column).alias("points"),
    )


def change_from_previous(df, keys, order_by, column, previous="previous_value", change="change"):
    def build(w):
        before = F.lag(column, 1).over(w)
        return {previous: before, change: F.col(column) - before}

    return recent_rows(df, keys, order_by, 1, [column], build)


def sigma_outliers(df, keys, column, sigmas=3.0, flag="is_anomaly"):
    """Flag values more than ``sigmas`` sample deviations from their group's mean."""
    stats = df.groupBy(*keys).agg(F.avg(column).alias("_mean"), F.stddev_samp(column).alias("_std"))
    apart = F.abs(F.col(column) - F.col("_mean")) > sigmas * F.col("_std")
    marked = match_on(df, stats, keys).withColumn(flag, F.coalesce((F.col("_std") > 0) & apart, F.lit(False)))
    return marked.drop("_mean", "_std")


def history_anomalies(df, keys, column, minimum=3, factor=1.5, flag="is_anomaly"):
    """Flag values outside the quartile fences of their history; histories under ``minimum`` flag nothing."""
    sizes = df.groupBy(*keys).agg(F.count(column).alias("_n"))
    fences = iqr_bounds(df, [column], keys, factor)
    marked = match_on(match_on(df, sizes, keys), fences, keys)
    hit = (F.col("_n") >= minimum) & outside_fence(column, f"low_{column}", f"high_{column}")
    return marked.withColumn(flag, F.coalesce(hit, F.lit(False))).drop("_n", f"low_{column}", f"high_{column}")


def entity_age(df, entity_col, ts_col, as_of: Column):
    """First record per entity, whole days since it and the exact elapsed seconds."""
    first = df.groupBy(entity_col).agg(F.min(ts_col).alias("first_record"))
    return first.withColumns(
        {
            "age_days": F.datediff(as_of, F.col("first_record")),
            "age_seconds": F.timestamp_diff("SECOND", F.col("first_record"), as_of),
        }
    )
