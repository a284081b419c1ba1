"""Feature store: long offline history, latest online state, registry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetlake.functions.numeric import to_double
from assetlake.operators.features import apply_scaling, min_max_scale, one_hot, scale_statistics
from assetlake.operators.ordering import match_on
from assetlake.operators.tables import delete_keys, latest_per_entity, upsert
from assetlake.operators.validation import validate_against_registry

OFFLINE_KEYS = ("equipment_id", "feature_name", "timestamp")
ONLINE_TTL_DAYS = 7  # fixed value

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("feature_name", T.StringType(), False),
        T.StructField("feature_type", T.StringType(), False),
        T.StructField("description", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("transformations", T.ArrayType(T.StringType())),
        T.StructField("min_value", T.DoubleType()),
        T.StructField("max_value", T.DoubleType()),
        T.StructField("allowed_values", T.ArrayType(T.StringType())),
        T.StructField("owners", T.ArrayType(T.StringType())),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("version", T.IntegerType()),
    ]
)

# The kinds of features and transformations a registry may name.
FEATURE_TYPES = ("numeric", "categorical", "temporal", "text", "embedding")
TRANSFORMATIONS = ("standard_scaler", "min_max_scaler", "one_hot_encoding", "log_transform", "binning")


# --- offline history -------------------------------------------------------------------------------------


def to_long(wide: DataFrame, features: Sequence[str], id_col="equipment_id", ts_col="timestamp") -> DataFrame:
    """One row per feature value; numbers only."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature_name"), F.col(c).cast("double").alias("feature_value")) for c in features]
    )
    return wide.select(
        F.col(id_col).alias("equipment_id"), F.col(ts_col).alias("timestamp"), F.inline(cells)
    ).select("equipment_id", "feature_name", "feature_value", "timestamp")


def map_to_long(df: DataFrame, map_col: str = "features") -> DataFrame:
    return df.select("equipment_id", "timestamp", F.explode(map_col).alias("feature_name", "feature_value"))


def upsert_features(offline: DataFrame, incoming: DataFrame, order_col: str = "created_at") -> DataFrame:
    """Last write per (entity, feature, time) wins."""
    return upsert(offline, incoming, list(OFFLINE_KEYS), order_col)


def scan_features(offline, start: Column, end: Column, entities=None, features=None, ts_col="timestamp") -> DataFrame:
    """Entity, time-range and feature-list scan; every predicate can reach the Parquet reader."""
    out = offline.filter((F.col(ts_col) >= start) & (F.col(ts_col) <= end))
    if entities is not None:
        out = out.filter(F.col("equipment_id").isin(*entities))
    if features is not None:
        out = out.filter(F.col("feature_name").isin(*features))
    return out


def to_wide(long: DataFrame, features: Sequence[str]) -> DataFrame:
    """(entity, time) rows with one column per feature; duplicates are averaged."""
    return long.groupBy("equipment_id", "timestamp").pivot("feature_name", list(features)).agg(F.avg("feature_value"))


def training_frame(offline: DataFrame, features: Sequence[str], start: Column, end: Column) -> DataFrame:
    """Wide feature rows of every entity in the period, in one job."""
    return to_wide(scan_features(offline, start, end, features=features), features)


def active_entities(offline: DataFrame, start: Column, end: Column) -> DataFrame:
    return scan_features(offline, start, end).select("equipment_id").distinct()


def ingest(
    wide: DataFrame, features: Sequence[str], registry: DataFrame, id_col="equipment_id", ts_col="timestamp"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Validated bulk ingest: (offline rows, online rows of each entity's newest record, rejected values)."""
    checked = validate_against_registry(to_long(wide, features, id_col, ts_col), registry)
    valid = checked.filter("valid").drop("valid", "error")
    newest = wide.groupBy(F.col(id_col).alias("equipment_id")).agg(F.max(ts_col).alias("_newest"))
    of_newest = match_on(valid, newest, ["equipment_id"], "inner").filter(F.col("timestamp") == F.col("_newest"))
    online = of_newest.groupBy("equipment_id", "timestamp").agg(
        F.map_from_entries(F.sort_array(F.collect_set(F.struct("feature_name", "feature_value")))).alias("features")
    )
    return valid, online, checked.filter(~F.col("valid"))


def ingest_records(records: DataFrame, features: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records without an entity id are refused: (long rows, refused records, success count)."""
    known = F.col("equipment_id").isNotNull() & (F.col("equipment_id") != "")
    good, bad = records.filter(known), records.filter(~F.coalesce(known, F.lit(False)))
    return to_long(good, features), bad, good.agg(F.count(F.lit(1)).alias("success_count"))


# --- statistics ------------------------------------------------------------------------------------------


def feature_statistics(offline: DataFrame) -> DataFrame:
    return offline.groupBy("feature_name").agg(
        F.count(F.lit(1)).alias("count"),
        F.min("timestamp").alias("min_timestamp"),
        F.max("timestamp").alias("max_timestamp"),
        F.count_distinct("equipment_id").alias("unique_equipment"),
    )


def entity_statistics(offline: DataFrame, as_of: Column, lookback_days: int = 30) -> DataFrame:
    start = as_of - F.expr(f"INTERVAL '{lookback_days}' DAY")
    return (
        scan_features(offline, start, as_of)
        .groupBy("equipment_id", "feature_name")
        .agg(
            F.avg("feature_value").alias("mean"),
            F.stddev_samp("feature_value").alias("std"),
            F.min("feature_value").alias("min"),
            F.max("feature_value").alias("max"),
            F.count("feature_value").alias("count"),
        )
    )


def store_summary(offline: DataFrame, online: DataFrame) -> DataFrame:
    """One row on the state of both stores."""
    latest = online.agg(F.struct(F.count(F.lit(1)).alias("n"), F.max("timestamp").alias("t"))).scalar()
    return (
        offline.agg(
            F.count(F.lit(1)).alias("offline_rows"),
            F.count_distinct("feature_name").alias("features"),
            F.count_distinct("equipment_id").alias("entities"),
            F.max("timestamp").alias("newest_offline"),
        )
        .withColumn("_o", latest)
        .select("*", F.col("_o.n").alias("online_keys"), F.col("_o.t").alias("newest_online"))
        .drop("_o")
    )


# --- online state ----------------------------------------------------------------------------------------


def online_state(rows: DataFrame, order_by: Sequence[str] = ("timestamp", "ingestion_time")) -> DataFrame:
    """Latest feature map per entity by event time, with count, names and last update.

    ``rows``: equipment_id, features map, timestamp, ingestion_time.
    """
    packed = rows.select(
        "equipment_id", F.map_entries("features").alias("_entries"), "timestamp", "ingestion_time", *[
            c for c in order_by if c not in ("timestamp", "ingestion_time")
        ]
    )
    newest = latest_per_entity(packed, "equipment_id", order_by)
    return newest.select(
        "equipment_id",
        F.map_from_entries("_entries").alias("features"),
        "timestamp",
        "ingestion_time",
        F.size("_entries").alias("feature_count"),
        F.transform("_entries", lambda e: e["key"]).alias("feature_names"),
    )


def unexpired(online: DataFrame, as_of: Column, days: int = ONLINE_TTL_DAYS) -> DataFrame:
    return online.filter(F.col("ingestion_time") > as_of - F.expr(f"INTERVAL '{days}' DAY"))


def lookup(online: DataFrame, entities: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    found = online.filter(F.col("equipment_id").isin(*entities))
    return found if names is None else select_features(found, names)


def select_features(online: DataFrame, names: Sequence[str]) -> DataFrame:
    return online.withColumn("features", F.map_filter("features", lambda k, _: k.isin(list(names))))


def feature_vector(features: str | Column, names: Sequence[str]) -> Column:
    """Values in the order of ``names``; a missing, NULL or unreadable one is 0.0."""
    source = F.col(features) if isinstance(features, str) else features
    return F.array(*[to_double(F.try_element_at(source, F.lit(n))) for n in names])


def vector_to_map(vector: str, names: Sequence[str]) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.col(vector))


def is_fresh(as_of: Column, max_age_minutes: int = 5, column: str = "ingestion_time") -> Column:
    """Strictly younger than the limit."""
    return F.col(column) > as_of - F.expr(f"INTERVAL '{max_age_minutes}' MINUTE")


def forget(online: DataFrame, doomed: DataFrame) -> DataFrame:
    return delete_keys(online, doomed, "equipment_id")


def sync_to_online(offline: DataFrame, as_of: Column, entities: Sequence[str] | None = None) -> DataFrame:
    """Newest row of the last 24 hours per entity as online state."""
    recent = scan_features(offline, as_of - F.expr("INTERVAL '1' DAY"), as_of, entities)
    newest = recent.groupBy("equipment_id").agg(F.max("timestamp").alias("_newest"))
    rows = match_on(recent, newest, ["equipment_id"], "inner").filter(F.col("timestamp") == F.col("_newest"))
    return rows.groupBy("equipment_id", "timestamp").agg(
        F.map_from_entries(F.sort_array(F.collect_set(F.struct("feature_name", "feature_value")))).alias("features")
    )


# --- registry --------------------------------------------------------------------------------------------


def registry_frame(spark: SparkSession, definitions: Sequence[dict]) -> DataFrame:
    """Registry rows from definition dictionaries (a YAML or JSON document read on the driver)."""
    rows = []
    for d in definitions:
        rules = d.get("validation_rules") or {}
        if d["type"] not in FEATURE_TYPES:
            raise ValueError(f"unknown feature type: {d['type']}")
        unknown = set(d.get("transformations") or []) - set(TRANSFORMATIONS)
        if unknown:
            raise ValueError(f"unknown transformations: {sorted(unknown)}")
        rows.append(
            (
                d["name"],
                d["type"],
                d.get("description", ""),
                d.get("source", ""),
                list(d.get("transformations") or []),
                None if rules.get("min") is None else float(rules["min"]),
                None if rules.get("max") is None else float(rules["max"]),
                list(rules.get("allowed_values") or []),
                list(d.get("owners") or []),
                d.get("created_at"),
                d.get("updated_at"),
                int(d.get("version", 1)),
            )
        )
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def register(registry: DataFrame, new: DataFrame) -> DataFrame:
    """Add or replace definitions by name."""
    return delete_keys(registry, new, "feature_name").unionByName(new)


def definition(registry: DataFrame, name: str) -> DataFrame:
    return registry.filter(F.col("feature_name") == name)


def of_type(registry: DataFrame, feature_type: str) -> DataFrame:
    return registry.filter(F.col("feature_type") == feature_type)


def update_definition(registry: DataFrame, name: str, updates: dict[str, Column], now: Column) -> DataFrame:
    hit = F.col("feature_name") == name
    changes = {**updates, "updated_at": now, "version": F.col("version") + 1}
    return registry.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in changes.items()})


def unregister(registry: DataFrame, name: str) -> DataFrame:
    return registry.filter(F.col("feature_name") != name)


def registry_export(registry: DataFrame) -> DataFrame:
    """Flat form of the registry with JSON text for the nested members."""
    rules = F.to_json(F.struct(F.col("min_value").alias("min"), F.col("max_value").alias("max"), "allowed_values"))
    return registry.select(
        "feature_name",
        "feature_type",
        "description",
        "source",
        F.to_json("transformations").alias("transformations"),
        rules.alias("validation_rules"),
        F.to_json("owners").alias("owners"),
        "created_at",
        F.coalesce("updated_at", "created_at").alias("updated_at"),
        "version",
    )


def apply_transformations(
    df: DataFrame, plan: dict[str, Sequence[str]], categories: dict[str, Sequence[str]], splits: dict[str, Sequence[float]]
) -> DataFrame:
    """Apply the transformations the registry declares: feature name -> transformation names."""
    out = df
    for name, steps in plan.items():
        for step in steps:
            if step == "standard_scaler":
                scaled = apply_scaling(out, scale_statistics(df, [name], 0), [name], "_scaled", zero_std_as_one=True)
                out = scaled
            elif step == "min_max_scaler":
                out = min_max_scale(out, name, f"{name}_minmax")
            elif step == "one_hot_encoding":
                out = out.withColumns(one_hot(name, categories[name], name))
            elif step == "log_transform":
                out = out.withColumn(f"{name}_log", F.log1p(name))
            elif step == "binning":
                out = out.withColumn(f"{name}_bin", bin_number(name, splits[name]))
            else:
                raise ValueError(f"unknown transformation: {step}")
    return out


def bin_number(column: str, splits: Sequence[float]) -> Column:
    """Number of the half-open bin [s_i, s_i+1); the last bin includes its upper edge."""
    value = F.col(column)
    below = sum(((value >= s).cast("int") for s in splits[1:-1]), F.lit(0))
    return F.when((value >= splits[0]) & (value <= splits[-1]), below)


