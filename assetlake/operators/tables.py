"""Latest-row, de-duplication, keyed upsert, retention and life-cycle operators on plain tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Newest row per key under the total order ``order_by``; an aggregate, so a hot key combines map-side."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order_by)).alias("_row")).select(*keys, "_row.*")


def latest_per_entity(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """``latest_per_key`` for a key with many rows each: a narrow hash aggregate finds the greatest value of the first order
    column, a semi-join on key and value (which deals a hot key's rows too) the few rows that have it; NULL is lowest.
    Where most keys have one row, ``latest_per_key`` reads the rows once and is the cheaper form."""
    edges = df.groupBy(F.col(key).alias("_key")).agg(F.max(order_by[0]).alias("_edge"))
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(order_by[0]).eqNullSafe(F.col("_edge"))
    return latest_per_key(df.join(edges, same, "left_semi"), [key], order_by)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Smallest row per key, e.g. the record with the lowest id among duplicates."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order_by)).alias("_row")).select(*keys, "_row.*")


def remove_duplicates_of_first(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """DELETE-USING form: drop every row whose id is not the smallest of its key."""
    groups = df.groupBy(*keys).agg(F.min(id_col).alias("_keep"), F.count(F.lit(1)).alias("_n"))
    repeated = groups.filter("_n > 1").select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_keep")
    condition = df[id_col] != repeated["_keep"]
    for k in keys:
        condition = condition & (df[k] == repeated[f"_k_{k}"])
    return df.join(repeated, condition, "left_anti")


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Union where the row with the greatest ``order_col`` wins; an incoming row wins a tie."""
    both = existing.withColumn("_side", F.lit(0)).unionByName(incoming.withColumn("_side", F.lit(1)))
    return latest_per_key(both, keys, [order_col, "_side"]).drop("_side").select(*existing.columns)


def upsert_replace(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    now: Column,
    keep: Sequence[str] = ("created_at",),
    stamp: str = "updated_at",
) -> DataFrame:
    """Keyed replace: an incoming row overwrites all but the ``keep`` columns and is stamped with ``now``."""
    old = existing.withColumn("_side", F.lit(0))
    new = incoming.withColumn(stamp, now).withColumn("_side", F.lit(1))
    both = old.unionByName(new, allowMissingColumns=True)
    values = [c for c in existing.columns if c not in keys]
    merged = []
    for c in values:
        if c in keep:
            merged.append(F.coalesce(F.max(F.when(F.col("_side") == 0, F.col(c))), F.max(F.col(c))).alias(c))
        else:
            merged.append(F.max_by(c, "_side").alias(c))
    return both.groupBy(*keys).agg(*merged).select(*existing.columns)


def touch_rows(existing: DataFrame, keys_df: DataFrame, keys: Sequence[str], now: Column) -> DataFrame:
    """Set ``updated_at`` on the rows named by ``keys_df``."""
    marked = keys_df.select(*keys).distinct().withColumn("_hit", F.lit(True))
    stamped = F.when(F.col("_hit"), now).otherwise(F.col("updated_at"))
    return existing.join(marked, list(keys), "left").withColumn("updated_at", stamped).drop("_hit")


def retain(df: DataFrame, ts_col: str, as_of: Column, days: int) -> DataFrame:
    return df.filter(F.col(ts_col) >= F.date_sub(as_of.cast("date"), days))


def retention_counts(frames: Sequence[tuple[str, DataFrame, str, int]], as_of: Column) -> DataFrame:
    """(layer, table, time column, days) -> kept and deleted rows per layer."""
    out = None
    for layer, df, ts_col, days in frames:
        old = F.col(ts_col) < F.date_sub(as_of.cast("date"), days)
        row = df.agg(
            F.lit(layer).alias("layer"),
            F.count(F.when(old, 1)).alias("deleted"),
            F.count(F.when(~old, 1)).alias("kept"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def delete_keys(df: DataFrame, doomed: DataFrame, key: str) -> DataFrame:
    return df.join(doomed.select(key).distinct(), key, "left_anti")


def alert_states(events: DataFrame) -> DataFrame:
    """Current state per alert from its event rows (alert_id, event, event_time, actor)."""

    def when_last(event, value):
        return F.max(F.when(F.col("event") == event, F.col(value)))

    states = events.groupBy("alert_id").agg(
        F.min(F.when(F.col("event") == "open", F.col("event_time"))).alias("created_at"),
        when_last("acknowledged", "event_time").alias("acknowledged_at"),
        when_last("resolved", "event_time").alias("resolved_at"),
    )
    return states.withColumns(
        {
            "acknowledged": F.col("acknowledged_at").isNotNull(),
            "resolved": F.col("resolved_at").isNotNull(),
            "state": F.when(F.col("resolved_at").isNotNull(), "resolved")
            .when(F.col("acknowledged_at").isNotNull(), "acknowledged")
            .otherwise("open"),
        }
    )


def promote_model(models: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """Upsert model metadata; a production model demotes the others of its type."""
    merged = upsert_replace(models, new, ["model_id"], now, keep=("created_at", "model_type", "training_date"))
    promoted = new.filter("is_production").groupBy("model_type").agg(F.max("model_id").alias("_winner"))
    demoted = F.col("_winner").isNotNull() & (F.col("model_id") != F.col("_winner"))
    return (
        merged.join(promoted, "model_type", "left")
        .withColumn("is_production", F.when(demoted, F.lit(False)).otherwise(F.col("is_production")))
        .drop("_winner")
        .select(*models.columns)
    )
