"""Synthetic minority rows (SMOTE, ADASYN) on exact nearest neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.learning.neighbors import distinct_points, nearest
from assetlake.learning.splits import class_counts, unit_hash
from assetlake.operators.ordering import running_totals
from assetlake.session import cut_lineage

CHUNK = 10000  # synthetic rows made from one generated chunk


def _neighbour_lists(minority: DataFrame, dimensions: int, k: int) -> DataFrame:
    """Per distinct minority vector: copies and its k nearest rows, equal rows counted as often as they occur."""
    sized = nearest(minority, minority, dimensions, k + 1).join(
        minority.select(F.col("v").alias("neighbour"), F.col("copies").alias("n_copies")), "neighbour"
    )
    itself = F.col("v") == F.col("neighbour")
    weight = F.least(F.when(itself, F.col("n_copies") - 1).otherwise(F.col("n_copies")), F.lit(k)).cast("int")
    entries = F.sort_array(F.collect_list(F.struct("distance", "neighbour", weight.alias("times"))))
    lists = sized.groupBy("v").agg(entries.alias("e"))
    repeated = F.flatten(F.transform("e", lambda x: F.array_repeat(x["neighbour"], x["times"])))
    return minority.join(lists.select("v", F.slice(repeated, 1, k).alias("near")), "v")


def _interpolate(wanted: DataFrame, columns: Sequence[str], seed: int) -> DataFrame:
    """Rows on the segments between a vector ``v`` and one of its ``near`` vectors; ``quota`` rows per vector."""
    chunks = wanted.filter((F.col("quota") > 0) & (F.size("near") > 0)).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("quota") - 1) / CHUNK)))
    )
    # chunks of one vector go to different tasks, so few vectors can still make many rows
    spread = chunks.repartition("v", "chunk")
    last = F.least(F.col("quota"), (F.col("chunk") + 1) * CHUNK) - 1
    rows = spread.withColumn("i", F.explode(F.sequence(F.col("chunk") * CHUNK, last)))
    pick = F.floor(unit_hash(seed, F.col("v"), F.col("i"), F.lit("pick")) * F.size("near")).cast("int")
    step = unit_hash(seed, F.col("v"), F.col("i"), F.lit("step"))
    picked = rows.select("v", F.get("near", pick).alias("n"), step.alias("step"))
    return picked.select(
        *[(F.col("v")[j] + F.col("step") * (F.col("n")[j] - F.col("v")[j])).alias(c) for j, c in enumerate(columns)]
    )


def _deficit(df: DataFrame, label: str) -> tuple[int, int]:
    counts = class_counts(df.filter(F.col(label).isin(0, 1)), label)
    return counts.get(0, 0) - counts.get(1, 0), counts.get(1, 0)


def smote(df: DataFrame, columns: Sequence[str], label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Synthetic rows (columns, label = 1) that bring the minority up to the majority's size."""
    missing, size = _deficit(df, label)
    minority = cut_lineage(distinct_points(df.filter(F.col(label) == 1), columns))
    lists = _neighbour_lists(minority, len(columns), k)
    # every minority row gets missing div size rows; the rest go to the first rows in hash order
    each, rest = divmod(max(missing, 0), max(size, 1))
    hashed = lists.withColumn("_h", unit_hash(seed, F.col("v")))
    quota = F.col("copies") * each + F.greatest(F.least(F.lit(rest) - F.col("_before"), F.col("copies")), F.lit(0))
    made = _interpolate(_with_copies_before(hashed).withColumn("quota", quota), columns, seed)
    return made.withColumn(label, F.lit(1))


def _with_copies_before(hashed: DataFrame) -> DataFrame:
    """Rows that come before a vector in hash order (vectors stand for ``copies`` rows each)."""
    return running_totals(hashed, "_h", ["copies"]).withColumn("_before", F.col("cum_copies") - F.col("copies"))


def adasyn(df: DataFrame, columns: Sequence[str], label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Synthetic rows in proportion to the majority share among each minority row's k nearest rows."""
    missing, _ = _deficit(df, label)
    known = df.filter(F.col(label).isin(0, 1))
    points = cut_lineage(distinct_points(known, columns, F.sum((F.col(label) == 1).cast("long")).alias("positives")))
    minority = cut_lineage(
        points.filter("positives > 0").select("v", F.col("positives").alias("copies"))
    )
    lists = _neighbour_lists(minority, len(columns), k)
    shares = majority_shares(minority.select("v"), points, len(columns), k)
    weighted = lists.join(shares, "v").withColumn("_w", F.col("share") * F.col("copies"))
    total = weighted.agg(F.sum("_w")).scalar()
    quota = F.coalesce(F.round(F.try_divide(F.col("_w") * max(missing, 0), F.col("_total"))), F.lit(0.0)).cast("long")
    made = _interpolate(weighted.withColumn("_total", total).withColumn("quota", quota), columns, seed)
    return made.withColumn(label, F.lit(1))


def majority_shares(queries: DataFrame, points: DataFrame, dimensions: int, k: int) -> DataFrame:
    """Share of majority rows among the k nearest rows of one row at each query vector (the row itself excluded)."""
    near = nearest(queries, points, dimensions, k + 1).join(
        points.select(F.col("v").alias("neighbour"), F.col("copies").alias("n"), F.col("positives").alias("pos")),
        "neighbour",
    )
    itself = F.col("v") == F.col("neighbour")
    pos = F.when(itself, F.col("pos") - 1).otherwise(F.col("pos"))
    entries = F.sort_array(F.collect_list(F.struct("distance", "neighbour", pos.alias("pos"), (F.col("n") - F.col("pos")).alias("neg"))))
    listed = near.groupBy("v").agg(entries.alias("e"))
    # walk outwards until k rows are taken; equal rows at the border count proportionally
    start = F.struct(F.lit(0.0).alias("taken"), F.lit(0.0).alias("neg"))

    def step(acc: Column, x: Column) -> Column:
        size = (x["pos"] + x["neg"]).cast("double")
        room = F.least(size, F.lit(float(k)) - acc["taken"])
        part = F.when(size > 0, room * x["neg"] / F.greatest(size, F.lit(1.0))).otherwise(F.lit(0.0))
        return F.struct((acc["taken"] + room).alias("taken"), (acc["neg"] + part).alias("neg"))

    walked = listed.withColumn("w", F.aggregate("e", start, step))
    return walked.select("v", (F.col("w.neg") / F.greatest(F.col("w.taken"), F.lit(1.0))).alias("share"))

