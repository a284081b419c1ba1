"""Exact k-nearest neighbours without comparing all pairs.

Points are cut into cells along their two widest columns. Every query first searches its own cell, which bounds
the distance of its k-th neighbour; it then visits only those cells whose bounding box is nearer than that.
Equal points are one point with a count, so copies never blow up a cell.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlake.operators.ordering import apply_range, range_bounds
from assetlake.session import cut_lineage, shuffle_partitions

CELL_POINTS = 2000
CHUNK_QUERIES = 20000
MAX_RANGES = 512


def distinct_points(df: DataFrame, columns: Sequence[str], *payload) -> DataFrame:
    """(v, copies, payload...) per distinct vector of the columns."""
    vector = F.array(*[F.col(c).cast("double") for c in columns])
    return df.groupBy(vector.alias("v")).agg(F.count(F.lit(1)).alias("copies"), *payload)


def _grid(points: DataFrame, dimensions: int) -> tuple[list[tuple[int, DataFrame]], int]:
    """Bounds of the two widest dimensions and the number of ranges along each."""
    stats = points.agg(
        F.count(F.lit(1)).alias("n"), *[F.var_pop(F.col("v")[i]).alias(f"s{i}") for i in range(dimensions)]
    ).first()
    widest = sorted(range(dimensions), key=lambda i: -(stats[f"s{i}"] or 0.0))[:2]
    wanted = (stats["n"] / CELL_POINTS) ** (1.0 / len(widest))
    size = 1
    while size < wanted and size < MAX_RANGES:
        size *= 2
    if size == 1:
        return [], 1
    return [(i, range_bounds(points.select(F.col("v")[i].alias("x")), "x", size)) for i in widest], size


def _with_cell(df: DataFrame, grid, size: int) -> DataFrame:
    out = df.withColumn("cell", F.lit(0))
    for i, bounds in grid:
        out = apply_range(out.withColumn("_x", F.col("v")[i]), "_x", bounds, size, "_r")
        out = out.withColumn("cell", F.col("cell") * size + F.col("_r")).drop("_x", "_r")
    return out


def _by_group(df: DataFrame, *keys: str):
    """Grouped by ``keys`` under new column identities (two frames of one origin can be co-grouped).

    The partition count is explicit because AQE merges partitions by bytes, and these few bytes mean much work.
    """
    fresh = df.select(*[F.col(c).alias(c) for c in df.columns])
    return fresh.repartition(shuffle_partitions(df.sparkSession), *keys).groupBy(*keys)


def _nearest_in_group(k: int, dimensions: int):
    """Search function of one (queries, points) pair of groups."""

    def search(queries: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        columns = ["v", "neighbour", "distance", "at"]
        if queries.empty or points.empty:
            return pd.DataFrame({c: [] for c in columns})
        q = np.vstack(queries["v"].to_numpy()).reshape(-1, dimensions)
        p = np.vstack(points["v"].to_numpy()).reshape(-1, dimensions)
        p = p[np.lexsort(p.T)]  # the arrival order of shuffled rows must not decide ties
        take = min(k, len(p))
        block = max(1, 4_000_000 // len(p))
        found_q, found_p, found_d = [], [], []
        for start in range(0, len(q), block):
            part = q[start : start + block]
            d2 = np.zeros((len(part), len(p)))
            for i in range(dimensions):
                d2 += np.square(part[:, i, None] - p[None, :, i])
            nearest = np.argpartition(d2, take - 1, axis=1)[:, :take] if take < len(p) else np.tile(np.arange(len(p)), (len(part), 1))
            found_q.append(np.repeat(np.arange(start, start + len(part)), take))
            found_p.append(nearest.ravel())
            found_d.append(np.sqrt(np.take_along_axis(d2, nearest, axis=1)).ravel())
        qi, pi = np.concatenate(found_q), np.concatenate(found_p)
        return pd.DataFrame(
            {
                "v": list(q[qi]),
                "neighbour": list(p[pi]),
                "distance": np.concatenate(found_d),
                "at": points["cell"].iloc[0],
            }
        )

    return search


_RESULT = "v array<double>, neighbour array<double>, distance double, at int"


def nearest(queries: DataFrame, points: DataFrame, dimensions: int, k: int) -> DataFrame:
    """The ``k`` nearest distinct points of every query: rows (v, neighbour, distance).

    Both frames carry a distinct vector column ``v`` and are read several times: pass checkpointed frames. A query
    that is itself a point finds itself at distance 0. Ties at the k-th distance are broken arbitrarily but the
    same way in every run.
    """
    grid, size = _grid(points, dimensions)
    placed = _with_cell(points.select("v"), grid, size)
    asked = _with_cell(queries.select("v"), grid, size)
    search = _nearest_in_group(k, dimensions)
    local = _by_group(asked, "cell").cogroup(_by_group(placed, "cell")).applyInPandas(search, _RESULT)
    found = local
    if size > 1:
        local = cut_lineage(local)
        boxes = placed.groupBy("cell").agg(
            F.array(*[F.min(F.col("v")[i]) for i in range(dimensions)]).alias("lo"),
            F.array(*[F.max(F.col("v")[i]) for i in range(dimensions)]).alias("hi"),
        )
        everywhere = boxes.agg(F.collect_list(F.struct("cell", "lo", "hi")))  # at most MAX_RANGES squared boxes
        reach = local.groupBy("v", F.col("at").alias("cell")).agg(
            F.when(F.count(F.lit(1)) >= k, F.max("distance")).otherwise(F.lit(float("inf"))).alias("reach")
        )

        def box_distance(box):
            gaps = [
                F.greatest(box["lo"][i] - F.col("v")[i], F.lit(0.0), F.col("v")[i] - box["hi"][i])
                for i in range(dimensions)
            ]
            return F.sqrt(sum((g * g for g in gaps), F.lit(0.0)))

        other = asked.join(reach, ["v", "cell"], "left").withColumn("reach", F.coalesce("reach", F.lit(float("inf"))))
        visits = other.withColumn("_boxes", everywhere.scalar()).select(
            "v",
            F.explode(
                F.transform(
                    F.filter("_boxes", lambda b: (b["cell"] != F.col("cell")) & (box_distance(b) < F.col("reach"))),
                    lambda b: b["cell"],
                )
            ).alias("cell"),
        )
        # a popular cell is searched by several tasks, each with its own copy of the cell's points
        shares = visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CHUNK_QUERIES).cast("int").alias("parts"))
        salted = visits.join(shares, "cell").withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int"))
        copied = placed.join(shares, "cell").withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        )
        sides = [_by_group(side, "cell", "part") for side in (salted, copied)]
        remote = sides[0].cogroup(sides[1]).applyInPandas(search, _RESULT)
        found = local.unionByName(remote)
    # per query at most k candidates from each visited cell
    ranked = found.groupBy("v").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("distance", "neighbour"))), 1, k).alias("best")
    )
    return ranked.select("v", F.inline("best")).select("v", "neighbour", "distance")
