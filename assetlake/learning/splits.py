"""Deterministic stratified splits and class balancing.

Rows are ordered by a seeded hash of their key. Per-class cut points on that hash are exact order statistics, so
a split is a filter on every row: no shuffle of the wide rows and no per-class sort in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.operators.ordering import exact_quantiles


def row_hash(keys: Sequence[str], seed: int = 42) -> Column:
    """52 bits of a seeded key hash, exactly representable as a double."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), 12).cast("double")


def unit_hash(seed: int, *parts: Column) -> Column:
    """Seeded pseudo-random number in [0, 1) that does not depend on partitioning."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 12).cast("double") / F.lit(float(2**52))


def _cuts(df: DataFrame, position: Column, label: str, probs: Sequence[float]) -> dict:
    """Ascending hash cuts per class, read back as literals (classes times cuts numbers)."""
    hashed = df.select(label, position.alias("_h"))
    found: dict = {}
    for row in exact_quantiles(hashed, ["_h"], probs, [label]).collect():
        found.setdefault(row[label], []).append(row["value"])
    return {value: sorted(cuts) for value, cuts in found.items()}


def _cuts_passed(cuts: dict, position: Column, label: str) -> Column:
    """How many cuts of its class a row's hash lies above; NULL for a row without a class."""
    passed = F.lit(None).cast("int")
    for value, edges in cuts.items():
        above = sum(((position > edge).cast("int") for edge in edges), F.lit(0))
        passed = F.when(F.col(label) == value, above).otherwise(passed)
    return passed


def with_fold(df: DataFrame, keys: Sequence[str], label: str, folds: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Fold number 0..folds-1; every class is spread evenly over the folds. Rows without a class are left out."""
    return with_fold_at(df, row_hash(keys, seed), label, folds, name)


def with_fold_at(df: DataFrame, position: Column, label: str, folds: int = 5, name: str = "fold") -> DataFrame:
    """``with_fold`` of rows whose ``row_hash`` is at hand."""
    cuts = _cuts(df, position, label, [i / folds for i in range(1, folds)])
    return df.withColumn(name, _cuts_passed(cuts, position, label)).filter(F.col(name).isNotNull())


def stratified_split(
    df: DataFrame, keys: Sequence[str], label: str, test_share: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with the same class shares; rows without a class are in neither."""
    position = row_hash(keys, seed)
    passed = _cuts_passed(_cuts(df, position, label, [1.0 - test_share]), position, label)
    return df.filter(passed == 0), df.filter(passed == 1)


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows per class, null being none; one small row per class is read back."""
    return {r[label]: r["n"] for r in df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def undersample(df: DataFrame, keys: Sequence[str], label: str, seed: int = 42) -> DataFrame:
    """Keep as many rows of every class as the smallest class has."""
    counts = class_counts(df, label)
    smallest = min(counts.values())
    out = None
    for value, n in counts.items():
        rows = df.filter(F.col(label) == value)
        if n > smallest:
            hashed = rows.select(row_hash(keys, seed).alias("_h"))
            cut = exact_quantiles(hashed, ["_h"], [(smallest - 1) / (n - 1)]).select("value").first()["value"]
            # the cut may sit a rounding error beside the wanted order statistic
            rows = rows.filter(F.floor(row_hash(keys, seed)) <= F.lit(round(cut)))
        out = rows if out is None else out.unionByName(rows)
    return out


def with_balanced_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Weight n / (classes * n_c)."""
    counts = class_counts(df, label)
    total = sum(counts.values())
    weight = F.lit(None).cast("double")
    for value, n in counts.items():
        weight = F.when(F.col(label) == value, F.lit(total / (len(counts) * n))).otherwise(weight)
    return df.withColumn(name, weight)
