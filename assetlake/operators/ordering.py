"""Ordered work that stays distributed when one key holds most of the rows.

A window over ``partitionBy(key)`` sorts the whole key in one task. The functions here cut the ordering
column into ranges of about equal row count (bounds from a mergeable quantile sketch), run the window inside
(key, range) cells and carry the small per-cell totals or edge rows across the cell borders. Results are exact:
the sketch only decides where the cuts lie.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from assetlake.session import shuffle_partitions, stored

RANGE = "_range"
DIGIT_TOP = 1 << 18  # above the number of every finite double's bucket
DIGIT_BUCKETS = 4096  # finer buckets of a pass of radix selection


def match_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on keys where NULL equals NULL; keeps the left side's key columns only."""
    renamed = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
    )
    condition = None
    for k in keys:
        term = left[k].eqNullSafe(renamed[f"_right_{k}"])
        condition = term if condition is None else condition & term
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"_right_{k}" for k in keys])


def range_count(df: DataFrame) -> int:
    """Number of ranges: the session's shuffle partitions rounded up to a power of two."""
    wanted = max(2, min(shuffle_partitions(df.sparkSession), 4096))
    size = 2
    while size < wanted:
        size *= 2
    return size


def range_bounds(df: DataFrame, column: str, size: int) -> DataFrame:
    """One row with the sorted cuts between ``size`` ranges of about equal row count (``size`` a power of two)."""
    cuts = [i / size for i in range(1, size)]
    return df.agg(F.percentile_approx(column, cuts, max(1000, 20 * size)).alias("bounds"))


def apply_range(df: DataFrame, column: str, bounds: DataFrame, size: int, name: str = RANGE) -> DataFrame:
    """Number of cuts at or below the value, by binary search in the cut array (NULL -> 0)."""
    steps, step = [], size // 2
    while step:
        steps.append(step)
        step //= 2
    return (
        df.withColumn("_bounds", bounds.scalar())
        .withColumn(
            name,
            F.aggregate(
                F.array(*[F.lit(s) for s in steps]),
                F.lit(0),
                lambda at, s: F.when(F.element_at("_bounds", at + s) <= F.col(column), at + s).otherwise(at),
            ),
        )
        .drop("_bounds")
    )


def with_range(df: DataFrame, column: str, ranges: int | None = None) -> DataFrame:
    """Add the number of the equal-count range the row's value falls into (0-based, ascending, NULL -> 0)."""
    size = ranges or range_count(df)
    return apply_range(df, column, range_bounds(df, column, size), size)


def _by(keys: Sequence[str]) -> list[Column]:
    return [F.col(k) for k in keys] or [F.lit(0)]


def running_totals(
    df: DataFrame,
    order_by: str,
    sums: Sequence[str],
    keys: Sequence[str] = (),
    descending: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``cum_<c>``: the running total of each column along ``order_by`` within ``keys``.

    The order column must be unique within ``keys`` (aggregate to distinct values first).
    """
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    ranged = with_range(df, order_by, ranges)
    cell = [*keys, RANGE]
    totals = ranged.groupBy(*cell).agg(*[F.sum(c).alias(f"_cell_{c}") for c in sums])
    before = Window.partitionBy(*_by(keys)).orderBy(direction(RANGE)).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *cell, *[F.coalesce(F.sum(f"_cell_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in sums]
    )
    inside = Window.partitionBy(*cell).orderBy(direction(order_by)).rowsBetween(Window.unboundedPreceding, 0)
    out = match_on(ranged, offsets, cell)
    for c in sums:
        out = out.withColumn(f"cum_{c}", F.col(f"_before_{c}") + F.sum(c).over(inside))
    return out.drop(RANGE, *[f"_before_{c}" for c in sums])


def row_numbers(
    df: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    name: str = "rn",
    ranges: int | None = None,
) -> DataFrame:
    """``row_number()`` along ``order_by`` within ``keys``; the first order column must be numeric or a time."""
    ranged = with_range(df, order_by[0], ranges)
    cell = [*keys, RANGE]
    totals = ranged.groupBy(*cell).agg(F.count(F.lit(1)).alias("_cell"))
    before = Window.partitionBy(*_by(keys)).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*cell, F.coalesce(F.sum("_cell").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*cell).orderBy(*[F.col(c) for c in order_by])
    return (
        match_on(ranged, offsets, cell)
        .withColumn(name, F.row_number().over(inside) + F.col("_before"))
        .drop(RANGE, "_before")
    )


def _composite_cuts(df: DataFrame, columns: Sequence[str], size: int) -> DataFrame:
    """One row with at most ``size - 1`` distinct ascending cuts, rows of ``df`` that part it into ranges of about equal row
    count along ``columns``; from the 40 rows for each range with the smallest hash, a sample of fixed size."""
    sample = df.select(F.struct(*columns).alias("cut")).orderBy(F.xxhash64("cut")).limit(40 * size)
    ordered = sample.agg(F.sort_array(F.collect_list("cut")).alias("cuts"))
    at = F.sequence(F.lit(1), F.lit(size - 1))
    picked = F.transform(at, lambda i: F.get("cuts", F.floor(i * F.size("cuts") / size).cast("int")))
    return ordered.select(F.array_distinct(F.array_compact(picked)).alias("cuts"))


def _with_composite_range(df: DataFrame, columns: Sequence[str], size: int) -> DataFrame:
    """Add the number of cuts at or below the row's ``columns`` and the cut that ends its range (null: none)."""
    steps = [size >> i for i in range(1, size.bit_length())]
    place = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: F.when(F.get("_cuts", at + s - 1) <= F.struct(*columns), at + s).otherwise(at),
    )
    cuts = _composite_cuts(df, columns, size).scalar()
    return df.withColumn("_cuts", cuts).withColumn(RANGE, place).withColumn("_end", F.get("_cuts", F.col(RANGE))).drop("_cuts")


def carried_rows(ranged: DataFrame, keys: Sequence[str], order_by: Sequence[str], lookback: int, columns: Sequence[str]) -> DataFrame:
    """The last ``lookback`` rows before each range of the key that the range's lower border cuts, if it cuts one.

    A range has one key at most that goes on beyond it, so there are no more than ranges x ``lookback`` of these rows.
    """
    goes_on = F.col("_end").isNotNull()
    for k in keys:
        goes_on = goes_on & F.col(k).eqNullSafe(F.col(f"_end.{k}"))
    latest = Window.partitionBy(RANGE).orderBy(*[F.col(c).desc() for c in order_by])
    tails = (
        ranged.filter(goes_on)
        .select(RANGE, *dict.fromkeys([*keys, *columns]))
        .withColumn("_r", F.row_number().over(latest))
        .filter(F.col("_r") <= lookback)
        .groupBy(*keys, RANGE)
        .agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("_tail"))
    )
    # a range between two borders of one key holds at least one of its rows, so `lookback` ranges suffice
    upto = Window.partitionBy(*_by(keys)).orderBy(RANGE).rowsBetween(1 - lookback, 0)
    before = tails.withColumn("_prev", F.flatten(F.collect_list("_tail").over(upto)))
    newest = F.slice("_prev", F.greatest(F.size("_prev") - lookback + 1, F.lit(1)), lookback)
    rows = before.select(*keys, (F.col(RANGE) + 1).alias(RANGE), F.explode(newest).alias("_row"))
    return rows.select(*keys, RANGE, *[F.col(f"_row.{c}").alias(c) for c in columns if c not in keys])


def recent_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    lookback: int,
    columns: Sequence[str],
    compute: Callable[[WindowSpec], dict[str, Column]],
    ranges: int | None = None,
) -> DataFrame:
    """Window expressions that look back at most ``lookback`` rows within ``keys``.

    ``compute`` receives the ordered window and returns the new columns; it may read ``columns`` only.
    Rows are cut into ranges along (keys, order), so a small key lies in one range and a hot one in many; a range is given
    the last ``lookback`` rows of the key that its border cuts, and no range needs its neighbours.
    """
    ranged = _with_composite_range(df, list(dict.fromkeys([*keys, *order_by])), ranges or range_count(df))
    carried = [*order_by, *[c for c in columns if c not in order_by]]
    carry = carried_rows(ranged, keys, order_by, lookback, carried).withColumn("_carry", F.lit(True))
    ordered = Window.partitionBy(RANGE, *keys).orderBy(*order_by)
    rows = ranged.drop("_end").withColumn("_carry", F.lit(False)).unionByName(carry, allowMissingColumns=True)
    return rows.withColumns(compute(ordered)).filter(~F.col("_carry")).drop(RANGE, "_carry")


def _magnitude(v: Column) -> Column:
    """Order-preserving number of the 64th of a power of two that a double lies in; NaN is above all."""
    power = F.floor(F.lit(64) * (F.log2(F.abs(v)) + 1100))
    sized = F.when(F.abs(v) == float("inf"), F.lit(DIGIT_TOP)).otherwise(power)
    return F.when(F.isnan(v), F.lit(DIGIT_TOP + 1)).when(v == 0, F.lit(0)).otherwise(F.signum(v).cast("long") * sized).cast("long")


def _upto(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Histogram rows (digit, n, ...) with the number of values before (first) and up to their bucket."""
    along = Window.partitionBy(*group).orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("upto", F.sum("n").over(along)).withColumn("first", F.col("upto") - F.col("n"))


def _between_passes(targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The wanted ranks after a pass: two rows for each column and probability of a whole table, else written once."""
    if keys:
        return stored(targets, "quantiles")
    return targets.sparkSession.createDataFrame(targets.collect(), targets.schema)


def _inside(df: DataFrame, intervals: set[tuple[str, float, float]]) -> DataFrame:
    """column, v, low and high of the values in a few disjoint intervals (column, low, high) of a whole table."""
    found = []
    for c in sorted({i[0] for i in intervals}):
        v = F.col(c).cast("double")
        cell = F.lit(None)
        for _, low, high in sorted(i for i in intervals if i[0] == c):
            own = F.struct(F.lit(c).alias("column"), v.alias("v"), F.lit(low).alias("low"), F.lit(high).alias("high"))
            cell = F.when(v.between(low, high), own).otherwise(cell)
        found.append(cell)
    return df.select(F.inline(F.array_compact(F.array(*found))))


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolation quantiles: rows (keys, column, prob, n, value).

    Radix selection over all columns and probabilities at once. The first pass counts values by the 64th of a power of two they
    lie in, every further pass counts the values of each bucket that holds a wanted rank in ``DIGIT_BUCKETS`` finer
    ones, until such a bucket has one distinct value. Counts combine before the shuffle, so a pass reads the rows once
    and shuffles histograms; no rows are sorted. Passes grow with the logarithm of the rows: usually two or three.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])
    values = df.select(*keys, F.inline(cells)).filter("v IS NOT NULL")
    bucket = [F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")]
    group = [*keys, "column"]
    counts = _upto(values.groupBy(*group, _magnitude(F.col("v")).alias("digit")).agg(*bucket), group)
    counts = counts.withColumn("total", F.max("upto").over(Window.partitionBy(*group)))
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.lit(side).alias("side")) for p in probs for side in (0, 1)])
    position = F.col("prob") * (F.col("total") - 1)
    targets = (
        counts.select("*", F.inline(wanted))
        .withColumn("rank", F.when(F.col("side") == 0, F.floor(position)).otherwise(F.ceil(position)))
        .filter((F.col("first") <= F.col("rank")) & (F.col("rank") < F.col("upto")))
        .select(*group, "prob", "side", "total", (F.col("rank") - F.col("first")).alias("rank"), "low", "high")
    )
    targets = _between_passes(targets, keys)
    interval = [*group, "low", "high"]
    while True:
        still = targets.filter("low < high")
        if still.isEmpty():
            break
        if keys:
            inside = match_on(values, still.select(*interval).distinct(), group, "inner").filter("v BETWEEN low AND high")
        else:
            inside = _inside(df, {tuple(r) for r in still.select(*interval).collect()})
        share = F.floor((F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * DIGIT_BUCKETS)
        finer = inside.withColumn("digit", F.least(share, F.lit(DIGIT_BUCKETS - 1)))
        finer = finer.withColumnsRenamed({"low": "_low", "high": "_high"}).groupBy(*group, "_low", "_high", "digit").agg(*bucket)
        finer = _upto(finer, [*group, "_low", "_high"]).withColumnsRenamed({"low": "low_value", "high": "high_value"})
        asked = still.withColumnsRenamed({"low": "_low", "high": "_high"})
        met = match_on(asked, finer, [*group, "_low", "_high"], "inner").filter("first <= rank AND rank < upto")
        narrowed = met.select(*group, "prob", "side", "total", (F.col("rank") - F.col("first")).alias("rank"), F.col("low_value").alias("low"), F.col("high_value").alias("high"))
        targets = _between_passes(targets.filter("NOT (low < high)").unionByName(narrowed), keys)
    ends = targets.groupBy(*group, "prob", "total").agg(*[F.max(F.when(F.col("side") == s, F.col("low"))).alias(name) for s, name in ((0, "below"), (1, "above"))])
    fraction = position - F.floor(position)
    value = F.when(F.col("below") == F.col("above"), F.col("below")).otherwise(F.col("below") + (F.col("above") - F.col("below")) * fraction)
    return ends.select(*group, "prob", F.col("total").alias("n"), value.alias("value"))


def wide_quantiles(quantiles: DataFrame, names: dict[tuple[str, float], str], keys: Sequence[str] = ()) -> DataFrame:
    """Turn the long quantile rows into one row per key with a named column per (column, prob)."""
    cells = [
        F.max(F.when((F.col("column") == c) & (F.col("prob") == p), F.col("value"))).alias(name)
        for (c, p), name in names.items()
    ]
    return quantiles.groupBy(*keys).agg(*cells)
