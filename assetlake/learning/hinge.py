"""Support vector fit with a radial kernel by random Fourier features that are made anew in every pass.

Kept, the features of a row take ``size`` doubles; the scaled columns they are made of take a few. So the rows are kept as
blocks of scaled columns and a pass makes the features of some thousand rows at a time, takes the sums it needs and
forgets them. Making them is most of a pass, so a fit takes few passes and learns much in each: the loss at several lengths
of a step, the gradient and the second derivatives. The steps (Newton's, on a hinge whose corner is rounded less and less) are
taken on the driver; to it come about ``size ** 2 / 2`` sums for every ``TASKS_A_SUM`` tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlake.session import stored

ROWS_PER_TASK = 200_000  # fewer rows than this are not worth a task of their own
BLOCK_ROWS = 50_000
AT_ONCE = 2048  # rows whose features are held at a time
MARGINS_AT_ONCE = 256
TASKS_A_SUM = 32  # tasks whose sums are added up in the cluster before they come to the driver
WIDTHS = 2.0, 0.1  # how far from a margin of 1 the corner of the hinge is rounded, at first and at last
RIDGE = 1e-3  # of the mean second derivative, added to each; it shortens a step and does not move the minimum
LENGTHS = 2.0 ** np.arange(2, -11, -1)  # of a step, whose loss a pass takes
SERIES = [(-1) ** k * (2 * math.pi) ** (2 * k + 1) / math.factorial(2 * k + 1) for k in range(11)]  # of sin(2 pi x), to 1/4
BLOCKS = "x binary, signed binary, n long, weight double"
SUMS = "sums binary"


def draws(width: int, size: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies (size, width) and shifts of the features of exp(-gamma |x - y|^2)."""
    drawn = np.random.RandomState(seed)
    return drawn.normal(0, np.sqrt(2 * gamma), (size, width)), drawn.uniform(0, 2 * np.pi, size)


@dataclass
class Reached:
    """Sums over all rows at a point: the loss there and at each of ``LENGTHS`` of a step, gradient and second derivatives."""

    before: float
    along: np.ndarray
    slope: np.ndarray
    bend: np.ndarray


def minimise(evaluate: Callable[[np.ndarray, np.ndarray, float, float], Reached], at: np.ndarray, steps: int, tol: float) -> np.ndarray:
    """Newton steps on the rounded hinge, its width halved with each until the last width, there until a step gains less than
    ``tol`` of the value. ``evaluate(at, step, length, width)`` gives the loss along ``step``, derivatives at ``length`` of it."""
    width, last = WIDTHS
    here = evaluate(at, np.zeros_like(at), 0.0, width)
    for _ in range(steps):
        spread = here.bend.trace() / len(at)
        if not here.slope.any() or not spread > 0:
            break
        step = -np.linalg.solve(here.bend + RIDGE * spread * np.eye(len(at)), here.slope)
        final, width = width == last, max(width / 2, last)
        there = evaluate(at, step, 1.0, width)  # most often the whole step is good, and its derivatives are at hand
        value, along = there.before, there.along
        best = int(np.argmin(along))
        gain = value - along[best]
        if final and not gain > 0:
            break
        length = 1.0
        if gain > 0 and value - along[LENGTHS == 1.0][0] < 0.7 * gain:
            length = float(LENGTHS[best])
            there = evaluate(at, step, length, width)
        elif not gain > 0:  # the derivatives of a wider corner lead nowhere: take those of this one
            length = 0.0
            there = evaluate(at, step, length, width)
        at, here = at + length * step, there
        if final and value - along[LENGTHS == length][0] <= tol * abs(value):
            break
    return at


def cosines(turns: np.ndarray) -> np.ndarray:
    """``cos(2 pi turns)`` in place, to 1e-15 for some turns: a sine series about the nearest zero, some twice as fast as ``np.cos``."""
    turns -= np.rint(turns)
    np.abs(turns, out=turns)
    np.subtract(0.25, turns, out=turns)
    square = turns * turns
    series = np.full_like(turns, SERIES[-1])
    for factor in SERIES[-2::-1]:
        series *= square
        series += factor
    turns *= series
    return turns


class _Fourier(Params, DefaultParamsReadable, DefaultParamsWritable):
    width = Param(Params._dummy(), "width", "entries of the input vector", TypeConverters.toInt)
    size = Param(Params._dummy(), "size", "number of features", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel coefficient", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the draws", TypeConverters.toInt)
    inputCol = Param(Params._dummy(), "inputCol", "scaled vector column read", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column of both classes' margins", TypeConverters.toString)

    def _drawn(self) -> tuple[np.ndarray, np.ndarray]:
        return draws(*[self.getOrDefault(p) for p in ("width", "size", "gamma", "seed")])


class FourierMargin(Model, _Fourier):
    """Margin of a linear model on ``sqrt(2/size) cos(w.x + b)``, in tasks and on streams."""

    coefficients = Param(Params._dummy(), "coefficients", "one for each feature", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "added to the margin", TypeConverters.toFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights, shifts = self._drawn()
        turned, moved = weights.T / (2 * math.pi), shifts / (2 * math.pi)
        factors = np.array(self.getOrDefault("coefficients")) * math.sqrt(2 / len(shifts))
        intercept = self.getOrDefault("intercept")

        @F.arrow_udf("double")
        def margin(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                known = batch.is_valid().to_numpy(zero_copy_only=False)
                x = batch.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(turned))
                out = np.full(len(batch), np.nan)
                found = [cosines(x[i : i + MARGINS_AT_ONCE] @ turned + moved) @ factors for i in range(0, len(x), MARGINS_AT_ONCE)]
                out[known] = np.concatenate([np.empty(0), *found]) + intercept
                yield pa.array(out)

        made = dataset.withColumn("_m", margin(vector_to_array(self.getOrDefault("inputCol"))))
        return made.withColumn(self.getOrDefault("outputCol"), both_margins("_m")).drop("_m")


def both_margins(name: str) -> Column:
    """Vector of both classes' margins from that of class 1."""
    return array_to_vector(F.array(-F.col(name), F.col(name)))


class FourierSVC(Estimator, _Fourier):
    """Weighted hinge loss without regularisation on random Fourier features of a scaled vector column; labels are 0 or 1."""

    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "weight column", TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "most steps", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "least gain of a step, as a share of the loss", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, width=1, size=256, gamma=1.0, seed=42, inputCol="scaled", outputCol="margin", labelCol="label", weightCol="weight", maxIter=100, tol=1e-3):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(width=1, size=256, gamma=1.0, seed=42, inputCol="scaled", outputCol="margin", labelCol="label", weightCol="weight", maxIter=100, tol=1e-3)

    def _fit(self, dataset: DataFrame) -> FourierMargin:
        weights, shifts = self._drawn()
        size, width = weights.shape
        label = F.col(self.getOrDefault("labelCol")).cast("double")
        sign = F.when(label.isin(0.0, 1.0), 2 * label - 1).otherwise(F.raise_error(F.lit("a label must be 0 or 1")))
        rows = dataset.select(vector_to_array(self.getOrDefault("inputCol")).alias("x"), (sign * F.col(self.getOrDefault("weightCol"))).alias("signed"))
        kept = stored(rows.mapInArrow(_to_blocks, BLOCKS), "hinge")
        n, total = kept.agg(F.sum("n"), F.sum("weight")).first()
        if not total:
            raise ValueError("no rows with a weight")
        tasks = max(1, n // ROWS_PER_TASK)
        blocks = kept.select("x", "signed").coalesce(tasks).persist()

        def evaluate(at: np.ndarray, step: np.ndarray, length: float, width: float) -> Reached:
            sums = blocks.mapInArrow(_hinge(weights, shifts, at, step, length, width), SUMS)
            if tasks > TASKS_A_SUM:
                sums = sums.repartition(-(-tasks // TASKS_A_SUM)).mapInArrow(_added_up, SUMS)
            found = sum(np.frombuffer(r["sums"]) for r in sums.collect()) / total
            bend = np.zeros((size + 1, size + 1))
            bend[np.triu_indices(size + 1)] = found[len(LENGTHS) + size + 2 :]
            return Reached(found[0], found[1 : len(LENGTHS) + 1], found[len(LENGTHS) + 1 :][: size + 1], bend + np.triu(bend, 1).T)

        try:
            at = minimise(evaluate, np.zeros(size + 1), self.getOrDefault("maxIter"), self.getOrDefault("tol"))
        finally:
            blocks.unpersist()
        shared = {p: self.getOrDefault(p) for p in ("width", "size", "gamma", "seed", "inputCol", "outputCol")}
        return FourierMargin()._set(**shared, coefficients=(at[:-1] * math.sqrt(size)).tolist(), intercept=float(at[-1]))


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows: x as 32-bit floats, and the weight with the sign of the class."""
    xs: list[np.ndarray] = []
    signs: list[np.ndarray] = []

    def block() -> pa.RecordBatch:
        signed = np.concatenate(signs)
        values = [np.concatenate(xs).astype("<f4").tobytes(), signed.tobytes(), len(signed), float(np.abs(signed).sum())]
        kinds = [pa.binary(), pa.binary(), pa.int64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], ["x", "signed", "n", "weight"])

    for batch in batches:
        if not batch.num_rows:
            continue
        xs.append(batch.column(0).flatten().to_numpy(zero_copy_only=False))
        signs.append(batch.column(1).to_numpy(zero_copy_only=False).astype(float))
        if sum(map(len, signs)) >= BLOCK_ROWS:
            yield block()
            xs.clear(), signs.clear()
    if signs:
        yield block()


def _hinge(weights: np.ndarray, shifts: np.ndarray, at: np.ndarray, step: np.ndarray, length: float, width: float):
    """Function of a task's blocks: sums of the loss at no step and ``LENGTHS`` of it, then of the gradient by feature and
    intercept and of the second derivatives (upper triangle) at ``length`` of it.

    The loss of a row that lacks u of a margin of 1 is 0 to ``u = -width``, u from ``width`` and a parabola between. The features are
    ``sqrt(2) cos(w.x + b)``, near deviation 1, in 32 bits, and 1 for the intercept; sums over blocks are doubles.
    """
    turned = np.column_stack([weights.T, np.zeros(weights.shape[1])]).astype("<f4")  # the intercept's cosine is that of 0
    moved = np.append(shifts, 0).astype("<f4")
    scale = np.append(np.full(len(shifts), math.sqrt(2)), 1.0)
    factors = np.column_stack([at * scale, step * scale]).astype("<f4")
    lengths = np.append(0.0, LENGTHS)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        along, slope, bend = np.zeros(len(lengths)), np.zeros(len(at)), np.zeros((len(at), len(at)))
        for batch in batches:
            for x, signed in zip(*batch.columns):
                signed = np.frombuffer(signed.as_buffer())
                x = np.frombuffer(x.as_buffer(), "<f4").reshape(len(signed), -1)
                for i in range(0, len(signed), AT_ONCE):
                    z = x[i : i + AT_ONCE] @ turned
                    z += moved
                    np.cos(z, out=z)
                    part = signed[i : i + AT_ONCE]
                    weight, sign = np.abs(part), np.sign(part)
                    now, more = (z @ factors).T.astype(float) * sign
                    lack = 1 - now - lengths * more
                    along += (width * _share(lack, width) ** 2 + np.maximum(lack - width, 0)) @ weight
                    lack = 1 - now - length * more
                    slope -= (part * _share(lack, width)).astype("<f4") @ z
                    bent = np.abs(lack) < width
                    root = z[bent] * np.sqrt(weight[bent] / (2 * width)).astype("<f4")[:, None]
                    bend += root.T @ root
        sums = np.concatenate([along, slope * scale, (bend * scale * scale[:, None])[np.triu_indices(len(at))]])
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["sums"])

    return run


def _share(lack: np.ndarray, width: float) -> np.ndarray:
    """Slope of the rounded hinge."""
    return np.clip((lack + width) / (2 * width), 0, 1)


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = [np.frombuffer(v.as_buffer()) for batch in batches for v in batch.column(0)]
    if found:
        yield pa.RecordBatch.from_arrays([pa.array([sum(found).tobytes()], pa.binary())], ["sums"])
