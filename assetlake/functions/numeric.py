"""Guards, rounding and simple arithmetic that must not raise under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Constants the derived features are defined with.
RATIO_EPSILON = 1e-10
POWER_DIVISOR = 9549.3


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_divide(numerator, denominator, default=None) -> Column:
    """Division that gives NULL (or ``default``) on a zero denominator."""
    result = F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))
    return result if default is None else F.coalesce(result, F.lit(default).cast("double"))


def percent(part, whole, scale: int = 2) -> Column:
    return F.round(safe_divide(100.0 * _col(part).cast("double"), whole), scale)


def count_where(condition: Column) -> Column:
    """Number of rows for which the condition is true; NULL counts as not true."""
    return F.count(F.when(condition, F.lit(1)))


def round_half_even(value, scale: int = 4) -> Column:
    return F.bround(_col(value), scale)


def round_half_up(value, scale: int = 4) -> Column:
    return F.round(_col(value), scale)


def to_double(value, default: float | None = 0.0) -> Column:
    """Lenient cast; text that is no number becomes ``default``."""
    result = _col(value).try_cast("double")
    return result if default is None else F.coalesce(result, F.lit(default))


def equal_width_bucket(value, low: float, high: float, bins: int) -> Column:
    """Bucket number 1..bins, 0 below ``low`` and bins+1 from ``high`` upwards."""
    return F.width_bucket(_col(value).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins))


def ratio_with_epsilon(numerator, denominator) -> Column:
    return _col(numerator) / (_col(denominator) + F.lit(RATIO_EPSILON))
