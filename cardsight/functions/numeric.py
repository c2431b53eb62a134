"""Numeric column helpers: exact fixed-point sums, ratios, thresholds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


DEFAULT_SCALE = 6
#: The scale of values that need more: 18 decimals, held as decimals, which no double of a usual size exceeds.
WIDE_SCALE = 18


def fits_scale(value: Column, scale: int = DEFAULT_SCALE) -> Column:
    """Whether a double is a whole number of ``10**-scale``: units back in double give it, but for its last bit."""
    unit = float(10**scale)
    back = F.round(value * unit) / unit
    return F.coalesce((F.abs(value) < 9e18 / unit) & (F.abs(back - value) <= F.abs(value) * 4.5e-16), F.lit(True))


def to_fixed(c: str | Column, data_type: T.DataType, scale: int = DEFAULT_SCALE) -> Column:
    """Integral value whose sums are exact.

    Integral columns are widened to ``long``; fractional ones count in units of
    ``10**-scale``. A value that is not a whole number of these units raises an error.
    At ``WIDE_SCALE`` a value is a decimal of 18 places instead, rounded to them.
    """
    col = _col(c)
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return col.cast("long")
    if isinstance(data_type, T.BooleanType):
        return col.cast("int").cast("long")
    if scale == WIDE_SCALE:
        return col.cast(f"decimal(38,{WIDE_SCALE})")
    value, unit = col.cast("double"), float(10**scale)
    units = F.round(value * unit).cast("long")
    # Units back in double give the value itself, but for its last bit.
    fits = F.abs(units.cast("double") / unit - value) <= F.abs(value) * 4.5e-16
    message = F.concat(F.lit(f"a value needs more than {scale} decimals, raise scale: "), value.cast("string"))
    return F.when(value.isNull() | fits, units).otherwise(F.raise_error(message).cast("long"))


def from_fixed(total: Column, data_type: T.DataType, scale: int = DEFAULT_SCALE) -> Column:
    """Inverse of ``to_fixed`` for a sum: integral stays ``long``, else double."""
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return total
    if scale == WIDE_SCALE:
        return total.cast("double")
    return total.cast("double") / float(10**scale)


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as double, NULL when ``den`` is 0 or NULL (ANSI safe)."""
    return F.try_divide(_col(num).cast("double"), _col(den))


def ratio_or_zero(num: str | Column, den: str | Column) -> Column:
    """``safe_ratio`` with NULL replaced by 0.0 (the fraud-risk convention)."""
    return F.coalesce(safe_ratio(num, den), F.lit(0.0))


def hard_label(score: str | Column, threshold: float = 0.5) -> Column:
    """1 when the score is strictly above the threshold, else 0."""
    return (_col(score) > F.lit(threshold)).cast("int")
