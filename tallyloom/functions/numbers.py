"""Number parsing, counters and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_number(text: Column, dtype: str = "int") -> Column:
    """Number in ``text``; text that is no number stops the query (ANSI cast)."""
    return text.cast(dtype)


def lenient_number(text: Column, dtype: str = "int") -> Column:
    """Number in ``text``, null where it is none."""
    return text.try_cast(dtype)


def add_counts(left: Column, right: Column) -> Column:
    """Sum of two counters in which a missing one counts as zero."""
    zero = F.lit(0).cast("long")
    return F.coalesce(left.cast("long"), zero) + F.coalesce(right.cast("long"), zero)


def _as_float(value: Column) -> Column:
    """32-bit value. The product keeps the optimizer from merging this cast with the cast to
    double that a division adds, which would skip the rounding."""
    return value.cast("float") * F.lit(1.0).cast("float")


def float_ratio(numerator: Column, denominator: Column) -> Column:
    """32-bit quotient of two whole numbers, each rounded to 32 bits first; null for a zero divisor."""
    divisor = F.when(denominator != 0, _as_float(denominator))
    return (_as_float(numerator) / divisor).cast("float")


def squared_norm(a: Column, b: Column) -> Column:
    """``a*a + b*b`` in 64 bits, so 32-bit inputs cannot overflow."""
    a, b = a.cast("long"), b.cast("long")
    return a * a + b * b


def wrap_int32(value: Column) -> Column:
    """The value a 32-bit register would hold (two's complement wrap-around)."""
    half = F.lit(1 << 31).cast("long")
    return F.pmod(value.cast("long") + half, F.lit(1 << 32).cast("long")) - half


def indicator(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for an unknown condition)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def random_int(seed: int) -> Column:
    """Uniform 32-bit integer per row. Not for values that are compared or joined on."""
    return (F.floor(F.rand(seed) * F.lit(float(1 << 32))) - F.lit(1 << 31)).cast("int")
