"""Exact decimal ratios.

``ROUND(a / b, s)`` done in integer arithmetic on DECIMAL(38,0): the quotient is
rounded half away from zero exactly once, so results do not depend on float
precision or on the scale Spark picks for a decimal division.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT = "decimal(38,0)"


def unscaled(col: Column, scale: int) -> Column:
    """The integer ``col * 10^scale`` as DECIMAL(38,0) (exact for a column of that scale)."""
    if scale:
        return (col * F.lit(10**scale)).cast(_INT)
    return col.cast(_INT)


def div_half_up(
    num: Column,
    den: Column,
    scale: int,
    num_scale: int = 0,
    den_scale: int = 0,
    times: int = 1,
) -> Column:
    """``round(times * num / den, scale)`` rounded half away from zero, as DECIMAL(38, scale).

    ``num_scale`` / ``den_scale`` are the decimal scales of the inputs (0 for
    integers). NULL in, NULL out. The caller guards ``den = 0``.
    """
    n = unscaled(num, num_scale)
    d = unscaled(den, den_scale)
    shift = scale + den_scale - num_scale
    a = (F.abs(n) * F.lit(times * 10 ** max(shift, 0))).cast(_INT)
    b = (F.abs(d) * F.lit(10 ** max(-shift, 0))).cast(_INT)
    top = (a * F.lit(2) + b).cast(_INT)
    bottom = (b * F.lit(2)).cast(_INT)
    quotient = ((top - top % bottom) / bottom).cast(_INT)
    signed = F.when((n < 0) != (d < 0), -quotient).otherwise(quotient)
    return (signed.cast(f"decimal({38 - scale},0)") / F.lit(10**scale)).cast(f"decimal(38,{scale})")
