"""Statistics that Spark has no built-in function for."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_TERMS = 80
_TAIL_FROM = 2.5


def erfc(x: Column) -> Column:
    """1 - erf(x) for x >= 0, to double precision.

    A power series with positive terms near 0, a continued fraction in the tail; both are evaluated
    from the innermost term outwards.
    """
    xx = x * x
    steps = F.sequence(F.lit(_TERMS), F.lit(1), F.lit(-1))
    series = F.aggregate(steps, F.lit(1.0), lambda acc, k: F.lit(1.0) + acc * F.lit(2.0) * xx / (F.lit(2.0) * k + 1))
    fraction = F.aggregate(steps, F.lit(1.0), lambda acc, k: F.lit(1.0) + k / (F.lit(2.0) * xx) / acc)
    gauss = F.exp(-xx)
    return F.when(x < _TAIL_FROM, F.lit(1.0) - F.lit(2.0 / math.sqrt(math.pi)) * x * gauss * series).when(
        x >= _TAIL_FROM, gauss / (x * F.lit(math.sqrt(math.pi)) * fraction)
    )


def normal_cdf(x: Column) -> Column:
    upper = erfc(F.abs(x) / F.lit(math.sqrt(2.0))) / F.lit(2.0)
    return F.when(x >= 0, F.lit(1.0) - upper).when(x < 0, upper)


def two_sided_p(z: Column) -> Column:
    """2 * (1 - cdf(|z|)), computed from the tail so that it does not cancel."""
    return erfc(F.abs(z) / F.lit(math.sqrt(2.0)))
