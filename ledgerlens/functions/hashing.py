"""Draws that depend only on a row's key and a seed, so they survive retries and repartitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_RANGE = 2**32


def digest(*parts: Column) -> Column:
    """32 hex digits; the parts are joined with ``:``."""
    return F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))


def uniform(*parts: Column) -> Column:
    """A double in [0, 1) from the first eight hex digits of the digest."""
    return F.conv(F.substring(digest(*parts), 1, 8), 16, 10).cast("double") / F.lit(float(_RANGE))


def poisson_cutoffs(rate: float) -> list[float]:
    """P(X <= k) for k = 0, 1, ... until the tail is below the resolution of ``uniform``."""
    if not 0 < rate <= 10:
        raise ValueError("rate must be in (0, 10]")
    cutoffs, term, k = [math.exp(-rate)], math.exp(-rate), 0
    while 1.0 - cutoffs[-1] > 1.0 / _RANGE:
        k += 1
        term *= rate / k
        cutoffs.append(cutoffs[-1] + term)
    return cutoffs


def poisson_weight(u: Column, rate: float) -> Column:
    """How often a row is drawn when sampling with replacement at ``rate``."""
    weight = F.lit(0)
    for cutoff in poisson_cutoffs(rate):
        weight = weight + (u >= F.lit(cutoff)).cast("int")
    return weight
