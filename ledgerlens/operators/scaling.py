"""Standard scaling as column expressions. The statistics are one aggregate row, read as a scalar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _statistics(df: DataFrame, columns: Sequence[str], spread) -> Column:
    parts = [F.struct(F.avg(c).alias("mean"), spread(c).alias("spread")).alias(c) for c in columns]
    return df.agg(F.struct(*parts).alias("stats")).scalar()


def _scaled(value: Column, spread: Column) -> Column:
    """A constant column has no spread and becomes 0, as the ML scalers do."""
    return F.coalesce(F.try_divide(value, spread), F.when(value.isNotNull(), F.lit(0.0)))


def standardize(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """``(x - mean) / population deviation``, replacing the columns."""
    stats = _statistics(df if fit_on is None else fit_on, columns, F.stddev_pop)
    return df.withColumns(
        {c: _scaled(F.col(c) - stats.getField(c).getField("mean"), stats.getField(c).getField("spread")) for c in columns}
    )


def unit_deviation(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """``x / sample deviation``, not centred, replacing the columns."""
    stats = _statistics(df if fit_on is None else fit_on, columns, F.stddev_samp)
    return df.withColumns({c: _scaled(F.col(c), stats.getField(c).getField("spread")) for c in columns})
