"""Date and time expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark numbers the days from Sunday = 1 to Saturday = 7.
WEEKEND = (1, 7)
THURSDAY_TO_SATURDAY = (5, 6, 7)

DAY_IN_PATH = r".*(\d{4}-\d{2}-\d{2})"


def is_weekend(ts: Column, days: Iterable[int] = WEEKEND) -> Column:
    return F.when(F.dayofweek(ts).isin(*days), 1).otherwise(0)


def hour_dummies(ts: Column, name: str = "tx_hour") -> list[Column]:
    """One 0/1 column per hour but the first, which is the base level."""
    hour = F.hour(ts)
    return [(hour == F.lit(h)).cast("int").alias(f"{name}_{h}") for h in range(1, 24)]


def repair_midnight(text: Column) -> Column:
    """``<day> 24:00:00`` becomes ``<next day> 00:00:00``; other text is unchanged."""
    day = F.try_to_date(F.substring(text, 1, 10))
    return F.when(
        F.substring(text, 12, 8) == "24:00:00",
        F.concat(F.date_add(day, 1).cast("string"), F.lit(" 00:00:00")),
    ).otherwise(text)


def day_of_path(path: Column) -> Column:
    """The last ``yyyy-mm-dd`` in a path, as a date."""
    return F.try_to_date(F.regexp_extract(path, DAY_IN_PATH, 1))


def on_day(ts: Column, day: str) -> Column:
    """Day equality as a half-open range, which reaches the Parquet scan."""
    start = F.lit(day).cast("date").cast("timestamp")
    return (ts >= start) & (ts < F.lit(day).cast("date").cast("timestamp") + F.expr("interval 1 day"))
