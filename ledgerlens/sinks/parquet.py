"""Day-partitioned Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter


def _by_day(df: DataFrame, globally_sorted: bool) -> DataFrameWriter:
    if globally_sorted:
        placed = df.repartitionByRange("tx_date", "transaction_id")
    else:
        # Adaptive execution joins small days into one task and splits a large day over several.
        placed = df.hint("rebalance", "tx_date")
    return placed.sortWithinPartitions("tx_date", "transaction_id").write.partitionBy("tx_date")


def overwrite_days(df: DataFrame, path: str, globally_sorted: bool = False) -> None:
    """Replace the days that occur in ``df``, leave the others."""
    _by_day(df, globally_sorted).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def write_new(df: DataFrame, path: str, globally_sorted: bool = False) -> None:
    """Write to a path that must not exist yet."""
    _by_day(df, globally_sorted).mode("errorifexists").parquet(path)
