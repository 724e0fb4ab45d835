"""Hot keys: the few keys that hold too many rows for one task.

A key is hot above ``max(hot_rows, rows / max_hot_keys)`` rows, so there are never more than
``max_hot_keys`` of them, whatever the data: the list is small enough to broadcast by arithmetic,
not by luck. Counting is exact and map-side combined, reads the key columns only, and gives the
same list on every retry. NULL is never hot: cleaned transactions have no NULL keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class HotKeys:
    hot_rows: int = 5_000_000
    max_hot_keys: int = 100_000
    # Length of the time slices a hot key's history is cut into.
    slice_seconds: int = 60
    # Number of shares a hot key's rows are dealt into where order does not matter.
    shares: int = 1024


DEFAULT = HotKeys()


def quoted(keys: list[str]) -> str:
    return ", ".join(f"`{k}`" for k in keys)


def hot_keys(df: DataFrame, keys: list[str], policy: HotKeys = DEFAULT) -> DataFrame:
    """At most ``policy.max_hot_keys`` rows, with the keys named ``_hot_<key>``."""
    rows = df.agg(F.expr("count(*)")).scalar()
    counts = df.dropna(subset=keys).groupBy(*keys).agg(F.expr("count(*) as _rows"))
    return counts.filter((F.col("_rows") > policy.hot_rows) & (F.col("_rows") * policy.max_hot_keys > rows)).selectExpr(
        *[f"`{k}` as `_hot_{k}`" for k in keys]
    )


def same_key(keys: list[str], prefix: str = "_hot_") -> Column:
    """Join condition between ``key`` and ``<prefix>key``."""
    return F.expr(" and ".join(f"`{k}` = `{prefix}{k}`" for k in keys))


def flag_hot(df: DataFrame, keys: list[str], policy: HotKeys, source: DataFrame | None = None) -> DataFrame:
    """Add ``_is_hot``: true, or NULL for ordinary keys.

    ``source`` is the frame ``df`` was derived from, cheaper to count in.
    """
    hot = hot_keys(df if source is None else source, keys, policy).selectExpr("*", "true as _is_hot")
    return df.join(F.broadcast(hot), same_key(keys), "left").drop(*[f"_hot_{k}" for k in keys])


def split_hot(
    df: DataFrame, keys: list[str], policy: HotKeys, source: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows of ordinary keys and the rows of hot keys.

    With no hot key the second frame is an empty join that adaptive execution drops.
    """
    hot = F.broadcast(hot_keys(df if source is None else source, keys, policy))
    return df.join(hot, same_key(keys), "left_anti"), df.join(hot, same_key(keys), "left_semi")
