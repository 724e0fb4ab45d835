"""Keys that are forgotten: segments of a key's history without a longer gap than it is remembered.

The batch twin of a stream's ``ttl_ms``: a transaction that comes longer than that after the one before it
starts a new segment, and features count inside the segment only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import DEFAULT, HotKeys, flag_hot, quoted
from .windows import running_features, same_slice, time_slice


def with_segment(
    df: DataFrame, keys: list[str], ttl_ms: int, policy: HotKeys = DEFAULT, source: DataFrame | None = None
) -> DataFrame:
    """Add ``_segment``, the time in microseconds at which the segment of the row began.

    Gaps and islands: a row starts a segment if its key has no row before it or the last one is too old. Hot keys are
    cut into time slices; the newest time of the earlier slices tells whether a slice's first row starts a segment, and
    the newest start in them gives the segment of rows before the slice's own first start. Rows without a time have no
    segment of their own (NULL).
    """
    at, names = "unix_micros(tx_datetime)", [f"`{c}`" for c in df.columns]
    flagged = flag_hot(df, keys, policy, source).selectExpr("*", f"if(_is_hot, {time_slice(at, policy)}, null) as _slice")
    part = f"over (partition by {quoted(keys)}, _slice order by {at}"
    rows = flagged.selectExpr(*names, "_slice", f"lag({at}) {part}) as _previous")
    newest = _earlier(flagged, keys, f"max({at})", "_newest")
    starts = f"if(coalesce(_previous, _newest) + {ttl_ms * 1000}L >= {at}, null, {at}) as _start"
    started = rows.join(newest, same_slice(keys), "left").selectExpr(*names, "_slice", starts)
    begun = _earlier(started, keys, "max(_start)", "_begun")
    inside = started.selectExpr(*names, "_slice", f"max(_start) {part}) as _own")
    return inside.join(begun, same_slice(keys), "left").selectExpr(*names, "coalesce(_own, _begun) as _segment")


def _earlier(rows: DataFrame, keys: list[str], measure: str, name: str) -> DataFrame:
    """Per slice of a hot key, the greatest value of the slices before it."""
    before = f"over (partition by {quoted(keys)} order by _slice rows between unbounded preceding and 1 preceding)"
    slices = rows.where("_slice is not null").groupBy(*keys, "_slice").agg(F.expr(f"{measure} as _value"))
    return slices.selectExpr(*[f"`{k}` as `_c_{k}`" for k in keys], "_slice as _c_slice", f"max(_value) {before} as {name}")


def expiring_features(
    df: DataFrame, keys: list[str], suffix: str, ttl_ms: int, *, policy: HotKeys = DEFAULT,
    source: DataFrame | None = None, **options,
) -> DataFrame:
    """``running_features`` of a key that is forgotten when it was not seen for longer than ``ttl_ms``.

    ``source`` is the frame ``df`` was derived from, with the same transactions.
    """
    told = with_segment(df, keys, ttl_ms, policy, source)
    own = None if source is None else with_segment(source, keys, ttl_ms, policy)
    return running_features(told, [*keys, "_segment"], suffix, policy=policy, source=own, **options).drop("_segment")
