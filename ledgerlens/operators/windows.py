"""Per-key window features.

Ordered features use Spark's default frame, RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW:
transactions of one key at the same instant see each other. The previous transaction and the
earlier frauds are row-wise, so ``transaction_id`` breaks their ties.

A window puts the whole history of a key in one task. For the keys that are too large for that
(see ``skew``), the history is cut into time slices; the windows run inside a slice, and the
totals of all earlier slices, pre-aggregated before their shuffle, are added afterwards. The
result is the same, since equal times share a slice. Without hot keys, adaptive execution drops
all of this and the plain window remains.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import DEFAULT, HotKeys, flag_hot, quoted, same_key, split_hot

# Spans of the trailing features, in seconds.
HOUR = 3600
DAY = 24 * HOUR
WEEK = 7 * DAY
MONTH = 30 * DAY


def time_slice(micros: str, policy: HotKeys) -> str:
    """Slice number; rows without a time sort first, so they get a slice before all others."""
    return f"coalesce({micros} div {policy.slice_seconds * 1_000_000}L, {-(2**62)}L)"


def _earlier_slices(history: DataFrame, keys: list[str], prior_fraud: bool) -> DataFrame:
    """For each slice of a hot key, the totals of the slices before it.

    Means are kept as distances from the key's first mean, so that the sums of squares do not cancel.
    """
    summary = [
        "count(transaction_id) as _n",
        "count(tx_amount) as _m",
        "avg(tx_amount) as _mean",
        "var_pop(tx_amount) * count(tx_amount) as _m2",
        "max(tx_datetime) as _last",
    ]
    slices = f"over (partition by {quoted(keys)} order by _slice rows between unbounded preceding and "
    before = f"{slices} 1 preceding)"
    totals = [
        f"sum(_n) {before} as _n0",
        f"sum(_m) {before} as _m0",
        f"sum(_m * (_mean - _origin)) {before} as _s0",
        f"sum(_m2 + _m * (_mean - _origin) * (_mean - _origin)) {before} as _q0",
        f"max(_last) {before} as _last0",
    ]
    kept = ["_n0", "_m0", "_last0"]
    if prior_fraud:
        summary.append("sum(tx_fraud) as _fraud")
        totals.append(f"sum(_fraud) {before} as _fraud0")
        kept.append("_fraud0")
    names = [*[f"`{k}` as `_c_{k}`" for k in keys], "_slice as _c_slice"]
    return (
        history.groupBy(*keys, "_slice")
        .agg(*[F.expr(e) for e in summary])
        .selectExpr("*", f"first(_mean, true) {slices} unbounded following) as _origin")
        .selectExpr(*names, "_origin", *totals)
        .selectExpr(
            *[f"`_c_{k}`" for k in [*keys, "slice"]],
            *kept,
            "_origin + try_divide(_s0, _m0) as _mean0",
            "_q0 - try_divide(_s0, _m0) * _s0 as _m20",
        )
    )


def running_features(
    df: DataFrame,
    keys: list[str],
    suffix: str,
    *,
    gap: bool = False,
    prior_fraud: bool = False,
    population_variance: bool = False,
    unit_divisor: float = 1.0,
    policy: HotKeys = DEFAULT,
    source: DataFrame | None = None,
) -> DataFrame:
    """Running mean, count and sample standard deviation of the amount per key, up to each transaction.

    ``gap`` adds ``time_since_last_tx``, ``prior_fraud`` the number of earlier frauds of the key.
    ``source`` is the frame ``df`` was derived from, with the same transactions: hot keys and their
    slice totals are then read from it and not from the longer plan. One shuffle of the rows.
    """
    source = df if source is None else source
    slice_of_row = time_slice("unix_micros(tx_datetime)", policy)
    sliced = flag_hot(df, keys, policy, source).selectExpr("*", f"if(_is_hot, {slice_of_row}, null) as _slice")
    history = split_hot(source, keys, policy)[1].selectExpr("*", f"{slice_of_row} as _slice")

    part = f"over (partition by {quoted(keys)}, _slice order by tx_datetime"
    # One select, the finer order first: its sort then serves both orders.
    inner = []
    if gap:
        inner.append(f"lag(tx_datetime) {part}, transaction_id) as _previous")
    if prior_fraud:
        rows = "rows between unbounded preceding and 1 preceding"
        inner.append(f"sum(tx_fraud) {part}, transaction_id {rows}) as _fraud")
    inner += [
        f"count(transaction_id) {part}) as _n",
        f"count(tx_amount) {part}) as _m",
        f"avg(tx_amount) {part}) as _mean",
        f"var_pop(tx_amount) {part}) * count(tx_amount) {part}) as _m2",
    ]
    windowed = sliced.selectExpr(*[f"`{c}`" for c in df.columns], "_slice", *inner)

    # The rows already lie by (keys, _slice); only the small slice totals move for this join.
    carry = _earlier_slices(history, keys, prior_fraud)
    joined = windowed.join(carry, same_slice(keys), "left")

    # Two groups of amounts merge into one by their counts, means and sums of squared distances.
    merged = joined.selectExpr(
        "*",
        "_m + coalesce(_m0, 0) as _all",
        "if(_m0 > 0 and _m > 0, _mean - _mean0, 0) as _delta",
    ).selectExpr(
        "*",
        "if(_m0 > 0 and _m > 0, _mean0 + _delta * _m / _all, coalesce(_mean, _mean0)) as _avg",
        "if(_m0 > 0 and _m > 0, _m20 + _m2 + _delta * _delta * _m0 * _m / _all, coalesce(_m2, _m20)) as _squares",
    )
    out = [
        f"_avg as avg_tx_amount_{suffix}",
        f"_n + coalesce(_n0, 0) as tx_count_{suffix}",
        f"if(_all > 1, sqrt(greatest(_squares, 0) / (_all - 1)), null) as sd_tx_amount_{suffix}",
    ]
    if population_variance:
        out.append(f"if(_all > 0, greatest(_squares, 0) / _all, null) as var_pop_tx_amount_{suffix}")
    if gap:
        since = "unix_seconds(tx_datetime) - unix_seconds(coalesce(_previous, _last0))"
        out.append(f"({since}) / {float(unit_divisor)!r}D as time_since_last_tx")
    if prior_fraud:
        out.append(f"coalesce(_fraud, 0) + coalesce(_fraud0, 0) as prior_fraud_{suffix}")
    return merged.selectExpr(*[f"`{c}`" for c in df.columns], *out)


def same_slice(keys: list[str]):
    return same_key(keys, "_c_") & F.expr("_slice = _c_slice")


def key_statistics(
    df: DataFrame, keys: list[str], suffix: str, *, policy: HotKeys = DEFAULT, source: DataFrame | None = None
) -> DataFrame:
    """Mean, count and sample standard deviation over all transactions of a key, on each of its rows.

    Ordinary keys use one window. Hot keys are aggregated map-side and come back by broadcast (one
    row per hot key), while their rows are dealt into shares so that no window gets them all.
    """
    source = df if source is None else source
    statistics = {
        f"avg_tx_amount_{suffix}": "avg(tx_amount)",
        f"tx_count_{suffix}": "count(transaction_id)",
        f"sd_tx_amount_{suffix}": "stddev_samp(tx_amount)",
    }
    hot = (
        split_hot(source, keys, policy)[1]
        .groupBy(*keys)
        .agg(*[F.expr(f"{e} as _hot_{name}") for name, e in statistics.items()])
        .selectExpr("*", "true as _is_hot")
        .withColumnsRenamed({k: f"_hot_{k}" for k in keys})
    )
    flagged = df.join(F.broadcast(hot), same_key(keys), "left").selectExpr(
        "*", f"if(_is_hot, pmod(xxhash64(transaction_id), {policy.shares}), null) as _share"
    )
    part = f"over (partition by {quoted(keys)}, _share)"
    return flagged.selectExpr(
        *[f"`{c}`" for c in df.columns],
        *[f"if(_is_hot, _hot_{name}, {e} {part}) as {name}" for name, e in statistics.items()],
    )


def trailing_features(
    df: DataFrame,
    keys: list[str],
    suffix: str,
    spans: Mapping[str, int],
    *,
    frequency: bool = False,
    policy: HotKeys = DEFAULT,
    source: DataFrame | None = None,
) -> DataFrame:
    """Sum and count of the amounts of a key in ``(t - span, t]``, for each named span in seconds.

    ``frequency`` adds transactions per day of the span. Amounts must be finite or NULL, as cleaning
    leaves them. The cost per row does not depend on how many transactions a span holds.

    One window serves all keys. A key's sum is its running total up to t minus that up to ``t - span``: both frames only
    grow, so Spark adds each row once to each; it would recompute a sliding frame for every row. Rows of hot keys enter
    and leave a running total inside time slices, on top of the totals of the earlier slices. ``source`` is the frame
    ``df`` was derived from, with the same transactions.
    """
    source = df if source is None else source
    names = [f"`{c}`" for c in df.columns]
    moves = _moves(flag_hot(df, keys, policy, source), keys, spans, policy)
    carry = _moved_before(split_hot(source, keys, policy)[1].selectExpr("*", "true as _is_hot"), keys, spans, policy)

    part = f"over (partition by {quoted(keys)}, _slice order by _at"
    totals = [f"{e} {part}) as _{i}" for i, e in _MEASURED.items()]
    for name, seconds in spans.items():
        gone = f"range between unbounded preceding and {seconds * 1_000_000}L preceding"
        totals += [f"{e} {part} {gone}) as _gone_{name}_{i}" for i, e in _MEASURED.items()]
        totals += [f"sum(_{name}_{i}) {part}) as _upto_{name}_{i}" for i in _MEASURED]
    whole = f"{part} rows between unbounded preceding and unbounded following)"
    running = moves.selectExpr("*", f"avg(tx_amount) {whole} as _mean").selectExpr(
        *names, "_is_hot", "_enters", "_slice", "_mean", *totals
    )
    # Hot keys only: their slices meet the totals of the earlier ones.
    joined = running.filter("_enters").join(carry, same_slice(keys), "left")

    columns = []
    for name, seconds in spans.items():
        x, m, n = (f"(_{i} - coalesce(_gone_{name}_{i}, 0))" for i in _MEASURED)
        hot_x, hot_m, hot_n = (f"(_upto_{name}_{i} + coalesce(_before_{name}_{i}, 0))" for i in _MEASURED)
        columns += [
            f"if(_is_hot, if({hot_m} > 0, {hot_x}, null), if({m} > 0, {x} + _mean * {m}, null)) as sum_{name}_{suffix}",
            f"if(_is_hot, {hot_n}, {n}) as count_{name}_{suffix}",
        ]
    both = joined.selectExpr(*names, *columns)
    if not frequency:
        return both
    return both.selectExpr(
        "*", *[f"count_{n}_{suffix} / {seconds / DAY!r}D as per_day_{n}_{suffix}" for n, seconds in spans.items()]
    )


#: What is summed up: distances from the key's mean, which stay small, and the numbers of amounts and of rows.
_MEASURED = {"x": "sum(tx_amount - _mean)", "m": "count(tx_amount)", "n": "count(transaction_id)"}
_MOVED = {
    "x": "coalesce(tx_amount, 0D)",
    "m": "cast(tx_amount is not null as bigint)",
    "n": "cast(transaction_id is not null as bigint)",
}


def _moves(rows: DataFrame, keys: list[str], spans: Mapping[str, int], policy: HotKeys) -> DataFrame:
    """Each row once as it enters; those of hot keys once more for each span, at the time at which they leave it.

    Only what enters is a row of the result; what leaves carries no other columns.
    """
    # 0 for entering, else the seconds after which the transaction leaves.
    after = ", ".join(f"{seconds}L" for seconds in [0, *sorted(set(spans.values()))])
    moved = [
        f"{e} * case _after when 0 then 1 when {seconds} then -1 else 0 end as _{name}_{i}"
        for name, seconds in spans.items()
        for i, e in _MOVED.items()
    ]
    kept = [f"`{c}`" if c in [*keys, "_is_hot"] else f"if(_after = 0, `{c}`, null) as `{c}`" for c in rows.columns]
    return (
        rows.selectExpr("*", f"explode(if(_is_hot, array({after}), array(0L))) as _after")
        .selectExpr(*kept, "unix_micros(tx_datetime) + _after * 1000000L as _at", "_after = 0 as _enters", *moved)
        .selectExpr("*", f"if(_is_hot, {time_slice('_at', policy)}, null) as _slice")
    )


def _moved_before(hot: DataFrame, keys: list[str], spans: Mapping[str, int], policy: HotKeys) -> DataFrame:
    """For each slice of a hot key, what the slices before it have moved."""
    names = [f"{name}_{i}" for name in spans for i in _MOVED]
    before = f"over (partition by {quoted(keys)} order by _slice rows between unbounded preceding and 1 preceding)"
    return (
        _moves(hot, keys, spans, policy)
        .groupBy(*keys, "_slice")
        .agg(*[F.expr(f"sum(_{c}) as _{c}") for c in names])
        .selectExpr(
            *[f"`{k}` as `_c_{k}`" for k in keys],
            "_slice as _c_slice",
            *[f"sum(_{c}) {before} as _before_{c}" for c in names],
        )
    )
