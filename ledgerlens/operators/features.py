"""The feature table that training and scoring share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import WEEKEND, hour_dummies, is_weekend
from .expiry import expiring_features
from .skew import DEFAULT, HotKeys
from .windows import running_features

# The columns of the feature vector, in its order.
FEATURES = [
    "tx_amount",
    "time_since_last_tx",
    "avg_tx_amount_customer",
    "tx_count_customer",
    "sd_tx_amount_customer",
    "avg_tx_amount_terminal",
    "tx_count_terminal",
    "sd_tx_amount_terminal",
]


def calendar_features(df: DataFrame, weekend_days: Iterable[int] = WEEKEND) -> DataFrame:
    """Weekend flag, hour of day and its 0/1 columns: no shuffle."""
    ts = F.col("tx_datetime")
    return df.select(
        "*", is_weekend(ts, weekend_days).alias("is_weekend"), F.hour(ts).alias("tx_hour"), *hour_dummies(ts)
    )


def customer_features(
    df: DataFrame, *, unit_divisor: float = 1.0, policy: HotKeys = DEFAULT, ttl_ms: int | None = None
) -> DataFrame:
    """``ttl_ms``, here and below: a key not seen for longer starts anew, as on a stream with this setting."""
    options = {"gap": True, "unit_divisor": unit_divisor, "policy": policy}
    if ttl_ms:
        return expiring_features(df, ["customer_id"], "customer", ttl_ms, **options)
    return running_features(df, ["customer_id"], "customer", **options)


def terminal_features(
    df: DataFrame, *, policy: HotKeys = DEFAULT, source: DataFrame | None = None, ttl_ms: int | None = None
) -> DataFrame:
    if ttl_ms:
        return expiring_features(df, ["terminal_id"], "terminal", ttl_ms, policy=policy, source=source)
    return running_features(df, ["terminal_id"], "terminal", policy=policy, source=source)


def transaction_features(
    df: DataFrame,
    *,
    weekend_days: Iterable[int] = WEEKEND,
    unit_divisor: float = 1.0,
    policy: HotKeys = DEFAULT,
    complete: bool = True,
    ttl_ms: int | None = None,
) -> DataFrame:
    """All running features of customer and terminal.

    ``complete`` drops rows in which a feature is NULL or NaN: the first transactions of each customer and of
    each terminal, which have no spread yet. Other columns may be NULL, such as a label still to come.
    """
    features = customer_features(df, unit_divisor=unit_divisor, policy=policy, ttl_ms=ttl_ms)
    features = terminal_features(features, policy=policy, source=df, ttl_ms=ttl_ms)
    features = features.withColumn("is_weekend", is_weekend(F.col("tx_datetime"), weekend_days))
    return features.dropna(subset=[*FEATURES, "is_weekend"]) if complete else features
