"""Comparison of two model runs by bootstrapped metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import two_sided_p
from .metrics import METRICS, confusion, weighted_metrics
from .sampling import bootstrap

# Names of the statistics of a metric.
STATS = ["mean", "std", "2.5th_percentile", "97.5th_percentile"]

ALPHA = 0.05


def bootstrap_metrics(
    scored: DataFrame, replicates: int = 5, fraction: float = 0.1, seed: int = 42, by: Sequence[str] = ()
) -> DataFrame:
    """``(by, replicate, metric, value)`` from one pass over rows scored once."""
    drawn = bootstrap(scored, replicates, fraction, seed)
    keys = [*by, "replicate"]
    wide = weighted_metrics(confusion(drawn, keys, weight="weight"), keys)
    pairs = ", ".join(f"'{m}', `{m}`" for m in METRICS)
    return wide.selectExpr(*[f"`{k}`" for k in keys], f"stack({len(METRICS)}, {pairs}) as (metric, value)")


def summarize(samples: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per metric the mean, population deviation and 2.5 / 97.5 percentiles (linear interpolation)."""
    bounds = F.percentile("value", F.array(F.lit(0.025), F.lit(0.975)))
    return (
        samples.groupBy(*by, "metric")
        .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), bounds.alias("bounds"))
        .select(
            *by,
            "metric",
            "mean",
            "std",
            F.col("bounds")[0].alias("low"),
            F.col("bounds")[1].alias("high"),
        )
    )


def z_score(mean: Column, std: Column, previous_mean: Column, previous_std: Column) -> Column:
    """NULL if neither run has any spread."""
    return F.try_divide(mean - previous_mean, F.sqrt(std * std + previous_std * previous_std))


# Fixed output text: verdict on a metric, with its name, the outcome, the p-value and the level.
DECISION, DIFFERS, ALIKE = "%s %s statistically significant difference (p_value=%.6f, alpha={alpha})", "has", "does not have"


def decision_text(metric: Column, p_value: Column, alpha: float) -> Column:
    outcome = F.when(p_value < alpha, DIFFERS).otherwise(ALIKE)
    return F.when(p_value.isNotNull(), F.format_string(DECISION.format(alpha=alpha), metric, outcome, p_value))


def compare(summary: DataFrame, previous: DataFrame, alpha: float = ALPHA, by: Sequence[str] = ()) -> DataFrame:
    """z-test of each metric against the previous run; NULL results where there is none.

    Both sides hold one row per metric.
    """
    keys = [*by, "metric"]
    old = previous.select(*keys, F.col("mean").alias("previous_mean"), F.col("std").alias("previous_std"))
    joined = summary.join(old, keys, "left")
    z = z_score(F.col("mean"), F.col("std"), F.col("previous_mean"), F.col("previous_std"))
    tested = joined.withColumn("z_score", z).withColumn("p_value", two_sided_p(F.col("z_score")))
    return tested.select(
        "*",
        (F.col("p_value") < alpha).alias("significant"),
        decision_text(F.col("metric"), F.col("p_value"), alpha).alias("decision"),
    )
