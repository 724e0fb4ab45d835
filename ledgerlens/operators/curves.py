"""Exact areas under the ROC and precision-recall curves of a score, with ties, for any number of rows.

Rows are first counted per score, before the shuffle. The counts of all higher scores are running totals over a
range-partitioned table: inside a partition by a window, before it by one total per group and partition. So no task
sees all scores of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def running_totals(table: DataFrame, groups: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """``table`` with ``<column>_before``: the sum over the rows of the group with a higher ``order``, and ``<column>_all``.

    ``order`` is unique in a group and not NULL; groups may have NULL keys. ``table`` is read twice.
    """
    placed = table.repartitionByRange(*groups, F.desc(order)).withColumn("_part", F.spark_partition_id())
    placed = materialize(placed, "ranged")
    sums = placed.groupBy(*groups, "_part").agg(*[F.sum(c).alias(f"_{c}") for c in columns])
    of_group = Window.partitionBy(*groups)
    earlier = of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        F.col("_part").alias("_of"),
        *[F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}_earlier") for c in columns],
        *[F.sum(f"_{c}").over(of_group).alias(f"{c}_all") for c in columns],
    )
    inside = Window.partitionBy(*groups, "_part").orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    within = placed.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_{c}_inside") for c in columns])
    same = F.col("_part") == F.col("_of")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return within.join(starts, same).select(
        *[F.col(c) for c in table.columns],
        *[(F.col(f"_{c}_inside") + F.col(f"_{c}_earlier")).alias(f"{c}_before") for c in columns],
        *[F.col(f"{c}_all") for c in columns],
    )


def areas_under_curves(df: DataFrame, by: Sequence[str] = (), score: str = "probability", label: str = "tx_fraud") -> DataFrame:
    """Per group ``positives``, ``negatives``, ``area_under_roc`` and ``area_under_pr``.

    The first area is the share of pairs of a positive and a negative row that the score puts in order, ties counting
    half. The second is the average precision: at every score, precision among the rows of this score and higher,
    weighted by the positives of this score. Rows without score or label do not count. A group of one class has NULL
    areas.
    """
    positive = F.col(label).cast("double") == 1
    counts = (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*by, F.col(score).cast("double").alias("_score"))
        .agg(F.count_if(positive).alias("_p"), F.count_if(~positive).alias("_n"))
    )
    groups = list(by)
    if not groups:
        counts, groups = counts.withColumn("_one", F.lit(1)), ["_one"]
    totals = running_totals(materialize(counts, "score-counts"), groups, "_score", ["_p", "_n"])
    # Negatives below, and half of those at the same score.
    won = F.col("_p") * (F.col("_n_all") - F.col("_n_before") - F.col("_n") / 2.0)
    upto = F.col("_p_before") + F.col("_p")
    precision = F.col("_p") * upto / (upto + F.col("_n_before") + F.col("_n"))
    summed = totals.groupBy(*groups).agg(
        F.sum("_p").alias("positives"), F.sum("_n").alias("negatives"), F.sum(won).alias("_won"), F.sum(precision).alias("_precision")
    )
    both = (F.col("positives") > 0) & (F.col("negatives") > 0)
    return summed.select(
        *by,
        "positives",
        "negatives",
        F.when(both, F.try_divide(F.try_divide("_won", "positives"), "negatives")).alias("area_under_roc"),
        F.when(both, F.try_divide("_precision", "positives")).alias("area_under_pr"),
    )
