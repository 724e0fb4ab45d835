"""Classification metrics from confusion counts.

Only ``confusion`` looks at the rows, with map-side aggregation; all metrics are computed from its
few counts. ``by`` names grouping columns such as a bootstrap replicate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of the metrics.
METRICS = ["accuracy", "precision", "recall", "f1"]


def class_counts(df: DataFrame, label: str = "tx_fraud") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("row_count"))


def confusion(
    df: DataFrame,
    by: Sequence[str] = (),
    label: str = "tx_fraud",
    prediction: str = "prediction",
    weight: str | None = None,
) -> DataFrame:
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    keys = [F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")]
    return df.groupBy(*by, *keys).agg(rows.cast("bigint").alias("row_count"))


def confusion_matrix(counts: DataFrame, classes: Sequence[float] = (0.0, 1.0)) -> DataFrame:
    """One row per label, one column per predicted class."""
    pivoted = counts.groupBy("label").pivot("prediction", list(classes)).agg(F.sum("row_count"))
    return pivoted.select(
        "label", *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(f"predicted_{int(c)}") for c in classes]
    )


def class_report(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of each class; 0 where a class is never predicted or never true."""
    n, zero = F.col("row_count"), F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(zero)
    as_label = F.struct(F.col("label").alias("class"), n.alias("support"), zero.alias("predicted"), hit.alias("hits"))
    as_prediction = F.struct(
        F.col("prediction").alias("class"), zero.alias("support"), n.alias("predicted"), zero.alias("hits")
    )
    totals = (
        counts.select(*by, F.explode(F.array(as_label, as_prediction)).alias("c"))
        .groupBy(*by, F.col("c.class").alias("class"))
        .agg(*[F.sum(f"c.{m}").alias(m) for m in ("support", "predicted", "hits")])
    )
    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    return totals.select(
        *by, "class", "support", "hits", precision.alias("precision"), recall.alias("recall"), f1.alias("f1")
    )


def weighted_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, and precision, recall and F1 averaged over the classes by their support."""
    total = F.sum("support")

    def weighted(name: str):
        return F.try_divide(F.sum(F.col(name) * F.col("support")), total).alias(name)

    return (
        class_report(counts, by)
        .groupBy(*by)
        .agg(
            F.try_divide(F.sum("hits"), total).alias("accuracy"),
            weighted("precision"),
            weighted("recall"),
            weighted("f1"),
        )
    )


def accuracy(df: DataFrame, label: str = "tx_fraud", prediction: str = "prediction") -> DataFrame:
    same = F.col(label).cast("double") == F.col(prediction).cast("double")
    return df.agg(F.avg(same.cast("int")).alias("accuracy"))


def amount_moments(df: DataFrame, key: str) -> DataFrame:
    """Per key: count, sum, sum of squares, mean and population variance of the amount."""
    x = F.col("tx_amount")
    return df.groupBy(key).agg(
        F.count(x).alias("tx_count"),
        F.sum(x).alias("total_amount"),
        F.sum(x * x).alias("sum_of_squares"),
        F.avg(x).alias("avg_tx_amount"),
        F.var_pop(x).alias("var_pop_tx_amount"),
    )
