"""The ``run_metrics`` table: statistics of all model runs, in long form.

A run becomes visible by its commit marker, which is written last: one that breaks off halfway is nobody's predecessor.
Markers lie in a sub-folder that readers of the table pass over.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import RUN_METRICS_SCHEMA
from .abtest import STATS


_COMMIT_SCHEMA = "committed boolean, experiment string, run_id string"


def _commits(path: str) -> str:
    return f"{path.rstrip('/')}/_commits"


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed runs."""
    commits = spark.read.schema(_COMMIT_SCHEMA).parquet(_commits(path))
    return spark.read.schema(RUN_METRICS_SCHEMA).parquet(path).join(commits, ["experiment", "run_id"], "left_semi").select(
        *RUN_METRICS_SCHEMA.fieldNames()
    )


def start_registry(spark: SparkSession, path: str) -> None:
    """Create the empty table, unless it exists."""
    for schema, folder in ((RUN_METRICS_SCHEMA, path), (_COMMIT_SCHEMA, _commits(path))):
        spark.createDataFrame([], schema).write.mode("ignore").partitionBy("experiment", "run_id").parquet(folder)


def commit_run(spark: SparkSession, path: str, experiment: str, run_id: str) -> None:
    """Make a run visible, once all its rows are written."""
    _replace_run(spark.range(1).select(F.lit(True).alias("committed")), _commits(path), experiment, run_id)


def _replace_run(rows: DataFrame, path: str, experiment: str, run_id: str) -> None:
    named = rows.select(F.lit(experiment).alias("experiment"), F.lit(run_id).alias("run_id"), "*")
    (
        named.coalesce(1)  # a few rows per run
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("experiment", "run_id")
        .parquet(path)
    )


def log_values(
    values: DataFrame, path: str, experiment: str, run_id: str, start_time: datetime, commit: bool = True
) -> None:
    """Write the ``(metric, stat, value)`` rows of a run. Logging a run again replaces its rows.

    Without ``commit`` the run stays invisible until ``commit_run``.
    """
    rows = values.select(
        F.lit(start_time).cast("timestamp").alias("start_time"),
        "metric",
        "stat",
        F.col("value").cast("double").alias("value"),
    )
    _replace_run(rows, path, experiment, run_id)
    if commit:
        commit_run(values.sparkSession, path, experiment, run_id)


def log_decisions(compared: DataFrame, path: str, experiment: str, run_id: str) -> None:
    """Write the text of each tested metric; a first run has none."""
    rows = compared.filter("decision is not null").select("metric", "significant", "decision")
    _replace_run(rows, path, experiment, run_id)


def summary_values(summary: DataFrame) -> DataFrame:
    """The summary of a run as ``(metric, stat, value)``."""
    pairs = ", ".join(f"'{stat}', `{c}`" for stat, c in zip(STATS, ["mean", "std", "low", "high"]))
    return summary.selectExpr("metric", f"stack({len(STATS)}, {pairs}) as (stat, value)")


def comparison_values(compared: DataFrame) -> DataFrame:
    """z-scores and p-values as ``(metric, stat, value)``."""
    pairs = "'z_score', z_score, 'p_value', p_value"
    return compared.selectExpr("metric", f"stack(2, {pairs}) as (stat, value)").filter("value is not null")


def newest_runs(runs: DataFrame, n: int = 2) -> DataFrame:
    """The n runs of all experiments that started last."""
    distinct = runs.select("experiment", "run_id", "start_time").distinct()
    return distinct.orderBy(F.desc("start_time"), F.desc("run_id")).limit(n)


def nth_newest_run(runs: DataFrame, n: int = 2) -> DataFrame:
    """Per experiment the n-th newest run; 2 is the predecessor of the newest.

    Spark keeps n runs per experiment already before the shuffle.
    """
    distinct = runs.select("experiment", "run_id", "start_time").distinct()
    order = Window.partitionBy("experiment").orderBy(F.desc("start_time"), F.desc("run_id"))
    return distinct.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") == n).drop("_rank")


def summary_of(runs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``(experiment, run_id, metric, mean, std)`` of chosen runs, from the long table."""

    def stat(name: str) -> Column:
        return F.max(F.when(F.col("stat") == name, F.col("value"))).alias(name)

    keys = ["experiment", "run_id"]
    return (
        runs.join(chosen.select(*keys), keys, "left_semi").groupBy(*keys, "metric").agg(stat("mean"), stat("std"))
    )


def before_run(runs: DataFrame, experiment: str, run_id: str) -> DataFrame:
    """``(metric, mean, std)`` of the run of an experiment before this one; empty for a first run.

    A run that is not logged yet counts as the newest.
    """
    own = runs.filter((F.col("experiment") == experiment) & (F.col("run_id") == run_id))
    began = own.agg(F.min("start_time").alias("_began"))  # one row
    others = runs.filter((F.col("experiment") == experiment) & (F.col("run_id") != run_id))
    others = others.join(F.broadcast(began), F.col("_began").isNull() | (F.col("start_time") < F.col("_began"))).drop("_began")
    return summary_of(others, nth_newest_run(others, 1)).select("metric", "mean", "std")
