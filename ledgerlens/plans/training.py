"""The training job: features, split, fit, A/B test against the previous run, saved model."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator
from pyspark.sql import DataFrame, SparkSession

from ..operators.abtest import ALPHA, bootstrap_metrics, compare, summarize
from ..operators.features import transaction_features
from ..operators.registry import (
    before_run,
    commit_run,
    comparison_values,
    log_decisions,
    log_values,
    read_runs,
    start_registry,
    summary_values,
)
from ..operators.sampling import split
from ..operators.skew import DEFAULT, HotKeys
from ..session import materialize
from . import modeling


def run_ab_test(
    scored: DataFrame,
    registry: str,
    experiment: str,
    run_id: str,
    start_time: datetime,
    replicates: int = 5,
    fraction: float = 0.1,
    seed: int = 42,
    alpha: float = ALPHA,
    decisions: str | None = None,
) -> DataFrame:
    """Bootstrap the metrics of scored rows, test them against the experiment's previous run, log both.

    Returns one row per metric; a first run has statistics only. ``decisions`` is a table for the texts. The run is
    visible to later ones once all of it is written.
    """
    spark = scored.sparkSession
    start_registry(spark, registry)
    summary = summarize(bootstrap_metrics(scored, replicates, fraction, seed))
    previous = before_run(read_runs(spark, registry), experiment, run_id)
    # Written before it is logged: the comparison must not read the run it is about to add.
    compared = materialize(compare(summary, previous, alpha), "ab-test")
    values = summary_values(compared).unionByName(comparison_values(compared))
    log_values(values, registry, experiment, run_id, start_time, commit=False)
    if decisions:
        log_decisions(compared, decisions, experiment, run_id)
    commit_run(spark, registry, experiment, run_id)
    return compared


def train(
    transactions: DataFrame,
    model_path: str,
    registry: str,
    experiment: str,
    run_id: str,
    start_time: datetime,
    classifier: Estimator | None = None,
    validation_fraction: float = 0.2,
    seed: int = 42,
    policy: HotKeys = DEFAULT,
) -> tuple[PipelineModel, DataFrame]:
    """Train on cleaned transactions; returns the model and the A/B comparison."""
    features = materialize(transaction_features(transactions, policy=policy), "features")
    training, validation = split(features, 1.0 - validation_fraction, seed)
    model = modeling.fit(training, classifier or modeling.forest(seed=seed))
    scored = materialize(
        modeling.predict(model, validation).select("transaction_id", "tx_fraud", "prediction", "probability"), "scored"
    )
    compared = run_ab_test(scored, registry, experiment, run_id, start_time, seed=seed)
    modeling.save(model, model_path)
    return model, compared


def score(spark: SparkSession, transactions: DataFrame, model_path: str, policy: HotKeys = DEFAULT) -> DataFrame:
    """``(transaction_id, prediction, probability, unscored)`` of every transaction; its history is in the same frame.

    Without history for all features there is no prediction, and ``unscored`` is ``no_history``.
    """
    features = transaction_features(transactions, policy=policy, complete=False)
    return modeling.predictions(modeling.load(model_path), features)
