from datetime import datetime

import pytest
from helpers import by_id
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerlens.adapters import transactions
from ledgerlens.operators import metrics, sampling, scaling
from ledgerlens.operators.features import FEATURES, transaction_features
from ledgerlens.operators.registry import read_runs
from ledgerlens.plans import modeling, training
from ledgerlens.schemas import SCORING_SCHEMA
from ledgerlens.session import materialize


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    return materialize(transaction_features(transactions(spark, sf_dir)), "features")


@pytest.fixture(scope="module")
def model(table):
    return modeling.fit(sampling.split(table)[0], modeling.forest(trees=10))


def test_defaults(spark):
    assert modeling.forest().getNumTrees() == 100 and modeling.forest().getSeed() == 42
    assert modeling.logistic().getMaxIter() == 1000


def test_model_reads_the_scaled_vector_fitted_on_training_rows(table, model):
    train = sampling.split(table)[0]
    scaled = model.stages[1].transform(model.stages[0].transform(train))
    values = vector_to_array("scaled")
    deviations = scaled.agg(*[F.stddev_samp(values[i]) for i in range(len(FEATURES))]).collect()[0]
    assert list(deviations) == pytest.approx([1.0] * len(FEATURES))
    assert model.stages[2].getFeaturesCol() == "scaled"
    by_sql = scaling.unit_deviation(train, FEATURES)
    one = by_sql.orderBy("transaction_id").select(*FEATURES).first()
    assert list(one) == pytest.approx(list(scaled.orderBy("transaction_id").select(values).first()[0]))


def test_scores_keep_the_key_and_all_rows(table, model):
    scored = modeling.predict(model, table)
    assert set(by_id(scored)) == set(by_id(table))
    assert scored.columns == [*table.columns, "prediction", "probability"]
    low, high = scored.agg(F.min("probability"), F.max("probability")).collect()[0]
    assert 0 <= low <= high <= 1
    assert {r["prediction"] for r in scored.select("prediction").distinct().collect()} <= {0.0, 1.0}


def test_a_loaded_model_predicts_the_same(spark, table, model, fresh_path):
    path = fresh_path("model")
    modeling.save(model, path)
    modeling.save(model, path)  # overwrites
    once, again = modeling.predictions(model, table), modeling.predictions(modeling.load(path), table)
    assert by_id(once, "prediction", "probability") == by_id(again, "prediction", "probability")


def test_metrics_of_a_model_equal_sparks_evaluator(table, model):
    scored = modeling.predict(model, table)
    ours = metrics.weighted_metrics(metrics.confusion(scored)).collect()[0].asDict()
    assert ours == pytest.approx(modeling.evaluate(scored), abs=1e-10)


def test_area_under_curve(spark):
    scored = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "tx_fraud int, probability double")
    assert modeling.area_under(scored) == pytest.approx(0.75)
    assert 0 < modeling.area_under(scored, "PR") <= 1


def test_training_job(spark, sf_dir, fresh_path):
    tx, path, runs = transactions(spark, sf_dir), fresh_path("model"), fresh_path("runs")
    _, first = training.train(tx, path, runs, "exp", "a", datetime(2024, 1, 1), classifier=modeling.forest(trees=5))
    _, second = training.train(tx, path, runs, "exp", "b", datetime(2024, 1, 2), classifier=modeling.logistic(20))
    assert {r["previous_mean"] for r in first.collect()} == {None}
    assert None not in {r["previous_mean"] for r in second.collect()}
    assert read_runs(spark, runs).select("run_id").distinct().count() == 2
    unlabelled = tx.select(*SCORING_SCHEMA.fieldNames())
    scored = training.score(spark, unlabelled, path)
    assert scored.columns == ["transaction_id", "prediction", "probability", "unscored"]
    assert scored.count() == tx.count()
    assert scored.filter("prediction is not null").count() == transaction_features(tx).count()
    assert scored.filter("(prediction is null) = (unscored = 'no_history')").count() == tx.count() - scored.filter("unscored is null").count()
