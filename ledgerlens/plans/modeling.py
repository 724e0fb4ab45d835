"""Train, store and apply the fraud model: one fitted pipeline from feature columns to prediction."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.features import FEATURES

LABEL = "tx_fraud"

# Spark's names of the metrics.
EVALUATOR_NAMES = {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1"}


def forest(trees: int = 100, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol="scaled", labelCol=LABEL, numTrees=trees, seed=seed)


def logistic(max_iter: int = 1000) -> LogisticRegression:
    return LogisticRegression(featuresCol="scaled", labelCol=LABEL, maxIter=max_iter)


def build_pipeline(classifier: Estimator, columns: Sequence[str] = FEATURES) -> Pipeline:
    """Assemble, scale to unit deviation without centring, classify on the scaled vector."""
    assembler = VectorAssembler(inputCols=list(columns), outputCol="assembled", handleInvalid="error")
    scaler = StandardScaler(inputCol="assembled", outputCol="scaled")
    return Pipeline(stages=[assembler, scaler, classifier])


def fit(train: DataFrame, classifier: Estimator, columns: Sequence[str] = FEATURES) -> PipelineModel:
    """Fit on training rows only, the scaler included. Give it a written table: fitting reads it several times."""
    return build_pipeline(classifier, columns).fit(train.select(*columns, LABEL))


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with ``prediction`` and ``probability`` of fraud; batch or stream, keys and all columns kept."""
    scored = model.transform(df)
    return scored.select(*df.columns, "prediction", vector_to_array("probability")[1].alias("probability"))


def predict_all(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``predict`` for every row: one without complete features has no prediction and ``unscored`` says why."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in FEATURES])
    marked = df.withColumn("_features", F.struct(*FEATURES)).withColumn("_known", known)
    filled = marked.withColumns({c: F.when(F.col("_known"), F.col(c)).otherwise(0).cast(df.schema[c].dataType) for c in FEATURES})
    scored = predict(model, filled)
    kept = [F.col(f"_features.{c}").alias(c) if c in FEATURES else F.col(c) for c in df.columns]
    told = [F.when(F.col("_known"), F.col(c)).alias(c) for c in ("prediction", "probability")]
    return scored.select(*kept, *told, F.when(~F.col("_known"), "no_history").alias("unscored"))


def predictions(model: PipelineModel, df: DataFrame) -> DataFrame:
    return predict_all(model, df).select("transaction_id", "prediction", "probability", "unscored")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def evaluate(scored: DataFrame) -> dict[str, float]:
    """Accuracy and weighted precision, recall and F1 by Spark's evaluator (one job per metric).

    ``operators.metrics.weighted_metrics`` gives the same numbers from one job.
    """
    evaluator = MulticlassClassificationEvaluator(labelCol=LABEL, predictionCol="prediction")
    pairs = scored.select(LABEL, "prediction")
    return {m: evaluator.evaluate(pairs, {evaluator.metricName: name}) for m, name in EVALUATOR_NAMES.items()}


def area_under(scored: DataFrame, curve: str = "ROC") -> float:
    """Area under the ROC or PR curve of ``probability``."""
    evaluator = BinaryClassificationEvaluator(
        labelCol=LABEL, rawPredictionCol="probability", metricName=f"areaUnder{curve}"
    )
    return evaluator.evaluate(scored.select(LABEL, "probability"))
