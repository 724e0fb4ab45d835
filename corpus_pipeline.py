"""A training-corpus pipeline: toxicity, near duplicates, benchmark passages, secrets, mixture."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.decontaminate import decontaminate
from ledgerlens.llm.jaccard_join import jaccard_components
from ledgerlens.llm.queries import TOXIC_FROM, mixture
from ledgerlens.llm.secret_scan import scan_secrets
from ledgerlens.llm.toxicity import score_toxicity
from ledgerlens.session import bound_batches, materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at ``TOXIC_FROM`` or more go."""
    bound_batches(spark)  # of all stages: texts are long
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_toxicity(docs, spark.read.parquet(f"{sf_dir}/documents.parquet"), labels)
    return scored.where(F.col("score") < TOXIC_FROM).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents that with the smallest id stays; of repeated rows, one does."""
    groups = jaccard_components(docs, k=5, percent=75)
    go = groups.where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(go.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns).distinct()


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), width=10)
    return found.where("n_hit = 0").select("row.*")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with its secrets masked and its length set anew."""
    masked = scan_secrets(docs, carry=[c for c in docs.columns if c not in ("text", "n_chars")])
    columns = {
        "text": F.col("masked_text"),
        "n_chars": F.char_length("masked_text").cast(docs.schema["n_chars"].dataType),
    }
    return masked.select(*[columns[c].alias(c) if c in columns else F.col(f"row.`{c}`") for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row per document and epoch it is in; columns of ``docs`` of the names that it adds give way."""
    own = [c for c in docs.columns if c.lower() not in ("domain", "n_tokens", "epoch")]
    return mixture(docs).select(*[F.col(f"row.`{c}`") for c in own], "domain", "n_tokens", F.col("epoch").cast("int").alias("epoch"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on what its predecessor has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: A trained classifier and set similarity by components are beyond SQL; tests compare with brute force.
ORACLE_SQL = None
