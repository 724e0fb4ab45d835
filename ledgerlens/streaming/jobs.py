"""Streaming queries: score messages, set bad ones aside, keep keyed state."""

from __future__ import annotations

import time

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..plans.modeling import predict_all
from ..schemas import MESSAGE_TIMESTAMP
from ..session import STATE_STORE, scratch_path, use_utc
from .messages import decode, rejected, usable, write_end
from .state import DELAY, customer_state, terminal_state, transaction_state


def state_session(spark: SparkSession, keys: int = 0, keys_per_partition: int = 1_000_000) -> SparkSession:
    """A session for one stateful query, with state partitions for about so many ``keys``.

    Their number is fixed for the life of a query. State grows with the keys and not with the input, so the
    default is one partition per core and more only for more keys than a million a core.
    """
    session = use_utc(spark.newSession())
    partitions = max(spark.sparkContext.defaultParallelism, -(-keys // keys_per_partition))
    session.conf.set("spark.sql.shuffle.partitions", partitions)
    return session


def scored_messages(
    messages: DataFrame,
    model: PipelineModel,
    ttl_ms: int | None = None,
    delay: str = DELAY,
    history: DataFrame | None = None,
    remember_ms: int | None = None,
) -> DataFrame:
    """Decode, add the running features from keyed state, score.

    Messages are scored in event-time order, once the watermark, ``delay`` behind the newest, has passed them.
    A key's first transactions have no spread yet and late ones no features: they come without a prediction and
    with the reason, as in batch. ``history`` is the batch of transactions before the stream. Repeats that wait together are scored once; a repeat of an answered message is late. With
    ``remember_ms`` every repeat comes back with the reason ``repeated``, so that each input message has its output row.
    """
    features = transaction_state(usable(decode(messages)), ttl_ms, delay, history, remember_ms)
    scored = predict_all(model, features)
    reason = F.when(F.col("late_customer") | F.col("late_terminal"), "late").otherwise(F.col("unscored"))
    if remember_ms:
        reason = F.when(F.col("repeated_customer"), "repeated").otherwise(reason)
    return scored.withColumn("unscored", reason).drop("late_customer", "late_terminal", "repeated_customer")


def joined_state(transactions: DataFrame, delay: str = DELAY, source: DataFrame | None = None) -> DataFrame:
    """Customer and terminal features computed on two branches and joined per transaction.

    Both branches release a transaction in the same micro-batch. The join's state is bounded by the time of
    release, so late rows pass, too. ``transaction_state`` gives the same rows without a join.
    """
    left = customer_state(transactions, delay=delay, released="_released")
    right = terminal_state(transactions if source is None else source, delay=delay, released="_released_too")
    right = right.select(
        F.col("transaction_id").alias("_id"), "_released_too", *[c for c in right.columns if c.endswith("_terminal")]
    )
    same = (F.col("transaction_id") == F.col("_id")) & (F.col("_released") == F.col("_released_too"))
    return left.join(right, same, "inner").drop("_id", "_released", "_released_too")


def start(
    df: DataFrame,
    target: str,
    checkpoint: str,
    format: str = "json",
    trigger: dict | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Write a stream to files; offsets, state and finished files are in ``checkpoint``, so a restart adds no copy.

    ``trigger`` defaults to all that is available; ``{"processingTime": "10 seconds"}`` keeps running.
    """
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    writer = df.writeStream.format(format).outputMode(mode).option("checkpointLocation", checkpoint)
    if format == "json":
        writer = writer.option("timestampFormat", MESSAGE_TIMESTAMP)
    return writer.trigger(**(trigger or {"availableNow": True})).start(target)


def start_scoring(
    messages: DataFrame,
    model: PipelineModel,
    target: str,
    quarantine: str,
    checkpoint: str,
    ttl_ms: int | None = None,
    delay: str = DELAY,
    history: DataFrame | None = None,
    remember_ms: int | None = None,
    **options,
) -> list[StreamingQuery]:
    """Scored messages as JSON lines in ``target``, unusable ones in ``quarantine``; ``ttl_ms`` bounds the state."""
    return [
        start(scored_messages(messages, model, ttl_ms, delay, history, remember_ms), target, f"{checkpoint}/scored", **options),
        start(rejected(decode(messages)), quarantine, f"{checkpoint}/rejected", **options),
    ]


def finish(queries: list[StreamingQuery], seconds: float | None = None) -> None:
    """Wait for the queries, at most ``seconds`` in all, then stop those still running, also if one fails."""
    deadline = None if seconds is None else time.monotonic() + seconds
    try:
        for query in queries:
            if deadline is None:
                query.awaitTermination()
            else:
                query.awaitTermination(max(0.001, deadline - time.monotonic()))
    finally:
        for query in queries:
            query.stop()


def run_to_table(df: DataFrame, name: str, mode: str = "append", source: str | None = None) -> DataFrame:
    """Drain a stream into a Parquet table in the shared folder and return the table.

    With ``source``, the folder of its messages, the input is ended after that, so that buffers are drained, too.
    """
    spark: SparkSession = df.sparkSession
    target, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    finish([start(df, target, checkpoint, format="parquet", mode=mode)])
    if source:
        write_end(spark, source)
        finish([start(df, target, checkpoint, format="parquet", mode=mode)])
    return spark.read.schema(df.schema).parquet(target)


class RowsSeen(StreamingQueryListener):
    """Counts the input rows of all queries of a session."""

    def __init__(self):
        self.rows = 0

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.rows += event.progress.numInputRows

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
