"""Transactions as JSON messages: the key is the id as text, timestamps are ISO 8601 without a fraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import END_OF_INPUT, MESSAGE_TIMESTAMP, TOO_LATE, TRANSACTION_SCHEMA

_JSON = {"timestampFormat": MESSAGE_TIMESTAMP}


def encode(df: DataFrame, *beside: Column) -> DataFrame:
    """``(key, value)`` messages, and what else is asked for."""
    return df.select(
        F.col("transaction_id").cast("string").alias("key"), F.to_json(F.struct("*"), _JSON).alias("value"), *beside
    )


def first_n(df: DataFrame, n: int) -> DataFrame:
    """The n transactions with the smallest ids (top-k per task, then merged)."""
    return df.orderBy("transaction_id").limit(n)


def publish(df: DataFrame, topic: str, options: dict[str, str], n: int | None = None) -> None:
    """Send all or the first n transactions to a Kafka topic; brokers and credentials are ``options``."""
    chosen = df if n is None else first_n(df, n)
    encode(chosen).write.format("kafka").options(**options).option("topic", topic).save()


def write_messages(df: DataFrame, path: str, n: int | None = None) -> None:
    """The same messages as files, one value per line."""
    chosen = df if n is None else first_n(df, n)
    encode(chosen).select("value").write.mode("append").text(path)


def write_end(spark: SparkSession, path: str) -> None:
    """The message that ends a finite input: its time moves the watermark past every transaction, so none stays buffered.

    Send it once all other messages have been read; operators ``in_event_time`` do not return it.
    """
    end = spark.range(1).select(
        F.lit(-1).alias("transaction_id"),
        F.lit(END_OF_INPUT).cast("timestamp").alias("tx_datetime"),
        *[F.lit(-1).alias(c) for c in ("customer_id", "terminal_id")],
        F.lit(0.0).alias("tx_amount"),
    )
    encode(end).select("value").write.mode("append").text(path)


def read_topic(spark: SparkSession, topic: str, options: dict[str, str], max_offsets: int = 1_000_000) -> DataFrame:
    """A stream of message values. The cap bounds a micro-batch, and so what one hot key puts in a task."""
    stream = spark.readStream.format("kafka").options(**options)
    stream = stream.option("subscribe", topic).option("maxOffsetsPerTrigger", max_offsets)
    return stream.load().select(F.col("value").cast("string").alias("value"))


def read_message_files(
    spark: SparkSession, path: str, max_bytes: int = 2**30, max_files: int | None = None
) -> DataFrame:
    """The same stream from files of one message per line, with a cap per micro-batch in bytes or in files."""
    stream = spark.readStream
    if max_files:
        stream = stream.option("maxFilesPerTrigger", max_files)
    else:
        stream = stream.option("maxBytesPerTrigger", max_bytes)
    return stream.text(path)


def decode(messages: DataFrame, too_late: str = TOO_LATE) -> DataFrame:
    """The fields of each message, its text in ``value``, and ``_error`` if it cannot be used.

    A message needs an id, a time, a customer, a terminal and an amount; one without would spoil the
    running state of its keys. A time of ``too_late`` or later would move the watermark past all other messages;
    only the message that ends the input may have it.
    """
    # As a string first, so that a bad time can be told from an absent one.
    fields = ", ".join(
        f"{f.name} {'string' if f.name == 'tx_datetime' else f.dataType.simpleString()}" for f in TRANSACTION_SCHEMA
    )
    parsed = messages.select("value", F.from_json("value", f"{fields}, _broken string", _parse_options()).alias("m"))
    at = F.try_to_timestamp(F.col("m.tx_datetime"), F.lit(MESSAGE_TIMESTAMP))
    needed = ["customer_id", "terminal_id", "tx_amount"]
    endless = F.abs("m.tx_amount") >= F.lit(float("inf"))  # NaN, too, which Spark orders last
    incomplete = F.coalesce(endless, F.lit(False)) | F.greatest(*[F.col(f"m.{c}").isNull() for c in needed])
    ends = (at == F.lit(END_OF_INPUT).cast("timestamp")) & F.greatest(
        *[F.col(f"m.{c}") for c in ("transaction_id", "customer_id", "terminal_id")]
    ).eqNullSafe(F.lit(-1).cast("long"))
    error = (
        F.when(F.col("m").isNull() | F.col("m._broken").isNotNull(), "not_json")
        .when(F.col("m.transaction_id").isNull(), "no_id")
        .when(at.isNull(), "bad_time")
        .when((at >= F.lit(too_late).cast("timestamp")) & ~F.coalesce(ends, F.lit(False)), "far_time")
        .when(incomplete, "incomplete")
    )
    columns = [at.alias(f.name) if f.name == "tx_datetime" else F.col(f"m.{f.name}") for f in TRANSACTION_SCHEMA]
    return parsed.select(*columns, "value", error.alias("_error"))


def _parse_options() -> dict[str, str]:
    return {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}


def usable(decoded: DataFrame) -> DataFrame:
    return decoded.filter("_error is null").drop("value", "_error")


def rejected(decoded: DataFrame) -> DataFrame:
    """Messages to set aside, with the reason."""
    return decoded.filter("_error is not null").select("value", F.col("_error").alias("error"))


def distinct_messages(df: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drop repeats of an id that arrive within ``delay`` of each other (sources deliver at least once).

    The clock is that of arrival, not of the transaction: a repeat follows its first soon, while a message of
    an old transaction is no repeat. So no message is late, however the input is cut, and the state is bounded.
    """
    arrived = df.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", delay)
    return arrived.dropDuplicatesWithinWatermark(["transaction_id"]).drop("_arrived")
