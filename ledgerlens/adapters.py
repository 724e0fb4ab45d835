"""The driver's tables seen as card transactions (``FIXTURES.md``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import scratch_path, use_utc
from .streaming.messages import encode


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as labelled transactions: one row per event."""
    events = use_utc(spark).read.parquet(f"{sf_dir}/events.parquet")
    ts = F.col("ts").cast("timestamp")
    is_error = F.col("event_type") == "error"
    return events.select(
        F.col("event_id").alias("transaction_id"),
        ts.alias("tx_datetime"),
        F.col("user_id").alias("customer_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("terminal_id"),
        F.col("value").alias("tx_amount"),
        (F.unix_seconds(ts) - 1704067200).cast("int").alias("tx_time_seconds"),
        F.datediff(ts.cast("date"), F.lit("2024-01-01").cast("date")).alias("tx_time_days"),
        F.when(is_error, 1).otherwise(0).alias("tx_fraud"),
        F.when(is_error, (1 + F.col("event_id") % 3).cast("int")).otherwise(0).alias("tx_fraud_scenario"),
    )


# The same table for DuckDB.
TRANSACTIONS_SQL = """
select event_id as transaction_id, ts as tx_datetime, user_id as customer_id,
       cast(json_extract_string(props, '$.k') as bigint) as terminal_id, value as tx_amount,
       cast(floor(epoch(ts)) as integer) - 1704067200 as tx_time_seconds,
       cast(date_diff('day', date '2024-01-01', cast(ts as date)) as integer) as tx_time_days,
       case when event_type = 'error' then 1 else 0 end as tx_fraud,
       case when event_type = 'error' then cast(1 + event_id % 3 as integer) else 0 end as tx_fraud_scenario
from events
"""


def raw_lines(tx: DataFrame) -> DataFrame:
    """Transactions as lines of daily text with known defects, and the ``day`` of their file.

    The defects depend on the id: negative id, midnight written as 24:00:00, a time on the day before,
    unknown customer, unreadable terminal, no amount, a line written twice.
    """
    n, ts = F.col("transaction_id"), F.col("tx_datetime")
    day = F.date_format(ts, "yyyy-MM-dd")
    at = (
        F.when(n % 53 == 0, F.concat(day, F.lit(" 24:00:00")))
        .when(n % 59 == 0, F.date_format(ts - F.expr("interval 1 day"), "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    )
    fields = [
        F.when(n % 97 == 0, -n).otherwise(n),
        at,
        F.when(n % 89 == 0, F.lit(-1)).otherwise(F.col("customer_id")),
        F.when(n % 101 == 0, F.lit("Err")).otherwise(F.col("terminal_id").cast("string")),
        F.when(n % 103 == 0, F.lit("")).otherwise(F.col("tx_amount").cast("string")),
        F.col("tx_time_seconds"),
        F.col("tx_time_days"),
        F.col("tx_fraud"),
        F.col("tx_fraud_scenario"),
    ]
    line = F.concat_ws(",", *[f.cast("string") for f in fields])
    copies = F.array_repeat(line, F.when(n % 41 == 0, 2).otherwise(1))
    lines = tx.select(F.explode(copies).alias("value"), day.alias("day"))
    comments = tx.select(F.lit("# transaction_id | tx_datetime").alias("value"), day.alias("day")).distinct()
    return lines.unionByName(comments)


def raw_files(spark: SparkSession, sf_dir: str) -> str:
    """Write ``raw_lines`` of all transactions as one folder of text files per day; returns the path."""
    path = scratch_path(spark, "daily-text")
    raw_lines(transactions(spark, sf_dir)).write.partitionBy("day").text(path)
    return path


def broken_messages(tx: DataFrame) -> DataFrame:
    """Transactions as JSON lines in ``value``, some of them unusable.

    The defects depend on the id: cut off, a time with a fraction, no id.
    """
    n = F.col("transaction_id")
    text = encode(tx).select(F.col("key").cast("bigint").alias("transaction_id"), "value")
    value = F.col("value")
    return text.select(
        F.when(n % 67 == 0, F.expr("substring(value, 1, length(value) - 5)"))
        .when(n % 71 == 0, F.regexp_replace(value, r'("tx_datetime":"[^"]*)"', '$1.250"'))
        .when(n % 73 == 0, F.regexp_replace(value, r'"transaction_id":\d+,', ""))
        .otherwise(value)
        .alias("value")
    )


def message_files(spark: SparkSession, messages: DataFrame) -> str:
    """Write messages as text files; returns the path."""
    path = scratch_path(spark, "messages")
    messages.write.text(path)
    return path


def rule_scores(tx: DataFrame, threshold: float) -> DataFrame:
    """A model that can be written in SQL: amounts above ``threshold`` are fraud."""
    return tx.withColumn("prediction", (F.col("tx_amount") > threshold).cast("double"))


def daily_runs(tx: DataFrame) -> DataFrame:
    """A run registry: each terminal is an experiment, each of its days a run with the mean amount."""
    return (
        tx.groupBy(F.col("terminal_id").cast("string").alias("experiment"), F.to_date("tx_datetime").alias("day"))
        .agg(F.min("tx_datetime").alias("start_time"), F.avg("tx_amount").alias("mean"), F.stddev_pop("tx_amount").alias("std"))
        .selectExpr(
            "experiment", "cast(day as string) as run_id", "start_time", "'amount' as metric",
            "stack(2, 'mean', mean, 'std', std) as (stat, value)",
        )
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with ``orders`` as transactions on day-level times: equal times are the rule."""
    use_utc(spark)
    lines, orders = spark.read.parquet(f"{sf_dir}/lineitem.parquet"), spark.read.parquet(f"{sf_dir}/orders.parquet")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("l_shipdate").cast("timestamp").alias("tx_datetime"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_suppkey").alias("terminal_id"),
        F.col("l_extendedprice").alias("tx_amount"),
        (F.col("l_returnflag") == "R").cast("int").alias("tx_fraud"),
    )
