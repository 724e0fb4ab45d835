"""Schemas of the transaction tables. Ids are 64-bit."""

from pyspark.sql import types as T

# The nine fields of a transaction, in file order.
TRANSACTION_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.LongType()),
    T.StructField("tx_datetime", T.TimestampType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("terminal_id", T.LongType()),
    T.StructField("tx_amount", T.DoubleType()),
    T.StructField("tx_time_seconds", T.IntegerType()),
    T.StructField("tx_time_days", T.IntegerType()),
    T.StructField("tx_fraud", T.IntegerType()),
    T.StructField("tx_fraud_scenario", T.IntegerType()),
])

COLUMNS = TRANSACTION_SCHEMA.fieldNames()

# A request to score has no label.
SCORING_SCHEMA = T.StructType([f for f in TRANSACTION_SCHEMA if not f.name.startswith("tx_fraud")])

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in COLUMNS])

NUMERIC_COLUMNS = [f.name for f in TRANSACTION_SCHEMA if f.name != "tx_datetime"]

CLEAN_SCHEMA = T.StructType([*TRANSACTION_SCHEMA.fields, T.StructField("tx_date", T.DateType())])

RUN_METRICS_SCHEMA = T.StructType([
    T.StructField("experiment", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("metric", T.StringType()),
    T.StructField("stat", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

# The text form of a timestamp in stream messages.
MESSAGE_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss"

# The time of the message that ends a finite stream.
END_OF_INPUT = "2200-01-01T00:00:00"

# Messages of this time and later are set aside: one of them would make all that follow it late.
TOO_LATE = "2100-01-01T00:00:00"
