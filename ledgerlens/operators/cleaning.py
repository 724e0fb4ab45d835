"""From raw text fields to typed, valid, distinct transactions.

The rules run in this order: the row's day must be the file's day, then ``24:00:00`` is repaired
(so such a row belongs to the file's day and is dated the next one), then the casts, then the signs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.temporal import repair_midnight
from ..schemas import COLUMNS, NUMERIC_COLUMNS, TRANSACTION_SCHEMA


def whole_number(text: Column, data_type: str) -> Column:
    """Text to an integer type; a fraction is cut off, anything else is NULL."""
    whole = F.regexp_extract(F.trim(text), r"^([+-]?\d+)\.\d*$", 1)
    return F.coalesce(text.try_cast(data_type), whole.try_cast(data_type))


def finite(number: Column) -> Column:
    """NULL instead of NaN and the infinities, which would spoil every sum they enter."""
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def typed(name: str) -> Column:
    """The cast of one raw field; NULL where the text does not fit."""
    text, data_type = F.col(name), TRANSACTION_SCHEMA[name].dataType.simpleString()
    if name == "tx_datetime":
        return F.try_to_timestamp(repair_midnight(text))
    if name == "tx_amount":
        return finite(text.try_cast("double"))
    return whole_number(text, data_type)


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def is_missing() -> Column:
    return _any([F.col(c).isNull() for c in COLUMNS])


def is_uncastable(name: str) -> Column:
    return F.col(name).isNotNull() & typed(name).isNull()


def is_negative(name: str) -> Column:
    return F.coalesce(typed(name) < 0, F.lit(False))


def is_midnight() -> Column:
    return F.coalesce(F.substring("tx_datetime", 12, 8) == "24:00:00", F.lit(False))


def is_foreign_day() -> Column:
    """No date, or another date than the file's."""
    return ~F.coalesce(F.try_to_date("tx_datetime") == F.col("file_day"), F.lit(False))


def with_defect(raw: DataFrame) -> DataFrame:
    """Add ``defect``: the first rule a row breaks, NULL for a good row."""
    return raw.withColumn(
        "defect",
        F.when(is_foreign_day(), "foreign_day")
        .when(is_missing(), "missing")
        .when(_any([is_uncastable(c) for c in COLUMNS]), "not_castable")
        .when(_any([is_negative(c) for c in NUMERIC_COLUMNS]), "negative"),
    )


def quarantine(raw: DataFrame) -> DataFrame:
    """The rows that ``clean`` rejects, with the reason. Copies are kept."""
    return with_defect(raw).filter(F.col("defect").isNotNull())


def clean(raw: DataFrame) -> DataFrame:
    """Valid transactions, one per distinct line of a file day, with ``tx_date`` = the file's day.

    Bad rows go before the shuffle, and copies collapse map-side, so a line repeated in a third of the
    input costs one row per task.
    """
    good = with_defect(raw).filter(F.col("defect").isNull()).select(*COLUMNS, "file_day")
    return good.dropDuplicates().select(*[typed(c).alias(c) for c in COLUMNS], F.col("file_day").alias("tx_date"))


def non_negative_ids(df: DataFrame) -> DataFrame:
    """Rows with three ids of 0 or more; a NULL id falls out."""
    return df.filter((F.col("transaction_id") >= 0) & (F.col("customer_id") >= 0) & (F.col("terminal_id") >= 0))


def known_customers(df: DataFrame) -> DataFrame:
    return df.filter(F.col("customer_id") >= 0)


def first_by_id(df: DataFrame) -> DataFrame:
    """The earliest row of each ``transaction_id``.

    Spark keeps one row per id already before the shuffle, so copies of one id do not pile up.
    """
    rest = [c for c in df.columns if c not in ("transaction_id", "tx_datetime")]
    order = Window.partitionBy("transaction_id").orderBy("tx_datetime", *rest)
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def clean_typed(df: DataFrame) -> DataFrame:
    """Cleaning of a typed scan: rows with a time, first row per id, valid ids."""
    return non_negative_ids(first_by_id(df.dropna(subset=["tx_datetime"])))
