"""Profiles of raw and typed tables. Each report is one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import COLUMNS, NUMERIC_COLUMNS
from . import cleaning


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def schema_table(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "column_name string, data_type string")


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def _rows_per_name(totals: DataFrame, names: list[str], measures: list[str]) -> DataFrame:
    """One wide row of ``<name>|<measure>`` columns to one row per name."""
    rows = ", ".join(f"'{n}', " + ", ".join(f"`{n}|{m}`" for m in measures) for n in names)
    return totals.selectExpr(f"stack({len(names)}, {rows}) as (column_name, {', '.join(measures)})")


def cast_failures(raw: DataFrame) -> DataFrame:
    """Per column, the rows whose text does not fit the type, and the rows without text."""
    counts = []
    for c in COLUMNS:
        counts.append(F.count_if(cleaning.is_uncastable(c)).alias(f"{c}|bad_rows"))
        counts.append(F.count_if(F.col(c).isNull()).alias(f"{c}|missing_rows"))
    return _rows_per_name(raw.agg(*counts), COLUMNS, ["bad_rows", "missing_rows"])


def uncastable_rows(raw: DataFrame, name: str) -> DataFrame:
    """The rows behind a ``cast_failures`` count."""
    return raw.filter(cleaning.is_uncastable(name))


def negative_counts(df: DataFrame) -> DataFrame:
    """Per numeric column of a typed table, the rows below zero."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    totals = df.agg(*[F.count_if(F.col(c) < 0).alias(f"{c}|negative_rows") for c in numeric])
    return _rows_per_name(totals, numeric, ["negative_rows"])


def negative_rows(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(name) < 0)


def duplicate_groups(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, with ``copies``."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def quality_report(raw: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Rows per kind of defect. A row may count under several; ``comment`` counts lines.

    ``raw`` of ``text.read_marked`` has the comments beside the rows: one scan gives all. Else they are in ``lines``.
    Distinct rows are counted once with their number of copies, so the whole report is one shuffle,
    and copies collapse before it.
    """
    if lines is None:
        marked = raw
    else:
        comments = lines.filter(F.startswith("value", F.lit("#"))).select(F.lit(True).alias("is_comment"))
        marked = raw.withColumn("is_comment", F.lit(False)).unionByName(comments, allowMissingColumns=True)
    distinct = marked.groupBy(*COLUMNS, "file_day", "is_comment").agg(F.count(F.lit(1)).alias("copies"))
    is_row = ~F.col("is_comment")

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(is_row & condition, F.col("copies"))), F.lit(0))

    def any_of(conditions: list[Column]) -> Column:
        return reduce(lambda a, b: a | b, conditions)

    measures = {
        "rows": rows(F.lit(True)),
        "duplicate": F.coalesce(F.sum(F.when(is_row, F.col("copies") - 1)), F.lit(0)),
        "midnight": rows(cleaning.is_midnight()),
        "foreign_day": rows(cleaning.is_foreign_day()),
        "missing": rows(cleaning.is_missing()),
        "not_castable": rows(any_of([cleaning.is_uncastable(c) for c in COLUMNS])),
        "negative": rows(any_of([cleaning.is_negative(c) for c in NUMERIC_COLUMNS])),
        "comment": F.coalesce(F.sum(F.when(F.col("is_comment"), F.col("copies"))), F.lit(0)),
    }
    totals = distinct.agg(*[m.alias(name) for name, m in measures.items()])
    pairs = ", ".join(f"'{name}', `{name}`" for name in measures)
    return totals.selectExpr(f"stack({len(measures)}, {pairs}) as (defect, row_count)")
