"""Daily transaction text: comma-separated, no header, ``#`` comment lines, the day in the path."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from ..functions.temporal import day_of_path
from ..schemas import RAW_SCHEMA, TRANSACTION_SCHEMA


def _files(reader: DataFrameReader, glob: str) -> DataFrameReader:
    return reader.option("pathGlobFilter", glob).option("recursiveFileLookup", True)


def _delimited(spark: SparkSession, glob: str) -> DataFrameReader:
    return _files(spark.read, glob).option("sep", ",").option("comment", "#").option("header", False)


def read_raw(spark: SparkSession, paths: str | list[str], glob: str = "*.txt") -> DataFrame:
    """All files in one scan, every field as text, with ``file_day`` from the path."""
    raw = _delimited(spark, glob).schema(RAW_SCHEMA).csv(paths)
    return raw.select("*", day_of_path(F.col("_metadata.file_path")).alias("file_day"))


def read_marked(spark: SparkSession, paths: str | list[str], glob: str = "*.txt") -> DataFrame:
    """The rows of ``read_raw`` and the comment lines, told apart by ``is_comment``, from one scan of the lines.

    A comment has no fields. Blank lines are left out, as the parser of ``read_raw`` leaves them out.
    """
    lines = _files(spark.read, glob).text(paths).filter(F.trim("value") != "")
    is_comment = F.startswith("value", F.lit("#"))
    fields = F.from_csv(F.when(~is_comment, F.col("value")), RAW_SCHEMA.simpleString()[7:-1].replace(":", " "), {"sep": ","})
    day = day_of_path(F.col("_metadata.file_path"))
    marked = lines.select(fields.alias("_fields"), day.alias("file_day"), is_comment.alias("is_comment"))
    return marked.select("_fields.*", "file_day", "is_comment")


def read_typed(spark: SparkSession, paths: str | list[str], glob: str = "*.txt") -> DataFrame:
    """The same files read with declared types: a cell that does not parse becomes NULL.

    Lossy: ``24:00:00`` is such a cell. ``read_raw`` and ``operators.cleaning.clean`` repair it.
    """
    return _delimited(spark, glob).option("mode", "PERMISSIVE").schema(TRANSACTION_SCHEMA).csv(paths)


def read_lines(spark: SparkSession, paths: str | list[str], glob: str = "*.txt") -> DataFrame:
    """Whole lines in ``value``, comments included."""
    return _files(spark.read, glob).text(paths)
