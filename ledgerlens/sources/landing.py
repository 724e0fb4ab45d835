"""Copy text files under a new prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.temporal import day_of_path
from .text import read_lines


def target_key(path: Column, source_prefix: str, target_prefix: str) -> Column:
    """``path`` with the first occurrence of one prefix replaced by the other."""
    at = F.instr(path, source_prefix)
    return F.when(at > 0, F.overlay(path, F.lit(target_prefix), at, F.lit(len(source_prefix)))).otherwise(path)


def landing_plan(files: DataFrame, source_prefix: str, target_prefix: str) -> DataFrame:
    """Source and target of each file."""
    path = F.col("path")
    return files.select(path.alias("source_path"), target_key(path, source_prefix, target_prefix).alias("target_path"))


def land(spark: SparkSession, source: str, target: str, glob: str = "*.txt") -> None:
    """Copy the lines of all matching files to ``target``, one folder per day of the file's path.

    Days that occur in ``source`` are replaced, the others stay. No shuffle: each task writes what it read.
    """
    lines = read_lines(spark, source, glob)
    day = F.coalesce(day_of_path(F.col("_metadata.file_path")).cast("string"), F.lit("unknown"))
    lines.select("value", day.alias("source_day")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("source_day").text(target)
