"""Cleaned tables and the inventory of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CLEAN_SCHEMA


def read_clean(spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """Cleaned transactions; a day range prunes partitions before any file is opened."""
    df = spark.read.schema(CLEAN_SCHEMA).parquet(path)
    if first_day:
        df = df.filter(F.col("tx_date") >= F.lit(first_day).cast("date"))
    if last_day:
        df = df.filter(F.col("tx_date") <= F.lit(last_day).cast("date"))
    return df


def list_files(spark: SparkSession, root: str, glob: str = "*.txt") -> DataFrame:
    """``path``, ``length`` and ``modificationTime`` of the files below ``root``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length", "modificationTime")
    )


def list_datasets(files: DataFrame, root: str, marker: str = ".txt") -> DataFrame:
    """Names of the folders directly below ``root`` that contain ``marker``."""
    below = F.substring_index(F.col("path"), f"{root.rstrip('/')}/", -1)
    folder = F.when(F.instr(below, "/") > 0, F.substring_index(below, "/", 1))
    return files.select(folder.alias("dataset")).filter(F.contains("dataset", F.lit(marker))).distinct()


def pick_dataset(datasets: DataFrame, seed: int) -> DataFrame:
    """One dataset, random over seeds and the same for the same seed."""
    return datasets.orderBy(F.xxhash64("dataset", F.lit(seed)), "dataset").limit(1)


def total_size(files: DataFrame) -> DataFrame:
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
