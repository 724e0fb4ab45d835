"""Landing with a ledger: every file is copied once, and lines of different sources stay apart.

``<target>/lines`` holds the lines by run, target folder and day, ``<target>/ledger`` the files that are landed.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.temporal import day_of_path
from .landing import target_key
from .tables import list_files

LEDGER_SCHEMA = T.StructType([
    T.StructField("source_path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("target_folder", T.StringType()),
    T.StructField("run", T.StringType()),
])
_MARK = "//landed//"


def read_ledger(spark: SparkSession, target: str) -> DataFrame:
    """The files landed so far, one row each."""
    path = f"{target.rstrip('/')}/ledger"
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("ignore").parquet(path)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def folder_below(path: Column, source: str) -> Column:
    """The folder directly below ``source`` that a file lies in; ``.`` for a file in ``source`` itself."""
    prefix = re.sub(r"^[A-Za-z0-9+.-]+:/*", "/", source).rstrip("/") + "/"
    below = F.substring_index(target_key(path, prefix, _MARK), _MARK, -1)
    return F.when(F.instr(below, "/") > 0, F.substring_index(below, "/", 1)).otherwise(".")


def judge_files(spark: SparkSession, source: str, target: str, glob: str = "*.txt") -> DataFrame:
    """All files below ``source``, their target folder, and ``status``: ``new``, ``known``, or ``changed`` since landed."""
    known = read_ledger(spark, target).select(
        F.col("source_path").alias("_path"), F.col("length").alias("_length"), F.col("modificationTime").alias("_time")
    )
    files = list_files(spark, source, glob).withColumnRenamed("path", "source_path")
    same = (F.col("length") == F.col("_length")) & (F.col("modificationTime") == F.col("_time"))
    status = F.when(F.col("_path").isNull(), "new").when(same, "known").otherwise("changed")
    return files.join(known, F.col("source_path") == F.col("_path"), "left").select(
        "source_path", "length", "modificationTime", folder_below(F.col("source_path"), source).alias("target_folder"), status.alias("status")
    )


def land_new(spark: SparkSession, source: str, target: str, glob: str = "*.txt") -> str | None:
    """Copy the lines of the files that the ledger does not know; returns the name of the run, None if there are none.

    The ledger is written last, and ``read_landed`` shows lines of runs in the ledger only: a landing that breaks off
    shows nothing, and the next one copies its files again. Changed files are not copied a second time;
    ``judge_files`` names them. No shuffle: each task writes what it read.
    """
    run = uuid.uuid4().hex
    # Names of files only, which Spark's own index holds on the driver, too.
    files = judge_files(spark, source, target, glob).where("status = 'new'").drop("status").collect()
    if not files:
        return None
    path = F.col("_metadata.file_path")
    day = F.coalesce(day_of_path(path).cast("string"), F.lit("unknown"))
    lines = spark.read.text([r["source_path"] for r in files]).select(
        "value", F.lit(run).alias("run"), folder_below(path, source).alias("target_folder"), day.alias("source_day")
    )
    lines.write.mode("append").partitionBy("run", "target_folder", "source_day").text(f"{target.rstrip('/')}/lines")
    rows = spark.createDataFrame([(*r, run) for r in files], LEDGER_SCHEMA)
    rows.coalesce(1).write.mode("append").parquet(f"{target.rstrip('/')}/ledger")
    return run


def read_landed(spark: SparkSession, target: str) -> DataFrame:
    """``value, run, target_folder, source_day`` of all lines whose landing is in the ledger."""
    runs = read_ledger(spark, target).select("run").distinct()
    if runs.isEmpty():
        return spark.createDataFrame([], "value string, run string, target_folder string, source_day string")
    lines = spark.read.schema("value string, run string, target_folder string, source_day string").text(f"{target.rstrip('/')}/lines")
    return lines.join(runs, "run", "left_semi").select("value", "run", "target_folder", "source_day")
