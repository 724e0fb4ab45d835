"""Daily text to day-partitioned Parquet: the text is scanned and parsed once, whatever is made of it."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.cleaning import clean, quarantine
from ..operators.quality import quality_report
from ..session import materialize
from ..sinks.parquet import overwrite_days, write_new
from ..sources.text import read_marked


def clean_daily_text(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    rejected: str | None = None,
    replace: bool = True,
    globally_sorted: bool = False,
    report: str | None = None,
) -> None:
    """Clean all text files below ``source`` into ``target``; bad rows go to ``rejected`` if given.

    Both keep the days that do not occur in ``source``. ``report`` gets the quality report. With more than one result
    the parsed fields are written once to the shared folder, by columns, and all results read them there.
    """
    marked = read_marked(spark, source)
    if rejected or report:
        marked = materialize(marked, "parsed")
    raw = marked.filter("not is_comment").drop("is_comment")
    write = overwrite_days if replace else write_new
    write(clean(raw), target, globally_sorted)
    if rejected:
        replaced = quarantine(raw).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        replaced.partitionBy("file_day", "defect").parquet(rejected)
    if report:
        quality_report(marked).write.mode("overwrite").parquet(report)
