"""Places 0, 1, 2, ... of the rows of every group, without a task that sees a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: A row's number in its partition takes the low bits of ``monotonically_increasing_id``.
_ROW_BITS = 33


def numbered(table: DataFrame, group: str, order: list[str], name: str, place: str = "place", size: str = "size") -> DataFrame:
    """``table`` with each row's place in its group by ``order``, and the number of rows of the group.

    ``table`` should be a written one, since its keys are read twice, and ``group`` must not be NULL. The rows are
    range-partitioned by group and order and written in order; a row's place is that in its partition plus the rows
    of its group in earlier partitions, of which there is one count per group and partition. A group of any size is
    spread over many partitions; end ``order`` with a column that is unique, or rows that tie in all of it share one.
    An empty table gives an empty one.
    """
    spread = table.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = materialize(spread.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", _ROW_BITS)
    counts = placed.groupBy(F.col(group).alias("_group"), part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    of_group = Window.partitionBy("_group")
    earlier = of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_group",
        "_part",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(of_group).alias(size),
    )
    same = (F.col(group) == F.col("_group")) & (part == F.col("_part"))
    found = placed.join(starts, same).withColumn(place, F.col("_at") + F.col("_shift"))
    return found.select(*table.columns, place, size)
