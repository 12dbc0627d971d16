"""Dense numbers in a given order, by two levels of prefix sums.

``row_number() OVER (ORDER BY ...)`` brings all rows to one task. Here rows are
dealt by key ranges and sorted inside them (one shuffle, of the keys only); each
range is counted, the counts' running sum (one row a range) gives every range
its offset, and a row's number is the offset plus its place in the range.

Inside a range the place comes from ``row_number`` over the range's own number,
so each task numbers what it holds, and spills what it can't. Rows are written
once in between: the count and the numbers must see the same ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabwise.plans.lineage import staged

RANGE, PLACE = "__range", "__place"


def ranged(df: DataFrame, order: list[Column], partitions: int | None = None) -> DataFrame:
    """``df`` written in key ranges, with each row's range and place in it."""
    dealt = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    marked = dealt.withColumn(RANGE, F.spark_partition_id())
    # the window's partitioning is not known to Spark: sorted inside the range, so rows don't move again
    place = F.monotonically_increasing_id() - F.shiftleft(F.col(RANGE).cast("long"), 33)
    return staged(marked.sortWithinPartitions(*order).withColumn(PLACE, place), "ranges")


def offsets(marked: DataFrame) -> DataFrame:
    """(range, offset): one row a range, however many rows there are."""
    sizes = marked.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(RANGE, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))


def with_numbers(df: DataFrame, order: list[Column], name: str = "number", partitions: int | None = None) -> DataFrame:
    """``df`` with dense numbers from 0 in the order of ``order``.

    Rows with equal keys lie in one range and are numbered in any order among
    themselves: give a key that tells them apart where that matters. The rows
    that shuffle are those of ``df``: select what is needed."""
    marked = ranged(df, order, partitions)
    numbered = marked.join(F.broadcast(offsets(marked)), RANGE)  # one row a task of the range shuffle
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__offset") + F.col(PLACE)).alias(name))
