"""Joins with a table of classes that may be large, and dense ranks of it.

A class table is small as a rule, but nothing bounds it: a column of user names
is a class column too. So nothing is broadcast on trust here. The ``hot`` most
frequent classes are a LIMIT, a bound that the plan itself shows, and are
broadcast: their rows, which may be most of the table, stay where they are. The
tail is joined by a shuffle; there, no class has more than a ``hot``-th of the
rows, so no key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabwise.operators.classify import class_counts
from cabwise.operators.numbering import with_numbers
from cabwise.plans.lineage import staged
from cabwise.plans.sizing import bounded_broadcast

HOT = 4096


def hybrid_join(df: DataFrame, classes: DataFrame, col: str = "category", count: str = "n", hot: int = HOT) -> DataFrame:
    """Inner join with ``classes`` (one row a class, with the class's row count).

    ``classes`` is read twice: give a written table. Rows without a class are
    dropped, as by any equi-join."""
    values = [c for c in classes.columns if c != col]
    head = classes.orderBy(F.col(count).desc(), F.col(f"`{col}`")).limit(hot)
    marked = df.where(F.col(f"`{col}`").isNotNull()).join(
        bounded_broadcast(head.withColumn("__hot", F.lit(True)), "hot classes"), col, "left")
    columns = [*df.columns, *values]
    by_broadcast = marked.where("__hot").select(*columns)
    rest = marked.where("__hot IS NULL").select(*df.columns)
    # a tail exists only if there are more classes than the bound
    return by_broadcast.unionByName(rest.join(classes.hint("merge"), col).select(*columns))


def ranked_classes(df: DataFrame, col: str = "category") -> DataFrame:
    """(class, label, n), written: 0.0 for the most frequent class, equal counts
    alphabetically; ranks by prefix sums, no window over all classes."""
    counts = class_counts(df.where(F.col(f"`{col}`").isNotNull()), col)
    ranked = with_numbers(counts, [F.col("n").desc(), F.col(f"`{col}`")], "label")
    return staged(ranked.select(F.col(f"`{col}`"), F.col("label").cast("double").alias("label"), "n"), "classes")


def with_class_labels(df: DataFrame, col: str = "category", hot: int = HOT) -> DataFrame:
    """``df`` with its class label, whatever the number of classes."""
    return hybrid_join(df, ranked_classes(df, col), col, "n", hot).drop("n")


def rows_of_frequent_classes(df: DataFrame, threshold: int, col: str = "category", hot: int = HOT) -> DataFrame:
    """Rows of ``df`` whose class has more than ``threshold`` rows."""
    frequent = staged(class_counts(df, col).where(F.col("n") > threshold).where(F.col(f"`{col}`").isNotNull()), "frequent-classes")
    return hybrid_join(df, frequent, col, "n", hot).drop("n")
