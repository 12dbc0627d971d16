"""Trip ⋈ vendor joins with a selectable, inspectable strategy.

* ``trips_with_vendor``: large ⋈ large on ``trip_id``. No hint: both sides
  are hash-partitioned on the (unique, hence unskewed) key and sort-merge
  joined, unless AQE measures one side small at run time and converts it.
  Tables bucketed on ``trip_id`` (``sources.files.write_bucketed``) join
  without any exchange.
* ``join_broadcast`` / ``join_sort_merge``: the join-strategy study. The small
  side is ``vendors`` ordered by key and limited to ``n`` rows, so its size is
  bounded by construction and a broadcast is safe at any input size. The
  strategy is a per-query hint, never a session-wide threshold change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabwise.plans.sizing import bounded_broadcast

STRATEGIES = ("broadcast", "merge", "shuffle_hash")


def trips_with_vendor(trips: DataFrame, vendors: DataFrame, key: str = "trip_id") -> DataFrame:
    return trips.join(vendors, key, "inner")


def limited_side(vendors: DataFrame, n: int = 50, key: str = "trip_id") -> DataFrame:
    """First ``n`` rows by key: a repeatable LIMIT (TakeOrderedAndProject:
    each task keeps its first n rows, one task merges those n-row lists)."""
    return vendors.orderBy(key).limit(n)


def join_with_strategy(big: DataFrame, small: DataFrame, strategy: str, key: str = "trip_id") -> DataFrame:
    """Inner join with a forced strategy. A broadcast side must be proven
    small (the LIMIT of ``limited_side`` proves it statically)."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if strategy == "broadcast":
        small = bounded_broadcast(small, "broadcast side")
    else:
        small = small.hint(strategy)
    return big.join(small, key, "inner")


def join_broadcast(trips: DataFrame, vendors: DataFrame, n: int = 50,
                   key: str = "trip_id") -> DataFrame:
    return join_with_strategy(trips, limited_side(vendors, n, key), "broadcast", key)


def join_sort_merge(trips: DataFrame, vendors: DataFrame, n: int = 50,
                    key: str = "trip_id") -> DataFrame:
    return join_with_strategy(trips, limited_side(vendors, n, key), "merge", key)


def join_pushed(trips: DataFrame, vendors: DataFrame, n: int = 50, key: str = "trip_id") -> DataFrame:
    """The same join with the small side's keys pushed into the scan of the large one.

    The ``n`` keys are fetched first (n is the caller's bound) and become an IN
    filter: on a table that is sorted by the key, only row groups whose range
    holds one of them are read, instead of all rows for ``n`` matches."""
    small = limited_side(vendors, n, key)
    keys = [r[0] for r in small.select(key).distinct().collect()]
    return trips.where(F.col(key).isin(keys)).join(bounded_broadcast(small, "broadcast side"), key, "inner")
