"""Broadcast only behind a proven size bound.

A side's bound is Catalyst's ``maxRows`` of the optimized logical plan: a
LIMIT n (the 50-row vendor side, the top-k lexicon) bounds every plan above it
that cannot add rows, whatever the input size. No job runs. n and k are the
caller's own parameters; there is no further constant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def static_row_bound(df: DataFrame) -> int | None:
    """``maxRows`` of the optimized plan, or None when Catalyst has no bound."""
    bound = df._jdf.queryExecution().optimizedPlan().maxRows()
    return int(bound.get()) if bound.isDefined() else None


def bounded_broadcast(df: DataFrame, what: str = "side") -> DataFrame:
    """``df`` to be broadcast; an error if its plan doesn't bound its rows."""
    if static_row_bound(df) is None:
        raise ValueError(f"the plan of the {what} has no row bound; give it a limit() before it is broadcast")
    return F.broadcast(df)
