"""Means that don't depend on the order of addition.

A sum of doubles rounds at every step, so that another partitioning gives
another last digit. Here each value is cut once, to a multiple of 2^-50, and
split into two whole numbers; whole numbers add up exactly in any order (as
decimals: no overflow), and the mean is rounded once, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HIGH, LOW = 20, 30  # binary places of the two parts


def exact_mean(c: str | Column) -> Column:
    """Aggregate: the mean of a double column, null without values, NaN if one is.

    Values are cut below 2^-50 (exact for coordinates from 4 degrees on: their
    last place is larger) and must be under 2^42 in size."""
    x = F.col(c) if isinstance(c, str) else c
    fine = F.when(~F.isnan(x), x * F.lit(float(1 << HIGH)))
    whole = F.floor(fine)
    rest = F.floor((fine - whole) * F.lit(float(1 << LOW)))
    total = lambda part: F.sum(part.cast("decimal(19,0)")).cast("decimal(28,0)")
    scaled = (total(whole) * F.lit(1 << LOW).cast("decimal(10,0)") + total(rest)).cast("double")
    mean = scaled / (F.count(x) * F.lit(float(1 << (HIGH + LOW))))
    return F.when(F.max(F.isnan(x)), F.lit(float("nan"))).otherwise(mean)
