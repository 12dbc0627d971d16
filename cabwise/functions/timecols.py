"""Timestamp parsing and time-of-day expressions.

All parsing yields ``TIMESTAMP_NTZ``: a local wall-clock reading that no
session zone can shift (a zone with a spring-forward gap would otherwise turn
03:30 into 04:30 and reorder start/end).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed input format of trip timestamps: yyyy-MM-dd HH:mm:ss
TIMESTAMP_REGEX = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c) -> Column:
    """Strict ``yyyy-MM-dd HH:mm:ss`` text → TIMESTAMP_NTZ, null when malformed.

    The pattern check rejects any other layout; ``try_cast`` then rejects
    impossible calendar values (Feb 30) without raising under ANSI mode.
    """
    c = _col(c)
    return F.when(c.rlike(TIMESTAMP_REGEX), c.try_cast("timestamp_ntz"))


def hour_of_day(c) -> Column:
    return F.hour(_col(c))


def hour_padded(c) -> Column:
    """Two-digit hour text, ``'00'`` .. ``'23'``."""
    return F.lpad(F.hour(_col(c)).cast("string"), 2, "0")


def minutes_between(start, end) -> Column:
    """Fractional minutes from ``start`` to ``end`` (whole-second resolution)."""
    return F.timestamp_diff("SECOND", _col(start), _col(end)) / F.lit(60.0)
