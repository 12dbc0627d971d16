"""Trips laid out along a space-filling curve, and boxes read as key ranges.

On write, a point's cell (65,536 by 65,536 over the globe) becomes one number by
interleaving the bits of its two coordinates: points near each other get near
numbers. Files and row groups are ranges of that number. On read, a box is
covered by a few ranges of numbers; these go into the scan as filters on one
column, whose minimum and maximum each row group keeps, beside the box itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwise.functions.geo import in_open_box

BITS = 16
CELL = "cell"
RANGES = 32
_SPREAD = [(8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)]


def _grid(value: Column, low: float, span: float) -> Column:
    """The cell of a coordinate along its axis."""
    return F.least(F.greatest(F.floor((value - low) / span * (1 << BITS)), F.lit(0)), F.lit((1 << BITS) - 1)).cast("long")


def _spread(x: Column) -> Column:
    """The bits of a number with a zero between each two."""
    for step, mask in _SPREAD:
        x = F.shiftleft(x, step).bitwiseOR(x).bitwiseAND(F.lit(mask))
    return x


def cell_of(lon: str, lat: str) -> Column:
    """The point's place on the curve; null without coordinates."""
    unknown = F.isnan(lon) | F.isnan(lat)
    here = _spread(_grid(F.col(lon), -180.0, 360.0)).bitwiseOR(F.shiftleft(_spread(_grid(F.col(lat), -90.0, 180.0)), 1))
    return F.when(~unknown, here)


def write_spatial(df: DataFrame, path: str, lon: str = "start_lon", lat: str = "start_lat", partitions: int | None = None,
                  row_group_bytes: int | None = None, mode: str = "errorifexists") -> str:
    """``df`` with its cell, in files that are ranges of cells and sorted by them."""
    keyed = df.withColumn(CELL, cell_of(lon, lat))
    placed = keyed.repartitionByRange(partitions, CELL) if partitions else keyed.repartitionByRange(CELL)
    writer = placed.sortWithinPartitions(CELL).write.mode(mode)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
    return path


def box_ranges(lon_bounds: tuple[float, float], lat_bounds: tuple[float, float], ranges: int = RANGES) -> list[tuple[int, int]]:
    """At most ``ranges`` ranges of cells that cover a box.

    Squares of the curve are quartered, the largest ones on the box's border
    first, while there is room; neighbours are joined."""
    def place(v, low, span):
        return min(max(int((v - low) / span * (1 << BITS)), 0), (1 << BITS) - 1)

    x0, x1 = (place(v, -180.0, 360.0) for v in lon_bounds)
    y0, y1 = (place(v, -90.0, 180.0) for v in lat_bounds)
    done, open_ = [], [(0, 0, BITS)]          # squares: corner and the bits of their side
    while open_:
        open_.sort(key=lambda s: s[2])
        x, y, bits = open_.pop()
        side = 1 << bits
        if x > x1 or y > y1 or x + side <= x0 or y + side <= y0:
            continue
        inside = x0 <= x and x + side - 1 <= x1 and y0 <= y and y + side - 1 <= y1
        if inside or not bits or len(done) + len(open_) + 4 > ranges:
            done.append((x, y, bits))
            continue
        half = side >> 1
        open_ += [(x + dx, y + dy, bits - 1) for dx in (0, half) for dy in (0, half)]
    spans = []
    for x, y, bits in done:
        start = sum(((x >> i & 1) | (y >> i & 1) << 1) << 2 * i for i in range(BITS))
        spans.append((start, start + (1 << 2 * bits) - 1))
    joined: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if joined and start == joined[-1][1] + 1:
            joined[-1] = (joined[-1][0], stop)
        else:
            joined.append((start, stop))
    return joined


def read_box(spark: SparkSession, path: str, lon_bounds: tuple[float, float], lat_bounds: tuple[float, float],
             lon: str = "start_lon", lat: str = "start_lat") -> DataFrame:
    """Rows strictly inside the box, without the cell."""
    table = spark.read.parquet(path)
    covered = reduce(lambda a, b: a | b, [F.col(CELL).between(a, b) for a, b in box_ranges(lon_bounds, lat_bounds)])
    return table.where(covered & in_open_box(lon, lat, lon_bounds, lat_bounds)).drop(CELL)
