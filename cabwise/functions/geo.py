"""Geographic column expressions (Catalyst built-ins only, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius in km, and the open bounding box of valid
# trip end points (longitude, latitude).
EARTH_RADIUS_KM = 6371.0
LON_BOUNDS = (-80.0, -70.0)
LAT_BOUNDS = (40.0, 46.0)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_open_box(lon, lat, lon_bounds=LON_BOUNDS, lat_bounds=LAT_BOUNDS) -> Column:
    """Strictly inside the box: ``lo < lon < hi`` and ``lo < lat < hi``.

    Plain comparisons (not BETWEEN) so the bounds are excluded and each
    conjunct can be pushed to a Parquet scan as a range filter.
    """
    lon, lat = _col(lon), _col(lat)
    return ((lon > F.lit(lon_bounds[0])) & (lon < F.lit(lon_bounds[1]))
            & (lat > F.lit(lat_bounds[0])) & (lat < F.lit(lat_bounds[1])))


def coordinate_deltas(lon1, lat1, lon2, lat2) -> tuple[Column, Column]:
    """(end - start) for longitude and latitude."""
    return _col(lon2) - _col(lon1), _col(lat2) - _col(lat1)


def haversine_km(lon1, lat1, lon2, lat2, unit: str = "deg",
                 radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance ``2R * atan2(sqrt(a), sqrt(1 - a))``.

    ``unit='deg'`` converts degrees to radians first (the geographically
    correct distance). ``unit='raw'`` feeds the coordinates to sin/cos as they
    are, which reproduces the published reference numbers. ``a`` is clamped
    to 1 so rounding can never push ``sqrt(1 - a)`` outside its domain. A null
    coordinate gives null, a NaN coordinate NaN.
    """
    if unit not in ("deg", "raw"):
        raise ValueError("unit must be 'deg' or 'raw'")
    lon1, lat1, lon2, lat2 = map(_col, (lon1, lat1, lon2, lat2))
    if unit == "deg":
        lon1, lat1, lon2, lat2 = map(F.radians, (lon1, lat1, lon2, lat2))
    dlon, dlat = coordinate_deltas(lon1, lat1, lon2, lat2)
    a = (F.pow(F.sin(dlat / 2), 2)
         + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin(dlon / 2), 2))
    # not least(): it skips nulls and ranks NaN highest, so unknown positions would become antipodes
    a = F.when((a > 1.0) & ~F.isnan(a), F.lit(1.0)).otherwise(a)
    return F.lit(2 * radius_km) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))
