"""Trip analytics: validity, per-trip metrics, hourly profile, longest trips.

Every function maps DataFrames to DataFrames with built-in expressions only,
so the whole chain stays in one whole-stage-codegen span up to the first
shuffle, and filters on stored columns reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabwise.functions.exact import exact_mean
from cabwise.functions.geo import haversine_km, in_open_box
from cabwise.functions.timecols import hour_of_day, hour_padded, minutes_between, parse_ts


def parse_trips(raw: DataFrame) -> DataFrame:
    """Text timestamps → TIMESTAMP_NTZ (malformed → null), numbers → double."""
    return raw.select(
        F.col("trip_id"),
        parse_ts("start_ts").alias("start_ts"),
        parse_ts("end_ts").alias("end_ts"),
        *[F.col(c).try_cast("double").alias(c)
          for c in ("start_lon", "start_lat", "end_lon", "end_lat", "cost")],
    )


def trip_is_valid():
    """The reference validity rule as one predicate.

    start strictly before end; both longitude and latitude changed; both
    ends strictly inside the box; positive cost. Nulls fail every branch.
    """
    return ((F.col("start_ts") < F.col("end_ts"))
            & (F.col("start_lon") != F.col("end_lon"))
            & (F.col("start_lat") != F.col("end_lat"))
            & in_open_box("start_lon", "start_lat")
            & in_open_box("end_lon", "end_lat")
            & (F.col("cost") > 0))


def valid_trips(trips: DataFrame) -> DataFrame:
    return trips.where(trip_is_valid())


def bbox_filter(trips: DataFrame) -> DataFrame:
    """Only the open-box part of the rule (both ends)."""
    return trips.where(in_open_box("start_lon", "start_lat") & in_open_box("end_lon", "end_lat"))


def trip_metrics(trips: DataFrame, unit: str = "deg") -> DataFrame:
    """trip_id, great-circle distance (km) and duration (minutes).

    ``unit='raw'`` reproduces the reference numbers (degrees fed to sin/cos).
    """
    return trips.select(
        "trip_id",
        haversine_km("start_lon", "start_lat", "end_lon", "end_lat", unit=unit).alias("distance"),
        minutes_between("start_ts", "end_ts").alias("duration"),
    )


def hourly_profile(trips: DataFrame) -> DataFrame:
    """Mean pick-up coordinate per hour of day over valid trips.

    groupBy + avg plans as partial HashAggregate → hash exchange of at most
    24 rows per map task → final HashAggregate: the data volume crossing the
    shuffle does not grow with the input.
    """
    return (valid_trips(trips)
            .groupBy(hour_of_day("start_ts").alias("hour"))
            .agg(F.avg("start_lon").alias("longitude"), F.avg("start_lat").alias("latitude"))
            .orderBy("hour"))


def hourly_profile_exact(trips: DataFrame) -> DataFrame:
    """The same profile with means that are equal to the last bit however the
    trips are partitioned."""
    return (valid_trips(trips)
            .groupBy(hour_of_day("start_ts").alias("hour"))
            .agg(exact_mean("start_lon").alias("longitude"), exact_mean("start_lat").alias("latitude"))
            .orderBy("hour"))


def hourly_profile_padded(trips: DataFrame) -> DataFrame:
    """Same profile keyed by the two-digit hour text ('00' .. '23')."""
    return (valid_trips(trips)
            .groupBy(hour_padded("start_ts").alias("hour"))
            .agg(F.avg("start_lon").alias("longitude"), F.avg("start_lat").alias("latitude"))
            .orderBy("hour"))


def has_distance():
    """Neither null nor NaN: a trip of unknown length is never the longest."""
    return F.col("distance").isNotNull() & ~F.isnan("distance")


def longest_trip_per_vendor(trips_vendor: DataFrame) -> DataFrame:
    """All trips whose distance equals their vendor's maximum (ties kept).

    Written as ``rank() = 1``: Catalyst inserts a partial WindowGroupLimit
    before the shuffle, so each map task forwards only its own top rows per
    vendor. A vendor holding most of the trips therefore never sends its
    whole row set to one reducer.
    """
    w = Window.partitionBy("vendor").orderBy(F.col("distance").desc())
    return (trips_vendor.where(has_distance())
            .withColumn("_rank", F.rank().over(w))
            .where(F.col("_rank") == 1)
            .select("vendor", "distance", "duration")
            .orderBy("vendor", "duration"))


def longest_trip_single(trips_vendor: DataFrame) -> DataFrame:
    """One longest trip per vendor; ties broken by the smallest trip_id."""
    w = Window.partitionBy("vendor").orderBy(F.col("distance").desc(), F.col("trip_id").asc())
    return (trips_vendor.where(has_distance())
            .withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1)
            .select("vendor", "trip_id", "distance", "duration")
            .orderBy("vendor"))


#: Q1's aggregation as SQL text over a DataFrame parameter that holds valid trips.
MEAN_PICKUP_SQL = """
SELECT extract(HOUR FROM start_ts) AS hour, mean(start_lon) AS longitude, mean(start_lat) AS latitude
FROM {valid}
GROUP BY 1
ORDER BY 1
"""


def hourly_profile_sql(trips: DataFrame) -> DataFrame:
    """The SQL form of :func:`hourly_profile`; validity stays in one place."""
    return trips.sparkSession.sql(MEAN_PICKUP_SQL, valid=valid_trips(trips))


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a frame to SQL text by name (session-scoped temporary view)."""
    df.createOrReplaceTempView(name)
    return df
