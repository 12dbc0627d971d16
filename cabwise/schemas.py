"""Declared schemas of the inputs.

Timestamps are ``TIMESTAMP_NTZ``: trip times are wall-clock readings, and a
session zone with a daylight-saving gap must not move or drop them.
File reads do not enforce ``nullable=False``; required-ness is a filter
(``valid_trips``), so every field here is nullable.
"""

from pyspark.sql import types as T

TRIP_COLUMNS = ["trip_id", "start_ts", "end_ts", "start_lon", "start_lat",
                "end_lon", "end_lat", "cost"]

# Parsed, typed trips (what the operators consume).
TRIPS = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("start_ts", T.TimestampNTZType()),
    T.StructField("end_ts", T.TimestampNTZType()),
    T.StructField("start_lon", T.DoubleType()),
    T.StructField("start_lat", T.DoubleType()),
    T.StructField("end_lon", T.DoubleType()),
    T.StructField("end_lat", T.DoubleType()),
    T.StructField("cost", T.DoubleType()),
])

# Headerless trip CSV as stored: timestamps arrive as text and are parsed with
# a strict pattern afterwards, so a malformed value becomes null, never an error.
TRIPS_CSV = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("start_ts", T.StringType()),
    T.StructField("end_ts", T.StringType()),
    T.StructField("start_lon", T.DoubleType()),
    T.StructField("start_lat", T.DoubleType()),
    T.StructField("end_lon", T.DoubleType()),
    T.StructField("end_lat", T.DoubleType()),
    T.StructField("cost", T.DoubleType()),
])

VENDORS = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("vendor", T.StringType()),
])

# Structured complaints / documents: one row per document, stable id.
COMPLAINTS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("date", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("text", T.StringType()),
])

TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"
