"""Trip operators on micro-fixtures (boundary rows) and golden rows."""
import datetime as dt
import math
import uuid

import pytest
from pyspark.sql import functions as F

from cabwise.operators import joins, trips as T
from cabwise.schemas import TRIPS, TRIPS_CSV
from cabwise.session import staging_path
from cabwise.sources import files as FS

# Four rows of the published joined output (trip columns | vendor).
GOLDEN = [
    "274878258448,2015-03-10 06:39:30,2015-03-10 06:49:16,-73.94724,40.799885,-73.97895,40.75603,15.35",
    "274878258449,2015-03-10 06:39:32,2015-03-10 06:48:48,-73.99934,40.76144,-73.97984,40.76207,8.8",
    "274878258450,2015-03-10 06:39:33,2015-03-10 06:48:57,-73.9741,40.794327,-73.966675,40.77033,11.3",
    "274878258451,2015-03-10 06:39:37,2015-03-10 07:16:40,-73.99845,40.68173,-73.86562,40.77089,46.0",
]
GOLDEN_VENDORS = {"274878258448": "1", "274878258449": "2", "274878258450": "1", "274878258451": "2"}

BASE = ("2015-03-10 06:00:00", "2015-03-10 06:10:00", -73.9, 40.7, -73.8, 40.8, 10.0)


def _row(tid, **kw):
    names = ["start_ts", "end_ts", "start_lon", "start_lat", "end_lon", "end_lat", "cost"]
    vals = dict(zip(names, BASE))
    vals.update(kw)
    out = [tid]
    for n in names:
        v = vals[n]
        out.append(dt.datetime.fromisoformat(v) if n.endswith("_ts") and isinstance(v, str) else v)
    return tuple(out)


BOUNDARY = [
    _row("ok"),
    _row("same_time", end_ts="2015-03-10 06:00:00"),
    _row("end_before_start", end_ts="2015-03-10 05:59:59"),
    _row("lon_minus80", start_lon=-80.0),
    _row("lon_minus70", end_lon=-70.0),
    _row("lat_40", start_lat=40.0),
    _row("lat_46", end_lat=46.0),
    _row("only_lon_changed", end_lat=40.7),
    _row("only_lat_changed", end_lon=-73.9),
    _row("cost_zero", cost=0.0),
    _row("cost_negative", cost=-3.0),
    _row("cost_null", cost=None),
    _row("start_null", start_ts=None),
]


def _trips(spark, rows):
    return spark.createDataFrame(rows, TRIPS)


def test_valid_trips_boundaries(spark):
    kept = {r.trip_id for r in T.valid_trips(_trips(spark, BOUNDARY)).collect()}
    assert kept == {"ok"}


def test_bbox_is_open_interval(spark):
    kept = {r.trip_id for r in T.bbox_filter(_trips(spark, BOUNDARY)).collect()}
    assert not kept & {"lon_minus80", "lon_minus70", "lat_40", "lat_46"}
    assert "ok" in kept and "cost_zero" in kept


def _golden_csv(spark, extra_lines=()):
    path = staging_path(spark, f"golden-{uuid.uuid4().hex[:6]}")
    lines = spark.createDataFrame([(l,) for l in list(GOLDEN) + list(extra_lines)], "value string")
    FS.write_text(lines, path)
    return T.parse_trips(FS.read_csv_schema(spark, path, TRIPS_CSV))


def chord_km(lon1, lat1, lon2, lat2):
    """Great-circle distance from the chord between two points on the sphere."""
    a, b = ([math.cos(y) * math.cos(x), math.cos(y) * math.sin(x), math.sin(y)] for x, y in ((lon1, lat1), (lon2, lat2)))
    return 2 * 6371.0 * math.asin(math.dist(a, b) / 2)


def test_golden_rows_metrics(spark):
    trips = _golden_csv(spark)
    assert trips.schema["start_ts"].dataType.typeName() == "timestamp_ntz"
    rows = {r.trip_id: r for r in T.trip_metrics(T.valid_trips(trips), unit="raw").collect()}
    assert set(rows) == set(GOLDEN_VENDORS)
    # published distances of these rows, degrees taken as radians
    for line in GOLDEN:
        f = line.split(",")
        assert rows[f[0]].distance == pytest.approx(chord_km(*map(float, f[3:7])), rel=1e-9)
    assert rows["274878258448"].duration == pytest.approx((9 * 60 + 46) / 60)
    assert rows["274878258451"].duration == pytest.approx((37 * 60 + 3) / 60)
    hours = {r.hour for r in T.hourly_profile(trips).collect()}
    assert hours == {6}


def test_malformed_text_rows_are_dropped_without_error(spark):
    bad = [
        "b1,2015-03-10 06:39:30,2015-03-10 06:49:16,-73.9,40.7,-73.8,40.8,x",        # cost text
        "b2,xx,2015-03-10 06:49:16,-73.9,40.7,-73.8,40.8,5.0",                       # bad time
        "b3,2015-02-30 06:00:00,2015-03-10 06:49:16,-73.9,40.7,-73.8,40.8,5.0",      # no such day
        "b4,2015-03-10T06:00:00,2015-03-10 06:49:16,-73.9,40.7,-73.8,40.8,5.0",      # other layout
        "b5,2015-03-10 06:00:00,2015-03-10 06:49:16,abc,40.7,-73.8,40.8,5.0",        # bad number
    ]
    trips = _golden_csv(spark, bad)
    assert trips.count() == 9
    kept = {r.trip_id for r in T.valid_trips(trips).collect()}
    assert kept == set(GOLDEN_VENDORS)


def test_parse_ts_strict(spark):
    from cabwise.functions.timecols import parse_ts
    df = spark.createDataFrame([("2015-03-29 03:30:00",), ("2015-03-29",), ("2015-02-30 01:00:00",),
                                ("x",), (None,)], "s string")
    got = [r.t for r in df.select(parse_ts("s").alias("t")).collect()]
    assert got == [dt.datetime(2015, 3, 29, 3, 30), None, None, None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Athens"])
def test_zone_independence(spark, zone):
    """A DST-gap wall clock keeps its hour and its order under any session zone."""
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        lines = ["z1,2015-03-29 03:30:00,2015-03-29 03:50:00,-73.9,40.7,-73.8,40.8,5.0",
                 "z2,2015-03-08 02:30:00,2015-03-08 02:45:00,-73.9,40.7,-73.8,40.8,5.0"]
        trips = _golden_csv(spark, lines)
        prof = {r.hour: r for r in T.hourly_profile(trips.where(F.col("trip_id").startswith("z"))).collect()}
        assert set(prof) == {2, 3}
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_zone_independence_on_tables(spark):
    from cabwise.sources import bindings as B
    results = []
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ["UTC", "America/New_York", "Europe/Athens"]:
            spark.conf.set("spark.sql.session.timeZone", zone)
            results.append(sorted(tuple(r) for r in T.hourly_profile(B.trips(spark, "/root/testdata/sf0.001")).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert results[0] == results[1] == results[2]


def _ties(spark):
    rows = [("t1", 10.0, 5.0, "1"), ("t2", 10.0, 7.0, "1"), ("t0", 3.0, 1.0, "1"),
            ("t9", 8.0, 2.0, "2"), ("t5", None, 1.0, "2")]
    return spark.createDataFrame(rows, "trip_id string, distance double, duration double, vendor string")


def test_longest_keeps_ties(spark):
    got = sorted(tuple(r) for r in T.longest_trip_per_vendor(_ties(spark)).collect())
    assert got == [("1", 10.0, 5.0), ("1", 10.0, 7.0), ("2", 8.0, 2.0)]


def test_longest_single_breaks_ties_by_trip_id(spark):
    got = [tuple(r) for r in T.longest_trip_single(_ties(spark)).collect()]
    assert got == [("1", "t1", 10.0, 5.0), ("2", "t9", 8.0, 2.0)]


def test_broadcast_equals_sort_merge(spark):
    from cabwise.sources import bindings as B
    t, v = B.trips(spark, "/root/testdata/sf0.001"), B.vendors(spark, "/root/testdata/sf0.001")
    a = sorted(tuple(r) for r in joins.join_broadcast(t, v).collect())
    b = sorted(tuple(r) for r in joins.join_sort_merge(t, v).collect())
    assert a == b and len(a) == 50


def _distances(spark, rows, unit="deg"):
    from cabwise.functions.geo import haversine_km
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a double, b double, c double, d double")
    return [r.km for r in df.orderBy("i").select(haversine_km("a", "b", "c", "d", unit=unit).alias("km")).collect()]


def test_haversine_known_distances(spark):
    quarter = math.pi * 6371.0 / 2
    got = _distances(spark, [(0.0, 0.0, 90.0, 0.0), (0.0, 0.0, 0.0, 90.0), (0.0, 0.0, 180.0, 0.0), (10.0, 50.0, -170.0, -50.0),
                             (5.0, 5.0, 5.0, 5.0), (-74.0060, 40.7128, -73.9857, 40.7484)])
    assert got[:5] == pytest.approx([quarter, quarter, 2 * quarter, 2 * quarter, 0.0], abs=1e-6)
    assert 3.5 < got[5] < 4.5                       # New York City Hall to the Empire State Building


def test_haversine_unknown_positions(spark):
    nan = float("nan")
    for unit in ("deg", "raw"):
        got = _distances(spark, [(None, 1.0, 2.0, 3.0), (1.0, 1.0, 2.0, None), (nan, 1.0, 2.0, 3.0), (1.0, 1.0, 2.0, nan)], unit)
        assert got[:2] == [None, None] and all(math.isnan(x) for x in got[2:])


def test_unknown_distance_is_never_the_longest(spark):
    rows = [("t1", None, 1.0, "1"), ("t2", float("nan"), 1.0, "1"), ("t3", 11.9, 1.0, "1")]
    df = spark.createDataFrame(rows, "trip_id string, distance double, duration double, vendor string")
    assert [r.distance for r in T.longest_trip_per_vendor(df).collect()] == [11.9]
    assert [r.trip_id for r in T.longest_trip_single(df).collect()] == ["t3"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Athens"])
def test_inferred_csv_keeps_wall_clocks(spark, zone):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        path = FS.write_text(spark.createDataFrame([("1,2015-03-29 03:30:00,x",), ("2,2015-03-08 02:30:00,y",)], "value string"),
                             staging_path(spark, "gaps"))
        got = FS.read_csv_inferred(spark, path)
        assert dict(got.dtypes) == {"_c0": "int", "_c1": "timestamp_ntz", "_c2": "string"}
        assert {r._c0: (r._c1.hour, r._c1.minute) for r in got.collect()} == {1: (3, 30), 2: (2, 30)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_csv_parquet_and_sql_forms_agree(spark):
    from cabwise.sources import bindings as B
    trips = B.trips(spark, "/root/testdata/sf0.001")
    csv_path = FS.write_csv(B.trips_as_text(trips), staging_path(spark, "meta-csv"))
    pq_path = FS.write_parquet(T.parse_trips(FS.read_csv_schema(spark, csv_path, TRIPS_CSV)),
                               staging_path(spark, "meta-pq"))

    def rows(df):
        return [(r.hour, round(r.longitude, 9), round(r.latitude, 9)) for r in df.collect()]

    from_csv = rows(T.hourly_profile(T.parse_trips(FS.read_csv_schema(spark, csv_path, TRIPS_CSV))))
    from_pq = rows(T.hourly_profile(FS.read_parquet(spark, pq_path)))
    from_sql = rows(T.hourly_profile_sql(FS.read_parquet(spark, pq_path)))
    assert from_csv == from_pq == from_sql
    assert len(from_csv) == 24
