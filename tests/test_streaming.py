"""Streaming hourly profile: resumes from its checkpoint and ends equal to
the batch profile over all files."""
from pyspark.sql import functions as F

from cabwise.operators import trips as T
from cabwise.session import staging_path
from cabwise.sources import bindings as B
from cabwise.streaming import hourly as HS
from tables import SF_SMOKE


def _rounded(rows):
    return sorted((r.hour, round(r.longitude, 9), round(r.latitude, 9)) for r in rows)


def test_stream_resumes_and_matches_batch(spark):
    trips = B.trips(spark, SF_SMOKE)
    source = staging_path(spark, "stream-src")
    out = staging_path(spark, "stream-out")
    ckpt = staging_path(spark, "stream-ckpt")
    first = trips.where(F.col("trip_id") % 2 == 0)
    second = trips.where(F.col("trip_id") % 2 == 1)
    first.repartition(2).write.parquet(source)
    schema = spark.read.parquet(source).schema
    HS.run_hourly_profile_stream(spark, source, out, ckpt, schema=schema)
    partial = _rounded(HS.read_hourly_profile(spark, out).collect())
    assert partial == _rounded(T.hourly_profile(first).collect())

    second.repartition(2).write.mode("append").parquet(source)
    HS.run_hourly_profile_stream(spark, source, out, ckpt, schema=schema)
    full = _rounded(HS.read_hourly_profile(spark, out).collect())
    assert full == _rounded(T.hourly_profile(trips).collect())


def test_a_crash_before_the_commit_loses_nothing(spark, monkeypatch):
    """The first run dies while it publishes; the next one finds no new file, and publishes all the same."""
    import pytest
    from pyspark.errors import StreamingQueryException
    from pyspark.sql.readwriter import DataFrameWriter
    source, out, ckpt = (staging_path(spark, f"crash-{x}") for x in ("src", "out", "ckpt"))
    trips = B.trips(spark, SF_SMOKE)
    trips.write.parquet(source)
    write = DataFrameWriter.parquet

    def broken(self, path, *args, **kwargs):
        if path.startswith(out):
            raise OSError("the store is away")
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", broken)
    with pytest.raises(StreamingQueryException):
        HS.run_hourly_profile_stream(spark, source, out, ckpt)
    monkeypatch.undo()
    HS.run_hourly_profile_stream(spark, source, out, ckpt)
    assert _rounded(HS.read_hourly_profile(spark, out).collect()) == _rounded(T.hourly_profile(trips).collect())
    HS.run_hourly_profile_stream(spark, source, out, ckpt)     # nothing new: the publication stays
    assert HS.read_hourly_profile(spark, out).count() == 24
