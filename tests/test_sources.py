"""Source helpers: field splitting, stable ids for raw lines, write modes."""
import pytest
from pyspark.errors import AnalysisException

from cabwise.session import staging_path
from cabwise.sources import files as FS, records as R
from tables import SF_SMOKE


def test_split_fields_matches_python_split(spark):
    lines = ["a,b,c", "a,,b,", ",", "", "x|y,z"]
    df = spark.createDataFrame([(l,) for l in lines], "value string")
    got = [r.fields for r in FS.split_fields(df).collect()]
    assert got == [l.split(",") for l in lines]
    pipes = [r.fields for r in FS.split_fields(df, "|").collect()]
    assert pipes == [l.split("|") for l in lines]


def test_complaint_ids_are_stable(spark):
    from cabwise.sources import bindings as B
    from pyspark.sql import functions as F
    path = FS.write_text(B.complaint_lines(spark, SF_SMOKE).select(
        F.regexp_replace("value", "\n", " ").alias("value")), staging_path(spark, "lines"))
    def ids():
        return sorted((r.doc_id, r.text) for r in R.complaints_from_lines(FS.read_lines(spark, path)).collect())

    first = ids()
    prev = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")     # other splits, other partitions
    try:
        again = ids()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", prev)
    assert first and first == again and len({i for i, _ in first}) == len(first)


def test_equal_lines_are_numbered(spark):
    lines = ["2015-01-01,a,same"] * 5 + ["2015-01-01,a,other"]
    df = spark.createDataFrame([(x,) for x in lines], "value string").repartition(3)
    got = [r.doc_id for r in R.complaints_from_lines(df).collect()]
    assert len(got) == 6 and len(set(got)) == 6
    assert sorted(got) == sorted(r.doc_id for r in R.complaints_from_lines(df.coalesce(1)).collect())


def test_staged_tables_are_removed(spark):
    import os
    from cabwise.plans.lineage import release_staged, staged
    from cabwise.session import local_path
    df = staged(spark.range(5), "removed")
    folder = local_path(df.inputFiles()[0].replace("file://", "")).rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    assert release_staged(spark) >= 1 and not os.path.exists(folder) and release_staged(spark) == 0


def test_release_deletes_its_owners_tables_only(spark):
    from cabwise.plans.lineage import intermediates, staged
    kept = staged(spark.range(7), "kept")
    with intermediates() as first:
        a = staged(spark.range(5), "a")
        with intermediates() as inner:
            b = staged(spark.range(6), "b")
    with intermediates() as second:
        c = staged(spark.range(8), "c")
    assert first.release() == 1 and first.release() == 0
    assert (kept.count(), b.count(), c.count()) == (7, 6, 8)
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        spark.read.schema(a.schema).parquet(*a.inputFiles()).count()
    assert inner.release() + second.release() == 2 and kept.count() == 7


def test_writers_refuse_to_overwrite_by_default(spark):
    path = FS.write_parquet(spark.range(3), staging_path(spark, "mode"))
    with pytest.raises(AnalysisException):
        FS.write_parquet(spark.range(3), path)
    FS.write_parquet(spark.range(5), path, mode="overwrite")
    assert spark.read.parquet(path).count() == 5


def test_bucketed_write_one_file_per_bucket(spark):
    import glob
    from cabwise.session import local_path
    from cabwise.sources import bindings as B
    path = staging_path(spark, "bucketed")
    FS.write_bucketed(B.trips(spark, SF_SMOKE), "trips_one_file_per_bucket", "trip_id", 4, path=path)
    assert len(glob.glob(local_path(path) + "/*.parquet")) == 4
    assert spark.table("trips_one_file_per_bucket").count() == B.trips(spark, SF_SMOKE).count()
