"""The command line on files staged from the provided tables."""
from pyspark.sql import functions as F

from cabwise.__main__ import main
from cabwise.session import staging_path
from cabwise.sources import bindings as B, files as FS
from tables import SF_SMOKE


def test_cli_workloads(spark, capsys):
    trips_csv = FS.write_csv(B.trips_as_text(B.trips(spark, SF_SMOKE)), staging_path(spark, "cli-trips"))
    vendors_csv = FS.write_csv(B.vendors(spark, SF_SMOKE).select(F.col("trip_id").cast("string"), "vendor"),
                               staging_path(spark, "cli-vendors"))
    lines = FS.write_text(B.complaint_lines(spark, SF_SMOKE).select(
        F.regexp_replace("value", "\n", " ").alias("value")), staging_path(spark, "cli-lines"))
    trips_pq, vendors_pq = staging_path(spark, "cli-trips-pq"), staging_path(spark, "cli-vendors-pq")
    main(["to-parquet", "--kind", "trips", "--input", trips_csv, "--output", trips_pq], stop=False)
    main(["to-parquet", "--kind", "vendors", "--input", vendors_csv, "--output", vendors_pq], stop=False)
    q1 = staging_path(spark, "cli-q1")
    main(["q1", "--trips", trips_csv, "--format", "csv-infer", "--output", q1], stop=False)
    assert spark.read.parquet(q1).count() == 24
    q2 = staging_path(spark, "cli-q2")
    main(["q2", "--trips", trips_pq, "--vendors", vendors_pq, "--output", q2], stop=False)
    assert {r.vendor for r in spark.read.parquet(q2).collect()} == {"1", "2"}
    main(["join", "--trips", trips_pq, "--vendors", vendors_pq, "--strategy", "merge", "--explain"], stop=False)
    assert "SortMergeJoin" in capsys.readouterr().out
    acc = staging_path(spark, "cli-acc")
    main(["classify", "--complaints", lines, "--max-iter", "10", "--output", acc], stop=False)
    assert spark.read.parquet(acc).count() == 1


def test_cli_classify_parquet_documents(spark):
    out = staging_path(spark, "cli-acc-pq")
    main(["classify", "--complaints", f"{SF_SMOKE}/documents.parquet", "--format", "parquet",
          "--category-col", "lang", "--max-iter", "10", "--output", out], stop=False)
    row = spark.read.parquet(out).first()
    assert row.n_classes == 4 and row.n_train > row.n_test > 0
