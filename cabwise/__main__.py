"""Command line: the reference's workloads on your own files.

    python -m cabwise to-parquet --kind trips   --input trips.csv   --output trips.parquet
    python -m cabwise q1 --trips trips.csv --format csv            # csv | csv-infer | parquet
    python -m cabwise q2 --trips trips.parquet --vendors vendors.parquet --format parquet --unit raw
    python -m cabwise join --trips trips.parquet --vendors vendors.parquet --strategy merge --explain
    python -m cabwise classify --complaints complaints.csv --weighting relative --min-class-count 2000
    python -m cabwise classify --complaints documents.parquet --format parquet --category-col lang

Inputs are headerless CSV (schemas in ``cabwise.schemas``) or Parquet written
by ``to-parquet``. Results are small (24 hours, one row per vendor, 50 joined
rows, one accuracy row) and are printed; ``--output`` writes them instead.
Every command prints its wall-clock time, like the reference scripts.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwise.operators import joins, textclass as TC, trips as T
from cabwise.plans.inspect import plan_text
from cabwise.schemas import TRIP_COLUMNS, TRIPS_CSV, VENDORS
from cabwise.session import build_session
from cabwise.sources import files as FS, records as R


def load_trips(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "csv-infer":
        raw = FS.name_positional(FS.read_csv_inferred(spark, path), TRIP_COLUMNS)
        return raw.select(F.col("trip_id").cast("string"), *TRIP_COLUMNS[1:])
    return T.parse_trips(FS.read_csv_schema(spark, path, TRIPS_CSV))


def load_vendors(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    return spark.read.parquet(path) if fmt == "parquet" else FS.read_csv_schema(spark, path, VENDORS)


def emit(df: DataFrame, output: str | None, rows: int) -> None:
    if output:
        FS.write_parquet(df, output)
    else:
        df.show(rows, truncate=False)


def main(argv=None, stop: bool = True) -> None:
    p = argparse.ArgumentParser(prog="cabwise")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    c = sub.add_parser("to-parquet")
    c.add_argument("--kind", choices=["trips", "vendors"], required=True)
    c.add_argument("--input", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--mode", default="errorifexists")

    for name in ("q1", "q2", "join"):
        c = sub.add_parser(name)
        c.add_argument("--trips", required=True)
        c.add_argument("--format", choices=["csv", "csv-infer", "parquet"], default="parquet")
        c.add_argument("--output")
        if name != "q1":
            c.add_argument("--vendors", required=True)
        if name == "q2":
            c.add_argument("--unit", choices=["raw", "deg"], default="raw")
            c.add_argument("--single", action="store_true", help="one trip per vendor (tie by trip_id)")
        if name == "join":
            c.add_argument("--strategy", choices=list(joins.STRATEGIES), default="broadcast")
            c.add_argument("--limit", type=int, default=50)
            c.add_argument("--explain", action="store_true")

    c = sub.add_parser("classify")
    c.add_argument("--complaints", required=True,
                   help="raw date,category,text lines, or a Parquet table with --format parquet")
    c.add_argument("--format", choices=["lines", "parquet"], default="lines")
    c.add_argument("--id-col", default="doc_id")
    c.add_argument("--category-col", default="category")
    c.add_argument("--text-col", default="text")
    c.add_argument("--weighting", choices=["augmented", "relative"], default="augmented")
    c.add_argument("--k", type=int, default=150)
    c.add_argument("--min-class-count", type=int, default=None)
    c.add_argument("--train-fraction", type=float, default=0.75)
    c.add_argument("--seed", type=int, default=1234)
    c.add_argument("--max-iter", type=int, default=100)
    c.add_argument("--split", choices=["hash", "sample"], default="hash")
    c.add_argument("--partitions", type=int, default=None, help="place the documents in so many partitions first")
    c.add_argument("--no-cache", action="store_true")
    c.add_argument("--output")

    a = p.parse_args(argv)
    spark = build_session(a.master, app=f"cabwise-{a.cmd}")
    t0 = time.perf_counter()
    if a.cmd == "to-parquet":
        df = load_trips(spark, a.input, "csv") if a.kind == "trips" else load_vendors(spark, a.input, "csv")
        FS.write_parquet(df, a.output, mode=a.mode)
    elif a.cmd == "q1":
        emit(T.hourly_profile(load_trips(spark, a.trips, a.format)), a.output, 24)
    elif a.cmd == "q2":
        m = T.trip_metrics(T.valid_trips(load_trips(spark, a.trips, a.format)), unit=a.unit)
        vendors = load_vendors(spark, a.vendors, "parquet" if a.format == "parquet" else "csv")
        j = joins.trips_with_vendor(m, vendors)
        emit(T.longest_trip_single(j) if a.single else T.longest_trip_per_vendor(j), a.output, 100)
    elif a.cmd == "join":
        t = load_trips(spark, a.trips, a.format)
        v = load_vendors(spark, a.vendors, "parquet" if a.format == "parquet" else "csv")
        joined = joins.join_with_strategy(t, joins.limited_side(v, a.limit), a.strategy)
        if a.explain:
            print(plan_text(joined))
        emit(joined, a.output, a.limit)
    elif a.cmd == "classify":
        if a.format == "parquet":
            docs = spark.read.parquet(a.complaints).select(
                F.col(a.id_col).alias("doc_id"), F.col(a.category_col).alias("category"),
                F.col(a.text_col).alias("text"))
        else:
            docs = R.complaints_from_lines(FS.read_lines(spark, a.complaints))
        run = TC.classify_documents(docs, a.k, a.weighting, a.min_class_count, a.train_fraction,
                                    a.seed, a.max_iter, cache_train=not a.no_cache, split=a.split,
                                    partitions=a.partitions)
        emit(TC.accuracy_report(run), a.output, 1)
        run.release()
    print(f"Time of {a.cmd}: {time.perf_counter() - t0:.2f} seconds")
    if stop:
        spark.stop()


if __name__ == "__main__":
    main()
