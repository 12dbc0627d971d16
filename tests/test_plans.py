"""Physical-plan assertions: strategies, group limits, pushdown, reuse of
partitioning, and no Python evaluation anywhere."""
import pytest

from pyspark.sql import functions as F

from cabwise.operators import classify as C, joins, lexicon as LX, textclass as TC, tfidf as TF, trips as T
from cabwise.plans.inspect import exchanges, join_node, plan_text, python_udf_nodes
from cabwise.plans.sizing import bounded_broadcast, static_row_bound
from cabwise.queries import QUERIES
from cabwise.session import staging_path
from cabwise.sources import bindings as B, files as FS
from tables import SF_SMOKE


def test_join_strategies(spark):
    t, v = B.trips(spark, SF_SMOKE), B.vendors(spark, SF_SMOKE)
    assert join_node(joins.join_broadcast(t, v)) == "BroadcastHashJoin"
    assert join_node(joins.join_sort_merge(t, v)) == "SortMergeJoin"


def test_rank_filter_becomes_partial_group_limit(spark):
    m = T.trip_metrics(T.valid_trips(B.trips(spark, SF_SMOKE)), unit="raw")
    plan = plan_text(T.longest_trip_per_vendor(joins.trips_with_vendor(m, B.vendors(spark, SF_SMOKE))))
    assert "WindowGroupLimit" in plan
    assert "Partial" in plan


def test_hourly_profile_partial_aggregation(spark):
    plan = plan_text(T.hourly_profile(B.trips(spark, SF_SMOKE)), "simple")
    assert "partial_avg" in plan


def test_parquet_filters_and_columns_pushed(spark):
    path = FS.write_parquet(B.trips(spark, SF_SMOKE), staging_path(spark, "plan-parquet"))
    df = T.hourly_profile(FS.read_parquet(spark, path))
    plan = plan_text(df, "formatted")
    assert "PushedFilters: [" in plan and "GreaterThan(cost,0.0)" in plan
    assert "LessThan(start_lon,-70.0)" in plan
    # trip_id is not needed: it is not read
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "trip_id" not in read_schema


def test_text_features_shuffle_no_document(spark):
    """No placement asked for: only words (lexicon) and document frequencies cross a shuffle."""
    docs = B.complaints(spark, SF_SMOKE)
    lazy = TC.document_features(docs, materialize=False)
    for partitioning, columns in exchanges(lazy):
        assert "doc_id" not in columns and "category" not in columns and "text" not in columns, (partitioning, columns)
    assert any(columns == ["word_idx", "count"] for _, columns in exchanges(lazy))
    assert "Generate explode" not in plan_text(LX.lexicon_counts(docs, ["a", "b"]), "simple")
    assert exchanges(LX.lexicon_counts(docs, ["a", "b"])) == []
    placed = exchanges(TC.document_features(docs, materialize=False, partitions=4))
    assert any(p.startswith("hashpartitioning(doc_id") for p, _ in placed)


def test_class_counts_need_no_features(spark):
    counts = TC.document_counts(B.complaints(spark, SF_SMOKE))
    for df in (C.class_counts(counts), C.frequent_classes(counts, 20)):
        assert [cols for _, cols in exchanges(df)] == [["category", "count"]]
    assert all("doc_id" not in cols for _, cols in exchanges(C.with_labels(counts)))


def test_except_distinct_takes_one_exchange(spark):
    df = spark.range(20).select((F.col("id") % 5).alias("a"), F.lit("x").alias("b"))
    assert len(exchanges(C.except_distinct(df, df.where("a = 1")))) == 1


def test_definitions_run_few_jobs(spark):
    """Defining features runs the lexicon job and one write; the rest is lazy."""
    tracker, group = spark.sparkContext.statusTracker(), "definition"
    counts = TC.document_counts(B.complaints(spark, SF_SMOKE))
    spark.sparkContext.setJobGroup(group, group)
    TC.labelled_features(counts)
    C.with_labels(counts), C.frequent_class_docs(counts, 3), TF.term_frequencies(counts)
    spark.sparkContext.setJobGroup("rest", "rest")
    assert not tracker.getJobIdsForGroup(group)


def test_bucketed_tables_join_without_exchange(spark):
    t = B.trips(spark, SF_SMOKE)
    v = B.vendors(spark, SF_SMOKE)
    FS.write_bucketed(t, "trips_bucketed", "trip_id", 8, mode="overwrite")
    FS.write_bucketed(v, "vendors_bucketed", "trip_id", 8, mode="overwrite")
    # the tables here are small enough to be broadcast; the hint asks for the plan of large ones
    joined = joins.trips_with_vendor(spark.table("trips_bucketed"), spark.table("vendors_bucketed").hint("merge"))
    plan = plan_text(joined, "simple")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == t.count()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_evaluation(spark, key):
    df = QUERIES[key](spark, SF_SMOKE)
    assert python_udf_nodes(df) == []


def test_scale_settings():
    from cabwise.session import scale_settings
    small = scale_settings(40 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "24"          # three waves
    big = scale_settings(100 << 40, 8000)
    n = int(big["spark.sql.shuffle.partitions"])
    assert n % 8000 == 0 and n * (128 << 20) >= (100 << 40) // 4       # no cap: partitions keep their size
    assert big["spark.sql.files.maxPartitionBytes"] == str(128 << 20)


def test_broadcast_bounds(spark):
    limited = joins.limited_side(B.vendors(spark, SF_SMOKE))
    assert static_row_bound(limited) == 50                    # proven without a job
    assert static_row_bound(B.vendors(spark, SF_SMOKE)) is None
    with pytest.raises(ValueError):
        bounded_broadcast(B.vendors(spark, SF_SMOKE), "test side")
    big = spark.range(0, 5000)
    assert "BroadcastHashJoin" in plan_text(big.join(bounded_broadcast(spark.range(10).limit(5)), "id"), "simple")


def test_q1_shuffles_partial_aggregates_only(spark):
    moved = exchanges(T.hourly_profile(B.trips(spark, SF_SMOKE)))
    hashed = [cols for p, cols in moved if p.startswith("hashpartitioning")]
    assert hashed and all(set(cols) <= {"_groupingexpression", "sum", "count"} for cols in hashed), moved


def test_broadcast_join_never_shuffles_the_large_side(spark):
    moved = exchanges(joins.join_broadcast(B.trips(spark, SF_SMOKE), B.vendors(spark, SF_SMOKE)))
    assert all("start_lon" not in cols for _, cols in moved), moved
    merged = exchanges(joins.join_sort_merge(B.trips(spark, SF_SMOKE), B.vendors(spark, SF_SMOKE)))
    assert any("start_lon" in cols for _, cols in merged)       # the forced sort-merge does


def test_q2_shuffles_metrics_not_raw_columns(spark):
    m = T.trip_metrics(T.valid_trips(B.trips(spark, SF_SMOKE)), unit="raw")
    moved = exchanges(T.longest_trip_per_vendor(joins.trips_with_vendor(m, B.vendors(spark, SF_SMOKE))))
    raw = {"start_lon", "start_lat", "end_lon", "end_lat", "start_ts", "end_ts", "cost"}
    assert all(not raw & set(cols) for _, cols in moved), moved
    assert any(p.startswith("hashpartitioning(vendor") for p, _ in moved)


def test_class_filter_is_a_broadcast_semi_join(spark):
    counts = TC.document_counts(B.complaints(spark, SF_SMOKE))
    kept = C.frequent_class_docs(counts, 20)
    plan = plan_text(kept, "simple")
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    # the documents are never shuffled by class: a hot class cannot land on one task
    assert not any("doc_id" in cols for _, cols in exchanges(kept))


def test_printed_plans_agree_with_the_handle(spark):
    from cabwise.plans import inspect as I
    trips, vendors = B.trips(spark, SF_SMOKE), B.vendors(spark, SF_SMOKE)
    frames = [joins.join_broadcast(trips, vendors), joins.join_sort_merge(trips, vendors), T.hourly_profile(trips),
              joins.trips_with_vendor(trips, vendors).groupBy("vendor").count(), trips.unionByName(trips).distinct(),
              spark.sql("SELECT * FROM {t} WHERE cost > (SELECT avg(cost) FROM {t})", t=trips)]
    for df in frames:
        assert I.printed_join_nodes(df) == I.join_nodes(df)
    for df in frames[:-1]:  # a subquery's plan is printed at its place and may be printed again
        assert sorted(x.split("(")[0].split(",")[0] for x in I.printed_exchanges(df)) == sorted(
            x.split("(")[0] for x, _ in I.exchanges(df))
    root, = I.parse_plan(I.printed_plan(frames[1]))
    join = next(n for n in root.walk() if n.name == "SortMergeJoin")
    assert len(join.children) == 2 and "trip_id" in join.details
    assert any(n.name == "FileScan" and "PushedFilters" in n.details for n in join.children[0].walk())


def test_plan_parser_on_text():
    from cabwise.plans.inspect import parse_plan
    text = """== Physical Plan ==
AdaptiveSparkPlan isFinalPlan=false
+- HashAggregate(keys=[k#1])
   +- *(2) BroadcastHashJoin [k#1], [k#2], Inner
      :- Exchange hashpartitioning(k#1, 8)
      :  +- * Filter isnotnull(k#1)
      +- LocalTableScan [k#2]

"""
    root, = parse_plan(text)
    assert [n.name for n in root.walk()] == ["AdaptiveSparkPlan", "HashAggregate", "BroadcastHashJoin", "Exchange", "Filter", "LocalTableScan"]
    join = root.children[0].children[0]
    assert [c.name for c in join.children] == ["Exchange", "LocalTableScan"] and join.children[0].details == "hashpartitioning(k#1, 8)"
