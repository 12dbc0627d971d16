"""Distributed selection, numbering, class joins, top-k, exact means and spatial layout."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cabwise.functions.exact import exact_mean
from cabwise.operators import classify as C, difference as DF, frequent as FR, hybrid as HY, joins, numbering as N, selection as SE, trips as T
from cabwise.plans.inspect import exchanges, plan_text
from cabwise.session import staging_path
from cabwise.sources import bindings as B, records as R, spatial as SP
from tables import SF_SMOKE


# ---------------------------------------------------------------- exact-size split

def wanted_split(rows, share, seed=1234):
    """Number of training rows of each (label, key)."""
    out, by = {}, {}
    for label, key in rows:
        by.setdefault(label, []).append((hashlib.md5(f"{seed}:{'' if key is None else key}".encode()).hexdigest(), key))
    for label, own in by.items():
        own.sort(key=lambda x: x[0])
        for i, (_, key) in enumerate(own):
            taken = label is not None and i < len(own) * share[0] // share[1]
            out[label, key] = out.get((label, key), 0) + taken
    return out


def split_counts(df, **options):
    got = SE.exact_split_flag(df, **options).groupBy("label", "doc_id").agg(F.count_if("is_train").alias("n")).collect()
    return {(r.label, r.doc_id): r.n for r in got}


def test_exact_split_takes_the_least_hashes(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("aaaaabbc"), i) for i in range(3000)] + [(None, i) for i in range(5)] + [("one", 7), ("a", None)]
    df = spark.createDataFrame(rows, "label string, doc_id long").repartition(6).withColumns({"take": F.lit(1), "hash": F.lit("x")})
    assert split_counts(df, fraction="0.75") == wanted_split(rows, (3, 4))
    # a bound of ten rows: the cut is searched through more levels
    assert split_counts(df, fraction="0.29", cell_rows=10) == wanted_split(rows, (29, 100))
    for none_or_all, n in (("0", 0), ("1", 3002)):
        assert SE.exact_split_flag(df, none_or_all).where("is_train").count() == n
    assert SE.exact_split_flag(df, "0.75").columns == [*df.columns, "is_train"]


def test_exact_split_among_repeated_keys(spark):
    rows = [("a", 5)] * 400 + [("a", i) for i in range(100, 200)] + [("b", 1)] * 7
    df = spark.createDataFrame(rows, "label string, doc_id long").repartition(5)
    for share in ((1, 2), (9, 10), (1, 100)):
        got = split_counts(df, fraction=str(share[0] / share[1]), cell_rows=50)
        assert sum(n for (label, _), n in got.items() if label == "a") == 500 * share[0] // share[1]
        assert got == wanted_split(rows, share)


def test_exact_split_moves_no_rows_by_label(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).alias("label"), F.lit("text").alias("text"))
    flagged = SE.exact_split_flag(df)
    # the text moves only with repetitions of the key at a cut, and by ranges, never by label alone
    moved = [(p, cols) for p, cols in exchanges(flagged) if "text" in cols]
    assert all("hashpartitioning(label" not in p for p, _ in moved)
    train, test = SE.exact_split(df)
    assert (train.count(), test.count()) == (sum(n * 3 // 4 for n in (667, 667, 666)), 2000 - sum(n * 3 // 4 for n in (667, 667, 666)))
    with pytest.raises(ValueError):
        SE.exact_split_flag(df, "1.5")
    assert SE.exact_split_flag(df.where("doc_id < 0")).count() == 0


# ---------------------------------------------------------------- numbers

def test_numbers_are_dense_and_in_order(spark):
    df = spark.range(5000).select(F.col("id"), F.xxhash64("id").alias("h")).repartition(9)
    for partitions in (None, 1, 13):
        got = [r.h for r in N.with_numbers(df, [F.col("h").desc()], "no", partitions).orderBy("no").collect()]
        assert got == sorted(got, reverse=True)
        assert N.with_numbers(df, [F.col("h")], "no", partitions).agg(F.min("no"), F.max("no"), F.countDistinct("no")).first() == (0, 4999, 5000)
    assert N.with_numbers(df.where("id < 0"), [F.col("h")]).count() == 0
    ties = N.with_numbers(spark.range(100).select((F.col("id") % 2).alias("k")), [F.col("k")])
    assert {r.number for r in ties.where("k = 0").collect()} == set(range(50))


def test_record_numbers_follow_the_lines(spark):
    lines = [f"2015-01-{i % 28 + 1:02d},c{i % 3},Text {i // 5}" if i % 4 else f"broken,{i}" for i in range(4000)]
    path = staging_path(spark, "numbered-lines")
    spark.createDataFrame([(x, i) for i, x in enumerate(lines)], "value string, i long").repartitionByRange(5, "i").sortWithinPartitions(
        "i").select("value").write.text(path)
    valid = [x for x in lines if not x.startswith("broken")]
    for size in ("128m", "2k"):  # other splits of the files
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            table = R.numbered_records(spark, path)
            got = table.orderBy("number").collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", "128MB")
        assert [r.number for r in got] == list(range(len(valid)))
        assert [(r.date, r.category, r.text) for r in got] == [tuple([*x.split(",")[:2], x.split(",")[2].lower()]) for x in valid]
        assert all(r.digest == hashlib.md5(x.encode()).hexdigest() for r, x in zip(got, valid))
        assert all("text" not in cols for _, cols in exchanges(table))


# ---------------------------------------------------------------- classes

def test_class_labels_with_few_hot_classes(spark):
    rows = [(i, "hot" if i % 2 else f"c{i % 300}") for i in range(3000)] + [(9999, None)]
    df = spark.createDataFrame(rows, "doc_id long, category string").repartition(4)
    want = {r.doc_id: r.label for r in C.with_labels(df).collect()}
    for hot in (1, 5, 4096):
        got = {r.doc_id: r.label for r in HY.with_class_labels(df, hot=hot).collect()}
        assert got == want
    assert {r.doc_id for r in HY.rows_of_frequent_classes(df, 10, hot=2).collect()} == {
        r.doc_id for r in C.frequent_class_docs(df, 10).collect()}
    assert HY.with_class_labels(df.where("doc_id < 0")).count() == 0
    text = plan_text(HY.with_class_labels(df, hot=5), "simple")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" in text


# ---------------------------------------------------------------- top-k

def test_top_values_equal_a_full_count(spark):
    rnd = random.Random(1)
    values = [f"w{min(int(rnd.paretovariate(0.6)), 5000)}" for _ in range(30_000)] + [None] * 50
    df = spark.createDataFrame([(v,) for v in values], "word string").repartition(7)
    want = [tuple(r) for r in df.where("word IS NOT NULL").groupBy("word").count().orderBy(F.col("count").desc(), "word").limit(40).collect()]
    for items in (64, 1 << 14, 2_000_000):
        assert [tuple(r) for r in FR.top_values(df, "word", 40, items).orderBy(F.col("n").desc(), "word").collect()] == want


def test_top_values_with_ties_at_the_cut(spark):
    """Every word as often as every other: no sketch can tell, the words decide."""
    df = spark.range(20_000).select(F.concat(F.lit("w"), F.lpad((F.col("id") % 4000).cast("string"), 5, "0")).alias("word")).repartition(5)
    got = [(r.word, r.n) for r in FR.top_values(df, "word", 25, items=128).orderBy("word").collect()]
    assert got == [(f"w{i:05d}", 5) for i in range(25)]
    few = FR.top_values(df.where("word < 'w00003'"), "word", 25).collect()     # fewer words than asked for
    assert sorted(r.word for r in few) == ["w00000", "w00001", "w00002"]
    assert FR.top_values(df.where("word IS NULL"), "word", 25).count() == 0


# ---------------------------------------------------------------- means

def test_exact_means_are_equal_to_the_last_bit(spark):
    trips = B.trips(spark, SF_SMOKE)
    plain = {tuple(r) for r in T.hourly_profile(trips).collect()}
    seen = []
    for n in (1, 7, 200):
        moved = trips.repartition(n, F.xxhash64("trip_id", F.lit(n)))
        seen.append({tuple(r) for r in T.hourly_profile_exact(moved).collect()})
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == len(plain)
    close = dict((h, (a, b)) for h, a, b in plain)
    assert all(abs(a - close[h][0]) < 1e-9 and abs(b - close[h][1]) < 1e-9 for h, a, b in seen[0])


def test_exact_mean_edges(spark):
    mean = lambda rows: spark.createDataFrame([(x,) for x in rows], "x double").agg(exact_mean("x")).first()[0]
    assert mean([1.5, None, -0.5]) == 0.5 and mean([None]) is None and mean([]) is None
    assert mean([1.0, float("nan")]) != mean([1.0, float("nan")])  # NaN
    assert mean([2.0**40, 1.0, -2.0**40]) == 1 / 3                # the small value isn't lost


# ---------------------------------------------------------------- layout and pushed keys

def test_spatial_layout_reads_the_box_and_skips_the_rest(spark):
    import glob
    import pyarrow.parquet as pq
    trips = spark.range(40_000).select(F.col("id").alias("trip_id"), (F.rand(1) * 10 - 80).alias("start_lon"),
                                       (F.rand(2) * 6 + 40).alias("start_lat")).persist()
    odd = spark.createDataFrame([(-1, None, 41.0), (-2, float("nan"), 41.0), (-3, -74.0, 41.0)],
                                "trip_id long, start_lon double, start_lat double")
    path = SP.write_spatial(trips.unionByName(odd), staging_path(spark, "spatial"), partitions=8, row_group_bytes=32 << 10)
    lon, lat = (-74.0, -73.5), (40.7, 41.1)
    got = SP.read_box(spark, path, lon, lat)
    inside = (F.col("start_lon") > lon[0]) & (F.col("start_lon") < lon[1]) & (F.col("start_lat") > lat[0]) & (F.col("start_lat") < lat[1])
    assert got.columns == trips.columns
    assert {r.trip_id for r in got.collect()} == {r.trip_id for r in trips.where(inside).collect()}
    pushed = next(x for x in plan_text(got).splitlines() if "PushedFilters" in x)
    assert "(cell" in pushed
    spans, total, read = SP.box_ranges(lon, lat), 0, 0
    assert len(spans) <= SP.RANGES
    for f in glob.glob(path.replace("file:", "") + "/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index("cell")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            read += stats is not None and stats.has_min_max and any(stats.min <= b and a <= stats.max for a, b in spans)
    assert total >= 8 and read <= total / 3
    trips.unpersist()


def test_box_ranges_cover_every_point(spark):
    df = spark.range(4000).select((F.rand(5) * 360 - 180).alias("a"), (F.rand(6) * 180 - 90).alias("b"))
    cells = df.select("a", "b", SP.cell_of("a", "b").alias("c")).collect()
    for lon, lat in (((-80.0, -70.0), (40.0, 46.0)), ((-180.0, 180.0), (-90.0, 90.0)), ((0.0, 0.001), (10.0, 60.0))):
        spans = SP.box_ranges(lon, lat)
        for r in cells:
            if lon[0] <= r.a <= lon[1] and lat[0] <= r.b <= lat[1]:
                assert any(x <= r.c <= y for x, y in spans)


def test_pushed_keys(spark):
    trips, vendors = B.trips(spark, SF_SMOKE), B.vendors(spark, SF_SMOKE)
    path = staging_path(spark, "sorted-trips")
    trips.repartitionByRange(6, "trip_id").sortWithinPartitions("trip_id").write.parquet(path)
    joined = joins.join_pushed(spark.read.parquet(path), vendors)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, joins.join_broadcast(trips, vendors).collect()))
    assert "In(trip_id" in next(x for x in plan_text(joined).splitlines() if "PushedFilters" in x and "trip_id" in x)
    nothing = joins.join_pushed(spark.read.parquet(path), vendors.where("trip_id < 0"))
    assert nothing.count() == 0


# ---------------------------------------------------------------- difference by digests

def text_rows(df):
    return sorted(str(tuple(r)).replace("-0.0", "0.0") for r in df.collect())


ODD_SCHEMA = "a int, b int, words array<string>, pair struct<x:double,y:array<int>>, __segment string"
ODD_ROWS = [(1, None, ["x"], (0.5, [1, None]), "s"), (None, 1, ["x"], (0.5, [1, None]), "s"), (1, None, ["x"], (0.5, [None, 1]), "s"),
            (1, 1, [], (float("nan"), [1]), None), (1, 1, [None], (float("nan"), [1]), None), (1, 1, None, (float("nan"), [1]), None),
            (2, 2, ["a", "bc"], None, ""), (2, 2, ["ab", "c"], None, ""), (2, 2, ["abc"], (None, None), ""), (2, 2, ["abc"], None, ""),
            (3, 3, ["k"] * 5000, (0.0, []), "long"), (3, 3, ["k"] * 5000, (-0.0, []), "long"), (4, 4, ["k"], (1.0, [1]), "t")]


@pytest.mark.parametrize("filter_bits", [1, 1 << 27])
def test_difference_by_digests_is_except(spark, filter_bits):
    """Nulls, borders of arrays, NaN, copies, long values and a clashing name; with a bitmap far too small, too."""
    rows = spark.createDataFrame(ODD_ROWS * 3, ODD_SCHEMA).repartition(5)
    for taken in ([], [0, 4, 7], [1, 2, 10], range(len(ODD_ROWS))):
        other = spark.createDataFrame([ODD_ROWS[i] for i in taken], ODD_SCHEMA)
        assert text_rows(DF.except_by_digest(rows, other, filter_bits)) == text_rows(C.except_distinct(rows, other))
    assert DF.except_by_digest(rows.limit(0), rows).count() == 0


def test_difference_of_many_rows(spark):
    """Several segments of the bitmap, rows at all of its places."""
    rows = spark.range(60_000).select((F.col("id") % 50_000).alias("k"), F.lit("x").alias("b"))
    taken = spark.range(0, 50_000, 3).select(F.col("id").alias("k"), F.lit("x").alias("b"))
    assert DF.segment_count(50_000) > 8 and DF.segment_count(0) == 1 and DF.segment_count(10**12) * DF.SEGMENT_BITS == DF.FILTER_BITS
    got = DF.except_by_digest(rows, taken)
    assert [r.k for r in got.orderBy("k").collect()] == [k for k in range(50_000) if k % 3]


def test_only_rows_that_stay_are_exchanged(spark):
    """Whole rows cross one exchange, behind the bitmap; the rows taken away aren't read again."""
    docs = B.table(spark, SF_SMOKE, "documents").select("text", "lang")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = DF.except_by_digest(docs, docs.where("lang = 'en'"))
        plan, moved = plan_text(df, "simple"), [columns for _, columns in exchanges(df) if "__row" in columns]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert moved == [[*DF.KEYS, "__row"]]
    assert plan.count("FileScan parquet [text") == 1
    assert plan.index("SortMergeJoin") < plan.index("Exchange hashpartitioning(__digest_1") < plan.index("getbit(") < plan.index("bitmap_construct_agg")
    with pytest.raises(TypeError, match="no digest"):
        DF.with_digest(spark.createDataFrame([([[1]],)], "a array<array<int>>"))
