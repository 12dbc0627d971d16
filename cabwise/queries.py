"""Registry: every operator bound to the provided tables, plus its DuckDB oracle.

Keys follow SURVEY §7.3. Each callable takes ``(spark, sf_dir)`` and returns a
DataFrame over the whole tables. Double columns are rounded (6 places; 4 for
kilometres) in both the Spark binding and the SQL, since floating-point sums
depend on evaluation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwise.functions.text import STOPWORDS
from cabwise.operators import (classify as C, difference as DF, frequent as FR, hybrid as HY, joins, lexicon as LX, numbering as N, selection as SE, textclass as TC,
                               tfidf as TF, trips as T)
from cabwise.plans.inspect import printed_join_nodes
from cabwise.plans.lineage import staged, tracked_path
from cabwise.schemas import TRIP_COLUMNS, TRIPS_CSV
from cabwise.sources import bindings as B, files as FS, records as R, spatial as SP
from cabwise.streaming import hourly as HS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, places: dict[str, int]) -> DataFrame:
    return df.select(*[F.round(F.col(c), places[c]).alias(c) if c in places else F.col(c)
                       for c in df.columns])


# ---------------------------------------------------------------------------
# DuckDB forms of the trip / vendor derivation (see sources/bindings.py)
# ---------------------------------------------------------------------------
DUCK_TRIPS = """
trips AS (
  SELECT event_id AS trip_id, ts AS start_ts,
    ts + to_seconds(CAST(event_id % 3600 AS INT) - 60) AS end_ts,
    CASE WHEN event_id % 41 = 0 THEN CAST(0.0 AS DOUBLE)
         ELSE CAST(-74.3 AS DOUBLE) + ((event_id * 7919) % 10007) / CAST(10007.0 AS DOUBLE) END AS start_lon,
    CAST(40.4 AS DOUBLE) + ((event_id * 104729) % 9973) / CAST(9973.0 AS DOUBLE) AS start_lat,
    CASE WHEN event_id % 97 = 0 THEN CAST(-74.3 AS DOUBLE) + ((event_id * 7919) % 10007) / CAST(10007.0 AS DOUBLE)
         ELSE CAST(-74.3 AS DOUBLE) + ((event_id * 611953) % 9967) / CAST(9967.0 AS DOUBLE) END AS end_lon,
    CAST(40.4 AS DOUBLE) + ((event_id * 15485863) % 9949) / CAST(9949.0 AS DOUBLE) AS end_lat,
    value - CAST(5.0 AS DOUBLE) AS cost
  FROM events)"""

DUCK_VENDORS = """
vendors AS (SELECT event_id AS trip_id, CAST(event_id % 2 + 1 AS VARCHAR) AS vendor FROM events)"""

DUCK_VALID = """
valid AS (
  SELECT * FROM trips
  WHERE start_ts < end_ts AND start_lon <> end_lon AND start_lat <> end_lat
    AND start_lon > -80 AND start_lon < -70 AND start_lat > 40 AND start_lat < 46
    AND end_lon > -80 AND end_lon < -70 AND end_lat > 40 AND end_lat < 46
    AND cost > 0)"""


def _duck_haversine(unit: str) -> str:
    if unit == "deg":
        lon1, lat1, lon2, lat2 = ("radians(start_lon)", "radians(start_lat)",
                                  "radians(end_lon)", "radians(end_lat)")
    else:
        lon1, lat1, lon2, lat2 = "start_lon", "start_lat", "end_lon", "end_lat"
    a = (f"(pow(sin(({lat2} - {lat1}) / 2), 2) + cos({lat1}) * cos({lat2}) * "
         f"pow(sin(({lon2} - {lon1}) / 2), 2))")
    a = f"(CASE WHEN {a} > 1.0 AND NOT isnan({a}) THEN 1.0 ELSE {a} END)"
    return f"(2 * 6371.0 * atan2(sqrt({a}), sqrt(1.0 - {a})))"


def _duck_metrics(unit: str) -> str:
    return f"""
metrics AS (
  SELECT trip_id, {_duck_haversine(unit)} AS distance,
         epoch(end_ts - start_ts) / 60 AS duration
  FROM valid)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


# ---------------------------------------------------------------------------
# Trips
# ---------------------------------------------------------------------------
@register("hourly_profile", _with(DUCK_TRIPS, DUCK_VALID) + """
SELECT CAST(hour(start_ts) AS INTEGER) AS hour,
       round(avg(start_lon), 6) AS longitude, round(avg(start_lat), 6) AS latitude
FROM valid GROUP BY 1 ORDER BY 1""")
def q_hourly_profile(spark, sf_dir):
    return rounded(T.hourly_profile(B.trips(spark, sf_dir)), {"longitude": 6, "latitude": 6})


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_hourly_profile(spark, sf_dir)


@register("hourly_profile_padded", _with(DUCK_TRIPS, DUCK_VALID) + """
SELECT lpad(CAST(hour(start_ts) AS VARCHAR), 2, '0') AS hour,
       round(avg(start_lon), 6) AS longitude, round(avg(start_lat), 6) AS latitude
FROM valid GROUP BY 1 ORDER BY 1""")
def q_hourly_profile_padded(spark, sf_dir):
    return rounded(T.hourly_profile_padded(B.trips(spark, sf_dir)), {"longitude": 6, "latitude": 6})


@register("valid_trips", _with(DUCK_TRIPS, DUCK_VALID) + "SELECT * FROM valid")
def q_valid_trips(spark, sf_dir):
    return T.valid_trips(B.trips(spark, sf_dir))


@register("bbox_filter", _with(DUCK_TRIPS) + """
SELECT * FROM trips
WHERE start_lon > -80 AND start_lon < -70 AND start_lat > 40 AND start_lat < 46
  AND end_lon > -80 AND end_lon < -70 AND end_lat > 40 AND end_lat < 46""")
def q_bbox_filter(spark, sf_dir):
    return T.bbox_filter(B.trips(spark, sf_dir))


@register("trip_metrics", _with(DUCK_TRIPS, DUCK_VALID, _duck_metrics("raw")) + """
SELECT trip_id, round(distance, 4) AS distance, round(duration, 6) AS duration FROM metrics""")
def q_trip_metrics(spark, sf_dir):
    m = T.trip_metrics(T.valid_trips(B.trips(spark, sf_dir)), unit="raw")
    return rounded(m, {"distance": 4, "duration": 6})


@register("trip_metrics_deg", _with(DUCK_TRIPS, DUCK_VALID, _duck_metrics("deg")) + """
SELECT trip_id, round(distance, 4) AS distance, round(duration, 6) AS duration FROM metrics""")
def q_trip_metrics_deg(spark, sf_dir):
    m = T.trip_metrics(T.valid_trips(B.trips(spark, sf_dir)), unit="deg")
    return rounded(m, {"distance": 4, "duration": 6})


def _metrics_with_vendor(spark, sf_dir, unit="raw"):
    m = T.trip_metrics(T.valid_trips(B.trips(spark, sf_dir)), unit=unit)
    return joins.trips_with_vendor(m, B.vendors(spark, sf_dir))


@register("trips_with_vendor", _with(DUCK_TRIPS, DUCK_VENDORS, DUCK_VALID, _duck_metrics("raw")) + """
SELECT m.trip_id, round(m.distance, 4) AS distance, round(m.duration, 6) AS duration, v.vendor
FROM metrics m JOIN vendors v USING (trip_id)""")
def q_trips_with_vendor(spark, sf_dir):
    return rounded(_metrics_with_vendor(spark, sf_dir), {"distance": 4, "duration": 6})


@register("longest_trip_per_vendor", _with(DUCK_TRIPS, DUCK_VENDORS, DUCK_VALID, _duck_metrics("raw")) + """,
j AS (SELECT v.vendor, m.distance, m.duration FROM metrics m JOIN vendors v USING (trip_id)),
r AS (SELECT *, rank() OVER (PARTITION BY vendor ORDER BY distance DESC) AS rk FROM j WHERE distance IS NOT NULL AND NOT isnan(distance))
SELECT vendor, round(distance, 4) AS distance, round(duration, 6) AS duration FROM r WHERE rk = 1""")
def q_longest_trip_per_vendor(spark, sf_dir):
    return rounded(T.longest_trip_per_vendor(_metrics_with_vendor(spark, sf_dir)),
                   {"distance": 4, "duration": 6})


@register("longest_trip_single", _with(DUCK_TRIPS, DUCK_VENDORS, DUCK_VALID, _duck_metrics("raw")) + """,
j AS (SELECT v.vendor, m.trip_id, m.distance, m.duration FROM metrics m JOIN vendors v USING (trip_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY vendor ORDER BY distance DESC, trip_id ASC) AS rn
      FROM j WHERE distance IS NOT NULL AND NOT isnan(distance))
SELECT vendor, trip_id, round(distance, 4) AS distance, round(duration, 6) AS duration FROM r WHERE rn = 1""")
def q_longest_trip_single(spark, sf_dir):
    return rounded(T.longest_trip_single(_metrics_with_vendor(spark, sf_dir)),
                   {"distance": 4, "duration": 6})


DUCK_GAPS = """
gaps AS (SELECT * REPLACE (CASE WHEN trip_id % 53 = 0 THEN NULL WHEN trip_id % 59 = 0 THEN CAST('NaN' AS DOUBLE)
                                ELSE start_lon END AS start_lon) FROM trips),
valid AS (SELECT * FROM gaps)"""


@register("longest_trip_unknown_positions", _with(DUCK_TRIPS, DUCK_VENDORS, DUCK_GAPS, _duck_metrics("raw")) + """,
j AS (SELECT v.vendor, m.trip_id, m.distance FROM metrics m JOIN vendors v USING (trip_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY vendor ORDER BY distance DESC, trip_id ASC) AS rn
      FROM j WHERE distance IS NOT NULL AND NOT isnan(distance)),
n AS (SELECT vendor, count(*) FILTER (WHERE distance IS NULL) AS n_null,
             count(*) FILTER (WHERE isnan(distance)) AS n_nan FROM j GROUP BY vendor)
SELECT vendor, trip_id, round(distance, 4) AS distance, n_null, n_nan FROM r JOIN n USING (vendor) WHERE rn = 1""")
def q_longest_trip_unknown_positions(spark, sf_dir):
    """Unfiltered trips, some without a known start: those have no distance and never win."""
    gaps = B.trips(spark, sf_dir).withColumn("start_lon", F.when(F.col("trip_id") % 53 == 0, F.lit(None).cast("double"))
                                             .when(F.col("trip_id") % 59 == 0, F.lit(float("nan"))).otherwise(F.col("start_lon")))
    own = joins.trips_with_vendor(T.trip_metrics(gaps, unit="raw"), B.vendors(spark, sf_dir))
    unknown = own.groupBy("vendor").agg(F.count_if(F.col("distance").isNull()).alias("n_null"),
                                        F.count_if(F.isnan("distance")).alias("n_nan"))
    best = T.longest_trip_single(own).select("vendor", "trip_id", "distance")
    return rounded(best.join(unknown, "vendor"), {"distance": 4})


_DUCK_JOIN50 = _with(DUCK_TRIPS, DUCK_VENDORS) + """,
small AS (SELECT * FROM vendors ORDER BY trip_id LIMIT 50)
SELECT t.*, s.vendor FROM trips t JOIN small s USING (trip_id)"""


@register("join_broadcast", _DUCK_JOIN50)
def q_join_broadcast(spark, sf_dir):
    return joins.join_broadcast(B.trips(spark, sf_dir), B.vendors(spark, sf_dir))


@register("join_sort_merge", _DUCK_JOIN50)
def q_join_sort_merge(spark, sf_dir):
    return joins.join_sort_merge(B.trips(spark, sf_dir), B.vendors(spark, sf_dir))


@register("join_plan_report", _with(DUCK_TRIPS, DUCK_VENDORS) + """,
small AS (SELECT * FROM vendors ORDER BY trip_id LIMIT 50),
j AS (SELECT count(*) AS n_rows FROM trips t JOIN small s USING (trip_id))
SELECT 'broadcast' AS strategy, 'BroadcastHashJoin' AS join_node, n_rows FROM j
UNION ALL
SELECT 'merge' AS strategy, 'SortMergeJoin' AS join_node, n_rows FROM j""")
def q_join_plan_report(spark, sf_dir):
    """One row per strategy: the join operator Catalyst chose and the number
    of joined rows Spark computed with it."""
    parts = []
    for strategy, fn in (("broadcast", joins.join_broadcast), ("merge", joins.join_sort_merge)):
        joined = fn(B.trips(spark, sf_dir), B.vendors(spark, sf_dir))
        parts.append(joined.agg(F.count(F.lit(1)).alias("n_rows"))
                     .select(F.lit(strategy).alias("strategy"),
                             F.lit(printed_join_nodes(joined)[0]).alias("join_node"), "n_rows"))
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------------------
# Text features (documents, class = lang)
# ---------------------------------------------------------------------------

LEXICON_K = 150


def _sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


DUCK_DOCS = """
docs AS (SELECT doc_id, lang AS category, text FROM documents)"""

DUCK_TOKENS = """
toks AS (
  SELECT doc_id, category,
         unnest(string_split(lower(text), ' ')) AS token,
         CAST(generate_subscripts(string_split(lower(text), ' '), 1) - 1 AS INTEGER) AS pos
  FROM docs)"""

DUCK_COUNTS = f"""
words AS (SELECT regexp_replace(token, '[^a-zA-Z]+', '', 'g') AS word FROM toks),
counts AS (SELECT word, count(*) AS n FROM words
           WHERE lower(word) NOT IN ({_sql_list(STOPWORDS)}) GROUP BY word)"""

DUCK_LEXICON = f"""
lex AS (SELECT word, CAST(row_number() OVER (ORDER BY n DESC, word ASC) - 1 AS INTEGER) AS word_idx, n
        FROM counts ORDER BY n DESC, word ASC LIMIT {LEXICON_K})"""

DUCK_MATCHED = """
matched AS (SELECT t.doc_id, t.category, t.pos, l.word, l.word_idx FROM toks t JOIN lex l ON t.token = l.word)"""

DUCK_TC = """
tc AS (SELECT doc_id, category, word_idx, count(*) AS cnt FROM matched GROUP BY doc_id, category, word_idx)"""

DUCK_IDF = """
idf AS (SELECT word_idx, count(*) AS df, (SELECT count(DISTINCT doc_id) FROM tc) AS n_docs,
               ln((SELECT count(DISTINCT doc_id) FROM tc) / count(*)) AS idf
        FROM tc GROUP BY word_idx)"""

DUCK_TF = {
    "augmented": """
tf AS (SELECT *, 0.5 + 0.5 * cnt / max(cnt) OVER (PARTITION BY doc_id) AS tf FROM tc)""",
    "relative": """
tf AS (SELECT *, cnt / sum(cnt) OVER (PARTITION BY doc_id) AS tf FROM tc)""",
}

DUCK_WEIGHTS = """
weights AS (SELECT tf.doc_id, tf.category, tf.word_idx, tf.tf * idf.idf AS weight
            FROM tf JOIN idf USING (word_idx))"""

DUCK_TEXT_BASE = (DUCK_DOCS, DUCK_TOKENS, DUCK_COUNTS, DUCK_LEXICON, DUCK_MATCHED, DUCK_TC)


def _docs(spark, sf_dir):
    return B.complaints(spark, sf_dir, "lang")


def _lexicon(spark, sf_dir):
    return LX.lexicon_topk(_docs(spark, sf_dir), LEXICON_K)


def _counts(spark, sf_dir):
    return TC.document_counts(_docs(spark, sf_dir), LEXICON_K)


def _features(spark, sf_dir, weighting="augmented"):
    return TC.features_of(_counts(spark, sf_dir), LEXICON_K, weighting)


@register("token_counts", _with(DUCK_DOCS, DUCK_TOKENS, DUCK_COUNTS) + "SELECT word, n FROM counts")
def q_token_counts(spark, sf_dir):
    return LX.token_counts(_docs(spark, sf_dir))


@register("lexicon_topk", _with(DUCK_DOCS, DUCK_TOKENS, DUCK_COUNTS, DUCK_LEXICON) + "SELECT * FROM lex")
def q_lexicon_topk(spark, sf_dir):
    return _lexicon(spark, sf_dir)


@register("matched_tokens", _with(*DUCK_TEXT_BASE[:-1]) + "SELECT * FROM matched")
def q_matched_tokens(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return LX.matched_tokens(docs, LX.lexicon_topk(docs, LEXICON_K))


@register("term_counts", _with(*DUCK_TEXT_BASE) + "SELECT * FROM tc")
def q_term_counts(spark, sf_dir):
    return TF.long_counts(_counts(spark, sf_dir))


@register("inverse_document_frequency", _with(*DUCK_TEXT_BASE, DUCK_IDF) + """
SELECT word_idx, df, n_docs, round(idf, 6) AS idf FROM idf""")
def q_inverse_document_frequency(spark, sf_dir):
    return rounded(TF.inverse_document_frequency(_counts(spark, sf_dir)), {"idf": 6})


@register("tf_augmented", _with(*DUCK_TEXT_BASE, DUCK_TF["augmented"]) + """
SELECT doc_id, category, word_idx, cnt, round(tf, 6) AS tf FROM tf""")
def q_tf_augmented(spark, sf_dir):
    terms = TF.term_frequencies(_counts(spark, sf_dir), "augmented")
    return rounded(terms.select("doc_id", "category", F.inline("terms")), {"tf": 6})


@register("tf_relative", _with(*DUCK_TEXT_BASE, DUCK_TF["relative"]) + """
SELECT doc_id, category, word_idx, cnt, round(tf, 6) AS tf FROM tf""")
def q_tf_relative(spark, sf_dir):
    terms = TF.term_frequencies(_counts(spark, sf_dir), "relative")
    return rounded(terms.select("doc_id", "category", F.inline("terms")), {"tf": 6})


@register("tfidf_augmented", _with(*DUCK_TEXT_BASE, DUCK_IDF, DUCK_TF["augmented"], DUCK_WEIGHTS) + """
SELECT doc_id, category, word_idx, round(weight, 6) AS weight FROM weights""")
def q_tfidf_augmented(spark, sf_dir):
    return rounded(TF.long_weights(_features(spark, sf_dir, "augmented")), {"weight": 6})


@register("tfidf_relative", _with(*DUCK_TEXT_BASE, DUCK_IDF, DUCK_TF["relative"], DUCK_WEIGHTS) + """
SELECT doc_id, category, word_idx, round(weight, 6) AS weight FROM weights""")
def q_tfidf_relative(spark, sf_dir):
    return rounded(TF.long_weights(_features(spark, sf_dir, "relative")), {"weight": 6})


DUCK_FEATURE_TEXT = """
feats AS (
  SELECT doc_id, category, CAST(count(*) AS INTEGER) AS n_terms,
         string_agg(CAST(word_idx AS VARCHAR), ' ' ORDER BY word_idx) AS indices,
         string_agg(CAST(CAST(round(weight * 1000000.0) AS BIGINT) AS VARCHAR), ' ' ORDER BY word_idx) AS weights
  FROM weights GROUP BY doc_id, category)"""


@register("feature_arrays", _with(*DUCK_TEXT_BASE, DUCK_IDF, DUCK_TF["augmented"], DUCK_WEIGHTS,
                                  DUCK_FEATURE_TEXT) + "SELECT * FROM feats")
def q_feature_arrays(spark, sf_dir):
    return TF.features_as_text(_features(spark, sf_dir))


# ---------------------------------------------------------------------------
# Classification (featured documents, class = lang)
# ---------------------------------------------------------------------------

MIN_CLASS_COUNT = 100     # strict ">" as in the reference's class filter
TRAIN_FRACTION = 0.75
SPLIT_SEED = 1234

DUCK_LABELS = """
fdocs AS (SELECT DISTINCT doc_id, category FROM tc),
ccount AS (SELECT category, count(*) AS n FROM fdocs GROUP BY category),
labels AS (SELECT category, CAST(row_number() OVER (ORDER BY n DESC, category ASC) - 1 AS DOUBLE) AS label, n
           FROM ccount)"""

DUCK_SPLIT = f"""
lf AS (
  SELECT f.doc_id, f.category, l.label, f.indices, f.weights,
         CAST(('0x' || substr(md5('{SPLIT_SEED}:' || CAST(f.doc_id AS VARCHAR)), 1, 8)) AS BIGINT)
           / 4294967296.0 < {TRAIN_FRACTION} AS is_train
  FROM feats f JOIN labels l USING (category))"""

DUCK_CLASS_BASE = (*DUCK_TEXT_BASE, DUCK_LABELS)
DUCK_SPLIT_BASE = (*DUCK_TEXT_BASE, DUCK_IDF, DUCK_TF["augmented"], DUCK_WEIGHTS, DUCK_FEATURE_TEXT,
                   DUCK_LABELS, DUCK_SPLIT)


@register("frequent_classes", _with(*DUCK_CLASS_BASE) + f"""
SELECT category, n FROM ccount WHERE n > {MIN_CLASS_COUNT}""")
def q_frequent_classes(spark, sf_dir):
    return C.frequent_classes(_counts(spark, sf_dir), MIN_CLASS_COUNT)


@register("frequent_class_docs", _with(*DUCK_CLASS_BASE) + f"""
SELECT doc_id, category FROM fdocs
WHERE category IN (SELECT category FROM ccount WHERE n > {MIN_CLASS_COUNT})""")
def q_frequent_class_docs(spark, sf_dir):
    return C.frequent_class_docs(_counts(spark, sf_dir), MIN_CLASS_COUNT).select("doc_id", "category")


@register("class_distribution", _with(*DUCK_CLASS_BASE) + "SELECT category, label, n FROM labels")
def q_class_distribution(spark, sf_dir):
    return C.label_table(_counts(spark, sf_dir))


@register("label_index", _with(*DUCK_CLASS_BASE) + """
SELECT f.doc_id, f.category, l.label FROM fdocs f JOIN labels l USING (category)""")
def q_label_index(spark, sf_dir):
    return C.with_labels(_counts(spark, sf_dir)).select("doc_id", "category", "label")


def _labelled(spark, sf_dir):
    return C.with_labels(_counts(spark, sf_dir))


@register("holdout_split", _with(*DUCK_SPLIT_BASE) + """
SELECT doc_id, category, label, CASE WHEN is_train THEN 'train' ELSE 'test' END AS split FROM lf""")
def q_holdout_split(spark, sf_dir):
    flagged = C.split_flag(_labelled(spark, sf_dir), TRAIN_FRACTION, SPLIT_SEED)
    return flagged.select("doc_id", "category", "label",
                          F.when(F.col("is_train"), "train").otherwise("test").alias("split"))


@register("except_distinct", _with(*DUCK_SPLIT_BASE) + """
SELECT category, label, indices, weights FROM lf
EXCEPT
SELECT category, label, indices, weights FROM lf WHERE is_train""")
def q_except_distinct(spark, sf_dir):
    rows = TF.features_as_text(TC.labelled_features(_counts(spark, sf_dir), LEXICON_K))
    train, _ = C.holdout_split(rows, TRAIN_FRACTION, SPLIT_SEED)
    cols = ["category", "label", "indices", "weights"]
    return C.except_distinct(rows.select(*cols), train.select(*cols))


@register("except_by_digest", f"""
SELECT text, lang, source, n_chars FROM documents
EXCEPT
SELECT text, lang, source, n_chars FROM documents WHERE md5('{SPLIT_SEED}:' || CAST(doc_id AS VARCHAR)) < 'c'""")
def q_except_by_digest(spark, sf_dir):
    """Documents whose text, language and source no document of a training set (three quarters) has."""
    docs = B.table(spark, sf_dir, "documents")
    train = docs.where(SE.row_hash("doc_id", SPLIT_SEED) < "c")
    cols = ["text", "lang", "source", "n_chars"]
    return DF.except_by_digest(docs.select(*cols), train.select(*cols))


@register("sample_by_label", _with(*DUCK_CLASS_BASE) + "SELECT label, n, TRUE AS share_as_asked FROM labels")
def q_sample_by_label(spark, sf_dir):
    """Random stratified sample (DataFrame.sampleBy) of the written, labelled
    table: the draw is Spark's own, so each class is checked for its share of
    rows (within five standard deviations of the fraction asked for)."""
    table = staged(_labelled(spark, sf_dir).select("doc_id", "label"), "labelled")
    classes = C.class_counts(table, "label")
    labels = [r.label for r in classes.collect()]
    drawn = C.class_counts(C.sample_by_label(table, TRAIN_FRACTION, SPLIT_SEED, labels=labels), "label")
    spread = 5 * F.sqrt(F.col("n") * TRAIN_FRACTION * (1 - TRAIN_FRACTION))
    off = F.abs(F.coalesce("drawn", F.lit(0)) - F.col("n") * TRAIN_FRACTION)
    return classes.join(drawn.withColumnRenamed("n", "drawn"), "label", "left").select(
        "label", "n", (off <= spread).alias("share_as_asked"))


@register("mlp_predictions", _with(*DUCK_SPLIT_BASE) + """
SELECT doc_id, category, label, TRUE AS known_label FROM lf WHERE NOT is_train""")
def q_mlp_predictions(spark, sf_dir):
    """The test set; each prediction is one of the fitted labels."""
    run = TC.classify_documents(_docs(spark, sf_dir), LEXICON_K, cache_train=False)
    known = F.col("prediction").isin([float(i) for i in range(len(run.labels))])
    return run.predictions.select("doc_id", "category", "label", known.alias("known_label"))


def _accuracy(spark, sf_dir, **options):
    """Sizes of the fit, and whether it beats the largest class. The fit itself
    is a job of its own; the report reads the written tables when it is asked for."""
    run = TC.classify_documents(_docs(spark, sf_dir), LEXICON_K, **options)
    run.train.unpersist()  # the fit is done
    return TC.accuracy_report(run).select("n_train", "n_test", "n_classes",
                                          (F.col("accuracy") > F.col("majority")).alias("beats_largest_class"))


DUCK_ACCURACY = """
SELECT count(*) FILTER (WHERE is_train) AS n_train, count(*) FILTER (WHERE NOT is_train) AS n_test,
       CAST(count(DISTINCT category) AS INTEGER) AS n_classes, TRUE AS beats_largest_class
FROM lf"""


@register("mlp_accuracy", _with(*DUCK_SPLIT_BASE) + DUCK_ACCURACY)
def q_mlp_accuracy(spark, sf_dir):
    return _accuracy(spark, sf_dir)


# ---------------------------------------------------------------------------
# Sources and sinks (round trips through the shared staging folder)
# ---------------------------------------------------------------------------


def _staged_trip_csv(spark, sf_dir) -> str:
    path = tracked_path(spark, "trips-csv")
    return FS.write_csv(B.trips_as_text(B.trips(spark, sf_dir)), path)


def _staged_complaint_lines(spark, sf_dir) -> str:
    path = tracked_path(spark, "complaint-lines")
    return FS.write_text(B.complaint_lines(spark, sf_dir, "lang"), path)


DUCK_TEXT_TRIPS = """
text_trips AS (
  SELECT CAST(trip_id AS VARCHAR) AS trip_id, date_trunc('second', start_ts) AS start_ts,
         date_trunc('second', end_ts) AS end_ts, start_lon, start_lat, end_lon, end_lat, cost
  FROM trips)"""

DUCK_LINES = """
lines AS (SELECT unnest(string_split(concat_ws(',', '2015-01-01', lang, text), chr(10))) AS value FROM documents),
fields AS (SELECT value, CAST(len(string_split(value, ',')) AS INTEGER) AS n_fields,
                  string_split(value, ',')[1] AS date, string_split(value, ',')[2] AS category,
                  string_split(value, ',')[3] AS text
           FROM lines)"""


@register("csv_schema_scan", _with(DUCK_TRIPS, DUCK_TEXT_TRIPS) + "SELECT * FROM text_trips")
def q_csv_schema_scan(spark, sf_dir):
    raw = FS.read_csv_schema(spark, _staged_trip_csv(spark, sf_dir), TRIPS_CSV)
    return T.parse_trips(raw)


@register("csv_infer_scan", ORACLE_SQL["hourly_profile"])
def q_csv_infer_scan(spark, sf_dir):
    """The reference's Q1 over a headerless CSV with inferred types."""
    raw = FS.name_positional(FS.read_csv_inferred(spark, _staged_trip_csv(spark, sf_dir)), TRIP_COLUMNS)
    return rounded(T.hourly_profile(raw), {"longitude": 6, "latitude": 6})


@register("parse_timestamps", _with(DUCK_TRIPS, DUCK_TEXT_TRIPS) + """
SELECT trip_id, start_ts, end_ts, CAST(hour(start_ts) AS INTEGER) AS hour FROM text_trips""")
def q_parse_timestamps(spark, sf_dir):
    parsed = T.parse_trips(B.trips_as_text(B.trips(spark, sf_dir)))
    return parsed.select("trip_id", "start_ts", "end_ts", F.hour("start_ts").alias("hour"))


@register("parquet_roundtrip", ORACLE_SQL["valid_trips"])
def q_parquet_roundtrip(spark, sf_dir):
    """Trips written to Parquet and read back; the validity filter is pushed
    into the scan (PushedFilters) and only needed columns are read."""
    path = FS.write_parquet(B.trips(spark, sf_dir), tracked_path(spark, "trips-parquet"))
    return T.valid_trips(FS.read_parquet(spark, path))


@register("text_line_scan", _with(DUCK_LINES) + "SELECT * FROM fields")
def q_text_line_scan(spark, sf_dir):
    return R.line_fields(FS.read_lines(spark, _staged_complaint_lines(spark, sf_dir)))


@register("valid_records", _with(DUCK_LINES) + r"""
SELECT date, category, lower(text) AS text FROM fields
WHERE n_fields = 3 AND starts_with(date, '201') AND regexp_matches(text, '\S')""")
def q_valid_records(spark, sf_dir):
    return R.valid_records(FS.read_lines(spark, _staged_complaint_lines(spark, sf_dir)))


@register("mlp_accuracy_relative", _with(*DUCK_SPLIT_BASE) + DUCK_ACCURACY)
def q_mlp_accuracy_relative(spark, sf_dir):
    """Second ML variant: relative term frequency."""
    return _accuracy(spark, sf_dir, weighting="relative")


@register("mlp_accuracy_frequent_classes", _with(*DUCK_SPLIT_BASE) + DUCK_ACCURACY + f"""
WHERE category IN (SELECT category FROM ccount WHERE n > {MIN_CLASS_COUNT})""")
def q_mlp_accuracy_frequent_classes(spark, sf_dir):
    """Third ML variant: classes with more than MIN_CLASS_COUNT documents only."""
    return _accuracy(spark, sf_dir, min_class_count=MIN_CLASS_COUNT)


# ---------------------------------------------------------------------------
# Incremental (Structured Streaming) form of the hourly profile
# ---------------------------------------------------------------------------

STREAM_FILES = 4


@register("hourly_profile_incremental", ORACLE_SQL["hourly_profile"])
def q_hourly_profile_incremental(spark, sf_dir):
    """Trips arrive as several files; the streaming aggregation consumes them
    one micro-batch per file and publishes the complete profile."""
    source = FS.write_parquet(B.trips(spark, sf_dir).repartition(STREAM_FILES),
                              tracked_path(spark, "trips-stream-source"))
    out = HS.run_hourly_profile_stream(spark, source, tracked_path(spark, "hourly-stream-out"))
    return rounded(HS.read_hourly_profile(spark, out), {"longitude": 6, "latitude": 6})


@register("split_class_distribution", _with(*DUCK_SPLIT_BASE) + """
SELECT category, label, CASE WHEN is_train THEN 'train' ELSE 'test' END AS split, count(*) AS n
FROM lf GROUP BY 1, 2, 3""")
def q_split_class_distribution(spark, sf_dir):
    """Class counts of the training and test sets (the reference prints both)."""
    flagged = C.split_flag(_labelled(spark, sf_dir), TRAIN_FRACTION, SPLIT_SEED).select(
        "category", "label", F.when(F.col("is_train"), "train").otherwise("test").alias("split"))
    return C.class_counts(flagged, ["category", "label", "split"])


# ---------------------------------------------------------------------------
# Distributed selection, numbering and class joins without a bound
# ---------------------------------------------------------------------------

DUCK_EXACT = f"""
ranked AS (
  SELECT f.doc_id, f.category, l.label, l.n,
         row_number() OVER (PARTITION BY l.label ORDER BY md5('{SPLIT_SEED}:' || CAST(f.doc_id AS VARCHAR))) AS place
  FROM fdocs f JOIN labels l USING (category))"""


@register("exact_split", _with(*DUCK_CLASS_BASE, DUCK_EXACT) + """
SELECT doc_id, category, label, CASE WHEN place <= floor(0.75 * n) THEN 'train' ELSE 'test' END AS split FROM ranked""")
def q_exact_split(spark, sf_dir):
    """Stratified split of exact size: the first floor(0.75 n) documents of each label by md5."""
    flagged = SE.exact_split_flag(staged(_labelled(spark, sf_dir).select("doc_id", "category", "label"), "labelled"), "0.75", SPLIT_SEED)
    return flagged.select("doc_id", "category", "label", F.when(F.col("is_train"), "train").otherwise("test").alias("split"))


@register("exact_split_ties", """
WITH ranked AS (
  SELECT l_returnflag AS label, l_orderkey AS key, count(*) OVER (PARTITION BY l_returnflag) AS n,
         row_number() OVER (PARTITION BY l_returnflag ORDER BY md5('7:' || CAST(l_orderkey AS VARCHAR))) AS place FROM lineitem)
SELECT label, key, count(*) FILTER (WHERE place <= floor(0.5 * n)) AS n_train, count(*) AS n_rows FROM ranked GROUP BY label, key""")
def q_exact_split_ties(spark, sf_dir):
    """The same with keys that repeat (order lines by their order): the cut falls among equal keys."""
    lines = B.table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("label"), F.col("l_orderkey").alias("key"))
    return SE.exact_split_flag(lines, "0.5", 7, key="key").groupBy("label", "key").agg(
        F.count_if("is_train").alias("n_train"), F.count(F.lit(1)).alias("n_rows"))


@register("document_numbers", """
SELECT doc_id, CAST(row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR))) - 1 AS BIGINT) AS number FROM documents""")
def q_document_numbers(spark, sf_dir):
    """Dense numbers in the order of a hash, by two levels of prefix sums."""
    keys = B.table(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("doc_id").cast("string")).alias("h"))
    return N.with_numbers(keys, [F.col("h")]).select("doc_id", "number")


@register("record_numbers", r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(concat_ws(',', '2015-01-01', lang, text), chr(10))) AS value,
         generate_subscripts(string_split(concat_ws(',', '2015-01-01', lang, text), chr(10)), 1) AS i FROM documents),
valid AS (SELECT *, string_split(value, ',') AS f FROM lines
          WHERE len(string_split(value, ',')) = 3 AND starts_with(value, '201')
            AND regexp_matches(string_split(value, ',')[3], '\S'))
SELECT CAST(row_number() OVER (ORDER BY doc_id, i) - 1 AS BIGINT) AS number, md5(value) AS digest, f[1] AS date, f[2] AS category,
       lower(f[3]) AS text FROM valid""")
def q_record_numbers(spark, sf_dir):
    """Valid complaint lines numbered in the order of their lines."""
    return R.numbered_records(spark, _staged_complaint_lines(spark, sf_dir))


HOT_PARTS = 64

DUCK_PARTS = """
WITH classes AS (SELECT l_partkey AS part, count(*) AS n FROM lineitem GROUP BY 1),
labels AS (SELECT part, n, CAST(row_number() OVER (ORDER BY n DESC, part) - 1 AS DOUBLE) AS label FROM classes)"""


def _part_lines(spark, sf_dir):
    return B.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
                                                     F.col("l_partkey").alias("part"))


@register("label_index_many_classes", DUCK_PARTS + """
SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part, label FROM lineitem JOIN labels ON part = l_partkey""")
def q_label_index_many_classes(spark, sf_dir):
    """Label index of a column whose number of classes grows with the table."""
    return HY.with_class_labels(_part_lines(spark, sf_dir), "part", hot=HOT_PARTS)


@register("frequent_rows_many_classes", DUCK_PARTS + """
SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part FROM lineitem JOIN labels ON part = l_partkey WHERE n > 30""")
def q_frequent_rows_many_classes(spark, sf_dir):
    return HY.rows_of_frequent_classes(_part_lines(spark, sf_dir), 30, "part", hot=HOT_PARTS)


@register("lexicon_topk_sketch", ORACLE_SQL["lexicon_topk"])
def q_lexicon_topk_sketch(spark, sf_dir):
    """The lexicon by frequent-items sketches and an exact recount of what they propose."""
    return FR.lexicon_by_sketch(_docs(spark, sf_dir), LEXICON_K)


@register("join_pushed_keys", _DUCK_JOIN50)
def q_join_pushed_keys(spark, sf_dir):
    return joins.join_pushed(B.trips(spark, sf_dir), B.vendors(spark, sf_dir))


_DUCK_EXACT_MEAN = "round(CAST(sum(CAST(floor({0} * 1048576) AS BIGINT)) * 1073741824 + sum(CAST(floor(({0} * 1048576 - floor({0} * 1048576)) * 1073741824) AS BIGINT)) AS DOUBLE) / (count(*) * CAST(1125899906842624 AS DOUBLE)), 12)"


@register("hourly_profile_exact", _with(DUCK_TRIPS, DUCK_VALID) + f"""
SELECT CAST(hour(start_ts) AS INTEGER) AS hour, {_DUCK_EXACT_MEAN.format("start_lon")} AS longitude,
       {_DUCK_EXACT_MEAN.format("start_lat")} AS latitude
FROM valid GROUP BY 1 ORDER BY 1""")
def q_hourly_profile_exact(spark, sf_dir):
    return rounded(T.hourly_profile_exact(B.trips(spark, sf_dir)), {"longitude": 12, "latitude": 12})


MIDTOWN = ((-74.0, -73.9), (40.7, 40.8))


@register("trips_from_box", _with(DUCK_TRIPS) + """
SELECT * FROM trips WHERE start_lon > -74.0 AND start_lon < -73.9 AND start_lat > 40.7 AND start_lat < 40.8""")
def q_trips_from_box(spark, sf_dir):
    """Trips that start in a small box, read from a table laid out along a space-filling curve."""
    path = SP.write_spatial(B.trips(spark, sf_dir), tracked_path(spark, "trips-spatial"))
    return SP.read_box(spark, path, *MIDTOWN)
