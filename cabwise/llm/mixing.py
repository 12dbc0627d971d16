"""Mixing sources to target weights by systematic sampling.

A document of a source with ``target`` words wanted out of ``source_size`` has
``target / source_size`` expected copies. Within a source the documents stand
in a line, sorted by size; the expected copies are summed along the line, one
random offset per source is added, and a document is emitted once for every
integer that its stretch of the sum crosses. Sorting by size makes
neighbours alike, so that a source's words come within about one document of
its target.

The prefix sum is distributed. A source is cut into size classes (eighths of
an octave) and each class into buckets by a hash of the id, one for ``RANKED``
rows of the table and ``BUCKETS`` at least: a block of (source, class, bucket)
has about ``RANKED`` rows at most, even if all rows are of one source and size.
The counts of these blocks are aggregated before they shuffle and summed on two
levels, buckets in their class and classes (512 at most) in their source;
documents are ranked inside their block. No task sees a whole source.

Defined results: a null or empty text has size 0 and takes no words. A null
source is a source of its own, after all others. A source without words has
target 0 and emits nothing. Rows that repeat an id are ranked one by one.
Empty input: empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cabwise.llm.common import documents, text_of

WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3
BUCKETS = 64
#: Rows of a block, about, if all rows are of one source and size class.
RANKED = 1 << 15
SEED = 20240


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`").cast("string"), F.lit(r"[^\x20\x09-\x0D]+")),
                      F.lit(0)).cast("long")


def unit_hash(*parts) -> Column:
    """A number in [0, 1) from an md5, equal in every engine."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(2.0 ** 32)


def size_class(size: str = "size") -> Column:
    """Eighths of an octave; grows with the size."""
    return F.expr(f"CASE WHEN {size} < 8 THEN {size} ELSE char_length(bin({size})) * 8 "
                  f"+ (shiftright({size}, char_length(bin({size})) - 4) & 7) END").cast("int")


def repeating_weights(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """Adds ``weight``: the given weights in turn, sources by code point, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return sources.withColumn("weight", F.get(cycle, place % len(weights)))


def target_words(sources: DataFrame, most_copies: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, weight) to targets: shares of all words by weight,
    none over ``most_copies`` times its source, the excess shared again.

    Sources that reach their cap are those with the least cap per weight, so
    one running sum over sources in that order finds the final level. This is
    a table of the mixture's settings, one row for each source.
    """
    capped = sources.withColumn("cap", F.col("source_size") * most_copies)
    order = [(F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    from_here = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = capped.withColumn("level", (F.sum("source_size").over(whole)
                                         - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                               / F.sum("weight").over(from_here))
    below = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    final = levels.withColumn("final", F.max(below).over(whole))  # the first level that fits
    return final.select("source", "source_size", F.least(
        F.col("cap").cast("double"), F.col("final") * F.col("weight")).alias("target"))


def blocks(rows: DataFrame, buckets: int, seed: int, doc_id: str) -> DataFrame:
    spot = unit_hash(F.lit(str(seed)), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")))
    return rows.withColumns({"__mix_class": size_class("__mix_size"),
                             "__mix_bucket": F.floor(spot * buckets).cast("int")})


def copies_of(docs: DataFrame, weigh=repeating_weights, most_copies: int = MOST_COPIES, buckets: int | None = None,
              seed: int = SEED, doc_id: str = "doc_id", text: str = "text", source: str = "source",
              out: str = "mix") -> DataFrame:
    """``docs`` with a struct column ``out``: size, source_size, target, copies.

    ``weigh`` adds a ``weight`` to a table (source, source_size); it may join
    a table of the caller's own weights. ``buckets`` follows the number of rows, unless
    given; the rows are counted when this is called (from the footers of a table).
    """
    if out in docs.columns:
        raise ValueError(f"the input has a column {out}; choose another name for the result")
    buckets = max(BUCKETS, -(-docs.count() // RANKED)) if buckets is None else buckets
    rows = blocks(docs.withColumns({
        "__mix_size": n_words(text), "__mix_no_source": F.col(f"`{source}`").isNull(),
        "__mix_source": F.coalesce(F.col(f"`{source}`").cast("string"), F.lit(""))}), buckets, seed, doc_id)
    place = ["__mix_source", "__mix_no_source", "__mix_class", "__mix_bucket"]
    counted = rows.groupBy(*place).agg(F.count(F.lit(1)).alias("n"), F.sum("__mix_size").alias("words"))
    line = Window.partitionBy(*place[:2]).orderBy("__mix_class")
    classes = counted.groupBy(*place[:3]).agg(F.sum("n").alias("n")).select(
        *place[:3], (F.sum("n").over(line) - F.col("n")).alias("__mix_shorter"))
    in_class = Window.partitionBy(*place[:3]).orderBy("__mix_bucket")
    starts = counted.select(*place, (F.sum("n").over(in_class) - F.col("n")).alias("__mix_inside")).join(
        classes, place[:3]).select(*place, (F.col("__mix_shorter") + F.col("__mix_inside")).alias("__mix_before"))
    sources = counted.groupBy(*place[:2]).agg(F.sum("words").alias("source_size")).select(
        F.when(~F.col("__mix_no_source"), F.col("__mix_source")).alias("source"), "source_size")
    targets = target_words(weigh(sources), most_copies).select(
        F.coalesce("source", F.lit("")).alias("__mix_source"), F.col("source").isNull().alias("__mix_no_source"),
        "source_size", "target",
        unit_hash(F.lit(f"{seed}:offset"), F.coalesce("source", F.lit(""))).alias("offset"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"))
    lines = starts.join(targets, place[:2])
    inside = Window.partitionBy(*place).orderBy("__mix_size", F.col(f"`{doc_id}`").asc_nulls_last(),
                                                F.xxhash64(text_of(text)))
    ranked = rows.withColumn("__mix_rank", F.row_number().over(inside)).join(lines, place)
    upto = lambda rank: F.floor(rank * F.col("rate") + F.col("offset"))
    rank = F.col("__mix_before") + F.col("__mix_rank")
    return ranked.select(*[F.col(f"`{c}`") for c in docs.columns], F.struct(
        F.col("__mix_size").alias("size"), F.col("source_size"), F.col("target"),
        (upto(rank) - upto(rank - 1)).cast("long").alias("copies")).alias(out))


def emit(mixed: DataFrame, out: str = "mix") -> DataFrame:
    """The mixture itself: each document as often as it is taken, own columns only."""
    columns = [F.col(f"`{c}`") for c in mixed.columns if c != out]
    return (mixed.where(F.col(f"{out}.copies") > 0)
            .select(*columns, F.explode(F.sequence(F.lit(1), F.col(f"{out}.copies").cast("int"))).alias("__mix_copy"))
            .drop("__mix_copy"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = copies_of(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return mix.select("doc_id", "mix.size", "mix.source_size", "mix.target",
                      (F.col("mix.copies") * F.col("mix.size")).alias("taken"))


OP1_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, source IS NULL AS no_source, coalesce(source, '') AS src,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT src, no_source, CAST(sum(size) AS BIGINT) AS source_size,
             [{', '.join(f'CAST({w} AS DOUBLE)' for w in WEIGHTS)}][
               (row_number() OVER (ORDER BY no_source, encode(src)) - 1) % {len(WEIGHTS)} + 1] AS weight,
             {MOST_COPIES} * CAST(sum(size) AS BIGINT) AS cap
      FROM d GROUP BY src, no_source),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, no_source, src
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY cap / weight, no_source, src
                                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM s),
t AS (SELECT src, no_source, source_size,
             least(CAST(cap AS DOUBLE),
                   max(CASE WHEN level * weight <= cap THEN level END) OVER () * weight) AS target,
             CAST(('0x' || substr(md5('{SEED}:offset:' || src), 1, 8)) AS BIGINT) / 4294967296.0 AS u
      FROM l),
c AS (SELECT *, CASE WHEN size < 8 THEN size
                     ELSE length(bin(size)) * 8 + ((size >> (length(bin(size)) - 4)) & 7) END AS class,
             floor(CAST(('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT)
                   / 4294967296.0 * (SELECT greatest({BUCKETS}, (count(*) + {RANKED - 1}) // {RANKED}) FROM d)) AS bucket
      FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY src, no_source ORDER BY class, bucket, size, doc_id NULLS LAST) AS rk
      FROM c),
e AS (SELECT r.doc_id, r.size, t.source_size, t.target, t.u, r.rk,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
      FROM r JOIN t USING (src, no_source))
SELECT doc_id, size, source_size, target,
       size * CAST(floor(rk * rate + u) - floor((rk - 1) * rate + u) AS BIGINT) AS taken
FROM e
"""
