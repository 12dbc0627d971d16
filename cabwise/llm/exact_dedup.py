"""Exact duplicates by two-pass Bloom filtering.

Texts are equal when they agree after all white space ``[\\x20\\x09-\\x0D]`` is
deleted. One scan hashes the texts; a two-pass Bloom filter over the hashes
(:mod:`cabwise.llm.bloom`) finds those that may be repeated. Only their rows
shuffle, to be grouped by the full SHA-256; all other rows pass straight
through. Groups are aggregated before the shuffle, and the rows are joined to
their groups by a sort-merge join that AQE splits where a group is hot.

Defined results: a null text is an empty one; empty texts are equal. Of equal
texts the one with the most code points in the original stays, then the
smallest id (null ids last). Rows that agree in id and text count as copies;
:func:`keep_distinct` keeps one of them. Empty input: empty result. Columns
beside id and text are carried through by :func:`keep_distinct` as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwise.llm.bloom import repeat_filter
from cabwise.llm.common import SPACES, documents, staged, text_of


def normalised_sha(text: str = "text") -> Column:
    return F.sha2(F.translate(text_of(text), SPACES, "").cast("binary"), 256)


def preference(doc_id: str = "doc_id", points: str = "n_points") -> Column:
    """The least of a group's values belongs to the row that stays."""
    return F.struct((-F.col(points)).alias("less"), F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"))


def text_hashes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_points, sha) for every row, written once."""
    return staged(docs.select(F.col(doc_id).alias("doc_id"), F.char_length(text_of(text)).alias("n_points"),
                              normalised_sha(text).alias("sha")), "text-hashes")


def possible_copies(hashes: DataFrame):
    """The Bloom test, to be applied to ``xxhash64(sha)``."""
    return repeat_filter(hashes.select(F.xxhash64("sha").alias("h")), "h", hashes.count())


def copy_groups(hashes: DataFrame, maybe) -> DataFrame:
    """(sha, group_size, keep) of the rows that the Bloom filter could not clear."""
    return (hashes.where(maybe(F.xxhash64("sha"))).groupBy("sha")
            .agg(F.count(F.lit(1)).alias("group_size"), F.min(preference()).alias("keep")))


def duplicate_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row."""
    hashes = text_hashes(docs, doc_id, text)
    maybe = possible_copies(hashes)
    flagged = maybe(F.xxhash64("sha"))
    single = hashes.where(~flagged).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    several = hashes.where(flagged).join(copy_groups(hashes, maybe), "sha").select(
        "doc_id", F.col("keep.id").alias("keep_id"), "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep.id")).alias("kept"), F.col("sha").alias("text_sha256"))
    return single.unionByName(several)


def keep_distinct(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged."""
    columns = docs.columns
    hashes = text_hashes(docs, doc_id, text)
    maybe = possible_copies(hashes)
    sha, points = "__llm_sha", "__llm_points"
    keyed = docs.withColumns({sha: normalised_sha(text), points: F.char_length(text_of(text))})
    flagged = maybe(F.xxhash64(F.col(sha)))
    keep = copy_groups(hashes, maybe).where("group_size > 1").select(
        F.col("sha").alias("__llm_keep_sha"), F.col("keep.less").alias("__llm_less"), F.col("keep.id").alias("__llm_id"))
    several = keyed.where(flagged).join(keep, F.col(sha) == F.col("__llm_keep_sha"), "left")
    stays = F.col("__llm_keep_sha").isNull() | (
        (-F.col(points) == F.col("__llm_less")) & F.col(doc_id).eqNullSafe(F.col("__llm_id")))
    several = several.where(stays).dropDuplicates([sha]).select(*[F.col(f"`{c}`") for c in columns])
    return keyed.where(~flagged).select(*[F.col(f"`{c}`") for c in columns]).unionByName(several)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_classes(documents(spark, sf_dir))


OP8_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM g
"""
