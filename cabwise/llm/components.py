"""Connected components of a table of links, by alternating stars.

Each round hangs neighbours on the least node they see (large star, then small
star) until nothing changes; the number of rounds grows with the logarithm of
a component's width. Minima are aggregated before they shuffle. Every round
is written to the shared folder, so that lost executors cost a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabwise.llm.common import staged


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both.join(_least(both).select("u", F.least("u", "least").alias("least")), "u")
    return near.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = _least(edges)
    moved = edges.join(least, "u").where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): every node of ``links`` that isn't its component's least one.

    ``links`` holds long columns ``a`` and ``b``, each link in either direction."""
    edges = staged(links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    sums = lambda x: x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    state = sums(edges)
    while state[0]:
        edges = staged(_small_star(_large_star(edges)), "stars")
        before, state = state, sums(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def components_sql(size: int, percent: int, more: str = "") -> str:
    """DuckDB SQL of ``documents``: (doc_id, n_shingles, component_id), linked where
    the sets of ``size`` lower-cased words in a row share ``percent``; ``more`` adds columns."""
    return rf"""
WITH RECURSIVE words AS (
  SELECT coalesce(doc_id, 9223372036854775807) AS doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
           lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' '))) END AS s FROM words),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS m, any_value(b.n) AS n, count(*) AS k
         FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id < b.doc_id
         WHERE 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n) GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE 100 * k >= {percent} * (m + n - k)),
edges AS (SELECT a AS u, b AS v FROM links UNION SELECT b, a FROM links),
reach AS (SELECT u, v FROM edges UNION SELECT r.u, e.v FROM reach r JOIN edges e ON r.v = e.u),
lowest AS (SELECT u, min(v) AS v FROM reach GROUP BY u)
SELECT nullif(doc_id, 9223372036854775807) AS doc_id, CAST(len(s) AS BIGINT) AS n_shingles,
       nullif(least(doc_id, coalesce(v, doc_id)), 9223372036854775807) AS component_id{more}
FROM sets LEFT JOIN lowest ON u = doc_id"""
