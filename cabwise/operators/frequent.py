"""Exact top-k words without a shuffle of the vocabulary.

Counting every word and taking the k largest sends each task's whole vocabulary
through a shuffle. Here each task keeps a frequent-items sketch of a fixed
number of words (``approx_top_k_accumulate``); sketches are merged in two
levels. A sketch of m items over N words misses no word that occurs more than
2E times, and counts none wrong by more than E, with E = 3.5 N / m. So the
sketch only *proposes*: all words whose estimate reaches the k-th one's less E
are counted exactly in a second pass (a word that isn't proposed never shuffles),
and the result stands if the k-th exact count is more than 2E, ties included.
If it isn't, the sketch is made eight times larger; after the largest one all
words are counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabwise.functions.text import cleaned_tokens, is_stopword
from cabwise.operators.lexicon import DEFAULT_K
from cabwise.plans.lineage import staged
from cabwise.plans.sizing import bounded_broadcast

ITEMS, MOST_ITEMS = 1 << 14, 1_000_000  # the largest sketch that the function allows
FAN = 64                                # sketches that one task merges at the end


def sketch(values: DataFrame, col: str, items: int) -> DataFrame:
    """One row, if there are values: ``top``, pairs (item, count) by falling estimate, and ``n``, all values."""
    parts = (values.where(F.col(col).isNotNull()).withColumn("__part", F.pmod(F.spark_partition_id(), F.lit(FAN))).groupBy("__part")
             .agg(F.expr(f"approx_top_k_accumulate(`{col}`, {items})").alias("s"), F.count(F.lit(1)).alias("n")))
    # grouped by a constant: a task without rows must not send an empty sketch, which can't be merged
    merged = parts.groupBy(F.lit(0).alias("all")).agg(F.expr("approx_top_k_combine(s)").alias("s"), F.sum("n").alias("n"))
    return merged.select("n", F.expr(f"approx_top_k_estimate(s, {items})").alias("top"))


def top_values(values: DataFrame, col: str, k: int, items: int = ITEMS) -> DataFrame:
    """(col, n): the k most frequent values, equal counts by value; nulls don't
    count. ``values`` is read twice at least."""
    while items <= MOST_ITEMS:
        seen = staged(sketch(values, col, items).select("n", F.inline("top")), "frequent-items").withColumnRenamed("item", col)
        total = (seen.agg(F.max("n")).first()[0]) or 0
        if not total:
            break
        error = -(-7 * total // (2 * items))
        kth = seen.orderBy(F.col("count").desc()).limit(k).agg(F.min("count")).first()[0]
        proposed = seen.where(F.col("count") >= kth - error).select(col).limit(items)
        exact = staged(values.join(bounded_broadcast(proposed, "proposed words"), col).groupBy(col).agg(F.count(F.lit(1)).alias("n")), "recounted")
        top = exact.orderBy(F.col("n").desc(), F.col(col)).limit(k)
        bound = top.agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).first()
        if bound.k == k and bound.least > 2 * error:
            return top
        items *= 8
    every = values.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return every.orderBy(F.col("n").desc(), F.col(col)).limit(k)


def lexicon_by_sketch(docs: DataFrame, k: int = DEFAULT_K, stopwords=None, text_col: str = "text", items: int = ITEMS) -> DataFrame:
    """(word, word_idx, n), as ``lexicon.lexicon_topk`` gives it."""
    words = docs.select(F.explode(cleaned_tokens(text_col)).alias("word"))
    top = top_values(words.where(~is_stopword("word", stopwords, lowercase=False)), "word", k, items)
    order = Window.orderBy(F.col("n").desc(), F.col("word"))  # k rows
    return top.select("word", (F.row_number().over(order) - 1).alias("word_idx"), "n")
