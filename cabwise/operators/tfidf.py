"""Inverse document frequency and the two TF-IDF weightings, inside the row.

Input: the counts table of ``lexicon.lexicon_counts``, one row per document
with sorted (word_idx, cnt) pairs. A document's maximum, total, term
frequencies and weights are array expressions on its own row. Only one thing
crosses a shuffle: document frequencies, at most k partial counts a task.
The k inverse frequencies come back as one scalar subquery, an array indexed
by word. The long form (a row per document and word) is derived by expanding
the arrays, for those who want it.
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


def long_counts(counts: DataFrame) -> DataFrame:
    """(doc_id, category, word_idx, cnt): a row per document and word."""
    return counts.select("doc_id", "category", F.inline("counts"))


def n_documents(counts: DataFrame) -> Column:
    """Scalar column: number of documents with at least one lexicon word."""
    return counts.agg(F.count(F.lit(1))).scalar()


def inverse_document_frequency(counts: DataFrame) -> DataFrame:
    """(word_idx, df, n_docs, idf) with idf = ln(N / df).

    Plain ln(N/df): a word found in every matched document gets idf 0.
    (spark.ml's IDF uses ln((N+1)/(df+1)) and is not the same quantity.)
    """
    n = n_documents(counts)
    return (counts.select(F.explode("counts.word_idx").alias("word_idx"))
            .groupBy("word_idx").agg(F.count(F.lit(1)).alias("df"))
            .select("word_idx", "df", n.alias("n_docs"), F.ln(n / F.col("df")).alias("idf")))


#: What a count is set against: the largest count of its document, or their sum.
BASES = {"augmented": lambda counts: F.array_max(counts),
         "relative": lambda counts: F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)}
#: tf from a count and that base.
TF_FUNCTIONS = {"augmented": lambda count, base: F.lit(0.5) + F.lit(0.5) * count / base,
                "relative": lambda count, base: count / base}


def term_frequencies(counts: DataFrame, weighting: str = "augmented") -> DataFrame:
    """(doc_id, category, terms): (word_idx, cnt, tf) of each document's words."""
    # the base is an argument beside the counts, worked out once a row, not once a word
    base = F.array_repeat(BASES[weighting](F.col("counts.cnt")), F.size("counts"))
    term = lambda c, b: F.struct(c["word_idx"].alias("word_idx"), c["cnt"].alias("cnt"),
                                 TF_FUNCTIONS[weighting](c["cnt"], b).alias("tf"))
    return counts.select("doc_id", "category", F.zip_with("counts", base, term).alias("terms"))


def idf_by_index(idf: DataFrame, k: int) -> Column:
    """Scalar column: the idf of words 0..k-1 (0 for a word no document has)."""
    found = F.map_from_entries(F.collect_list(F.struct("word_idx", "idf")))
    dense = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.coalesce(F.element_at("found", i), F.lit(0.0)))
    return idf.agg(found.alias("found")).select(dense).scalar()


def feature_arrays(counts: DataFrame, idf: DataFrame, k: int, weighting: str = "augmented") -> DataFrame:
    """(doc_id, category, features): (word_idx, weight = tf * idf) pairs sorted by index."""
    terms = term_frequencies(counts, weighting).withColumn("__idf", idf_by_index(idf, k))
    weight = lambda t: F.struct(t["word_idx"].alias("word_idx"),
                                (t["tf"] * F.get("__idf", t["word_idx"])).alias("weight"))
    return terms.select("doc_id", "category", F.transform("terms", weight).alias("features"))


def long_weights(arrays: DataFrame) -> DataFrame:
    """(doc_id, category, word_idx, weight): a row per document and word."""
    return arrays.select("doc_id", "category", F.inline("features"))


def sparse_layout(arrays: DataFrame, size: int, col: str = "features") -> DataFrame:
    """The pair array in the storage layout of a sparse ml vector.

    Written as Parquet and read with :func:`vector_schema` it is a sparse
    vector column: nothing dense of ``size`` numbers is ever made."""
    indices, values = F.col(f"{col}.word_idx"), F.col(f"{col}.weight")
    return arrays.withColumn(col, F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
                                           indices.alias("indices"), values.alias("values")))


def vector_schema(df: DataFrame, col: str = "features") -> StructType:
    """The schema to read a :func:`sparse_layout` table with."""
    return StructType([StructField(f.name, VectorUDT() if f.name == col else f.dataType) for f in df.schema])


def features_as_text(arrays: DataFrame, col: str = "features", places: int = 6) -> DataFrame:
    """Engine-neutral text form of the pair array, for comparisons:
    ``indices`` = space-separated indices, ``weights`` = space-separated
    weights scaled by 10**places and rounded to integers."""
    scale = float(10 ** places)
    return arrays.select(
        *[c for c in arrays.columns if c != col],
        F.size(col).alias("n_terms"),
        F.array_join(F.transform(F.col(col), lambda p: p["word_idx"].cast("string")), " ").alias("indices"),
        F.array_join(F.transform(F.col(col), lambda p: F.round(p["weight"] * scale).cast("bigint").cast("string")),
                     " ").alias("weights"),
    )
