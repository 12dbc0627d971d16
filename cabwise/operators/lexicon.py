"""Lexicon building and lexicon matching over a document table.

Input: any DataFrame with ``doc_id``, ``category`` and ``text``.

Plan shape (all built-ins):

* ``token_counts``: clean → split → explode → stopword ``InSet`` filter →
  ``groupBy(word).count()``. The partial aggregate runs before the exchange,
  so a word present in every document (the hot key) crosses the shuffle once
  per map task, not once per occurrence.
* ``lexicon_topk``: ``orderBy(n desc, word asc).limit(k)`` plans as
  TakeOrderedAndProject — each task keeps k rows; only k rows ever reach a
  single partition, where the 0-based index is assigned.
* ``matched_tokens``: raw document tokens inner-joined to the lexicon. The
  lexicon's plan must bound its rows (LIMIT k) before it is broadcast, so
  the document side is never shuffled.
* ``lexicon_counts``: the same matches, counted inside the row of each
  document; no token ever becomes a row.
"""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabwise.functions.text import clean_token, cleaned_tokens, is_stopword, tokens
from cabwise.plans.sizing import bounded_broadcast

DEFAULT_K = 150


def doc_tokens(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc_id, category, pos, token): raw lower-cased tokens, empties kept."""
    return docs.select("doc_id", "category",
                       F.posexplode(tokens(text_col)).alias("pos", "token"))


def token_counts(docs: DataFrame, stopwords=None, text_col: str = "text") -> DataFrame:
    """(word, n): cleaned tokens that are not stopwords, with their counts."""
    words = docs.select(F.explode(cleaned_tokens(text_col)).alias("word"))
    # cleaned tokens hold only a-z: the stopword test needs no lower()
    return (words.where(~is_stopword("word", stopwords, lowercase=False))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def lexicon_topk(docs: DataFrame, k: int = DEFAULT_K, stopwords=None,
                 text_col: str = "text") -> DataFrame:
    """(word, word_idx, n): the k most frequent words, ties by word ascending."""
    order = [F.col("n").desc(), F.col("word").asc()]
    top = token_counts(docs, stopwords, text_col).orderBy(*order).limit(k)
    return top.select("word", (F.row_number().over(Window.orderBy(*order)) - 1).alias("word_idx"), "n")


def matched_tokens(docs: DataFrame, lexicon: DataFrame, text_col: str = "text",
                   clean_docs: bool = False, with_pos: bool = True,
                   with_category: bool = True) -> DataFrame:
    """(doc_id, category, pos, word, word_idx) for every document token that
    is a lexicon word. Tokens are matched as they are (``paid.`` does not
    match ``paid``) unless ``clean_docs`` is set. Documents without a lexicon
    word produce no rows. ``with_pos=False`` drops the token position (and
    the work of generating it) when only counts are needed;
    ``with_category=False`` leaves the per-document class out of the
    per-token rows (it is re-attached once per document later)."""
    keep = ["doc_id", "category"] if with_category else ["doc_id"]
    if with_pos:
        toks = docs.select(*keep, F.posexplode(tokens(text_col)).alias("pos", "token"))
    else:
        toks = docs.select(*keep, F.explode(tokens(text_col)).alias("token"))
    if clean_docs:
        toks = toks.withColumn("token", clean_token("token"))
    lex = bounded_broadcast(lexicon.select("word", "word_idx"), "lexicon")  # LIMIT k
    cols = keep + (["pos"] if with_pos else []) + ["word", "word_idx"]
    return toks.join(lex, toks["token"] == lex["word"], "inner").select(*cols)


def lexicon_words(lexicon: DataFrame) -> list[str]:
    """The k words of a lexicon by index."""
    return [r.word for r in lexicon.orderBy("word_idx").collect()]


def lexicon_counts(docs: DataFrame, words: list[str], text_col: str = "text",
                   clean_docs: bool = False) -> DataFrame:
    """(doc_id, category, counts): pairs (word_idx, cnt) sorted by index, for
    documents with at least one lexicon word.

    The tokens of a document are counted where they are, by a vocabulary model
    of the lexicon: no explode, no shuffle. ``clean_docs`` compares tokens
    with their non-letters removed.
    """
    own = cleaned_tokens(text_col) if clean_docs else tokens(text_col)
    toks = docs.select("doc_id", "category", F.coalesce(own, F.array().cast("array<string>")).alias("tokens"))
    if not words:
        counted = toks.withColumn("dense", F.array().cast("array<double>"))
    else:
        model = CountVectorizerModel.from_vocabulary(words, inputCol="tokens", outputCol="vector", minTF=1.0)
        counted = model.transform(toks).withColumn("dense", vector_to_array("vector"))
    pairs = F.transform("dense", lambda n, i: F.struct(i.cast("int").alias("word_idx"), n.cast("long").alias("cnt")))
    own = F.struct("doc_id", "category", F.filter(pairs, lambda p: p["cnt"] > 0).alias("counts"))
    # a filter on the column would be moved below the counting, which then is done twice for each document
    return counted.select(F.inline(F.filter(F.array(own), lambda row: F.size(row["counts"]) > 0)))
