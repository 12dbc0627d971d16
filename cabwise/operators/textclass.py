"""End-to-end text classification: documents → features → labels → split →
MLP → predictions and accuracy (the reference's three ML variants are
parameter choices: ``weighting`` and ``min_class_count``).

The counts table (one row per document) is written once; everything behind it
reads that table: document frequencies, N, class counts, labels and weights.
Between the scan and the features nothing about single documents is shuffled,
unless the caller asks for a placement with ``partitions``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabwise.operators import classify as C
from cabwise.operators import lexicon as LX
from cabwise.operators import tfidf as TF
from cabwise.plans.lineage import Intermediates, intermediates, staged


def document_counts(docs: DataFrame, k: int = LX.DEFAULT_K, stopwords=None, clean_docs: bool = False,
                    partitions: int | None = None, materialize: bool = True) -> DataFrame:
    """(doc_id, category, counts) of documents with a word of the top-k lexicon.

    The k lexicon words are fetched when this is called (the vocabulary of a
    model is a parameter of the plan), and the table is written.
    ``partitions`` first places the documents by ``doc_id``: for a file of one
    row group, which one task would read.
    """
    if partitions is not None:
        docs = docs.repartition(partitions, "doc_id")
    words = LX.lexicon_words(LX.lexicon_topk(docs, k, stopwords))
    counts = LX.lexicon_counts(docs, words, clean_docs=clean_docs)
    return staged(counts, "counts") if materialize else counts


def features_of(counts: DataFrame, k: int = LX.DEFAULT_K, weighting: str = "augmented") -> DataFrame:
    """(doc_id, category, features) with features = sorted (word_idx, weight) pairs."""
    return TF.feature_arrays(counts, TF.inverse_document_frequency(counts), k, weighting)


def document_features(docs: DataFrame, k: int = LX.DEFAULT_K, weighting: str = "augmented", stopwords=None,
                      clean_docs: bool = False, partitions: int | None = None, materialize: bool = True) -> DataFrame:
    return features_of(document_counts(docs, k, stopwords, clean_docs, partitions, materialize), k, weighting)


def labelled_features(counts: DataFrame, k: int = LX.DEFAULT_K, weighting: str = "augmented",
                      min_class_count: int | None = None) -> DataFrame:
    """(doc_id, category, features, label), classes filtered if asked for.

    Classes are filtered after the weighting, as in the reference: idf counts
    all documents."""
    table = features_of(counts, k, weighting)
    if min_class_count is not None:
        frequent = C.frequent_classes(counts, min_class_count).select("category")
        table = table.join(F.broadcast(frequent), "category", "left_semi").select(*table.columns)
        counts = counts.join(F.broadcast(frequent), "category", "left_semi")
    labels = C.label_table(counts).select("category", "label")
    return table.join(F.broadcast(labels), "category").select(*table.columns, "label")


#: Least rows of a partition in the fit.
FIT_ROWS = 2048


@dataclass
class ClassificationRun:
    train: DataFrame          # persisted when cache_train is set; see release()
    test: DataFrame
    model: object
    predictions: DataFrame
    labels: list[str]         # index → class name (from the fitted indexer)
    written: Intermediates    # the tables that train, test and predictions read

    def release(self) -> None:
        """Drop the cached training rows and the tables written for this run, no others."""
        self.train.unpersist()
        self.written.release()


def for_the_fit(train: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """A written training table with partitions of ``rows`` rows at least, made without a shuffle.

    The fit runs a job of all partitions for each of its iterations. The rows are
    counted from the files' footers; a table of many rows keeps its scan's partitions."""
    return train.coalesce(max(1, -(-train.count() // rows)))


def split_vectors(docs: DataFrame, k: int, weighting: str, min_class_count: int | None, train_fraction: float,
                  seed: int, split: str = "hash", partitions: int | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """(train, test, class names): written tables with sparse vectors."""
    if split not in ("hash", "sample"):
        raise ValueError("split must be 'hash' or 'sample'")
    counts = document_counts(docs, k, partitions=partitions)
    features = labelled_features(counts, k, weighting, min_class_count).drop("label")
    features = staged(features, "features")
    table, indexer = C.index_labels(features)
    fractions = {float(i): train_fraction for i in range(len(indexer.labels))}
    cut = C.holdout_split if split == "hash" else C.sampled_split
    parts = [TF.sparse_layout(part, k) for part in cut(table, fractions, seed)]
    train, test = (staged(part, "vectors", TF.vector_schema(part)) for part in parts)
    return for_the_fit(train), test, list(indexer.labels)


def classify_documents(docs: DataFrame, k: int = LX.DEFAULT_K, weighting: str = "augmented",
                       min_class_count: int | None = None, train_fraction: float = 0.75,
                       seed: int = 1234, max_iter: int = 100, block_size: int = 128,
                       cache_train: bool = True, split: str = "hash", partitions: int | None = None) -> ClassificationRun:
    """``split='hash'``: by an md5 of the id; ``'sample'``: the reference's random
    stratified sample and EXCEPT."""
    with intermediates() as written:
        train, test, labels = split_vectors(docs, k, weighting, min_class_count, train_fraction, seed, split, partitions)
    if cache_train:
        train = train.persist(StorageLevel.MEMORY_AND_DISK)
    model = C.mlp_fit(train, k, len(labels), max_iter=max_iter, block_size=block_size, seed=seed)
    predictions = model.transform(test).select("doc_id", "category", "label", "prediction")
    return ClassificationRun(train, test, model, predictions, labels, written)


def accuracy_report(run: ClassificationRun) -> DataFrame:
    """One row: n_train, n_test, n_classes, accuracy, majority (the share of the
    test set's largest class)."""
    n_train = run.train.agg(F.count(F.lit(1))).scalar()
    largest = C.class_counts(run.test, "label").agg(F.max("n")).scalar()
    return (C.accuracy(run.predictions)
            .select(n_train.alias("n_train"), "n_test", F.lit(len(run.labels)).alias("n_classes"), "accuracy",
                    (largest / F.col("n_test")).alias("majority")))
