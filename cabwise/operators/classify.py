"""Class filtering, label index, train/test split, MLP fit and accuracy.

Input: any table with one row per document that has ``doc_id`` and
``category``; counts and labels need no feature.

Scale notes:

* Class counts are a partial/final hash aggregate (one row per class leaves
  each task). Filtering and labelling join them back by broadcast: a table of
  classes has the size of the network's output layer, which every task holds
  anyway. Documents are never shuffled by class, so a class that has a third
  of them is no hot key.
* The hash split is a per-row test (md5 of seed and ``doc_id``), so it needs
  no shuffle, is the same on every recomputation and in every engine, and
  its complement is exactly the test set (no row lost, none duplicated).
"""

from __future__ import annotations

from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_SPACE = 4294967296.0  # 2**32: the first 8 hex digits of an md5


def class_counts(df: DataFrame, col: str | list[str] = "category") -> DataFrame:
    cols = [col] if isinstance(col, str) else list(col)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def frequent_classes(df: DataFrame, threshold: int, col: str = "category") -> DataFrame:
    """Classes with strictly more than ``threshold`` rows."""
    return class_counts(df, col).where(F.col("n") > F.lit(threshold))


def frequent_class_docs(df: DataFrame, threshold: int, col: str = "category") -> DataFrame:
    """Rows of ``df`` whose class is frequent (left semi join)."""
    return df.join(F.broadcast(frequent_classes(df, threshold, col).select(col)), col, "left_semi")


def label_table(df: DataFrame, col: str = "category") -> DataFrame:
    """(class, label, n): 0.0 for the most frequent class, equal counts alphabetically."""
    order = Window.orderBy(F.col("n").desc(), F.col(col).asc())  # one row per class
    return class_counts(df.where(F.col(col).isNotNull()), col).select(
        col, (F.row_number().over(order) - 1).cast("double").alias("label"), "n")


def with_labels(df: DataFrame, col: str = "category") -> DataFrame:
    """``df`` with its class label; the plan is lazy, nothing is fitted."""
    return df.join(F.broadcast(label_table(df, col).select(col, "label")), col).select(*df.columns, "label")


def label_indexer(df: DataFrame, input_col: str = "category", output_col: str = "label"):
    """Most frequent class → 0.0; equal counts ordered alphabetically;
    unseen classes are skipped at transform time."""
    return StringIndexer(inputCol=input_col, outputCol=output_col,
                         stringOrderType="frequencyDesc", handleInvalid="skip").fit(df)


def index_labels(df: DataFrame, input_col: str = "category", output_col: str = "label"):
    model = label_indexer(df, input_col, output_col)
    return model.transform(df), model


def hash_unit(key: str = "doc_id", seed: int = 1234) -> Column:
    """Uniform value in [0, 1) from md5(seed ':' key); reproducible anywhere."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(HASH_SPACE)


def _fraction_of(label_col: str, fractions: dict | float) -> Column:
    if isinstance(fractions, (int, float)):
        return F.lit(float(fractions))
    expr = None
    for label, frac in sorted(fractions.items()):
        cond = F.col(label_col) == F.lit(label)
        expr = F.when(cond, F.lit(float(frac))) if expr is None else expr.when(cond, F.lit(float(frac)))
    return expr  # null (never sampled) for a label absent from the map


def split_flag(df: DataFrame, fractions: dict | float = 0.75, seed: int = 1234,
               key: str = "doc_id", label_col: str = "label") -> DataFrame:
    """Adds ``is_train``: a stratified Bernoulli draw per row, deterministic."""
    frac = _fraction_of(label_col, fractions)
    return df.withColumn("is_train", F.coalesce(hash_unit(key, seed) < frac, F.lit(False)))


def holdout_split(df: DataFrame, fractions: dict | float = 0.75, seed: int = 1234,
                  key: str = "doc_id", label_col: str = "label") -> tuple[DataFrame, DataFrame]:
    """(train, test); test is the exact complement of train."""
    flagged = split_flag(df, fractions, seed, key, label_col)
    train = flagged.where(F.col("is_train")).drop("is_train")
    test = flagged.where(~F.col("is_train")).drop("is_train")
    return train, test


def sample_by_label(df: DataFrame, fractions: dict | float = 0.75, seed: int = 1234,
                    label_col: str = "label", labels=None) -> DataFrame:
    """``DataFrame.sampleBy`` (the reference's random stratified sample).

    A float applies to every label in ``labels``; pass the fitted indexer's
    labels (or their indices) so the fraction map matches the data."""
    if not isinstance(fractions, dict):
        fractions = {lab: float(fractions) for lab in labels}
    return df.sampleBy(label_col, fractions=fractions, seed=seed)


def except_distinct(all_rows: DataFrame, train: DataFrame) -> DataFrame:
    """Reference test set: EXCEPT DISTINCT (drops duplicates and any row equal
    to a training row). ``holdout_split`` is the loss-free alternative.

    Both sides go through one aggregation over all columns that remembers
    whether a row came from ``train``: one exchange, nulls equal to nulls, and
    a group of copies is one row a task before it shuffles.
    """
    columns = all_rows.columns
    marked = all_rows.withColumn("__in_train", F.lit(False)).unionByName(train.select(*columns).withColumn("__in_train", F.lit(True)))
    return marked.groupBy(*columns).agg(F.max("__in_train").alias("__in_train")).where(~F.col("__in_train")).select(*columns)


def sampled_split(df: DataFrame, fractions: dict, seed: int = 1234,
                  label_col: str = "label") -> tuple[DataFrame, DataFrame]:
    """The reference's split: a random stratified sample, and what EXCEPT leaves.

    ``df`` must give the same rows whenever it is read (a written table)."""
    train = sample_by_label(df, fractions, seed, label_col)
    return train, except_distinct(df, train)


def mlp_layers(n_features: int, n_classes: int) -> list[int]:
    return [n_features, (n_features + n_classes) // 2, n_classes]


def mlp_fit(train: DataFrame, n_features: int, n_classes: int, max_iter: int = 100,
            block_size: int = 128, seed: int = 1234, features_col: str = "features",
            label_col: str = "label"):
    trainer = MultilayerPerceptronClassifier(
        maxIter=max_iter, layers=mlp_layers(n_features, n_classes), blockSize=block_size,
        seed=seed, featuresCol=features_col, labelCol=label_col)
    return trainer.fit(train)


def accuracy(predictions: DataFrame, label_col: str = "label",
             prediction_col: str = "prediction") -> DataFrame:
    """One row: share of rows whose prediction equals the label (the same
    number MulticlassClassificationEvaluator(metricName='accuracy') gives)."""
    hit = (F.col(prediction_col) == F.col(label_col)).cast("double")
    return predictions.agg(F.count(F.lit(1)).alias("n_test"), F.avg(hit).alias("accuracy"))
