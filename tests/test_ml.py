"""MLP classification end to end on the smallest tables."""
import pytest
from pyspark.sql import functions as F

from cabwise.operators import classify as C, textclass as TC
from cabwise.sources import bindings as B
from tables import SF_SMOKE


def test_classification_beats_majority_and_is_repeatable(spark):
    docs = B.complaints(spark, SF_SMOKE, "lang")
    run = TC.classify_documents(docs, max_iter=40)
    acc = run.predictions.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    counts = [r.n for r in C.class_counts(run.test, "label").collect()]
    majority = max(counts) / sum(counts)
    assert acc > majority
    assert len(run.labels) == 4
    # same rows, same seed: same model output
    model2 = C.mlp_fit(run.train, 150, len(run.labels), max_iter=40)
    p1 = {r.doc_id: r.prediction for r in run.predictions.collect()}
    p2 = {r.doc_id: r.prediction for r in model2.transform(run.test).collect()}
    assert p1 == p2
    rep = TC.accuracy_report(run).first()
    n_docs = TC.document_counts(docs).count()
    assert (rep.n_train, rep.n_test) == (run.train.count(), len(p1)) and rep.n_train + rep.n_test == n_docs
    assert abs(rep.accuracy - acc) < 1e-12 and abs(rep.majority - majority) < 1e-12
    other = TC.document_counts(docs)  # another result of the same session stays readable
    run.release()
    assert other.count() == n_docs
    assert not run.train.storageLevel.useMemory and spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_class_filter_variant(spark):
    docs = B.complaints(spark, SF_SMOKE, "lang")
    lf = TC.labelled_features(TC.document_counts(docs), min_class_count=20)
    got = {r.category: r.label for r in lf.select("category", "label").distinct().collect()}
    assert set(got) == {"en", "de", "fr"} and sorted(got.values()) == [0.0, 1.0, 2.0]   # es has 13 featured documents


def test_partitions_of_the_fit(spark, tmp_path):
    spark.range(1000).repartition(6).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.option("maxPartitionBytes", 1).parquet(f"{tmp_path}/rows")
    for least, most in ((2048, 1), (300, 4), (1, rows.rdd.getNumPartitions())):
        got = TC.for_the_fit(rows, least)
        assert got.rdd.getNumPartitions() <= most and got.distinct().count() == 1000
    assert "Exchange" not in TC.for_the_fit(rows, 300)._jdf.queryExecution().executedPlan().toString()


def test_many_classes_can_be_learned(spark):
    docs = B.complaints_by_length(spark, SF_SMOKE.replace("0.001", "0.01"))
    run = TC.classify_documents(docs, max_iter=40, min_class_count=30)
    report = TC.accuracy_report(run).first()
    assert report.n_classes >= 8 and report.accuracy > report.majority
    run.release()


def test_sampled_split_in_the_pipeline(spark):
    docs = B.complaints(spark, SF_SMOKE, "lang")
    run = TC.classify_documents(docs, max_iter=20, split="sample", cache_train=False)
    train, test = ({r.doc_id for r in x.select("doc_id").collect()} for x in (run.train, run.test))
    assert not train & test and train | test == {r.doc_id for r in TC.document_counts(docs).select("doc_id").collect()}
    assert 0.55 < len(train) / len(train | test) < 0.92
    run.release()
    with pytest.raises(ValueError):
        TC.split_vectors(docs, 150, "augmented", None, 0.75, 1, split="other")
