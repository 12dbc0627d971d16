"""Tokens, lexicon, idf/tf and class/split operators on micro-fixtures,
checked against plain-Python computations of the same definitions."""
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cabwise.functions.text import NON_LETTERS, NON_LETTERS_OR_SPACE, STOPWORDS
from cabwise.operators import classify as C, lexicon as LX, tfidf as TF
from cabwise.sources import records as R

DOCS = [
    (1, "a", "The cat  sat on the mat. Paid paid paid."),
    (2, "a", "Don't pay the cat; cat paid."),
    (3, "b", "ÉCOLE école mat mat mat dog"),
    (4, "b", "dog dog cat sat"),
    (5, "c", "here is the xxxx"),            # stopwords only: no lexicon word
    (6, "c", "dog dog cat sat"),            # same text as 4 (another id)
]


def _docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, category string, text string")


def _py_counts():
    c = Counter()
    for _, _, text in DOCS:
        for tok in text.lower().split(" "):
            w = re.sub("[^a-zA-Z]+", "", tok)
            if w.lower() not in set(STOPWORDS):
                c[w] += 1
    return c


def test_token_counts_match_python(spark):
    got = {r.word: r.n for r in LX.token_counts(_docs(spark)).collect()}
    assert got == dict(_py_counts())
    assert "" not in got and "the" not in got
    assert got["dont"] == 1          # apostrophe removed before the stopword test
    assert got["cole"] == 2          # accented letters are dropped, leaving fragments


def test_lexicon_order_and_ties(spark):
    lex = LX.lexicon_topk(_docs(spark), k=4).orderBy("word_idx").collect()
    py = sorted(_py_counts().items(), key=lambda kv: (-kv[1], kv[0]))[:4]
    assert [(r.word, r.n) for r in lex] == py
    assert [r.word_idx for r in lex] == [0, 1, 2, 3]


def test_matched_tokens_are_raw(spark):
    docs = _docs(spark)
    lex = LX.lexicon_topk(docs, k=150)
    m = LX.matched_tokens(docs, lex)
    words_doc1 = sorted(r.word for r in m.where("doc_id = 1").collect())
    # "mat." and "paid." are not matched as they are; "cat", "sat", "paid" (twice) are
    assert words_doc1 == ["cat", "paid", "paid", "sat"]
    cleaned = LX.matched_tokens(docs, lex, clean_docs=True)
    assert sorted(r.word for r in cleaned.where("doc_id = 1").collect()) == \
        ["cat", "mat", "paid", "paid", "paid", "sat"]
    # a document without any lexicon word is absent
    assert m.where("doc_id = 5").count() == 0


def _python_tfidf(spark, weighting):
    docs = _docs(spark)
    lex = {r.word: r.word_idx for r in LX.lexicon_topk(docs, k=150).collect()}
    per_doc = {}
    for did, _, text in DOCS:
        toks = [t for t in text.lower().split(" ") if t in lex]
        if toks:
            per_doc[did] = Counter(lex[t] for t in toks)
    n = len(per_doc)
    df = Counter(i for c in per_doc.values() for i in c)
    out = {}
    for did, c in per_doc.items():
        mx, total = max(c.values()), sum(c.values())
        for i, cnt in c.items():
            tf = 0.5 + 0.5 * cnt / mx if weighting == "augmented" else cnt / total
            out[(did, i)] = tf * math.log(n / df[i])
    return out


def _counts(docs, k=150):
    return LX.lexicon_counts(docs, LX.lexicon_words(LX.lexicon_topk(docs, k)))


def _weights(counts, k=150, weighting="augmented"):
    return TF.feature_arrays(counts, TF.inverse_document_frequency(counts), k, weighting)


@pytest.mark.parametrize("weighting", ["augmented", "relative"])
def test_tfidf_matches_python(spark, weighting):
    counts = _counts(_docs(spark))
    got = {(r.doc_id, r.word_idx): r.weight for r in TF.long_weights(_weights(counts, weighting=weighting)).collect()}
    exp = _python_tfidf(spark, weighting)
    assert set(got) == set(exp)
    for k, v in exp.items():
        assert got[k] == pytest.approx(v, abs=1e-12)


def test_counts_in_the_row_equal_exploded_tokens(spark):
    docs = _docs(spark)
    for clean in (False, True):
        lex = LX.lexicon_topk(docs, k=150)
        long = LX.matched_tokens(docs, lex, clean_docs=clean).groupBy("doc_id", "category", "word_idx").agg(F.count(F.lit(1)).alias("cnt"))
        rowwise = TF.long_counts(LX.lexicon_counts(docs, LX.lexicon_words(lex), clean_docs=clean))
        assert sorted(map(tuple, long.collect())) == sorted(map(tuple, rowwise.collect()))
    nulls = spark.createDataFrame([(1, "a", None), (2, "a", "")], "doc_id long, category string, text string")
    assert LX.lexicon_counts(nulls, ["cat"]).count() == 0 and LX.lexicon_counts(docs, []).count() == 0


def test_word_in_every_document_has_zero_idf(spark):
    rows = [(1, "a", "cat dog"), (2, "a", "cat"), (3, "b", "cat cat")]
    docs = spark.createDataFrame(rows, "doc_id long, category string, text string")
    idf = {r.word_idx: r for r in TF.inverse_document_frequency(_counts(docs, 10)).collect()}
    lex = {r.word: r.word_idx for r in LX.lexicon_topk(docs, k=10).collect()}
    assert idf[lex["cat"]].idf == 0.0
    assert idf[lex["dog"]].idf == pytest.approx(math.log(3))
    assert idf[lex["cat"]].n_docs == 3


def test_sparse_vectors(spark):
    from cabwise.plans.lineage import staged
    arr = _weights(_counts(_docs(spark)))
    pairs = {r.doc_id: [(p.word_idx, p.weight) for p in r.features] for r in arr.collect()}
    assert all(x == sorted(x) for x in pairs.values())
    table = TF.sparse_layout(arr, 150)
    vectors = {r.doc_id: r.features for r in staged(table, "vectors", TF.vector_schema(table)).collect()}
    for doc, v in vectors.items():
        assert type(v).__name__ == "SparseVector" and v.size == 150
        assert list(zip(v.indices.tolist(), v.values.tolist())) == pairs[doc]


def test_valid_records_rule(spark):
    lines = ["2015-01-02,Mortgage,Some text", "2015-01-02,Mortgage,text, with comma",
             "2015-01-02,Mortgage,", "2015-01-02,Mortgage,   ", "2009-01-01,Mortgage,old",
             "2015-01-02,Mortgage", "2015-01-02,Loan,Trailing,", "2016-05-05,Card,UPPER Case"]
    df = spark.createDataFrame([(l,) for l in lines], "value string")
    got = [tuple(r) for r in R.valid_records(df).collect()]
    assert got == [("2015-01-02", "Mortgage", "some text"), ("2016-05-05", "Card", "upper case")]


def test_frequent_classes_strict(spark):
    rows = [(i, c) for i, c in enumerate(["a"] * 3 + ["b"] * 2 + ["c"])]
    df = spark.createDataFrame(rows, "doc_id long, category string")
    assert {r.category for r in C.frequent_classes(df, 2).collect()} == {"a"}
    assert {r.doc_id for r in C.frequent_class_docs(df, 2).collect()} == {0, 1, 2}


def test_label_index_frequency_then_alphabetical(spark):
    rows = [(i, c) for i, c in enumerate(["b"] * 2 + ["a"] * 2 + ["z"] * 3 + ["c"])]
    df = spark.createDataFrame(rows, "doc_id long, category string")
    out, model = C.index_labels(df)
    assert list(model.labels) == ["z", "a", "b", "c"]
    lazy = {r.category: r.label for r in C.with_labels(df).collect()}
    assert lazy == {"z": 0.0, "a": 1.0, "b": 2.0, "c": 3.0}
    assert {r.category: r.label for r in out.collect()} == {"z": 0.0, "a": 1.0, "b": 2.0, "c": 3.0}


def test_split_is_a_partition_and_deterministic(spark):
    df = spark.range(0, 2000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("double").alias("label"))
    train, test = C.holdout_split(df, {0.0: 0.75, 1.0: 0.75}, seed=1234)
    tr = {r.doc_id for r in train.collect()}
    te = {r.doc_id for r in test.collect()}
    assert tr | te == set(range(2000)) and not tr & te
    # label 2.0 is absent from the map: never sampled into train
    assert all(i % 3 != 2 for i in tr)
    share = len([i for i in tr if i % 3 == 0]) / len([i for i in range(2000) if i % 3 == 0])
    assert 0.68 < share < 0.82
    train2, _ = C.holdout_split(df, {0.0: 0.75, 1.0: 0.75}, seed=1234)
    assert {r.doc_id for r in train2.collect()} == tr


def test_duplicates_kept_by_split_removed_by_except(spark):
    rows = [(1, "x", 0.0), (2, "x", 0.0), (3, "y", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, features string, label double")
    train, test = C.holdout_split(df, 0.0)      # nothing in train
    assert test.count() == 3                      # both identical documents kept
    left = C.except_distinct(df.select("features", "label"), train.select("features", "label"))
    assert left.count() == 2                      # EXCEPT DISTINCT keeps one of them


def test_except_distinct_is_null_safe(spark):
    all_rows = spark.createDataFrame([(1, None), (1, None), (2, "x"), (None, "y"), (3, "z")], "a int, b string")
    train = spark.createDataFrame([(1, None), (3, "z"), (9, "q")], "a int, b string")
    assert sorted(map(str, map(tuple, C.except_distinct(all_rows, train).collect()))) == sorted(map(str, [(2, "x"), (None, "y")]))


def test_sample_by_label_repeatable_on_a_written_table(spark):
    from cabwise.plans.lineage import staged
    df = staged(spark.range(0, 3000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 3).cast("double").alias("label")), "sample")
    fractions = {0.0: 0.75, 1.0: 0.75}
    a = {r.doc_id for r in C.sample_by_label(df, fractions, seed=1234).collect()}
    train, test = C.sampled_split(df, fractions, seed=1234)
    assert a == {r.doc_id for r in train.collect()}
    assert {r.doc_id for r in test.collect()} == set(range(3000)) - a
    assert all(i % 3 != 2 for i in a)                     # label 2.0 not in the map
    assert 0.7 < len([i for i in a if i % 3 == 0]) / 1000 < 0.8


def test_cleaning_pattern_lists_its_letters():
    """A class of ranges takes Java some eight times as long over a text as one of single letters."""
    for listed, ranges in ((NON_LETTERS, "[^a-zA-Z]+"), (NON_LETTERS_OR_SPACE, "[^a-zA-Z ]+")):
        assert "a-z" not in listed
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x11000)]))
        assert re.sub(listed, "", every) == re.sub(ranges, "", every)


def test_words_are_counted_once_a_document(spark):
    docs = spark.createDataFrame(DOCS + [(7, "d", None), (None, None, "dog dog"), (None, None, "dog dog")],
                                 "doc_id long, category string, text string")
    counts = LX.lexicon_counts(docs, ["dog", "cat", "mat"])
    assert counts._jdf.queryExecution().executedPlan().toString().count("split(lower(") == 1
    got = sorted(((r.doc_id or 0, r.category, {c.word_idx: c.cnt for c in r.counts}) for r in counts.collect()), key=str)
    assert got == sorted([(0, None, {0: 2}), (0, None, {0: 2}), (1, "a", {1: 1}), (2, "a", {1: 1}),
                          (3, "b", {0: 1, 2: 3}), (4, "b", {0: 2, 1: 1}), (6, "c", {0: 2, 1: 1})], key=str)
