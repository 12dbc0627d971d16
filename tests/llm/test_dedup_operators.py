"""Exact, near and substring duplicates against plain versions."""

import collections

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import cabwise.llm.near_dedup as ND
import cabwise.llm.substring_dedup as SD
from cabwise.llm.bloom import member_filter, repeat_filter, segment_count
from cabwise.llm.components import components
from cabwise.llm.exact_dedup import OP8_SQL, duplicate_classes, keep_distinct, op8_exact_dedup
from conftest_paths import SF_SMOKE, documents_of
from oracle_harness import compare


def test_op8_against_sql(spark):
    got = compare(spark, SF_SMOKE, "op8", op8_exact_dedup, OP8_SQL)
    assert got["cols_match"] and got["types_match"] and got["hash_match"], got


def test_exact_edge_rows(spark):
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in duplicate_classes(plain.edge_docs(spark)).collect()}
    assert {(1, 3, 3, False), (2, 3, 3, False), (3, 3, 3, True)} <= got          # null, empty and blank are equal
    assert {(6, 6, 3, True), (7, 6, 3, False)} <= got                            # ties: the smallest id
    assert (None, None, 2, True) in got and (4, 4, 1, True) in got               # case counts
    assert duplicate_classes(plain.no_docs(spark)).count() == 0


def test_keep_distinct_keeps_columns_and_one_of_each(spark):
    docs = plain.edge_docs(spark)
    kept = keep_distinct(docs)
    assert kept.columns == docs.columns
    ids = collections.Counter(r.doc_id for r in kept.collect())
    assert ids[None] == 1 and ids[6] == 1 and not ids[7] and not ids[1] and ids[3] == 1 and max(ids.values()) == 1
    assert keep_distinct(plain.no_docs(spark)).count() == 0


def test_bloom_has_no_false_negatives(spark):
    values = list(range(5000)) + list(range(0, 5000, 7))
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(7).withColumn("h", F.xxhash64("v"))
    maybe = repeat_filter(df, "h", len(values))
    found = {r.v for r in df.where(maybe("h")).collect()}
    assert set(range(0, 5000, 7)) <= found and len(found) < 1000
    tight = repeat_filter(df, "h", len(values), max_bytes=1 << 14)   # far too small: more pass, none are lost
    assert set(range(0, 5000, 7)) <= {r.v for r in df.where(tight("h")).collect()}
    member = member_filter(df.where("v < 100"), "h", 100)
    inside = {r.v for r in df.where(member("h")).collect()}
    assert set(range(100)) <= inside and len(inside) < 300
    assert segment_count(10**12) * (1 << 14) <= 64 << 20


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates_against_all_pairs(spark, size):
    docs = documents_of(spark, "sf0.001")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {doc: c for (doc, _), c in zip(rows, plain.similar_components(rows, size))}
    got = {r.doc_id: r for r in ND.near_duplicates(docs, size=size).collect()}
    assert {d: r.component_id for d, r in got.items()} == want
    assert all(r.kept == (d == r.component_id) and r.n_shingles == len(plain.shingles(dict(rows)[d], size)) for d, r in got.items())
    kept = ND.keep_one_of_each(docs, size=size)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, c in want.items() if d == c)


def near_family(n=60):
    """Texts of which neighbours are similar and distant ones aren't, and one unlike text."""
    base = [f"w{i}" for i in range(300)]
    out = []
    for k in range(n):
        words = list(base)
        for j in range(k):
            words[(j * 5) % 300] = f"x{j}"
        out.append((k, " ".join(words), "en", "a"))
    return out + [(n, " ".join(f"z{i}" for i in range(100)), "en", "a")]


def test_chains_and_small_blocks(spark, monkeypatch):
    """A chain of near copies whose ends are unlike: links come from the block comparison."""
    monkeypatch.setattr(ND, "BLOCK", 8)
    rows = near_family()
    got = {r.doc_id: r.component_id for r in ND.near_duplicates(spark.createDataFrame(rows, plain.SCHEMA)).collect()}
    want = plain.similar_components([(r[0], r[1]) for r in rows], 4)
    assert [got[r[0]] for r in rows] == want


@pytest.mark.parametrize("bits", [1, 8])
def test_sets_that_share_a_class_number(spark, monkeypatch, bits):
    """With so few bits many different sets meet; they are told apart by the digest's other half."""
    monkeypatch.setattr(ND, "CLASS_BITS", bits)
    docs = documents_of(spark, "sf0.001")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {doc: c for (doc, _), c in zip(rows, plain.similar_components(rows, 4))}
    got = {r.doc_id: r.component_id for r in ND.near_duplicates(docs).collect()}
    assert got == want
    kept = ND.keep_one_of_each(docs, size=4)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, c in want.items() if d == c)


def test_near_edge_rows(spark):
    got = collections.defaultdict(list)
    for r in ND.near_duplicates(plain.edge_docs(spark)).collect():
        got[r.doc_id].append((r.n_shingles, r.component_id, r.kept))
    assert got[1] == got[2].__class__([(0, 1, True)]) and got[2] == [(0, 2, True)] and got[3] == [(0, 3, True)]
    assert got[4] == [(1, 4, True)] and got[5] == [(1, 4, False)]
    assert got[7] == [(1, 6, False)] * 2 and got[9][0][1] == 8 and got[None][0][1] is None
    assert ND.near_duplicates(plain.no_docs(spark)).count() == 0
    kept = ND.keep_one_of_each(plain.edge_docs(spark), size=4)
    assert kept.columns == plain.edge_docs(spark).columns
    assert not {5, 7, 9} & {r.doc_id for r in kept.collect()}


def test_bayesian_bounds():
    least = ND.least_matches(80, 1e-6)
    assert list(least) == sorted(least) and least[0] >= 1 and least[-1] < 0.8 * ND.HASHES
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**32, (2000, ND.HASHES), dtype=np.uint32)
    b = np.where(rng.random(a.shape) < 0.8, a, a + 1)      # pairs of similarity 0.8
    assert len(ND.may_be_similar(a, b, 80)[0]) == 2000
    assert len(ND.may_be_similar(a, np.roll(a, 1, axis=0), 80)[0]) == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 102), (101, 102), (7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_shingle_sets_of_sliced_arrays():
    texts = pa.array(["x", "A b  c\nd e", None, "a B c d e", "one two", "é È"])
    sets = [set(x.tolist()) for x in ND.shingle_sets(texts.slice(1))]
    assert sets[0] == sets[2] and [len(s) for s in sets] == [2, 0, 2, 1, 1]


def window_rows():
    passage = [f"p{i}" for i in range(55)]
    filler = lambda k, n: [f"f{k}_{i}" for i in range(n)]
    rows = [(k, " ".join(filler(k, 10 + k) + passage + filler(-k - 1, 7))) for k in range(30)]
    rows += [(40, " ".join(["same"] * 130)), (41, " ".join(["same"] * 120 + filler(9, 5))), (42, " ".join(passage[:49])),
             (43, " ".join(passage[3:] + passage[:50])), (None, " ".join(passage)), (44, None), (45, "")]
    return rows + [(46, plain.LONG), (47, plain.LONG[:5000])]


@pytest.mark.parametrize("group", [2048, 3, 1])
def test_repeated_passages_against_plain(spark, monkeypatch, group):
    """Whole subtrees, and (with tiny group sizes) prefixes lengthened step by step to whole windows."""
    monkeypatch.setattr(SD, "GROUP", group)
    rows = window_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in SD.remove_repeats(docs).collect()}
    assert got == {doc: x for (doc, _), x in zip(rows, plain.without_repeats(rows))}


def test_repeated_passages_of_documents(spark):
    docs = documents_of(spark, "sf0.001")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in SD.remove_repeats(docs, digest=True).collect()}
    assert got == {doc: (n, gone, plain.sha(left)) for (doc, _), (n, gone, left) in zip(rows, plain.without_repeats(rows))}


def test_repeated_passages_edge_rows(spark):
    got = [(r.doc_id, r.n_words, r.n_removed) for r in SD.remove_repeats(plain.edge_docs(spark)).collect()]
    rows = [(d, t) for d, t, _, _ in plain.EDGE]
    key = lambda x: (x[0] is None, x)
    assert sorted(got, key=key) == sorted(((d, n, g) for (d, _), (n, g, _) in zip(rows, plain.without_repeats(rows))), key=key)
    assert SD.remove_repeats(plain.no_docs(spark)).count() == 0


def repeats_by_pairs(texts, docs, window):
    """For each word of each text, the longest common run with a text of a smaller document."""
    out = []
    for x, doc in zip(texts, docs):
        for i in range(len(x)):
            best = 0
            for y, other in zip(texts, docs):
                for j in range(len(y)) if other < doc else ():
                    n = 0
                    while i + n < len(x) and j + n < len(y) and x[i + n] == y[j + n]:
                        n += 1
                    best = max(best, n)
            out.append(best if best >= window else 0)
    return out


@pytest.mark.parametrize("seed", range(20))
def test_suffix_trees_against_pairs(seed):
    """Deep nodes give the longest repeats, and the maximal ones cover all of them."""
    rng = np.random.default_rng(seed)
    lengths, docs = rng.integers(3, 30, 8), rng.permutation(8) // 2
    words = rng.integers(0, 2 + seed % 3, lengths.sum()).astype(np.uint64)
    reach = SD.longest_repeats(words, lengths, docs, 3)
    assert reach.tolist() == repeats_by_pairs(np.split(words, np.cumsum(lengths)[:-1]), docs, 3)
    offset = np.cumsum(lengths) - lengths
    covered = np.zeros(len(words), bool)
    spans = list(zip(*(x.tolist() for x in SD.maximal_spans(reach, lengths))))
    for text, start, stop in spans:
        covered[offset[text] + start:offset[text] + stop] = True
        assert not any(t == text and a <= start and stop <= b and (a, b) != (start, stop) for t, a, b in spans)
    want = np.zeros(len(words), bool)
    for i in np.flatnonzero(reach):
        want[i:i + reach[i]] = True
    assert covered.tolist() == want.tolist()


def test_suffix_trees_of_nothing():
    none = np.zeros(0, np.int64)
    assert len(SD.longest_repeats(none.astype(np.uint64), none, none, 50)) == 0
    assert [len(x) for x in SD.maximal_spans(none, none)] == [0, 0, 0]


def test_prefixes_are_lengthened_only_where_groups_are_large(spark, monkeypatch):
    """A line of 30 words: prefixes of 40 are no longer shared; a passage of a hundred words, cut at many places: to whole windows."""
    taken = []
    real = SD.longer_prefixes
    monkeypatch.setattr(SD, "longer_prefixes", lambda pieces, window: taken.append(1) or real(pieces, window))
    monkeypatch.setattr(SD, "GROUP", 20)
    filler = lambda k, n: [f"f{k}_{i}" for i in range(n)]
    line, passage = [f"l{i}" for i in range(30)], [f"p{i}" for i in range(100)]
    for rows, rounds in (([(k, " ".join(filler(k, 60) + line + filler(-k - 1, 60))) for k in range(120)], 2),
                         ([(k, " ".join(filler(k, 3) + passage[:60 + k % 40] + filler(-k - 1, 60))) for k in range(120)], 6)):
        taken.clear()
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in SD.remove_repeats(docs).collect()}
        assert got == {doc: x for (doc, _), x in zip(rows, plain.without_repeats(rows))}
        assert 1 <= len(taken) <= rounds
