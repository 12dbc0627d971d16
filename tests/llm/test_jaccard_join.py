"""The n-gram Jaccard join against its SQL and a plain join of all pairs."""

import random

import numpy as np
import plain
import pytest

import cabwise.llm.jaccard_join as J
from conftest_paths import SF_SMOKE, documents_of
from oracle_harness import compare


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def wanted(rows, size=5):
    least = plain.similar_components(rows, size)
    return sorted(((i, len(plain.shingles(t, size)), c) for (i, t), c in zip(rows, least)), key=str)


def test_query_against_sql(spark):
    got = compare(spark, SF_SMOKE, "op12", J.op12_jaccard_join, J.OP12_SQL)
    assert got["cols_match"] and got["types_match"] and got["hash_match"], got


def test_edge_rows(spark):
    assert found(J.jaccard_join(plain.edge_docs(spark))) == wanted([r[:2] for r in plain.EDGE])
    assert J.jaccard_join(plain.no_docs(spark)).count() == 0


def near_copies(n, words, edits, seed, start=0):
    """Texts made from one by ``edits`` edits each: similar to some of the others, not to all."""
    rnd = random.Random(seed)
    base = [f"b{seed}x{i}" for i in range(words)]
    rows = []
    for k in range(n):
        own = list(base)
        for _ in range(rnd.randint(0, edits)):
            own[rnd.randrange(words)] = f"e{rnd.randrange(10**9)}"
        rows.append((start + k, " ".join(own)))
    return rows


def passages(n, shared, own, seed, start):
    """Texts that have one passage in common and are otherwise their own."""
    rnd = random.Random(seed)
    common = [f"p{seed}x{i}" for i in range(shared)]
    return [(start + k, " ".join([f"o{rnd.randrange(10**9)}" for _ in range(own)] + common)) for k in range(n)]


@pytest.mark.parametrize("blocks", [None, (1 << 12, 16)])
def test_groups_of_all_sorts(spark, monkeypatch, blocks):
    if blocks:  # tiny blocks give the same links
        monkeypatch.setattr(J, "BLOCK_BYTES", blocks[0])
        monkeypatch.setattr(J, "BLOCK_ROWS", blocks[1])
    rows = (near_copies(150, 120, 6, 1) + near_copies(60, 40, 3, 2, 1000) + passages(80, 60, 60, 3, 2000)
            + passages(80, 100, 20, 4, 3000) + passages(40, 60, 2, 5, 4000) + [(9000, "one two three"), (9001, "ONE two three")])
    random.Random(9).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(J.jaccard_join(docs)) == wanted(rows)


def test_other_sizes_and_thresholds(spark):
    rows = near_copies(60, 50, 5, 7) + [(500 + i, t) for i, (_, t) in enumerate(near_copies(20, 9, 2, 8))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for size, percent in ((3, 60), (2, 90)):
        got = {(r.doc_id, r.component_id) for r in J.jaccard_join(docs, size=size, percent=percent).collect()}
        assert got == {(i, c) for (i, _), c in zip(rows, plain.similar_components(rows, size, percent))}


def test_similar_sets_share_l_tokens_of_their_prefixes():
    rnd = np.random.default_rng(1)
    tested = 0
    for _ in range(3000):
        m = int(rnd.integers(1, 60))
        x = np.unique(rnd.integers(0, 400, m))
        y = np.unique(np.concatenate([rnd.permutation(x)[:int(len(x) * rnd.uniform(0.8, 1)) or 1], rnd.integers(0, 400, int(rnd.integers(0, 8)))]))
        x, y = sorted((x, y), key=len, reverse=True)  # y is the smaller one
        both = len(np.intersect1d(x, y))
        if 100 * both < 80 * (len(x) + len(y) - both):
            continue
        tested += 1
        for ell in range(1, both + 1):
            assert len(np.intersect1d(y[:J.least(len(y), 80) + ell], x[:J.spare(len(x), 80) + ell])) >= ell
    assert tested > 500


def test_choice_lengthens_the_prefix_where_that_is_cheaper():
    # 100 tokens, 12 may be spared: ten of the first twelve are dear, few behind them are held by others
    dear = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 9], np.int32)
    ell, places = J.choose(100, dear, np.full(10, 1000), 80, 20)
    assert ell == 11 and not len(places)                       # ten tokens can't make eleven matches
    ell, places = J.choose(100, dear, np.full(10, 1000), 80, 4)
    assert ell == 4 and len(places) == 7                       # at most four: seven are looked up
    ell, places = J.choose(100, np.arange(100, dtype=np.int32), np.full(100, 2), 80, 80)
    assert ell == 1 and len(places) == 12                      # nothing is gained by a longer one


def test_match_counts():
    prefixes = [np.array([1, 5, 9], np.uint64), np.array([2, 5], np.uint64)]
    holders = [np.array([1, 2, 3, 5, 9], np.uint64), np.array([7], np.uint64), np.array([5, 9, 11], np.uint64)]
    assert J.matches(prefixes, holders).tolist() == [[3, 0, 2], [2, 0, 1]]


def test_real_documents_with_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_ROWS", 2)
    rows = [(r.doc_id, r.text) for r in documents_of(spark, "sf0.001").collect()]
    assert found(J.op12_jaccard_join(spark, SF_SMOKE)) == wanted(rows)
