"""The filter audit against its SQL, and its state against a plain count when smaller ids come later."""

import collections

import plain
from pyspark.sql import functions as F

import cabwise.llm.filter_audit as FA
from conftest_paths import SF_SMOKE
from oracle_harness import compare


def plain_counters(rows, labels):
    """{(part, mask, good, toxic): n} of rows (id, text, part)."""
    key = lambda i: float("inf") if i is None else i
    least, out = {}, collections.Counter()
    for i, text, _ in rows:
        least[text or ""] = min(least.get(text or "", float("inf")), key(i))
    for i, text, part in rows:
        text = text or ""
        words = plain.WORD.findall(text)
        fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words),
                 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), any(c in "#$%&*|" for c in text), key(i) > least[text]]
        good, toxic = (max((int(x[k] == 1) for x in labels if x[0] == i and i is not None), default=0) for k in (1, 2))
        out[part or "", sum(f << k for k, f in enumerate(fails)), good, toxic] += 1
    return dict(out)


def counted(df):
    return {(r.part, r["mask"], r.good, r.toxic): r.n for r in df.collect()}


def test_query_against_sql(spark):
    got = compare(spark, SF_SMOKE, "op13", FA.op13_filter_audit, FA.OP13_SQL)
    assert got["cols_match"] and got["types_match"] and got["hash_match"], got


def test_edge_rows_and_later_smaller_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(FA, "SETTLE_ROWS", 4)
    rows = [r[:3] for r in plain.EDGE]
    rows += [(5000 - i, "copied " * (3 + i % 2), ("en", "de", None)[i % 3]) for i in range(60)]   # ids fall: every file retracts
    rows += [(4000, "copied " * 3, "fr"), (4000, "copied " * 3, "fr"), (None, "copied " * 4, "fr")]
    labels = [(4999, 1, 0), (5000, 1, 1), (4941, 1, 0), (4941, 0, 1), (4000, 1, None), (None, 1, 1), (77, 1, 1)]
    path = f"{tmp_path}/documents.parquet"
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.lit(c) for c in ("key", "id", "mask", "part", "good", "n")})
    for start in range(0, docs.count(), 20):  # files in the order of the rows
        spark.createDataFrame(docs.collect()[start:start + 20], docs.schema).coalesce(1).write.mode("append").parquet(path)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = plain_counters(rows, labels)
    for batches, digits in ((1, None), (3, 1), (100, 2)):
        assert counted(FA.part_counters(spark, path, table, batches=batches, digits=digits)) == want
    audit = FA.filter_audit(spark, path, table).collect()
    parts = {p for p, *_ in want}
    assert len(audit) == 600 * len(parts) and {r.part for r in audit} == parts
    for r in audit[::37]:
        at, before = FA.LETTERS.index(r.filter_order[r.step - 1]), {FA.LETTERS.index(x) for x in r.filter_order[:r.step - 1]}
        own = [(m, n) for (p, m, *_), n in want.items() if p == r.part]
        earlier = lambda m: any(m >> i & 1 for i in before)
        assert r.removed == sum(n for m, n in own if m >> at & 1 and not earlier(m))
        assert r.redundant == sum(n for m, n in own if m >> at & 1 and earlier(m))
        assert r.kept == sum(n for m, n in own if not m >> at & 1 and not earlier(m))
        assert r.unique_fails == sum(n for m, n in own if m == 1 << at)


def test_a_later_run_reads_new_files_only(spark, tmp_path):
    path, folder = f"{tmp_path}/documents.parquet", f"{tmp_path}/audit"
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    first = [(10 + i, f"text {i % 4}", "en") for i in range(12)]
    second = [(i, f"text {i % 4}", "de") for i in range(6)]                     # smaller ids, in another part
    schema = "doc_id long, text string, lang string"
    spark.createDataFrame(first, schema).write.parquet(path)
    assert counted(FA.part_counters(spark, path, labels, folder=folder, digits=1)) == plain_counters(first, [])
    spark.createDataFrame(second, schema).write.mode("append").parquet(path)
    assert counted(FA.part_counters(spark, path, labels, folder=folder, digits=1)) == plain_counters(first + second, [])


def test_no_rows(spark, tmp_path):
    plain.no_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert FA.filter_audit(spark, f"{tmp_path}/documents.parquet", labels).count() == 0
