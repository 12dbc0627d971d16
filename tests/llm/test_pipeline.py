"""The pipeline against plain versions of its stages, and the registry."""

import collections

import duckdb
import plain
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from cabwise.llm import fertility
from cabwise.llm.mixing import OP1_SQL
from conftest_paths import SF_SMOKE, documents_of


def plain_pipeline(spark, sf):
    kept = {r.doc_id for r in fertility.quality_metrics(documents_of(spark, sf)).where("kept").collect()}
    rows = [r for r in documents_of(spark, sf).collect() if r.doc_id in kept]
    groups = collections.defaultdict(list)
    for r in rows:
        groups["".join(plain.WORD.findall(r.text or ""))].append(r)
    rows = [min(g, key=lambda r: (-len(r.text or ""), r.doc_id)) for g in groups.values()]
    least = plain.similar_components([(r.doc_id, r.text) for r in rows], 5)
    rows = [r for r, c in zip(rows, least) if r.doc_id == c]
    import pyarrow as pa
    documents = pa.table({c: [r[c] for r in rows] for c in ("doc_id", "text", "source")})  # noqa: F841
    con = duckdb.connect()
    con.register("documents", documents)
    taken = {d: t // s for d, s, t in con.execute(f"SELECT doc_id, size, taken FROM ({OP1_SQL})").fetchall() if s}
    return [(r.doc_id, r.text) for r in rows for _ in range(taken.get(r.doc_id, 0))]


def test_pipeline_against_plain_stages(spark):
    got = corpus_pipeline.run(spark, SF_SMOKE).collect()
    want = plain.pieces(plain_pipeline(spark, "sf0.001"))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    plain.check_packing([(r.length, r.sequence_id, r.offset) for r in got])


def test_stages_carry_the_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "mixing", "packing"]
    docs = plain.edge_docs(spark).withColumn("mix", F.lit("mix"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMOKE)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.count()


def test_pipeline_on_edge_rows_and_on_none(spark, tmp_path):
    real = documents_of(spark, "sf0.001").select((F.col("doc_id") + 10_000).alias("doc_id"), "text", "lang", "source")
    docs = plain.edge_docs(spark).unionByName(real.withColumns({c: F.lit(c) for c in plain.EXTRA})).withColumn("mix", F.lit(1))
    docs.write.parquet(f"{tmp_path}/edge/documents.parquet")
    plain.no_docs(spark).write.parquet(f"{tmp_path}/none/documents.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/edge").collect()
    plain.check_packing([(r.length, r.sequence_id, r.offset) for r in got])
    clean = {r.doc_id for r in fertility.quality_metrics(docs).where("kept").collect()}
    assert got and {r.doc_id for r in got} <= clean and 1 not in clean and 3 not in clean
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_registry():
    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= names
