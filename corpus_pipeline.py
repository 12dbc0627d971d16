"""The training-data pipeline: quality rules, exact and near duplicates, mixing, packing.

Every stage gets all rows that its predecessor kept. Its result is written as
Parquet to the shared folder and read again by the next one, so that a lost
executor costs a re-read of one stage.

Defined results: a null text is an empty one; it fails the quality rules, as does
any text of less than 50 words. A null id sorts after all ids, a null source is a
source of its own. Texts are read whole, however long. Of equal texts the
longest original with the least id stays, of near copies the least id; rows that
repeat an id are looked at one by one. Other columns, whatever their names, are
carried along up to the last stage. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cabwise.llm.common import documents, staged
from cabwise.llm.exact_dedup import keep_distinct
from cabwise.llm.fertility import keep_clean
from cabwise.llm.mixing import copies_of, emit
from cabwise.llm.near_dedup import keep_one_of_each
from cabwise.llm.packing import pack_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fertility bands and base rules accept."""
    return keep_clean(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return keep_distinct(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five words, similarity 0.8)."""
    return keep_one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    out = "mix"
    while out in map(str.lower, docs.columns):  # a column of the documents may have this name
        out += "_"
    return emit(copies_of(docs, out=out), out)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in the token sequences."""
    return pack_documents(docs)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("mixing", mixing), ("packing", packing)]

#: Tokenisers and Bayesian verification have no SQL form; tests/llm has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
