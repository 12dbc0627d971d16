"""Queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cabwise.llm.chat import OP4_SQL, op4_chat
from cabwise.llm.exact_dedup import OP8_SQL, op8_exact_dedup
from cabwise.llm.fertility import op6_fertility
from cabwise.llm.filter_audit import OP13_SQL, op13_filter_audit
from cabwise.llm.jaccard_join import OP12_SQL, op12_jaccard_join
from cabwise.llm.mixing import OP1_SQL, op1_mixing
from cabwise.llm.near_dedup import OP3_SQL, op3_near_dedup
from cabwise.llm.packing import op2_packing
from cabwise.llm.ppm import op10_ppm
from cabwise.llm.substring_dedup import OP7_SQL, op7_substring_dedup
from cabwise.llm.token_shards import op5_token_shards
from cabwise.llm.warc import OP9_SQL, op9_warc
from cabwise.llm.whitening import op11_whitening
from corpus_pipeline import run as pipeline

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_packing": op2_packing,
    "op3_near_dedup": op3_near_dedup,
    "op4_chat": op4_chat,
    "op5_token_shards": op5_token_shards,
    "op6_fertility": op6_fertility,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_warc": op9_warc,
    "op10_ppm": op10_ppm,
    "op11_whitening": op11_whitening,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_filter_audit": op13_filter_audit,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {
    "op1_mixing": OP1_SQL,
    "op3_near_dedup": OP3_SQL,
    "op4_chat": OP4_SQL,
    "op7_substring_dedup": OP7_SQL,
    "op8_exact_dedup": OP8_SQL,
    "op9_warc": OP9_SQL,
    "op12_jaccard_join": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
