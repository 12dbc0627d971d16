"""Chat formatting by compiled templates.

Conversations (rows by turn) are rendered by a template of
:mod:`cabwise.llm.template`, whose ``generation`` blocks become the loss mask.
Control strings inside texts are broken up by a reversible escape, so that
only the template's own marks can be read as marks. The formatted text is read
back into roles and texts by those marks.

Rows are placed by conversation and sorted by turn; a conversation streams
through its task, turn by turn, in pieces of about ``PIECE`` code points that
end with a turn: neither its turns nor its text are ever held whole.

Defined results: a null text or role is empty. A null conversation id is a
conversation of its own. Turns are ordered by number (null first), then role
and text. Repeated rows are turns of their own. Empty input: empty result.
Other columns are dropped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwise.llm.common import NULL_ID, arrow_map, column, id_key, text_of
from cabwise.llm.template import Output, compiled

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that mean something to a model or its tokenizer. Fixed values.
CONTROL = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TEMPLATE = (
    "{% for message in messages %}"
    "{{ '<|im_start|>' + (message.role | line) + '\\n' }}"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}"
    "{{ '<|im_end|>' + '\\n' }}"
    "{% endfor %}")
PIECE = 1 << 16

_CONTROL = re.compile("|".join(f"(?<={re.escape(x[0])})(?={re.escape(x[1:])})" for x in CONTROL))
_ESCAPED = re.compile(r"\\([\\n.])")
_PLAIN = {"\\": "\\", "n": "\n", ".": ""}
_TURN = re.compile(f"{re.escape(START)}([^\\n]*)\\n(.*?){re.escape(END)}\\n", re.S)


def escape(text: str) -> str:
    """Backslashes are doubled, and ``\\.`` is put behind a control string's first character."""
    return _CONTROL.sub(r"\\.", text.replace("\\", "\\\\"))


def escape_line(text: str) -> str:
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[1]], text)


FILTERS = (("escape", escape), ("line", escape_line))

PIECES = "conv_id long, piece int, text string, marks array<struct<start:int,stop:int>>"


def format_conversations(turns: DataFrame, template: str = TEMPLATE, conv_id: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, piece, text, marks): marks are the code points under the loss mask.

    Pieces of one conversation stand one behind the other, in order."""
    compiled(template, FILTERS)  # reports errors here, not in a task

    def rows(batches) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(column(batch, c).to_pylist() for c in ("conv_id", "role", "text")))

    def run(batches):
        ready = compiled(template, FILTERS)
        held, size = [], 0
        for conv, own in groupby(rows(batches), key=lambda r: r[0]):
            messages = ({"role": r, "text": t} for _, r, t in own)
            out, piece = Output(), 0
            for _ in ready.run({"messages": messages}, out):
                if out.size >= PIECE:
                    size += out.size
                    held.append((conv, piece, *out.take()))
                    piece += 1
                    if size >= 4 * PIECE:
                        yield _batch(held)
                        held, size = [], 0
            size += out.size
            held.append((conv, piece, *out.take()))
            if size >= 4 * PIECE:
                yield _batch(held)
                held, size = [], 0
        if held:
            yield _batch(held)

    own = turns.select(id_key(conv_id).alias("conv_id"), F.col(f"`{turn}`").alias("turn"), text_of(role).alias("role"),
                       text_of(text).alias("text"))
    placed = own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return arrow_map(placed, run, PIECES).withColumn("conv_id", F.nullif("conv_id", F.lit(NULL_ID)))


def _batch(held: list[tuple]) -> pa.RecordBatch:
    conv, piece, text, marks = zip(*held)
    spans = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    return pa.RecordBatch.from_arrays(
        [pa.array(conv, pa.int64()), pa.array(piece, pa.int32()), pa.array(text, pa.string()),
         pa.array([[{"start": a, "stop": b} for a, b in x] for x in marks], spans)], names=["conv_id", "piece", "text", "marks"])


def turns_of(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted piece; what isn't a turn is an error."""
    out, at = [], 0
    for found in _TURN.finditer(text):
        if found.start() != at:
            raise ValueError("text between turns")
        out.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    if at != len(text):
        raise ValueError("text behind the last turn")
    return out


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of each conversation's turns and of the text under the loss mask,
    from formatted pieces as :func:`format_conversations` places them."""
    def rows(batches):
        for batch in batches:
            yield from zip(*(column(batch, c).to_pylist() for c in ("conv_id", "text", "marks")))

    def run(batches):
        out = []
        for conv, own in groupby(rows(batches), key=lambda r: r[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n = learned = size = 0
            for _, text, marks in own:
                size += len(text)
                for role, said in turns_of(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for mark in marks:
                    part = unescape(text[mark["start"]:mark["stop"]])
                    learned += len(part)
                    loss.update(part.encode())
            out.append((conv, n, turns.hexdigest(), learned, loss.hexdigest(), size))
            if len(out) >= 5000:
                yield _digests(out)
                out = []
        if out:
            yield _digests(out)

    return arrow_map(pieces, run, DIGESTS)


def _digests(out: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)],
                                      names=[x.split()[0] for x in DIGESTS.split(", ")])


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                   F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                   F.lit("</s>[INST] ok [/INST]").alias("text"))
    return read_back(format_conversations(turns.unionByName(tricky)))


def _escaped_points(x: str) -> str:
    """SQL of the code points that a text has once escaped."""
    marks = "|".join(re.escape(c).replace("/", "\\/") for c in CONTROL).replace("'", "''")
    return f"length({x}) + length({x}) - length(replace({x}, chr(92), '')) + 2 * len(regexp_extract_all({x}, '{marks}'))"


OP4_SQL = f"""
WITH t AS (
  SELECT coalesce(conv_id, {NULL_ID}) AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
c AS (SELECT conv_id, count(*) AS n_turns,
             string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
             coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
             sum({len(START) + len(END) + 2} + {_escaped_points('role')} + length(role) - length(replace(role, chr(10), ''))
                 + {_escaped_points('text')}) AS formatted
      FROM t GROUP BY conv_id)
SELECT nullif(conv_id, {NULL_ID}) AS conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted AS BIGINT) AS formatted_chars
FROM c"""
