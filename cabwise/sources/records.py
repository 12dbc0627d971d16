"""Raw complaint lines → validated records.

A line is a record when it splits on ',' into exactly three fields (CSV
quoting is deliberately not honoured, as in the reference), the date field
starts with ``201`` and the text has a non-blank character.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cabwise.functions.text import has_non_blank
from cabwise.plans.lineage import staged
from cabwise.sources.files import split_fields

# Fixed value: a record's date field must start with this text.
DATE_PREFIX = "201"


def line_fields(lines: DataFrame, col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """(value, n_fields, date, category, text): positional fields, null when absent.
    Columns named in ``keep`` are carried along in front."""
    f = F.col("fields")
    return (split_fields(lines, ",", col)
            .select(*keep, F.col(col).alias("value"), F.size(f).alias("n_fields"),
                    F.get(f, 0).alias("date"), F.get(f, 1).alias("category"),
                    F.get(f, 2).alias("text")))


def record_is_valid():
    return ((F.col("n_fields") == 3)
            & F.col("date").startswith(DATE_PREFIX)
            & has_non_blank("text"))


def valid_records(lines: DataFrame, col: str = "value") -> DataFrame:
    """(date, category, text) of valid lines; text lower-cased."""
    return (line_fields(lines, col).where(record_is_valid())
            .select("date", "category", F.lower("text").alias("text")))


def complaints_from_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Raw lines → (doc_id, date, category, text) of valid records.

    ``doc_id`` is a hash of the line and of its number among equal lines, so
    it doesn't depend on the file split or the cluster. Equal lines are counted
    by partial aggregation (a line that makes up a third of the input is one
    row a task) and numbered by expanding the count.
    """
    fields = line_fields(lines, col).where(record_is_valid())
    numbered = (fields.groupBy("value", "date", "category", F.lower("text").alias("text"))
                .agg(F.count(F.lit(1)).alias("copies"))
                .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))
    return numbered.select(F.xxhash64("value", "copy").alias("doc_id"), "date", "category", "text")


def numbered_records(spark: SparkSession, path: str) -> DataFrame:
    """Text files → (number, digest, date, category, text) of valid records.

    ``number`` counts the valid lines from 0 in the order of the files' names and
    of the lines in them, whatever the splits. The records are written once;
    a record's place in what its scan task wrote is known to the reader
    (``_metadata.row_index``), so that only one row a split of the input (its
    first place and its count) is gathered: the running sum over these gives
    each split its offset. No text is in an exchange. ``digest`` (md5 of the
    line) tells records apart by content: equal lines have equal ones.
    """
    lines = spark.read.text(path).select(
        F.xxhash64("_metadata.file_path", "_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    records = line_fields(lines, keep=("split", "file", "block")).where(record_is_valid()).select(
        "split", "file", "block", F.md5("value").alias("digest"), "date", "category", F.lower("text").alias("text"))
    table = staged(records, "records").withColumn("place", F.col("_metadata.row_index"))
    splits = table.groupBy("split", "file", "block").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)  # one row a split
    shifts = splits.select("split", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return table.join(F.broadcast(shifts), "split").select(  # 16 bytes for each split of the input, not for its rows
        (F.col("place") + F.col("shift")).alias("number"), "digest", "date", "category", "text")
