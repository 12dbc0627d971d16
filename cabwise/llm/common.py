"""Helpers shared by the operators: words of Arrow texts, staged tables, keys.

A *word* is a maximal run of characters outside ``[\\x20\\x09-\\x0D]``; Arrow's
ASCII white-space split has exactly this class. Every helper treats a null
text as an empty one.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwise.plans.lineage import tracked_path

SPACES = " \t\n\x0b\x0c\r"
#: Bytes of text that a task works on at once; a longer single text is one slice.
SLICE_BYTES = 4 << 20
NULL_ID = (1 << 63) - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    ``cabwise.plans.lineage.release_staged`` deletes what is written here.
    """
    path = tracked_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()
#: Spark's own default bound of an Arrow batch, and the one used for texts in its place.
ARROW_BYTES, SPARK_DEFAULT, SMALLER = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Rows hold whole texts and sets, so Arrow batches are kept small (a batch is
    held several times over between JVM and Python), unless the session has a
    bound of its own."""
    if spark.conf.get(ARROW_BYTES, SPARK_DEFAULT) == SPARK_DEFAULT:
        spark.conf.set(ARROW_BYTES, SMALLER)
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="cabwise-code-"), "cabwise_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def give_back() -> None:
    """Return freed memory to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def arrow_map(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package on the executors' path."""
    ship_code(df.sparkSession)

    def run(batches):
        yield from fn(batches)
        give_back()

    return df.mapInArrow(run, schema)


def id_key(col: str = "doc_id") -> Column:
    """Ids as longs; null sorts after every id."""
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID))


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of one slice hold ``limit`` bytes or one row."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(column(batch, text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


class Words:
    """The words of a slice of texts.

    ``offsets[i]:offsets[i+1]`` are the places of row i's words in ``codes``;
    ``codes`` index ``vocabulary``, the slice's distinct words.
    """

    def __init__(self, texts: pa.Array, lower: bool = False, pattern: str | None = None):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        parts = pc.split_pattern(texts, pattern) if pattern else pc.ascii_split_whitespace(texts)
        flat, bounds = parts.values, parts.offsets.to_numpy()
        filled = pc.greater(pc.binary_length(flat), 0)
        before = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
        self.offsets = before[bounds].astype(np.int64)
        coded = flat.filter(filled).dictionary_encode()
        self.codes = coded.indices.to_numpy()
        self.vocabulary = coded.dictionary
        if lower:  # of the distinct words only; Arrow's kernel errs on sliced texts
            same = pc.ascii_lower(self.vocabulary).dictionary_encode()
            self.codes = same.indices.to_numpy()[self.codes]
            self.vocabulary = same.dictionary

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash for each distinct word."""
        return hash_strings(self.vocabulary)

    def word_bytes(self) -> np.ndarray:
        return pc.binary_length(self.vocabulary).to_numpy(zero_copy_only=False)

    def word_points(self) -> np.ndarray:
        return pc.utf8_length(self.vocabulary).to_numpy(zero_copy_only=False)


def hash_strings(values: pa.Array) -> np.ndarray:
    raw = values.cast(pa.large_binary()).to_pylist()
    return np.fromiter((xxhash.xxh3_64_intdigest(x) for x in raw), dtype=np.uint64, count=len(raw))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (murmur's public constants)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values[offsets[i]:offsets[i+1]]`` for each i, empty rows too."""
    total = np.concatenate([np.zeros(1, dtype=values.dtype if values.dtype != bool else np.int64),
                            np.cumsum(values, dtype=None if values.dtype != bool else np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def as_longs(x: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values in a signed long column."""
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def binary_rows(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows ``data[offsets[i]:offsets[i+1]]`` as a binary column."""
    data = np.ascontiguousarray(data)
    ends = offsets.astype(np.int64) * data.itemsize
    if len(ends) and ends[-1] > 2**31 - 1:
        raise ValueError("a slice's binary column is over 2 GB")
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of equal keys from batches that come sorted by them, one at a time.

    For groups of bounded size: a group is held whole."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [column(batch, k).to_numpy(zero_copy_only=False) for k in keys]
        changes = np.zeros(batch.num_rows - 1, bool)
        for x in values:
            changes |= x[1:] != x[:-1]
        cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
        first = tuple(x[0] for x in values)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        for start, stop in zip(cuts[:-1], cuts[1:]):
            if start:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
        last = tuple(x[-1] for x in values)
    if held:
        yield pa.Table.from_batches(held)
