"""Two-pass Bloom filter over a distributed column of 64-bit hashes.

First pass: every task marks its hashes in a Bloom filter ``seen``; marking a
bit again marks it in ``twice``. The filter is cut into segments (a hash lives
in one segment), each task sends the bits of the segments it touched, and the
segments are merged in parallel: a bit that two tasks have seen is marked
twice. Second pass: a hash may be repeated only if all its bits are marked
twice. There are no false negatives, so rows that test negative are single.

``twice`` is what tasks need, and its size is bounded: the filter has
``bits_per_key`` bits for each row up to ``max_bytes`` in all. Over that bound
more rows test positive (they are then compared exactly, as every positive
row is); no result changes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabwise.llm.common import arrow_map, column, mixed

SEGMENT_BITS = 17
PROBES = 4
BITS_PER_KEY = 16
MAX_BYTES = 64 << 20


def segment_count(rows: int, bits_per_key: int = BITS_PER_KEY, max_bytes: int = MAX_BYTES) -> int:
    """A power of two."""
    wanted = max(1, rows * bits_per_key) >> SEGMENT_BITS
    most = max(1, (max_bytes * 8) >> SEGMENT_BITS)
    return 1 << min(int(wanted).bit_length(), most.bit_length() - 1)


def probes(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each hash, and its ``PROBES`` bit places there (a row each)."""
    x = mixed(hashes)
    segment = (x >> np.uint64(40)).astype(np.int64) & (segments - 1)
    y = mixed(x ^ np.uint64(0x9E3779B97F4A7C15))
    low, high = x & np.uint64(0xFFFFFFFF), y >> np.uint64(32)
    steps = np.arange(PROBES, dtype=np.uint64)
    places = (low[:, None] + steps * (high[:, None] | np.uint64(1))) & np.uint64((1 << SEGMENT_BITS) - 1)
    return segment, places.astype(np.int64)


def _task_bits(hashes: np.ndarray, segments: int) -> Iterator[tuple[int, bool, bytes]]:
    """(segment, marked twice?, sorted bit places) of one task's hashes."""
    distinct, counts = np.unique(hashes, return_counts=True)
    for twice, own in ((False, distinct), (True, distinct[counts > 1])):
        if not len(own):
            continue
        segment, places = probes(own, segments)
        marks = np.unique((segment[:, None] << SEGMENT_BITS | places).ravel())
        cuts = np.flatnonzero(np.diff(marks >> SEGMENT_BITS)) + 1
        for part in np.split(marks, cuts):
            bits = (part & ((1 << SEGMENT_BITS) - 1)).astype(np.uint32)
            yield int(part[0] >> SEGMENT_BITS), twice, zlib.compress(np.diff(bits, prepend=np.uint32(0)).tobytes(), 1)


def _merge(batches, schema: pa.Schema, repeated: bool):
    """Rows come sorted by segment: one segment's bits are held at a time."""
    current, seen, twice = None, None, None

    def done():
        bits = np.packbits(twice if repeated else seen).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([zlib.compress(bits, 1)])],
                                          schema=schema)

    for batch in batches:
        for segment, again, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if segment != current:
                if current is not None and (twice if repeated else seen).any():
                    yield done()
                current = segment
                seen, twice = np.zeros(1 << SEGMENT_BITS, bool), np.zeros(1 << SEGMENT_BITS, bool)
            bits = np.cumsum(np.frombuffer(zlib.decompress(data), np.uint32), dtype=np.int64)
            if again:
                twice[bits] = True
            else:
                twice[bits[seen[bits]]] = True
                seen[bits] = True
    if current is not None and (twice if repeated else seen).any():
        yield done()


def repeat_filter(df: DataFrame, col: str, rows: int, max_bytes: int = MAX_BYTES, raw: bool = False):
    """``maybe(column)``: false only for hashes that ``df[col]`` holds at most once.

    ``rows`` (or an estimate) sizes the filter. The broadcast filter has at
    most ``max_bytes`` bytes, whatever the input. With ``raw``, a function of
    unsigned 64-bit numpy arrays, for use inside tasks.
    """
    return _filter(df, col, rows, max_bytes, repeated=True, raw=raw)


def member_filter(df: DataFrame, col: str, rows: int, max_bytes: int = MAX_BYTES, raw: bool = False):
    """``maybe(column)``: false only for hashes that ``df[col]`` doesn't hold."""
    return _filter(df, col, rows, max_bytes, repeated=False, raw=raw)


def _filter(df: DataFrame, col: str, rows: int, max_bytes: int, repeated: bool, raw: bool = False):
    segments = segment_count(rows, max_bytes=max_bytes)
    merged = pa.schema([("segment", pa.int32()), ("bits", pa.binary())])

    def mark(batches):
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(column(batch, "h").to_numpy(zero_copy_only=False).view(np.uint64))
            if sum(map(len, held)) >= 1 << 20:
                yield from bits(np.concatenate(held))
                held.clear()
        if held:
            yield from bits(np.concatenate(held))

    def bits(hashes):
        rows = list(_task_bits(hashes, segments))
        for i in range(0, len(rows), 256):
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows[i:i + 256]), (pa.int32(), pa.bool_(), pa.binary()))],
                names=["segment", "twice", "data"])

    marks = arrow_map(df.select(F.col(col).alias("h")).where("h is not null"), mark,
                      "segment int, twice boolean, data binary")
    found = arrow_map(marks.repartition("segment").sortWithinPartitions("segment"),
                      lambda batches: _merge(batches, merged, repeated), "segment int, bits binary").collect()
    table = np.zeros((segments, (1 << SEGMENT_BITS) // 8), np.uint8)
    for row in found:
        table[row.segment] = np.frombuffer(zlib.decompress(bytes(row.bits)), np.uint8)
    shared = df.sparkSession.sparkContext.broadcast(table)

    if raw:
        return lambda hashes: test(shared.value, hashes)

    @F.arrow_udf("boolean")
    def maybe(h: pa.Array) -> pa.Array:
        known = h.is_valid().to_numpy(zero_copy_only=False)
        out = np.zeros(len(h), bool)
        out[known] = test(shared.value, h.drop_null().to_numpy().view(np.uint64))
        return pa.array(out)

    return maybe


def test(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    segment, places = probes(hashes, len(table))
    found = table[segment[:, None], places >> 3] >> (7 - (places & 7)).astype(np.uint8) & 1
    return found.all(axis=1)
