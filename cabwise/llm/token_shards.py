"""Token sequences materialised in training order.

Documents become token ids with an end token each, and every task cuts its
stream of them into sequences of ``SEQUENCE`` tokens (a task's last one may be
shorter). Counting the sequences of each task gives every sequence an index.
A keyed Feistel network permutes the indices: it permutes the next power of
four, and walks along its cycle until it is back among the indices, so every
sequence has one slot of the training order, and every slot one sequence. The
order is known from the key alone; nothing is sorted by random numbers.

Sequences are range-partitioned by slot. A partition writes whole shards of
``PER_SHARD`` sequences with a fixed stride, so that slot ``s`` lies in shard
``s // PER_SHARD`` at a known byte. Reading resumes at any slot by a seek. A
shard file belongs to a task attempt; the manifest lists those of finished
attempts.

Sequences are written once, compressed, before they are shuffled: tasks that
run again then meet the same sequences, and texts are not tokenised twice.

Defined results: a null text is an empty one and has only its end token. Rows
that repeat an id are documents of their own; a null id is listed as null.
Empty input: no sequences, no shards. Other columns are dropped.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwise.llm.common import arrow_map, column, documents, mixed, slices, staged, text_of
from cabwise.llm.packing import END_ID, VOCABULARY, with_ends
from cabwise.llm.tokens import text_ids, vocabulary_path
from cabwise.llm.warc import open_store
from cabwise.plans.lineage import tracked_path

SEQUENCE = 2048
PER_SHARD = 2048
ROUNDS = 6
KEY = 20240
HEADER, HEADER_BYTES = "<4sIII", 16  # magic, tokens a sequence, records, shard
MAGIC = b"TOK1"


# ---------------------------------------------------------------- the permutation

def feistel(index: np.ndarray, n: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """A permutation of 0..n-1: the slots of the given indices."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mixed(np.arange(rounds, dtype=np.uint64) + np.uint64(key * 0x9E3779B97F4A7C15 % 2**64))
    out = index.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> shift, out[walking] & mask
        for k in keys:
            left, right = right, left ^ (mixed(right + k) & mask)
        out[walking] = left << shift | right
        walking = walking[out[walking] >= n]
    return out.astype(np.int64)


# ---------------------------------------------------------------- sequences

SEQUENCES = "task int, nth long, n_tokens int, doc_ids array<long>, ids binary"


def sequences(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID, size: int = SEQUENCE,
              doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(task, nth, n_tokens, doc_ids, ids): ids are 16-bit numbers, compressed."""
    path = vocabulary_path(vocabulary)

    def run(batches):
        task, nth = TaskContext.get().partitionId(), 0
        pack = zstandard.ZstdCompressor(3).compress
        rest, owners = np.zeros(0, "<u2"), [np.zeros(0, np.int64)] * 2  # tokens not cut yet; where documents end, and their ids

        def cut(ids, ends, names, last):
            """Rows of all whole sequences (of the rest too, if last), and what is left."""
            nonlocal nth
            n = -(-len(ids) // size) if last else len(ids) // size
            first = np.searchsorted(ends, np.arange(n) * size, side="right")
            final = np.minimum(np.searchsorted(ends, np.minimum(np.arange(1, n + 1) * size, len(ids)), side="left"), len(ends) - 1)
            rows = []
            for k in range(n):
                own = ids[k * size:(k + 1) * size]
                rows.append((task, nth, len(own), names[first[k]:final[k] + 1], pack(own.tobytes())))
                nth += 1
            return rows, n * size

        for batch in slices(batches):
            flat, bounds = text_ids(column(batch, "text"), path)
            ids, starts = with_ends(flat, bounds, end_id)
            if len(ids) and ids.max() > 0xFFFF:
                raise ValueError("the vocabulary has ids over 16 bits")
            ids = np.concatenate([rest, ids.astype("<u2")])
            ends = np.concatenate([owners[0], len(rest) + starts[1:]])
            names = owners[1].tolist() + column(batch, "doc_id").to_pylist()
            rows, done = cut(ids, ends, names, last=False)
            if rows:
                yield _batch(rows)
            left = np.searchsorted(ends, done, side="right")
            rest, owners = ids[done:], [ends[left:] - done, np.array(names[left:], object)]
        if len(rest):
            yield _batch(cut(rest, owners[0], owners[1].tolist(), last=True)[0])

    return arrow_map(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(text).alias("text")), run, SEQUENCES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)],
                                      names=["task", "nth", "n_tokens", "doc_ids", "ids"])


def with_slots(cut: DataFrame, key: int = KEY) -> DataFrame:
    """Adds ``slot`` to written sequences. Gathers one number for each task."""
    counts = sorted((r.task, r.n) for r in cut.groupBy("task").agg(F.count(F.lit(1)).alias("n")).collect())
    tasks = np.array([t for t, _ in counts], np.int64)
    ends = np.cumsum([n for _, n in counts], dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    known = cut.sparkSession.sparkContext.broadcast((tasks, np.concatenate([[0], ends]).astype(np.int64)))

    @F.arrow_udf("long")
    def slot(task: pa.Array, nth: pa.Array) -> pa.Array:
        tasks, starts = known.value
        index = starts[np.searchsorted(tasks, task.to_numpy())] + nth.to_numpy()
        return pa.array(feistel(index, total, key))

    return cut.withColumn("slot", slot("task", "nth"))


# ---------------------------------------------------------------- shards

MANIFEST = "shard long, file string, records int"


class TokenShards:
    """Shards below a folder, listed by a manifest (shard, file, records)."""

    def __init__(self, folder: str, manifest: DataFrame, size: int = SEQUENCE, per_shard: int = PER_SHARD):
        self.folder, self.manifest, self.size, self.per_shard = folder, manifest, size, per_shard

    def read(self, from_slot: int = 0, digest: bool = False) -> DataFrame:
        """(slot, n_tokens, ids) of all slots from one on; ids are 16-bit numbers.

        With ``digest``, ids_crc32 instead of the ids."""
        folder, size, per_shard = self.folder, self.size, self.per_shard

        def run(batches):
            store, path = open_store(folder)
            for batch in batches:
                for shard, name, records in zip(*(column(batch, c).to_pylist() for c in ("shard", "file", "records"))):
                    with store.open_input_file(f"{path}/{name}") as file:
                        for out in read_shard(file, shard, records, size, per_shard, max(0, from_slot - shard * per_shard)):
                            if digest:
                                crc = pa.array([zlib.crc32(x.as_buffer()) for x in out.column(2)], pa.int64())
                                out = pa.RecordBatch.from_arrays([out.column(0), out.column(1), crc], names=["slot", "n_tokens", "ids_crc32"])
                            yield out

        wanted = self.manifest.where(F.col("shard") >= from_slot // per_shard)
        return arrow_map(wanted.repartition("shard"), run, "slot long, n_tokens int, " + ("ids_crc32 long" if digest else "ids binary"))


def read_shard(file, shard: int, records: int, size: int, per_shard: int, first: int = 0):
    """Batches of a shard's records from the given one on, after one seek."""
    magic, tokens, n, number = struct.unpack(HEADER, file.read_at(HEADER_BYTES, 0))
    if (magic, tokens, n, number) != (MAGIC, size, records, shard):
        raise ValueError(f"shard {shard} isn't what the manifest says")
    stride = 4 + 2 * size
    for k in range(first, records, 256):
        n = min(256, records - k)
        raw = file.read_at(n * stride, HEADER_BYTES + k * stride)
        counts = [struct.unpack_from("<I", raw, i * stride)[0] for i in range(n)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k, k + n) + shard * per_shard), pa.array(counts, pa.int32()),
             pa.array([raw[i * stride + 4:i * stride + 4 + 2 * c] for i, c in enumerate(counts)], pa.binary())],
            names=["slot", "n_tokens", "ids"])


def write_shards(slotted: DataFrame, folder: str, size: int = SEQUENCE, per_shard: int = PER_SHARD) -> DataFrame:
    """Write sequences (slot, n_tokens, ids) as shards; returns the manifest."""
    def run(batches):
        store, path = open_store(folder)
        unpack = zstandard.ZstdDecompressor().decompress
        shard, held, done = None, [], []

        def close():
            name = f"shard-{shard:08d}-{uuid.uuid4().hex}.bin"
            with store.open_output_stream(f"{path}/{name}", compression=None) as out:
                out.write(struct.pack(HEADER, MAGIC, size, len(held), shard))
                for ids in held:
                    raw = unpack(ids)
                    out.write(struct.pack("<I", len(raw) // 2) + raw + bytes(2 * size - len(raw)))
            done.append((shard, name, len(held)))

        for batch in batches:
            for slot, ids in zip(column(batch, "slot").to_pylist(), column(batch, "ids").to_pylist()):
                if slot // per_shard != shard:
                    if held:
                        close()
                    shard, held = slot // per_shard, []
                held.append(ids)
        if held:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), (pa.int64(), pa.string(), pa.int32()))],
                                             names=["shard", "file", "records"])

    ranged = (slotted.select(F.floor(F.col("slot") / per_shard).alias("shard"), "slot", "ids")
              .repartitionByRange("shard").sortWithinPartitions("slot").select("slot", "ids"))
    return arrow_map(ranged, run, MANIFEST)


def materialise(docs: DataFrame, key: int = KEY, size: int = SEQUENCE, per_shard: int = PER_SHARD,
                **options) -> tuple[TokenShards, DataFrame]:
    """All documents as shards in training order, and (slot, n_tokens, doc_ids)."""
    spark = docs.sparkSession
    folder = tracked_path(spark, "token-shards")
    store, path = open_store(folder)
    store.create_dir(path, recursive=True)
    slotted = with_slots(staged(sequences(docs, size=size, **options), "sequences"), key)
    manifest = staged(write_shards(slotted, folder, size, per_shard), "shard-manifest")
    shards = TokenShards(folder, manifest, size, per_shard)
    return shards, slotted.select("slot", "n_tokens", "doc_ids")


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each sequence, read back from the shards: slot, shard, record,
    n_tokens, ids_crc32 (little-endian unsigned 16-bit ids), doc_ids."""
    shards, own = materialise(documents(spark, sf_dir))

    read = shards.read(digest=True).select(
        "slot", F.floor(F.col("slot") / PER_SHARD).alias("shard"), (F.col("slot") % PER_SHARD).alias("record"),
        F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32")
    # sizes are guessed from the small manifest here: without the hint one side would be broadcast
    return read.join(own.select("slot", "doc_ids").hint("merge"), "slot")
