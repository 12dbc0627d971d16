"""Best-fit packing of documents into token sequences by bin completion.

Documents become token ids plus an end token; only documents longer than a
sequence are cut. What the packing needs to know is how many pieces there are
of each length: at most ``capacity`` numbers, however large the corpus. Bin
completion works on this histogram: around the longest piece left it
enumerates the undominated fillings of the space, prunes branches by the
waste that the best packing so far (first the best-fit one) still allows, and
uses a filling as often as the histogram permits. The fullest filling is found
by subset sums on the bits of a number; the first way down takes it each time. The
search isn't exhaustive: it ends after a number of steps that grows with the
number of lengths, and follows ``FILLINGS`` fillings a step. The outcome is a list of
patterns; pieces are matched to patterns by their rank among the pieces of
their length. Ranks are counted in hash buckets first, as many for each length
as its pieces ask for, so that a length that many pieces share is not ranked in one
task, and no piece moves but with the columns it has.

Defined results: a null text is an empty one, whose only token is the end.
Rows that repeat an id are pieces of their own. Empty input: empty result.
Other columns are dropped.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cabwise.llm.common import arrow_map, binary_rows, column, documents, slices, staged
from cabwise.llm.tokens import text_ids, vocabulary_path

CAPACITY = 2048
END_ID = 0
VOCABULARY = "word_bpe_49k.json"
#: Pieces of one length that are ranked in one group, about.
RANKED = 1 << 15
#: Fillings that the search may try before the best packing so far stands: at
#: least, and for each length there is (one way down uses up about one a step).
NODES = 4000
NODES_A_LENGTH = 10
FILLINGS = 4

Filling = tuple[tuple[int, int], ...]  # (length, how many), longest first


# ---------------------------------------------------------------- pieces

def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID,
           doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) for every row.

    ``ids`` are little-endian unsigned 32-bit numbers."""
    path = vocabulary_path(vocabulary)

    def cut(batches):
        for batch in slices(batches):
            flat, bounds = text_ids(column(batch, "text"), path)
            yield from _pieces_of(column(batch, "doc_id"), flat, bounds, capacity, end_id, with_ids)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return arrow_map(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                                 F.col(f"`{text}`").cast("string").alias("text")), cut, schema)


def with_ends(flat: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's ids followed by the end token."""
    n = len(bounds) - 1
    out = np.empty(len(flat) + n, "<u4")
    starts = bounds + np.arange(n + 1)
    ends = starts[1:] - 1
    rest = np.ones(len(out), bool)
    rest[ends] = False
    out[rest] = flat
    out[ends] = end_id
    return out, starts


def _pieces_of(doc_ids: pa.Array, flat, bounds, capacity: int, end_id: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    ids, starts = with_ends(flat, bounds, end_id)
    size = np.diff(starts)
    n = -(-size // capacity)
    row = np.repeat(np.arange(len(size)), n)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = piece * capacity
    length = np.minimum(capacity, size[row] - start)
    first = starts[row] + start
    raw = memoryview(ids).cast("B")
    crc = [zlib.crc32(raw[4 * a:4 * (a + k)]) for a, k in zip(first.tolist(), length.tolist())]
    columns = [doc_ids.take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
               pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if with_ids:
        columns.append(binary_rows(ids, np.append(first, starts[-1])))
        names.append("ids")
    yield pa.RecordBatch.from_arrays(columns, names=names)


# ---------------------------------------------------------------- bin completion

def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing on a histogram: each length goes where least space stays."""
    open_bins: dict[int, list[tuple[dict, int]]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            space = min((s for s in open_bins if s >= length and open_bins[s]), default=None)
            if space is None:
                each = min(capacity // length, left)
                times = left // each
                own, used = {length: each}, each
                space = capacity
            else:
                held, there = open_bins[space].pop()
                each = min(space // length, left)
                times = min(there, left // each)
                if times < there:
                    open_bins[space].append((held, there - times))
                own, used = {**held, length: each}, each
            left -= times * used
            open_bins.setdefault(space - used * length, []).append((own, times))
    return [(tuple(sorted(held.items(), reverse=True)), n) for same in open_bins.values() for held, n in same]


def least_sequences(counts: dict[int, int], capacity: int) -> int:
    """A lower bound on the sequences: pieces over half a sequence have one each, and
    the pieces from ``alpha`` to a half fit only beside those that leave ``alpha`` or more.

    The largest such bound over all ``alpha`` (Martello and Toth's second)."""
    n = np.zeros(capacity + 1, np.int64)
    n[list(counts)] = list(counts.values())
    weight = n * np.arange(capacity + 1)
    upto_n, upto_w = np.cumsum(n), np.cumsum(weight)
    half = capacity // 2
    alpha = np.arange(half + 1)
    small = upto_w[half] - upto_w[alpha] + weight[alpha]
    room = (upto_n[capacity - alpha] - upto_n[half]) * capacity - (upto_w[capacity - alpha] - upto_w[half])
    more = np.maximum(0, -(-(small - room) // capacity))
    return int((upto_n[capacity] - upto_n[half] + more).max())


def _dominated(filling: dict[int, int], slack: int, left: list[int], counts: dict[int, int]) -> bool:
    """Whether one piece left over would do better than one or two of the filling."""
    have = {x for x in left if counts[x] > filling.get(x, 0)}
    if min(have, default=slack + 1) <= slack:
        return True
    if any(x in have for a in filling for x in range(a + 1, a + slack + 1)):
        return True
    items = [a for a, n in filling.items() for _ in range(min(n, 2))]
    return any(x in have for i, a in enumerate(items) for b in items[i + 1:] for x in range(a + b, a + b + slack + 1))


def fillings(counts: dict[int, int], space: int, most: int = FILLINGS) -> list[tuple[int, dict[int, int]]]:
    """Undominated fillings of ``space`` from the histogram, least waste first.

    The sums that the pieces can reach are the bits of a number, one number after
    each length from the longest down, so the fullest filling is always found.
    Of equally full ones those come first whose least piece is longest. At most
    ``most`` are given, each with another least piece or another sum; of sums that
    leave space, the ``2 * most`` fullest are looked at.
    """
    lengths = sorted((x for x in counts if counts[x] > 0 and x <= space), reverse=True)
    if not lengths:
        return [(space, {})]
    mask = (1 << space + 1) - 1
    sums = [1]  # sums[i]: what pieces of lengths[:i] reach

    def trace(last: int, total: int) -> dict[int, int]:
        """Pieces of lengths[:last + 1] that add up to ``total``, at least one of the last length,
        and as few of the shorter ones as can be."""
        held: dict[int, int] = {}
        for i in range(last, -1, -1):
            k = int(i == last)
            while not sums[i] >> total - k * lengths[i] & 1:
                k += 1
            if k:
                held[lengths[i]] = k
                total -= k * lengths[i]
            if not total:
                break
        return held

    found: list[tuple[int, dict[int, int]]] = []
    for i, length in enumerate(lengths):
        reach, n, step = sums[-1], min(counts[length], space // length), 1
        while n:  # 1, 2, 4, ... copies: every number up to n
            take = min(step, n)
            reach |= reach << take * length & mask
            n, step = n - take, 2 * step
        if reach >> space & 1 and any(sums[-1] >> space - k * length & 1
                                      for k in range(1, min(counts[length], space // length) + 1)):
            found.append((0, trace(i, space)))
            if len(found) >= most:
                return found
        sums.append(reach)
    below = (1 << space) - 1  # the fullest sums that leave something
    for _ in range(2 * most):
        total = (sums[-1] & below).bit_length() - 1
        if total <= 0 or len(found) >= most:
            break
        held = trace(next(i for i in range(len(lengths)) if sums[i + 1] >> total & 1), total)
        if not found or not _dominated(held, space - total, lengths, counts):
            found.append((space - total, held))
        below = (1 << total) - 1
    return found


def steps(counts: dict[int, int]) -> int:
    return max(NODES, NODES_A_LENGTH * len(counts))


def bin_completion(counts: dict[int, int], capacity: int, nodes: int | None = None) -> list[tuple[Filling, int]]:
    """Patterns (filling, how often) that use up the histogram.

    Branch and bound: a branch is left when its waste is more than a packing
    with one sequence less than the best known could have, or when the pieces
    left need too many sequences by :func:`least_sequences`. The first way down
    takes the fullest filling each time.
    """
    nodes = steps(counts) if nodes is None else nodes
    left = {a: n for a, n in counts.items() if n}
    total = sum(a * n for a, n in left.items())
    bound = least_sequences(left, capacity)
    best = best_fit(counts, capacity)
    most = sum(n for _, n in best)
    if most <= bound:
        return best

    def change(filling: Filling, times: int) -> int:
        """Take a filling's pieces (or put them back, if negative): the waste of it."""
        for a, n in filling:
            now = left.get(a, 0) - times * n
            if now:
                left[a] = now
            else:
                del left[a]
        return times * (capacity - sum(a * n for a, n in filling))

    def branches(most: int) -> list[tuple[Filling, int]]:
        """Fillings around the longest piece left, the best one last."""
        longest = max(left)
        rest = {**left, longest: left[longest] - 1}
        own = []
        for _, held in fillings(rest, capacity - longest, most):
            held = {**held, longest: held.get(longest, 0) + 1}
            own.append((tuple(sorted(held.items(), reverse=True)), min(left[a] // n for a, n in held.items())))
        return own[::-1]

    path: list[tuple[Filling, int]] = []
    untried = [branches(1)]  # one list more than the path is long
    whole = [False]  # whether a list had all its fillings: they are looked up on the way back
    waste = spent = used = 0
    while untried and most > bound and spent < nodes:
        if not untried[-1] and not whole[-1]:
            untried[-1], whole[-1] = branches(FILLINGS)[:-1], True
        elif not untried[-1]:
            untried.pop(), whole.pop()
            if path:
                filling, times = path.pop()
                waste += change(filling, -times)
                used -= times
        else:
            filling, times = untried[-1].pop()
            spent += 1
            waste += change(filling, times)
            used += times
            path.append((filling, times))
            if not left and used < most:
                best, most = list(path), used
            over = (not left or waste > (most - 1) * capacity - total
                    or whole[-1] and used + least_sequences(left, capacity) >= most)
            untried.append([] if over else branches(1))
            whole.append(over)
    return best


# ---------------------------------------------------------------- placing

def _slots(patterns: list[tuple[Filling, int]], counts: dict[int, int]):
    """Slots sorted by (length, rank): from which rank on they hold, the first
    sequence, pieces a sequence, and the first piece's place in it."""
    next_rank = dict.fromkeys(counts, 0)
    slots, sequence = [], 0
    for filling, times in patterns:
        at = 0
        for length, each in filling:
            slots.append((length, next_rank[length], sequence, each, at))
            next_rank[length] += each * times
            at += length * each
        sequence += times
    assert next_rank == counts, "the patterns don't use up the pieces"
    return np.array(sorted(slots), np.int64).reshape(-1, 5)


def pack(cut: DataFrame, capacity: int = CAPACITY, nodes: int | None = None, ranked: int = RANKED) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a table of pieces.

    ``ranked``: pieces of one length that a group of the ranking has, about. ``cut``
    is read twice; write it first where it is dear to make."""
    counts = {int(r.length): int(r.n) for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    whole = counts.pop(capacity, 0)  # these need no search
    patterns = ([(((capacity, 1),), whole)] if whole else []) + bin_completion(counts, capacity, nodes)
    slots = _slots(patterns, counts | ({capacity: whole} if whole else {}))
    shared = cut.sparkSession.sparkContext.broadcast(slots)
    counts |= {capacity: whole} if whole else {}
    buckets = F.get(F.lit([-(-counts.get(a, 1) // ranked) for a in range(capacity + 1)]), F.col("length").cast("int"))
    placed = cut.withColumn("__pack_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), buckets))
    key = ["length", "__pack_bucket"]
    starts = placed.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).select(*key, (F.sum("n").over(
        Window.partitionBy("length").orderBy("__pack_bucket")) - F.col("n")).alias("__pack_before"))
    inside = Window.partitionBy(*key).orderBy("doc_id", "piece", "ids_crc32")
    with_ranks = (placed.withColumn("__pack_place", F.row_number().over(inside)).join(starts, key)
                  .withColumn("__pack_rank", F.col("__pack_before") + F.col("__pack_place") - 1)
                  .select(*cut.columns, "__pack_rank"))

    def place(batches):
        table = shared.value
        reach = int(table[:, 1].max(initial=0)) + 1
        for batch in batches:
            length = column(batch, "length").to_numpy()
            rank = column(batch, "__pack_rank").to_numpy()
            lengths = np.unique(table[:, 0])
            by = np.searchsorted(lengths, table[:, 0]) * reach + table[:, 1]
            slot = table[np.searchsorted(by, np.searchsorted(lengths, length) * reach + np.minimum(rank, reach - 1), side="right") - 1]
            nth = rank - slot[:, 1]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + [pa.array(slot[:, 2] + nth // slot[:, 3]), pa.array(slot[:, 4] + nth % slot[:, 3] * length)],
                names=batch.schema.names[:-1] + ["sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    return arrow_map(with_ranks, place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the token sequences, from pieces with their ids.

    A group has one sequence, at most ``capacity`` tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select(
        "sequence_id", "length", F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, with_ids: bool = False, **options) -> DataFrame:
    """Pieces of all documents with their sequences and places."""
    return pack(staged(pieces(docs, with_ids=with_ids, **options), "pieces"), options.get("capacity", CAPACITY))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))
