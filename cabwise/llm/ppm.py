"""Scoring by prediction by partial matching over byte contexts.

A trie of byte contexts up to ``ORDER`` is counted on the training documents.
A byte is predicted by the longest context that has been seen; if it never
followed there, an escape (method C: as likely as the distinct bytes seen)
leads to the next shorter context, where the bytes that the longer one knows
are excluded. Behind the empty context all bytes left are equally likely. A
document's score is the log10 probability of its bytes, A-Z lower-cased, and
of its end. A plain word model (additive smoothing) is scored beside it.

The counts of all training text are gathered by partial aggregation: each task
counts its own n-grams and words before they shuffle. What tasks hold for
scoring is bounded, what is scored is not: at most ``MAX_EDGES`` trie edges of
the longest order and at most ``MAX_WORDS`` words, the most frequent ones (a
power-of-two threshold chosen from the counts' histogram), with the totals of
all counts. The bytes and words of a text that aren't among them are looked up
in the full counts by joins: a byte's contexts all end in the same bytes, so
edges and bytes wanted are dealt by the last bytes of the context, and each
task builds that part of the trie upon the orders that are held whole (the
longest one of at most ``MAX_EDGES`` edges, and all shorter ones).

Defined results: a null text is an empty one and has its end as only token. A
null id is the text ''; it is in the training part. Without training
documents every byte is equally likely. Rows that repeat an id count and are
scored one by one. Empty input: empty result.
"""

from __future__ import annotations

import gc
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwise.llm.common import Words, arrow_map, as_longs, column, documents, row_sums, slices, staged, text_of

ORDER = 5
MARK = 0xFF  # no UTF-8 text has this byte: it stands for start and end
MAX_EDGES = 1 << 20
MAX_WORDS = 1 << 21
FOLDS, HELD_FOLD = 5, 1
WORD, GRAM = 0, 1
#: Edges and bytes wanted that a task works on at once, if no group of them is larger.
PART_ROWS = 1 << 18
#: Bytes of text that a task works on at once: contexts, look-ups and sorts take some 60 bytes for each.
PART_BYTES = 1 << 18
#: Distinct keys that a task counts before it sends them on.
HELD_KEYS = 1 << 20
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_FIRST_SHIFT = np.uint64(0x9E3779B97F4A7C15)


def is_held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_FOLD


# ---------------------------------------------------------------- bytes and their contexts

def context_keys(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each text and each text's end: the ``order`` bytes
    before it and itself, as one number; and where each text's keys start."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    size = np.diff(bounds)
    starts = np.concatenate([[0], np.cumsum(size + 1)])
    symbols = np.full(starts[-1], MARK, np.uint8)
    own = np.ones(len(symbols), bool)
    own[starts[1:] - 1] = False
    symbols[own] = _LOWER[data]
    keys = symbols.astype(np.uint64)
    first = np.arange(len(symbols)) - np.repeat(starts[:-1], size + 1)
    padded = np.concatenate([np.full(order, MARK, np.uint64), keys])
    n = len(symbols)
    for back in range(1, order + 1):
        before = padded[order - back:order - back + n]
        keys |= np.where(first >= back, before, np.uint64(MARK)) << np.uint64(8 * back)
    return keys, starts


class Counter:
    """Counts of 64-bit keys, merged now and then."""

    def __init__(self):
        self.keys, self.counts, self.pending = np.zeros(0, np.uint64), np.zeros(0, np.int64), []

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.pending.append((keys, counts))
        if sum(len(k) for k, _ in self.pending) > 1 << 20:
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.pending)])
        counts = np.concatenate([self.counts, *(c for _, c in self.pending)])
        self.pending = []
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.keys = keys[starts]
        self.counts = np.add.reduceat(counts, starts) if len(keys) else counts

    def emptied(self, kind: int):
        """All counts so far as batches; the sum over tasks and batches comes behind the shuffle."""
        self.merge()
        keys, counts = self.keys, self.counts
        self.__init__()
        for i in range(0, len(keys), 100_000):
            part = keys[i:i + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), kind, np.int8)), as_longs(part), pa.array(counts[i:i + 100_000])], names=["kind", "key", "n"])


def corpus_counts(docs: DataFrame, order: int) -> DataFrame:
    """(kind, key, n): n-grams of ``order`` + 1 bytes, and words by their hash."""
    def run(batches):
        counters = {WORD: Counter(), GRAM: Counter()}
        for batch in slices(batches, limit=PART_BYTES):
            texts = column(batch, "text")
            words = Words(texts, lower=True)
            counters[WORD].add(words.hashes(), np.bincount(words.codes, minlength=len(words.vocabulary)))
            counters[GRAM].add(*np.unique(context_keys(texts, order)[0], return_counts=True))
            for kind, counter in counters.items():
                if len(counter.keys) > HELD_KEYS:
                    yield from counter.emptied(kind)
        for kind, counter in counters.items():
            yield from counter.emptied(kind)

    return (arrow_map(docs, run, "kind byte, key long, n long")
            .groupBy("kind", "key").agg(F.sum("n").alias("n")))


def most_frequent(counts: DataFrame, most: int) -> tuple[DataFrame, int]:
    """Rows of at least some power of two, at most ``most`` of them; that power."""
    sizes = {r.size: r.rows for r in counts.groupBy(F.char_length(F.bin("n")).alias("size")).agg(
        F.count(F.lit(1)).alias("rows")).collect()}  # at most 64 rows
    size, held = max(sizes, default=0) + 1, 0
    while size > 1 and held + sizes.get(size - 1, 0) <= most:
        size -= 1
        held += sizes.get(size, 0)
    least = 1 << (size - 1)
    return counts.where(F.col("n") >= least), least


def _gathered(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(key, n) columns of a bounded table, sorted by key."""
    table = df.select("key", "n").toArrow()
    keys = table.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], table.column("n").to_numpy()[order]


# ---------------------------------------------------------------- the model

class Index:
    """Places of 64-bit keys among ``keys`` (-1: not there), by open addressing."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.table = np.full(1 << self.bits, -1, np.int32)
        left, slot = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(left):
            free = self.table[slot] < 0
            self.table[slot[free]] = left[free]
            lost = self.table[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & (len(self.table) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _FIRST_SHIFT) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        slot = self._slot(keys)
        found = self.table[slot]
        open_ = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.table) - 1)
            found[open_] = self.table[slot[open_]]
            own = found[open_]
            open_ = open_[(own >= 0) & (self.keys[own] != keys[open_])]
        return found


@dataclass
class Level:
    """Contexts of one length. An edge is a context with a byte that followed.

    ``total`` is log10 of a context's count with its escapes, ``escape`` the
    log10 probability of an escape; ``below_total`` and ``below_escape`` are
    the same for the next shorter context without this one's bytes. The next
    longer order is built from ``raw``: counts of the edges, counts and distinct
    bytes of the contexts."""

    edges: Index
    log_count: np.ndarray | Coded
    node_of: np.ndarray
    nodes: Index
    total: np.ndarray | Coded
    escape: np.ndarray | Coded
    below_total: np.ndarray | Coded
    below_escape: np.ndarray | Coded
    raw: tuple[np.ndarray, np.ndarray, np.ndarray] | None

    def for_scoring(self) -> Level:
        """The same probabilities in less memory; no longer order can be built from it."""
        return replace(self, raw=None, **{x: Coded(getattr(self, x)) for x in
                                          ("log_count", "total", "escape", "below_total", "below_escape")})


class Coded:
    """An array of few different values as short codes into them."""

    def __init__(self, values: np.ndarray):
        self.values, codes = np.unique(values, return_inverse=True)
        self.codes = codes.astype(np.min_scalar_type(len(self.values)))

    def __getitem__(self, places: np.ndarray) -> np.ndarray:
        return self.values[self.codes[places]]


def _log10(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log10(x)


def build_levels(edges: list[tuple[np.ndarray, np.ndarray]], lower: list[Level] | None = None) -> list[Level]:
    """``edges[i]``: sorted keys (k context bytes and the byte) and counts, of the
    orders k from 0 or from the one above ``lower``, which the result starts with.

    Every edge's shorter forms must be among the edges of lower order, with the
    counts of all text, and every context must have all its edges."""
    levels = list(lower or [])
    for k, (keys, counts) in enumerate(edges, len(levels)):
        context = keys >> np.uint64(8)
        starts = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(keys) else np.zeros(0, np.int64)
        nodes = context[starts]
        node_of = np.searchsorted(nodes, context)
        totals = np.add.reduceat(counts, starts) if len(keys) else counts[:0]
        distinct = np.diff(np.append(starts, len(keys)))
        n = len(nodes)
        if k:
            below = levels[-1]
            below_counts, below_totals, below_distinct = below.raw
            short = np.searchsorted(below.edges.keys, keys & np.uint64((1 << 8 * k) - 1))
            excluded = np.add.reduceat(below_counts[short], starts) if n else counts[:0]
            parent = below.node_of[short[starts]] if n else starts
            rest = below_totals[parent] - excluded
            new = below_distinct[parent] - distinct
        else:  # below the empty context all bytes left are equally likely
            rest, new = 256.0 - distinct, np.zeros(n)
        below_total = _log10(np.maximum(rest + new, 1e-300))
        below_escape = np.where(rest + new > 0, _log10(new) - below_total, 0.0)
        levels.append(Level(Index(keys), np.log10(counts), node_of.astype(np.int32), Index(nodes), np.log10(totals + distinct),
                            np.log10(distinct) - np.log10(totals + distinct), below_total, below_escape, (counts, totals, distinct)))
    return levels


def shorter(keys: np.ndarray, counts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a lower order, sorted, from all edges of a higher one."""
    counter = Counter()
    counter.add(keys & np.uint64((1 << 8 * (order + 1)) - 1), counts)
    counter.merge()
    return counter.keys, counter.counts


def log_probabilities(levels: list[Level], keys: np.ndarray) -> np.ndarray:
    """log10 of each byte's probability behind its context."""
    out = np.zeros(len(keys))
    left = np.arange(len(keys))              # bytes not predicted yet
    total = np.full(len(keys), np.nan)       # set where a longer context has escaped
    escape = np.full(len(keys), np.nan)
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k]
        key = keys[left] & np.uint64((1 << 8 * (k + 1)) - 1)
        edge = level.edges.find(key)
        hit = edge >= 0
        own, fresh = edge[hit], np.isnan(total[hit])
        out[left[hit]] += level.log_count[own] - np.where(fresh, level.total[level.node_of[own]], total[hit])
        miss = ~hit
        left, key, total, escape = left[miss], key[miss], total[miss], escape[miss]
        node = level.nodes.find(key >> np.uint64(8))
        there = node >= 0
        at = node[there]
        out[left[there]] += np.where(np.isnan(escape[there]), level.escape[at], escape[there])
        total[there], escape[there] = level.below_total[at], level.below_escape[at]
    out[left] -= np.where(np.isnan(total), np.log10(256.0), total)
    return out


@dataclass
class Model:
    """What tasks need for scoring.

    ``levels`` are the orders held whole. If these aren't all, ``frequent`` has
    the most frequent edges of the longest order, with their log10 probabilities."""

    order: int
    levels: list[Level]
    frequent: Index | None
    frequent_logs: np.ndarray | Coded | None
    words: np.ndarray        # hashes of the frequent words, sorted
    word_counts: np.ndarray
    scale: float             # log10 of the word model's denominator
    ends: int

    def word_logs(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are held, and their log10 probabilities (as unknown, if not)."""
        if not len(self.words):
            return np.zeros(len(hashes), bool), np.full(len(hashes), np.log10(0.5) - self.scale)
        place = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        held = self.words[place] == hashes
        return held, np.log10(np.where(held, self.word_counts[place].astype(np.float64), 0.0) + 0.5) - self.scale

    def for_scoring(self) -> Model:
        """What a task that scores texts holds: it has this once for each of its executor's cores."""
        levels = [] if self.frequent is not None else [x.for_scoring() for x in self.levels]
        counts = self.word_counts.astype(np.min_scalar_type(self.word_counts.max(initial=0)))
        return replace(self, levels=levels, word_counts=counts,
                       frequent_logs=None if self.frequent is None else Coded(self.frequent_logs))

    def byte_logs(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each byte's log10 probability (0 where it has to be looked up), and where it has to be."""
        if self.frequent is None:
            return log_probabilities(self.levels, keys), np.zeros(0, np.int64)
        place = self.frequent.find(keys)
        logs = np.zeros(len(keys))
        held = place >= 0
        logs[held] = self.frequent_logs[place[held]]
        return logs, np.flatnonzero(~held)


@dataclass
class Rest:
    """Written counts (key, n): words that the model doesn't hold; all edges of the longest order."""

    words: DataFrame
    grams: DataFrame


def whole_orders(grams: DataFrame, order: int) -> list[Level]:
    """The longest order of at most ``MAX_EDGES`` edges, and all shorter ones."""
    k = order
    while k and grams.count() > MAX_EDGES:
        k -= 1
        grams = staged(grams.groupBy(F.col("key").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).alias("key")).agg(
            F.sum("n").alias("n")), "ppm-edges")
    longest = _gathered(grams)
    levels = build_levels([shorter(*longest, j) for j in range(k)] + [longest])
    return [replace(x, raw=None) for x in levels[:-1]] + levels[-1:]


def frequent_edges(grams: DataFrame) -> tuple[Index, np.ndarray]:
    """The most frequent edges of the longest order, with the totals of all their context's edges."""
    context = F.shiftright("key", 8).alias("context")
    contexts = grams.groupBy(context).agg((F.sum("n") + F.count(F.lit(1))).alias("total"))
    kept = most_frequent(grams, MAX_EDGES)[0].select("key", "n", context).join(contexts, "context")
    table = kept.select("key", (F.log10("n") - F.log10("total")).alias("log")).toArrow()
    return Index(table.column("key").to_numpy().view(np.uint64)), table.column("log").to_numpy()


def train(docs: DataFrame, order: int = ORDER) -> tuple[Model, Rest, int]:
    """The model of a table with a ``text`` column; the counts that it doesn't
    hold; and the number of training tokens."""
    counts = staged(corpus_counts(docs.select(text_of("text").alias("text")), order), "ppm-counts")
    words = counts.where(F.col("kind") == WORD)
    frequent, least = most_frequent(words, MAX_WORDS)
    sums = words.agg(F.count(F.lit(1)).alias("distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    grams = counts.where(F.col("kind") == GRAM).select("key", "n")
    ends = grams.where((F.col("key").bitwiseAND(F.lit(0xFF))) == MARK).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n_tokens = sums.tokens + ends
    scale = np.log10(n_tokens + 0.5 * (sums.distinct + (ends > 0) + 1))

    levels = whole_orders(grams, order)
    edges, logs = frequent_edges(grams) if len(levels) <= order else (None, None)
    keys, n = _gathered(frequent)
    model = Model(order, levels, edges, logs, keys, n, float(scale), int(ends))
    return model, Rest(words.where(F.col("n") < least).select("key", "n"), grams), n_tokens


# ---------------------------------------------------------------- scoring

def part_logs(levels: list[Level], order: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """(key, log) of the keys wanted (n = 0), from all edges (n > 0) of contexts
    that end in the same bytes as theirs."""
    wanted, grams, counts = keys[n == 0], keys[n > 0], n[n > 0]
    if len(wanted):
        levels = build_levels([shorter(grams, counts, k) for k in range(len(levels), order + 1)], levels)
    return pa.RecordBatch.from_arrays([as_longs(wanted), pa.array(log_probabilities(levels, wanted))], names=["key", "log"])


def joined_logs(wanted: DataFrame, grams: DataFrame, model: Model) -> DataFrame:
    """(key, log): log10 probabilities of distinct keys, from the written counts.

    Keys and edges are dealt by the last bytes of the context, one more than the
    orders held whole look at; edges with equal ones are worked on together."""
    order, mask = model.order, (1 << 8 * len(model.levels)) - 1
    shared = wanted.sparkSession.sparkContext.broadcast(model.levels)

    def run(batches):
        held, size, most = [], 0, PART_ROWS
        for batch in batches:
            held.append([column(batch, x).to_numpy() for x in ("key", "n")])
            size += batch.num_rows
            if size >= most:
                keys, n = (np.concatenate(x) for x in zip(*held))
                ends = keys >> 8 & mask
                cut = int(np.searchsorted(ends, ends[-1]))
                if cut:
                    yield part_logs(shared.value, order, keys[:cut].view(np.uint64), n[:cut])
                held, size = [[keys[cut:], n[cut:]]], size - cut
                most = max(PART_ROWS, 2 * size)
        if size:
            keys, n = (np.concatenate(x) for x in zip(*held))
            yield part_logs(shared.value, order, keys.view(np.uint64), n)

    dealt = (grams.unionByName(wanted.select("key", F.lit(0).cast("long").alias("n")))
             .withColumn("ends", F.shiftright("key", 8).bitwiseAND(F.lit(mask)))
             .repartition("ends").sortWithinPartitions("ends"))
    return arrow_map(dealt.select("key", "n"), run, "key long, log double")


def score(docs: DataFrame, model: Model, rest: Rest, train_tokens: int) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of a
    table (doc_id, held_out, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model.for_scoring())

    def run(batches):
        gc.collect()  # an earlier model, if the worker had one
        model, task, row = shared.value, TaskContext.get().partitionId(), 0
        for batch in slices(batches, limit=PART_BYTES):
            texts, n = column(batch, "text"), batch.num_rows
            keys, starts = context_keys(texts, model.order)
            logs, wanted = model.byte_logs(keys)
            wanted_keys, wanted_rows = keys[wanted], np.searchsorted(starts, wanted, side="right") - 1
            by = np.lexsort((wanted_keys, wanted_rows))
            wanted_keys, wanted_rows = wanted_keys[by], wanted_rows[by]
            new = np.concatenate([[True], (wanted_keys[1:] != wanted_keys[:-1]) | (wanted_rows[1:] != wanted_rows[:-1])])[:len(by)]
            firsts = np.flatnonzero(new)
            wanted_bounds = pa.array(np.searchsorted(wanted_rows[firsts], np.arange(n + 1)).astype(np.int32))
            words = Words(texts, lower=True)
            hashes = words.hashes()
            held, base = model.word_logs(hashes)
            rare = ~held[words.codes]
            rare_bounds = np.concatenate([[0], np.cumsum(row_sums(rare.astype(np.int64), words.offsets))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array((task << 40) + row + np.arange(n)), column(batch, "doc_id"), column(batch, "held_out"),
                pa.array(words.counts + 1), pa.array(row_sums((~rare).astype(np.int64), words.offsets) + int(model.ends > 0)),
                pa.array(row_sums(base[words.codes], words.offsets) + np.log10(model.ends + 0.5) - model.scale), pa.array(row_sums(logs, starts)),
                pa.ListArray.from_arrays(pa.array(rare_bounds), as_longs(hashes[words.codes[rare]])),
                pa.ListArray.from_arrays(wanted_bounds, as_longs(wanted_keys[firsts])),
                pa.ListArray.from_arrays(wanted_bounds, pa.array(np.diff(np.append(firsts, len(by))).astype(np.int32)))],
                names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare", "wanted", "times"])
            row += n

    scored = staged(arrow_map(docs, run, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
                                         "score double, rare array<long>, wanted array<long>, times array<int>"), "ppm-scores")
    shared.destroy()  # the scores are written
    more = (scored.select("row", F.explode("rare").alias("key")).join(rest.words, "key")
            .select("row", F.lit(1).alias("known"), (F.log10(F.col("n") + 0.5) - float(np.log10(0.5))).alias("base"), F.lit(0.0).alias("log")))
    if model.frequent is not None:
        bytes_ = scored.select("row", F.inline(F.arrays_zip(F.col("wanted").alias("key"), "times")))
        logs = joined_logs(bytes_.select("key").distinct(), rest.grams, model)
        more = more.unionByName(bytes_.join(logs, "key").select(
            "row", F.lit(0).alias("known"), F.lit(0.0).alias("base"), (F.col("times") * F.col("log")).alias("log")))
    more = more.groupBy("row").agg(F.sum("known").alias("more_known"), F.sum("base").alias("more_base"), F.sum("log").alias("more_log"))
    return scored.drop("rare", "wanted", "times").join(more, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_log", F.lit(0.0))).alias("score"))


def op10_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.col("doc_id"), is_held_out().alias("held_out"), text_of().alias("text"))
    model, rest, n_tokens = train(docs.where(~F.col("held_out")))
    return score(docs, model, rest, n_tokens)
