"""Repeated passages by prefix-partitioned suffix trees.

A window is ``WINDOW`` consecutive words. Every window has an anchor, its
least-hashed ``ANCHOR``-word gram, so equal windows have equal anchors at
equal places. Neighbouring windows mostly share one: a *stretch* is a run of
windows with one anchor, with the words that they cover.

1. A two-pass Bloom filter over all anchors finds those that may stand in more
   than one document; stretches of all others can't be repeated and go no
   further.
2. The suffixes that begin at the windows of the stretches left are split by
   prefixes that a repeat must share, of variable length: first the anchor's
   ``ANCHOR`` words. While a prefix leaves more than ``GROUP`` stretches, its
   stretches are cut in two by the anchor's place in the window. The windows of
   a half share more words (10, 30, 40, 45, 48, 49, 50 by default), and these
   are its prefix. Only too large groups are cut on; at ``WINDOW`` words a group
   is one window, and what is left of it is an aggregate.
3. A task sorts its groups' suffixes by doubling prefixes and takes the common
   prefixes of neighbours: the suffix trees of the groups. Below an inner node
   at least ``WINDOW`` words deep, every document but the least repeats the
   node's words. The deepest such node above a suffix gives the longest repeat
   that begins there; one that no repeat from further left holds is maximal.

Hashes only place stretches in groups; inside them words (each as 64 bits of
its own) are compared. Equal stretches, and the windows of groups cut down to
one, are known by 128 bits.

Stretches with equal words are pre-aggregated in each task, so a passage that
a third of all documents share is one row a task, and what documents lose is
joined back by a join that AQE splits where a passage is hot.

Defined results: a null text is an empty one. A null id counts as the largest.
Rows that repeat an id keep their passages against each other (only a smaller
id takes them away). Empty input: empty result. Other columns are dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwise.llm.bloom import member_filter, repeat_filter
from cabwise.llm.common import (NULL_ID, Words, arrow_map, as_longs, column, documents, id_key, mixed, slices, staged,
                                text_of)

WINDOW = 50
ANCHOR = 10
#: Stretches of one shared prefix that one task compares at a time; more lengthen the prefix.
GROUP = 2048
#: Stretches, of whole groups, that a task sorts together.
FOREST = 4096
FILTER_BYTES = 128 << 20
BASE = 0x9E3779B97F4A7C15
SECOND_BASE = 0xD6E8FEB86659FD93


# ---------------------------------------------------------------- windows and anchors

class Runs:
    """Hashes of word runs: ``of(start, n)`` in constant time each."""

    def __init__(self, words: np.ndarray, base: int = BASE):
        n = len(words) + 1
        power, back = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 2**64), np.uint64)
        power[0] = back[0] = 1
        self.back = np.cumprod(back)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * np.cumprod(power)[:-1])])

    def of(self, start: np.ndarray, n) -> np.ndarray:
        return mixed((self.sums[start + n] - self.sums[start]) * self.back[start])


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each i, where the first least of ``values[i:i + width]`` stands."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, reach = np.arange(len(values)), 1
    while 2 * reach <= width:
        left, right = best[:-reach], best[reach:]
        best = np.where(values[left] <= values[right], left, right)
        reach *= 2
    left, right = best[:n], best[width - reach:width - reach + n]
    return np.where(values[left] <= values[right], left, right)


class Stretches:
    """Runs of windows with one anchor: row, first window, how many, anchor place
    and hash, of a slice of texts."""

    def __init__(self, texts: pa.Array, window: int, anchor: int):
        words = Words(texts)
        self.offsets = words.offsets
        self.words = words.hashes()[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
        self.runs = Runs(self.words)
        rows = np.repeat(np.arange(len(words.counts)), words.counts)
        n = len(self.words) - window + 1
        if n <= 0:
            self.row = self.first = self.count = self.place = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, np.uint64)
            return
        grams = self.runs.of(np.arange(len(self.words) - anchor + 1), anchor)
        place = leftmost_least(grams, window - anchor + 1)
        starts = np.flatnonzero(rows[:n] == rows[window - 1:])
        place = place[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
        heads = np.flatnonzero(new)
        self.first, self.place = starts[heads], place[heads]
        self.count = np.diff(np.append(heads, len(starts)))
        self.row, self.anchor = rows[self.first], grams[self.place]

    def contents(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """128 bits for a stretch's words and the anchor's place in it, as two halves."""
        place = mixed(((self.place - self.first) * 4096 + self.count).astype(np.uint64))
        return tuple(mixed(runs.of(self.first, self.count + window - 1) + place)
                     for runs in (self.runs, second_runs(self.words)))


def second_runs(words: np.ndarray) -> Runs:
    return Runs(mixed(words), SECOND_BASE)


def anchors(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(h): the distinct anchors of each document."""
    def run(batches):
        for batch in slices(batches):
            found = Stretches(column(batch, "text"), window, anchor)
            key = np.stack([found.row.astype(np.uint64), found.anchor], axis=1)
            yield pa.RecordBatch.from_arrays([as_longs(np.ascontiguousarray(np.unique(key, axis=0)[:, 1]))], names=["h"])

    return arrow_map(docs.select("text"), run, "h long")


STRETCH = ("content long, check long, doc_id long, text_hash long, first int, anchor long, lead int, words binary")


def repeated_stretches(docs: DataFrame, maybe_table, window: int, anchor: int) -> DataFrame:
    """Stretches whose anchor may stand in several documents.

    One row for each, with its place; and for each distinct content of a slice
    one row with its words, its anchor and the least document that has it."""
    def run(batches):
        for batch in slices(batches):
            found = Stretches(column(batch, "text"), window, anchor)
            own = np.flatnonzero(maybe_table(found.anchor))
            content, check = (x[own] for x in found.contents(window))
            row = found.row[own]
            doc = column(batch, "doc_id").to_numpy()[row]
            first, count = found.first[own], found.count[own]
            lead = found.place[own] - first
            yield _rows(STRETCH, content, check, doc, column(batch, "text_hash").to_numpy()[row],
                        first - found.offsets[row], None, None, None)
            by = np.lexsort((doc, check, content))
            same = (content[by][1:] == content[by][:-1]) & (check[by][1:] == check[by][:-1])
            heads = by[np.concatenate([[True], ~same])] if len(by) else by
            for i in range(0, len(heads), 20_000):
                at = heads[i:i + 20_000]
                words = [found.words[a:a + n + window - 1].tobytes() for a, n in zip(first[at].tolist(), count[at].tolist())]
                yield _rows(STRETCH, content[at], check[at], doc[at], None, None, found.anchor[own][at], lead[at], words)

    return arrow_map(docs, run, STRETCH)


def _rows(schema: str, *columns) -> pa.RecordBatch:
    """A record batch of the columns; None is a column of nulls."""
    names, types = zip(*(x.split() for x in schema.split(", ")))
    n = len(next(x for x in columns if x is not None))
    made = []
    for kind, x in zip(types, columns):
        kind = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[kind]
        if isinstance(x, np.ndarray):
            x = x.view(np.int64) if x.dtype == np.uint64 else x
        made.append(pa.nulls(n, kind) if x is None else pa.array(x).cast(kind) if len(x) else pa.array([], kind))
    return pa.RecordBatch.from_arrays(made, names=list(names))


# ---------------------------------------------------------------- suffix trees

def longest_repeats(words: np.ndarray, lengths: np.ndarray, docs: np.ndarray, window: int) -> np.ndarray:
    """For each word of the texts, how many words from it on stand in a text of a smaller document.

    ``words``: the texts end to end; ``lengths`` and ``docs``: one value each.
    0 where that is less than ``window``."""
    n = len(words)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(n)
    ranks, width = [np.unique(words, return_inverse=True)[1] + 1], 1
    while n and width < lengths.max():
        after = np.zeros(n, np.int64)
        inside = np.flatnonzero(left > width)
        after[inside] = ranks[-1][inside + width]
        ranks.append(np.unique(ranks[-1] * (n + 1) + after, return_inverse=True)[1] + 1)
        width *= 2
    starts = np.flatnonzero(left >= window)
    order = starts[np.argsort(ranks[-1][starts], kind="stable")]
    out = np.zeros(n, np.int64)
    if len(order) < 2:
        return out
    one, other = order[:-1], order[1:]
    common = np.zeros(len(one), np.int64)
    for k in reversed(range(len(ranks))):
        alike = ranks[k][np.minimum(one + common, n - 1)] == ranks[k][np.minimum(other + common, n - 1)]
        common += alike.astype(np.int64) << k
    common = np.minimum(common, np.minimum(left[one], left[other]))
    below = np.repeat(docs, lengths)[order]
    for depth in np.unique(common[common >= window]):
        node = np.concatenate([[0], np.cumsum(common < depth)])
        heads = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        least = np.minimum.reduceat(below, heads)
        out[order[least[node] < below]] = depth
    return out


def maximal_spans(reach: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, stop) of the repeats that no repeat from further left in the text holds."""
    text = np.repeat(np.arange(len(lengths)), lengths)
    offset = np.cumsum(lengths) - lengths
    stops = np.arange(len(reach)) + reach
    furthest = np.maximum.accumulate(np.where(reach > 0, stops, 0))
    before = np.concatenate([[0], furthest[:-1]])
    own = np.flatnonzero((reach > 0) & (stops > before))
    return text[own], own - offset[text[own]], stops[own] - offset[text[own]]


SPANS = "content long, check long, least long, size int, spans binary"
PIECE = "key long, key2 long, content long, check long, doc_id long, lead int, at int, lo int, hi int, words binary"


def whole_groups(batches, key: str, rows: int):
    """Tables of whole groups of a key, ``rows`` rows or one group each, from batches that come sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held += [batch] if batch.num_rows else []
        if sum(b.num_rows for b in held) < rows:
            continue
        table = pa.Table.from_batches(held)
        values = table.column(key).to_numpy()
        ends = np.flatnonzero(values[1:] != values[:-1]) + 1
        start = 0
        while True:  # the last group may go on in the next batch
            later = ends[ends >= start + rows]
            if not len(later):
                break
            yield table.slice(start, int(later[0]) - start)
            start = int(later[0])
        held = table.slice(start).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def subtrees(pieces: DataFrame, window: int) -> DataFrame:
    """(content, check, least, size, spans): of each piece of a content, its least
    document, its words, and the maximal repeats (start, stop: pairs of int32) that
    this document shares with smaller ones, counted from the content's first word."""
    def run(batches):
        for group in whole_groups(batches, "key", FOREST):
            key, content, check = (group.column(x).to_numpy() for x in ("key", "content", "check"))
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1]) | (check[1:] != check[:-1])
            heads = np.flatnonzero(new)
            least = np.minimum.reduceat(group.column("doc_id").to_numpy(), heads)
            at = group.column("at").to_numpy()[heads]
            own = pa.concat_arrays(group.column("words").take(pa.array(heads)).chunks)
            size = np.diff(np.frombuffer(own.buffers()[1], np.int32)[own.offset:own.offset + len(own) + 1]) // 8
            shared = np.zeros(len(heads), bool)                      # pieces that aren't alone in their group
            alike = key[heads][1:] == key[heads][:-1]
            shared[1:] |= alike
            shared[:-1] |= alike
            spans: list[bytes] = [b""] * len(heads)
            some = np.flatnonzero(shared)
            if len(some):
                words = np.concatenate([np.frombuffer(own[i].as_buffer(), np.uint64) for i in some.tolist()])
                text, start, stop = maximal_spans(longest_repeats(words, size[some], least[some], window), size[some])
                pairs = np.stack([start + at[some][text], stop + at[some][text]], axis=1).astype(np.int32)
                cuts = np.searchsorted(text, np.arange(len(some) + 1))
                for i in np.unique(text).tolist():
                    spans[some[i]] = pairs[cuts[i]:cuts[i + 1]].tobytes()
            yield _rows(SPANS, content[heads], check[heads], least, size, spans)

    keyed = pieces.select("key", "content", "check", "doc_id", "at", "words")
    return arrow_map(keyed.repartition("key").sortWithinPartitions("key", "content", "check"), run, SPANS)


def longer_prefixes(pieces: DataFrame, window: int) -> DataFrame:
    """Each piece cut in two by the anchor's place in its windows.

    ``lo`` to ``hi``: words of a window before the anchor. All windows of a
    piece hold the words from ``lo`` before the anchor to the end of the window
    that begins ``hi`` before it: the prefix that ``key`` and ``key2`` stand for."""
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                content, check, doc, lead, at, lo, hi = (
                    column(part, x).to_numpy() for x in ("content", "check", "doc_id", "lead", "at", "lo", "hi"))
                own = [np.frombuffer(x.as_buffer(), np.uint64) for x in column(part, "words")]
                words = np.concatenate(own)
                size = np.array([len(x) for x in own])
                offset = np.cumsum(size) - size
                runs = (Runs(words), second_runs(words))
                middle = (lo + hi) // 2
                for low, high in ((lo, middle), (middle + 1, hi)):
                    first = np.maximum(at, lead - high)                       # windows first to last of the content
                    last = np.minimum(at + size - window, lead - low)
                    n = np.flatnonzero((low <= high) & (first <= last))
                    prefix, length = (offset + lead - low - at)[n], (window - (high - low))[n]
                    salt = mixed((low * 4096 + high)[n].astype(np.uint64))
                    keys = [mixed(x.of(prefix, length) + salt) for x in runs]
                    begin = (offset + first - at)[n]
                    cut = [words[a:b].tobytes() for a, b in zip(begin.tolist(), (begin + (last - first)[n] + window).tolist())]
                    yield _rows(PIECE, *keys, content[n], check[n], doc[n], lead[n], first[n], low[n], high[n], cut)

    return arrow_map(pieces, run, PIECE)


def heavy_keys(pieces: DataFrame, key: str):
    """The test for keys of more than ``GROUP`` rows, None where there are none."""
    keys = pieces.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP)
    keys = staged(keys.select(F.xxhash64(key).alias("h")), "heavy-prefixes")
    n = keys.count()
    return member_filter(keys, "h", n)(F.xxhash64(key)) if n else None


def split_subtrees(contents: DataFrame, window: int, anchor: int) -> DataFrame:
    """Spans of contents whose anchors' groups are too large: prefixes are lengthened until groups fit."""
    own = contents.groupBy("content", "check").agg(*(F.min(x).alias(x) for x in ("doc_id", "lead")),
                                                   F.first("words").alias("words"))
    own = staged(own, "hot-stretches", compression="zstd")
    done = own.select("content", "check", F.col("doc_id").alias("least"), (F.length("words") / 8).cast("int").alias("size"),
                      F.lit(b"").alias("spans"))
    pieces = own.withColumns({"at": F.lit(0), "lo": F.lit(0), "hi": F.lit(window - anchor)})
    for _ in range((window - anchor).bit_length()):   # then every piece is one window
        pieces = staged(longer_prefixes(pieces, window), "pieces", compression="zstd")
        is_heavy = heavy_keys(pieces, "key")
        light = pieces if is_heavy is None else pieces.where(~is_heavy)
        done = done.unionByName(subtrees(light, window).where("length(spans) > 0"))
        if is_heavy is None:
            break
        heavy = pieces.where(is_heavy)
        single = heavy.where("lo = hi")
        least = single.groupBy("key", "key2").agg(F.min("doc_id").alias("least"))
        both = F.concat(_int32(F.col("at")), _int32(F.col("at") + window))
        done = done.unionByName(single.join(least, ["key", "key2"]).where("least < doc_id").select(
            "content", "check", F.col("doc_id").alias("least"), F.lit(0).alias("size"), both.alias("spans")))
        pieces = heavy.where("lo < hi").drop("key", "key2")
    return done.groupBy("content", "check").agg(F.min("least").alias("least"), F.max("size").alias("size"),
                                                F.collect_list("spans").alias("spans"))


def _int32(x: Column) -> Column:
    """Little-endian bytes of an int column."""
    digits = F.lpad(F.hex(x.cast("long")), 8, "0")
    return F.unhex(F.concat(*(F.substring(digits, i, 2) for i in (7, 5, 3, 1))))


# ---------------------------------------------------------------- the operator

def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, text_hash, spans): words [start, stop) that a smaller document has, too.

    ``docs``: doc_id long, text_hash long, text string."""
    chars = docs.agg(F.sum(F.char_length("text"))).first()[0] or 0
    maybe = repeat_filter(anchors(docs, window, anchor), "h", chars // 200, FILTER_BYTES, raw=True)
    found = staged(repeated_stretches(docs, maybe, window, anchor), "stretches", compression="zstd")  # neighbours share words
    contents = found.where(F.col("words").isNotNull())
    whole = contents.select(F.col("anchor").alias("key"), "content", "check", "doc_id", F.lit(0).alias("at"), "words")
    is_heavy = heavy_keys(whole, "key")
    light = whole if is_heavy is None else whole.where(~is_heavy)
    least = subtrees(light, window).withColumn("spans", F.array("spans"))
    if is_heavy is not None:
        hot = contents.withColumnRenamed("anchor", "key").where(is_heavy)
        least = least.unionByName(split_subtrees(hot, window, anchor))

    def lost(batches):
        for batch in batches:
            doc, first, least, size = (column(batch, x).to_numpy() for x in ("doc_id", "first", "least", "size"))
            later = np.flatnonzero(doc > least)           # they repeat all of the stretch
            rows, starts, stops = [later], [first[later]], [(first + size)[later]]
            spans = column(batch, "spans")
            for i in np.flatnonzero(doc == least).tolist():
                pairs = np.frombuffer(b"".join(spans[i].as_py()), np.int32).reshape(-1, 2)
                rows.append(np.full(len(pairs), i))
                starts.append(first[i] + pairs[:, 0])
                stops.append(first[i] + pairs[:, 1])
            at = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id").take(at), column(batch, "text_hash").take(at),
                 pa.array(np.concatenate(starts).astype(np.int32)), pa.array(np.concatenate(stops).astype(np.int32))],
                names=["doc_id", "text_hash", "start", "stop"])

    places = found.where(F.col("words").isNull()).select("content", "check", "doc_id", "text_hash", "first")
    repeats = (F.col("doc_id") > F.col("least")) | F.exists("spans", lambda x: F.length(x) > 0)
    with_least = places.join(least, ["content", "check"]).where(repeats).select(
        "doc_id", "text_hash", "first", "least", "size", "spans")
    return arrow_map(with_least, lost, "doc_id long, text_hash long, start int, stop int").groupBy(
        "doc_id", "text_hash").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, doc_id: str = "doc_id",
                   text: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text): kept words joined by one blank.

    With ``digest``, kept_sha256 instead of the text."""
    own = docs.select(id_key(doc_id).alias("doc_id"), text_of(text).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    spans = repeated_spans(own, window, anchor)
    joined = own.join(spans, ["doc_id", "text_hash"], "left").select(
        "doc_id", "text", F.col("spans.start").alias("starts"), F.col("spans.stop").alias("stops"))

    def cut(batches):
        for batch in slices(batches):
            out = []
            for x, starts, stops in zip(column(batch, "text").to_pylist(), column(batch, "starts").to_pylist(),
                                        column(batch, "stops").to_pylist()):
                words, kept, at, gone = x.encode().split(), [], 0, 0
                for a, b in zip(starts or (), stops or ()):
                    kept += words[at:a]
                    gone += max(0, b - max(a, at))
                    at = max(at, b)
                kept += words[at:]
                left = b" ".join(kept)
                out.append((len(words), gone, hashlib.sha256(left).hexdigest() if digest else left.decode()))
            n, gone, left = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(left, pa.string())], names=["doc_id", "n_words", "n_removed", last])

    last = "kept_sha256" if digest else "kept_text"
    return arrow_map(joined, cut, f"doc_id long, n_words long, n_removed long, {last} string").withColumn(
        "doc_id", F.nullif("doc_id", F.lit(NULL_ID)))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), digest=True)


OP7_SQL = rf"""
WITH d AS (
  SELECT coalesce(doc_id, {NULL_ID}) AS doc_id, row_number() OVER () AS r,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
starts AS (SELECT doc_id, r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d),
windows AS (SELECT doc_id, r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s FROM starts),
firsts AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY s),
gone AS (SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS p FROM windows JOIN firsts USING (s) WHERE least < doc_id),
words AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT nullif(doc_id, {NULL_ID}) AS doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""
