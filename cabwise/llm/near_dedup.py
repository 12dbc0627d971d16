"""Near duplicates by MinHash with sequential Bayesian verification.

1. Every text becomes the set of its distinct ``SHINGLE``-word shingles (64-bit
   hashes) and a signature of ``HASHES`` minima. Texts with equal sets (128 bits of
   digest) are one class from here on; the class with the least id stands for it.
2. Signatures are cut into bands; equal bands make a bucket. Two texts of
   similarity 0.8 miss each other in all bands with probability 5e-8.
3. Each text is first paired with one other of its buckets, the hub: the least
   id of the bucket, the one met in most bands. That is one pair a text,
   however many copies a bucket holds.
4. A pair's signatures are compared batch by batch. After each batch the
   posterior probability (uniform prior) that the similarity reaches the
   threshold is bounded; the pair is dropped when it is under ``MISS``.
   Survivors are verified exactly on their full shingle sets.
5. In buckets whose texts have different hubs, texts are compared with each
   other, batch by batch as before, in blocks of ``BLOCK`` signatures, each
   pair only in its first common band. Texts with a surviving partner get
   their shingle sets, and the pairs are verified exactly where the block is,
   likeliest first; a pair whose texts are joined already adds nothing. No pair
   is dropped for a bucket's size, and no pair becomes a row unless it joins
   two parts of its group.
6. All links give components (alternating stars).

Defined results: a null text is an empty one; texts without words have no
shingles and link with nothing. A null id counts as the largest one. Rows that
repeat an id keep their own sets: each row is
reported with the component of its set. Empty input: empty result. Texts are
taken whole, however long: a task holds one long text's set at a time. Other
columns are dropped by ``near_duplicates`` and kept by ``keep_one_of_each``.
"""

from __future__ import annotations

from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwise.llm.bloom import member_filter
from cabwise.llm.common import (NULL_ID, Words, arrow_map, as_longs, column, documents, id_key, mixed, slices,
                                sorted_groups, staged, text_of)
from cabwise.llm.components import components, components_sql

SHINGLE = 4
PERCENT = 80
HASHES, ROWS = 128, 4
BATCH = 16
MISS = 1e-6
BLOCK = 512
#: Of a set's digest that number its class; sets that meet in them are told apart by the other half.
CLASS_BITS = 64
#: Pairs that a task compares at once.
PAIRS = 1 << 13
_MUL, _ADD = (np.random.default_rng(seed).integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
              for seed in (11, 12))


# ---------------------------------------------------------------- sets and signatures

def shingle_sets(texts: pa.Array, size: int = SHINGLE):
    """The sorted distinct shingle hashes of each text, one array a row."""
    words = Words(texts, lower=True)
    hashed = words.hashes()[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    wide = np.uint64(0x9E3779B97F4A7C15)
    rolling = mixed(hashed)
    last = max(0, len(hashed) - size + 1)
    grams = rolling[:last].copy()
    for i in range(1, size):
        grams = grams * wide + rolling[i:last + i]
    grams = mixed(grams)
    for start, stop in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist()):
        if stop - start >= size:
            yield np.unique(grams[start:stop - size + 1])
        elif stop > start:
            own = np.array([stop - start], np.uint64)
            for i in range(start, stop):
                own = own * wide + rolling[i:i + 1]
            yield mixed(own)
        else:
            yield grams[:0]


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, 2**64 - 1, np.uint64)
    for i in range(0, len(shingles), 4096):
        part = shingles[None, i:i + 4096] * _MUL[:, None] + _ADD[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


class ClassNumbers:
    """A signed 64-bit number for each shingle set, from its 128-bit digest.

    The number is the digest's first half, or the second half where different
    sets meet in the first one (``shared``: those few first halves)."""

    def __init__(self, bits: int, shared: frozenset = frozenset()):
        self.bits, self.shared = bits, shared

    def halves(self, shingles: np.ndarray) -> tuple[int | None, int | None]:
        """Null for the empty set."""
        if not len(shingles):
            return None, None
        digest = xxhash.xxh3_128_digest(shingles.tobytes())
        first, second = (int.from_bytes(x, "little", signed=True) for x in (digest[:8], digest[8:]))
        return first >> (64 - self.bits), second

    def of(self, shingles: np.ndarray) -> int | None:
        first, second = self.halves(shingles)
        return second if first in self.shared else first


def signatures(docs: DataFrame, doc_id: str, text: str, size: int, numbers: ClassNumbers) -> DataFrame:
    """(doc_id, n_shingles, cls, second, sig): both halves of the set's digest; null without shingles, as is sig."""
    def run(batches):
        for batch in slices(batches):
            n, keys, sigs = [], [], []
            for own in shingle_sets(column(batch, "text"), size):
                n.append(len(own))
                keys.append(numbers.halves(own))
                sigs.append(signature(own).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(n, pa.int64()), pa.array([x for x, _ in keys], pa.int64()),
                 pa.array([x for _, x in keys], pa.int64()), pa.array(sigs, pa.binary())],
                names=["doc_id", "n_shingles", "cls", "second", "sig"])

    return arrow_map(docs.select(id_key(doc_id).alias("doc_id"), text_of(text).alias("text")), run,
                     "doc_id long, n_shingles long, cls long, second long, sig binary")


def matrix(sigs: pa.Array) -> np.ndarray:
    """Signatures of a binary column as rows of a matrix."""
    if not len(sigs):
        return np.zeros((0, HASHES), np.uint32)
    return np.frombuffer(b"".join(sigs.to_pylist()), np.uint32).reshape(-1, HASHES)


def band_keys(sigs: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    bands = sigs.reshape(len(sigs), -1, ROWS).astype(np.uint64)
    key = np.arange(bands.shape[1], dtype=np.uint64)[None, :] + np.uint64(1)
    for i in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, i])
    return key


def band_rows(reps: DataFrame) -> DataFrame:
    """(band, cls) for every band of every class."""
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                keys = band_keys(matrix(column(part, "sig")))
                ids = np.repeat(column(part, "cls").to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([as_longs(keys.ravel()), pa.array(ids)], names=["band", "cls"])

    return arrow_map(reps.select("cls", "sig"), run, "band long, cls long")


# ---------------------------------------------------------------- sequential Bayesian comparison

@cache
def least_matches(percent: int = PERCENT, miss: float = MISS) -> tuple[int, ...]:
    """For each number of hashes compared so far (a batch more each time): with
    fewer matches the similarity reaches the threshold with probability under
    ``miss``. Uniform prior: n hashes with m matches have the posterior
    Beta(m + 1, n - m + 1), whose upper tail at t is P(Binomial(n + 1, t) <= m)."""
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * t**m * (1 - t)**(n + 1 - m)
        out.append(m)
    return tuple(out)


def may_be_similar(a: np.ndarray, b: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of two signature matrices survive the batches, and their matches."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    for k, least in enumerate(least_matches(percent)):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches[:len(alive)] + (a[alive, part] == b[alive, part]).sum(axis=1)
        left = matches >= least
        alive, matches = alive[left], matches[left]
    return alive, matches


def surviving(pairs: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that the signatures can't rule out."""
    joined = (pairs.join(sigs.select(F.col("cls").alias("a"), F.col("sig").alias("sig_a")), "a")
              .join(sigs.select(F.col("cls").alias("b"), F.col("sig").alias("sig_b")), "b")
              .select("a", "b", "sig_a", "sig_b"))

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 4000):
                part = batch.slice(i, 4000)
                alive, _ = may_be_similar(matrix(column(part, "sig_a")), matrix(column(part, "sig_b")), percent)
                yield part.select(["a", "b"]).take(pa.array(alive))

    return arrow_map(joined, run, "a long, b long")


BLOCKS = ["band", "low", "high"]
BLOCK_ROWS = "band long, low int, high int, block int, cls long, root long, sig binary"


def block_rows(members: DataFrame, sigs: DataFrame) -> DataFrame:
    """Members (band, cls, root) of buckets with several roots, with their
    signatures: one row for each two blocks that are to be compared.

    A bucket up to ``BLOCK`` members is one block; a row is made once."""
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("least"), F.max("root").alias("most"))
    several = sizes.where("least != most").select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("n_blocks"))
    return (members.join(several, "band")
            .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("n_blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
            .select("band", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                    "block", "cls", "root").join(sigs.select("cls", "sig"), "cls")
            .select(*[x.split()[0] for x in BLOCK_ROWS.split(", ")]))


def surviving_in_block(group: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (a, b) of the pairs of a group that signatures can't rule out, and
    their matches. Of pairs of different roots; each only in its first common band."""
    get = lambda name: group.column(name).to_numpy()
    band, low, high = (int(get(k)[0]) for k in BLOCKS)
    cls, root, block = get("cls"), get("root"), get("block")
    sig = matrix(group.column("sig").combine_chunks())
    wanted = (root[:, None] != root[None, :]) & (cls[:, None] < cls[None, :])
    if low != high:
        wanted = wanted | wanted.T
        wanted &= (block == low)[:, None] & (block == high)[None, :]
    a, b = np.nonzero(wanted)
    found = [(i, *may_be_similar(sig[a[i:i + PAIRS]], sig[b[i:i + PAIRS]], percent)) for i in range(0, len(a), PAIRS)]
    alive = np.concatenate([np.zeros(0, np.int64), *(i + x for i, x, _ in found)])
    matches = np.concatenate([np.zeros(0, np.int64), *(m for _, _, m in found)])
    a, b = a[alive], b[alive]
    keyed = band_keys(sig).view(np.int64)
    first = np.concatenate([np.zeros(0, bool), *(
        keyed[a[i:i + PAIRS], (keyed[a[i:i + PAIRS]] == keyed[b[i:i + PAIRS]]).argmax(axis=1)] == band
        for i in range(0, len(a), PAIRS))])
    return a[first], b[first], matches[first]


def members_in_doubt(rows: DataFrame, percent: int) -> DataFrame:
    """Those rows of ``block_rows`` that have a surviving partner in their group."""
    def run(batches):
        for group in sorted_groups(batches, BLOCKS):
            a, b, _ = surviving_in_block(group, percent)
            if len(a):
                yield from group.take(pa.array(np.union1d(a, b))).combine_chunks().to_batches()

    return arrow_map(rows.repartition(*BLOCKS).sortWithinPartitions(*BLOCKS), run, BLOCK_ROWS)


# ---------------------------------------------------------------- exact verification

def shingle_table(classes: DataFrame, reps: DataFrame, docs: DataFrame, doc_id: str, text: str, size: int,
                  numbers: ClassNumbers) -> DataFrame:
    """(cls, shingles) of the given classes, written.

    Only their documents have their texts read out again: a Bloom filter of
    the ids thins out the scan."""
    needed = staged(reps.join(classes, "cls", "left_semi").select("cls", "doc_id"), "needed-ids")
    maybe = member_filter(needed.select(F.xxhash64("doc_id").alias("h")), "h", needed.count(), raw=True)

    def sets(batches):
        thinned = (batch.filter(pa.array(maybe(column(batch, "h").to_numpy().view(np.uint64)))) for batch in batches)
        for batch in slices(thinned):
            own = list(shingle_sets(column(batch, "text"), size))
            yield pa.RecordBatch.from_arrays(
                [pa.array([numbers.of(x) for x in own], pa.int64()), pa.array([x.tobytes() for x in own], pa.binary())],
                names=["cls", "shingles"])

    keyed = docs.select(F.xxhash64(id_key(doc_id)).alias("h"), text_of(text).alias("text"))
    found = arrow_map(keyed, sets, "cls long, shingles binary")
    return staged(found.join(needed.select("cls"), "cls", "left_semi").dropDuplicates(["cls"]), "shingle-sets")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets (sorted, distinct) reach the threshold."""
    less, more = sorted((len(x), len(y)))
    if 100 * less < percent * more:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def verified_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full shingle sets reach the threshold."""
    def run(batches):
        for batch in batches:
            keep = [similar(*(np.frombuffer(z.as_buffer(), np.uint64) for z in xy), percent)
                    for xy in zip(column(batch, "x"), column(batch, "y"))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = (pairs.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x")), "a")
              .join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y"))
    return arrow_map(joined, run, "a long, b long")


def verified_in_blocks(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join up all roots of a group that verified pairs join.

    The pairs of a group are verified where its members are, likeliest first;
    a pair whose roots are joined already adds nothing."""
    def run(batches):
        for group in sorted_groups(batches, BLOCKS):
            a, b, matches = surviving_in_block(group, percent)
            raw, cls = group.column("shingles"), group.column("cls").to_numpy()
            shingles = {int(i): np.frombuffer(raw[int(i)].as_buffer(), np.uint64) for i in np.union1d(a, b)}
            root = group.column("root").to_numpy().tolist()
            above = {x: x for x in root}

            def top(x):
                while above[x] != x:
                    above[x] = x = above[above[x]]
                return x

            links = []
            for k in np.argsort(-matches, kind="stable").tolist():
                i, j = int(a[k]), int(b[k])
                x, y = top(root[i]), top(root[j])
                if x != y and similar(shingles[i], shingles[j], percent):
                    above[x] = y
                    links.append((int(cls[i]), int(cls[j])))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)], names=["a", "b"])

    own = rows.join(sets, "cls").select(*[x.split()[0] for x in BLOCK_ROWS.split(", ")], "shingles")
    return arrow_map(own.repartition(*BLOCKS).sortWithinPartitions(*BLOCKS), run, "a long, b long")


# ---------------------------------------------------------------- the operator

def class_table(feats: DataFrame) -> DataFrame:
    """(cls, doc_id, n, sig, shared): shared where sets of different digests have this number."""
    return staged(feats.where("cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"), F.first("sig").alias("sig"),
        (F.min("second") != F.max("second")).alias("shared")), "classes")


def classes_and_components(docs: DataFrame, doc_id: str, text: str, size: int,
                           percent: int) -> tuple[DataFrame, DataFrame, ClassNumbers]:
    """(doc_id, n_shingles, cls) for every row, (cls, n, component_id) for every class, and how classes are numbered."""
    numbers = ClassNumbers(CLASS_BITS)
    feats = staged(signatures(docs, doc_id, text, size, numbers), "signatures")
    reps = class_table(feats)
    shared = [r.cls for r in reps.where("shared").select("cls").collect()]  # n^2 / 2^65: three of 10^10 sets
    if shared:
        numbers = ClassNumbers(CLASS_BITS, frozenset(shared))
        feats = feats.withColumn("cls", F.when(F.col("cls").isin(shared), F.col("second")).otherwise(F.col("cls")))
        reps = class_table(feats)
    rows = band_rows(reps)
    buckets = rows.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("cls").alias("hub")).where("n > 1")
    members = staged(rows.join(buckets, "band").select("band", "cls", "hub"), "buckets")
    sigs = staged(reps.join(members.select("cls"), "cls", "left_semi").select("cls", "sig"), "active")

    votes = members.where("cls != hub").groupBy("cls", "hub").agg(F.count(F.lit(1)).alias("bands"))
    best = votes.groupBy(F.col("cls").alias("b")).agg(F.max(F.struct("bands", "hub")).alias("best"))
    stars = surviving(best.select(F.col("best.hub").alias("a"), "b"), sigs, percent)
    stars = staged(stars, "star-pairs")
    both_ends = stars.select(F.col("a").alias("cls")).unionByName(stars.select(F.col("b").alias("cls")))
    sets = shingle_table(both_ends, reps, docs, doc_id, text, size, numbers)
    links = staged(verified_pairs(stars, sets, percent), "star-links")
    # each text points to its verified hub: enough to leave most pairs of one component out
    pointers = links.select(F.col("b").alias("cls"), F.col("a").alias("root"))
    grouped = members.select("band", "cls").join(pointers, "cls", "left").select("band", "cls", F.coalesce("root", "cls").alias("root"))
    doubt = staged(members_in_doubt(block_rows(staged(grouped, "bucket-roots"), sigs), percent), "in-doubt")
    sets = shingle_table(doubt.select("cls"), reps, docs, doc_id, text, size, numbers)
    more = staged(verified_in_blocks(doubt, sets, percent), "block-links")
    roots = components(links.unionByName(more), "a", "b")

    rooted = (reps.join(roots, reps["cls"] == roots["node"], "left")
              .select("cls", "n", "doc_id", F.coalesce("root", "cls").alias("root")))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return feats.select("doc_id", "n_shingles", "cls"), staged(rooted.join(least, "root").select(
        "cls", "n", "component_id"), "components"), numbers


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row."""
    feats, found, _ = classes_and_components(docs, doc_id, text, size, percent)
    of = F.coalesce("component_id", "doc_id")
    return feats.join(found.select("cls", "component_id"), "cls", "left").select(
        F.nullif("doc_id", F.lit(NULL_ID)).alias("doc_id"), "n_shingles",
        F.nullif(of, F.lit(NULL_ID)).alias("component_id"), (F.col("doc_id") == of).alias("kept"))


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = PERCENT, doc_id: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay (the least id of each component), all columns unchanged.

    Only rows that a Bloom filter of the dropped ids can't clear are joined."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    feats, found, numbers = classes_and_components(docs, doc_id, text, size, percent)
    gone = staged(feats.join(found, "cls").where("doc_id != component_id").select(
        F.col("doc_id").alias("__llm_id"), F.col("cls").alias("__llm_cls")).distinct(), "dropped")
    hashes, n_gone = gone.select(F.xxhash64("__llm_id").alias("h")), gone.count()
    maybe = member_filter(hashes, "h", n_gone)
    test = member_filter(hashes, "h", n_gone, raw=True)

    @F.arrow_udf("doubt boolean, cls long")
    def checked(h: pa.Array, texts: pa.Array) -> pa.Array:
        """Whether a text's id may be dropped, and the text's class if so."""
        doubt = test(h.to_numpy().view(np.uint64))
        batch = pa.RecordBatch.from_arrays([texts.filter(pa.array(doubt))], names=["text"])
        keys = iter([numbers.of(x) for part in slices(iter([batch])) for x in shingle_sets(part.column(0), size)])
        cls = pa.array([next(keys) if x else None for x in doubt], pa.int64())
        return pa.StructArray.from_arrays([pa.array(doubt), cls], names=["doubt", "cls"])

    h, key = F.xxhash64(id_key(doc_id)), "__llm_key"
    # "nondeterministic" keeps the optimizer from evaluating it once for the filter and once for the key
    in_doubt = docs.withColumn(key, checked.asNondeterministic()(h, text_of(text))).where(f"{key}.doubt")
    stays = in_doubt.withColumns({"__llm_id": id_key(doc_id), "__llm_cls": F.col(f"{key}.cls")}).join(
        gone, ["__llm_id", "__llm_cls"], "left_anti").select(*columns)
    return docs.where(~maybe(h)).unionByName(stays)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


OP3_SQL = components_sql(SHINGLE, PERCENT, ", doc_id <= coalesce(v, doc_id) AS kept")
