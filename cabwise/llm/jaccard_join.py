"""N-gram Jaccard join with adaptive multi-match prefixes.

A set's tokens (64-bit hashes of its distinct word shingles) are kept in
ascending order. Two sets of similarity 80 % share at least 8/9 of the smaller
one and 8/10 of the larger one, so that for every l >= 1 the first
``least(y) + l`` tokens of the smaller set y and the first ``spare(x) + l`` tokens of
the larger one x have at least l tokens in common.

1. Texts with equal sets (128-bit digest) are one class. Its *head*, three tenths
   of its tokens, is indexed: tokens that two classes have are *shared*.
2. Every class is compared with two hubs, the ones that most of its tokens elect:
   two pairs a class, however many classes share a token. The heads bound what
   a pair can have in common; survivors are verified on full sets. Links
   found make roots; tokens that only one root has are of no further use.
3. Each class chooses its l: the prefix is lengthened token by token, and the
   l - 1 tokens that most classes hold need not be looked up, since l matches
   can't all be among them. The cost is the number of index entries behind the
   other tokens. A class with fewer than l tokens left has no partner: most
   classes end here, for their own text thins out what they share with others.
4. The classes that are left, and those that hold one of the tokens they look up,
   get their full sets, and choose again from prefixes as long as they like.
5. Classes that looked-up tokens connect are compared in blocks of bounded
   bytes and equal size bands. A block counts the matches of each prefix at
   once (a product of incidence matrices), keeps the pairs with at least l, and
   verifies them on the full sets, likeliest first; a pair whose roots are
   joined already adds nothing. So no pair becomes a row unless it joins two
   roots, and none is left out: there is no cap.
6. All links give components.

Defined results: a null text is an empty one; a text without words has no
shingles and links with nothing; one with fewer words than a shingle is a single
shingle. A null id counts as the largest one. Rows that repeat an id keep
their own sets. Whole texts count, however long: a block's sides
hold sets of about ``BLOCK_BYTES``, or one set each if it is larger. Other columns aren't read.
Empty input: empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwise.llm.bloom import member_filter
from cabwise.llm.common import NULL_ID, arrow_map, column, documents, id_key, slices, sorted_groups, staged, text_of
from cabwise.llm.components import components, components_sql
from cabwise.llm.near_dedup import shingle_sets, similar
from cabwise.plans.lineage import intermediates

SHINGLE, PERCENT = 5, 80
#: Bytes of the full sets, and sets, on either side of a block.
BLOCK_BYTES, BLOCK_ROWS = 8 << 20, 1024
#: Columns of an incidence matrix at once.
COLUMNS = 1 << 13


# ---------------------------------------------------------------- prefixes

def least(size, percent: int):
    """Tokens that the smaller of two similar sets can spare."""
    return size - -(-2 * percent * size // (100 + percent))


def spare(size, percent: int):
    """Tokens that the larger one can spare."""
    return size - -(-percent * size // 100)


def head_length(size: int, percent: int) -> int:
    """Tokens in the index: the larger one's prefix for every l that a smaller set may choose at first."""
    return min(size, spare(size, percent) + 1 + most_extra(size, percent))


def most_extra(size: int, percent: int) -> int:
    """l - 1 at most, at first. Grows with the size: a larger partner's head is long enough."""
    return max(4, spare(size, percent) // 2)


def choose(size: int, positions: np.ndarray, counts: np.ndarray, percent: int, most: int) -> tuple[int, np.ndarray]:
    """(l, places of the tokens to look up) of least cost, for a set whose tokens
    at ``positions`` are held by ``counts`` classes, others by none of another root."""
    order = np.argsort(positions)
    positions, counts = positions[order], counts[order]
    best_cost, best = math.inf, (1, np.arange(0))
    ell = 1
    while ell <= most:
        within = int(np.searchsorted(positions, least(size, percent) + ell))
        if within < ell:
            return ell, np.arange(0)
        by_cost = np.argsort(counts[:within], kind="stable")[:within - ell + 1]
        cost = int(counts[by_cost].sum())
        if cost < best_cost:
            best_cost, best = cost, (ell, order[by_cost])
        ell += max(1, ell // 16)
    return best


# ---------------------------------------------------------------- classes

def digest_of(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def features(docs: DataFrame, doc_id: str, text: str, size: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, digest, head); digest and head are null without shingles."""
    def run(batches):
        for batch in slices(batches):
            sets = list(shingle_sets(column(batch, "text"), size))
            heads = [x[:head_length(len(x), percent)].tobytes() if len(x) else None for x in sets]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array([len(x) for x in sets], pa.int64()),
                 pa.array([digest_of(x) for x in sets], pa.binary()), pa.array(heads, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "head"])

    return arrow_map(docs.select(id_key(f"`{doc_id}`").alias("doc_id"), text_of(f"`{text}`").alias("text")), run,
                     "doc_id long, n_shingles long, digest binary, head binary")


def tokens_of(sets: DataFrame, name: str) -> DataFrame:
    """(token, cls, pos) of sorted tokens in a binary column."""
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                own = [np.frombuffer(x, np.int64) for x in column(part, name).to_pylist()]
                n = np.array([len(x) for x in own], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([np.zeros(0, np.int64), *own])), pa.array(np.repeat(column(part, "cls").to_numpy(), n)),
                     pa.array(np.concatenate([np.zeros(0, np.int32), *(np.arange(k, dtype=np.int32) for k in n)]))],
                    names=["token", "cls", "pos"])

    return arrow_map(sets.select("cls", name), run, "token long, cls long, pos int")


def shared_tokens(postings: DataFrame) -> DataFrame:
    """Those (token, cls, pos) whose token several classes have."""
    several = postings.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("token")
    return postings.join(several, "token")


def full_sets(classes: DataFrame, reps: DataFrame, docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """(cls, size, shingles) of the given classes, written: their documents' texts are read out again."""
    needed = staged(reps.select("cls", "size", "doc_id", "digest").join(classes.select("cls").distinct(), "cls"), "join-needed")
    maybe = member_filter(needed.select(F.xxhash64("doc_id").alias("h")), "h", needed.count(), raw=True)

    def run(batches):
        thinned = (b.filter(pa.array(maybe(column(b, "h").to_numpy().view(np.uint64)))) for b in batches)
        for batch in slices(thinned):
            own = list(shingle_sets(column(batch, "text"), size))
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest_of(x) for x in own], pa.binary()), pa.array([x.tobytes() for x in own], pa.binary())],
                names=["digest", "shingles"])

    found = arrow_map(docs.select(F.xxhash64(id_key(f"`{doc_id}`")).alias("h"), text_of(f"`{text}`").alias("text")), run,
                      "digest binary, shingles binary")
    return staged(found.join(needed.select("digest", "cls", "size"), "digest").groupBy("cls", "size").agg(
        F.first("shingles").alias("shingles")), "join-sets")


# ---------------------------------------------------------------- hubs

def rooted(frame: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``frame`` (with cls) and each class's root."""
    if roots is None:
        return frame.withColumn("root", F.col("cls"))
    return frame.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))


def compatible(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def hub_pairs(shared: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(a, b): each class with the hubs that most of its tokens elect. A token
    elects the first and the last class in the order of a hash."""
    member = shared.join(sizes, "cls").withColumn("m", F.struct(F.xxhash64("cls").alias("h"), "cls", "size"))
    elected = member.groupBy("token").agg(F.min("m").alias("low"), F.max("m").alias("high"))
    each = member.select("token", "cls", "size").join(elected, "token").select(
        "cls", "size", F.explode(F.array("low", "high")).alias("hub")).select("cls", "size", "hub.cls", "hub.size").toDF(
        "b", "size", "a", "hub_size")
    votes = each.where((F.col("a") != F.col("b")) & compatible("size", "hub_size", percent)).groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("votes"))
    ranked = votes.groupBy("b").agg(F.max(F.struct("votes", "a")).alias("x"), F.max_by("a", F.struct("votes", -F.col("a"))).alias("y"))
    return ranked.select("b", F.explode(F.array_distinct(F.array("x.a", "y"))).alias("a")).select("a", "b")


def reachable(pairs: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """Pairs whose heads allow the similarity: up to the smaller of the heads' last
    tokens both sets are known; behind it, all that is left may agree."""
    def run(batches):
        for batch in batches:
            get = lambda c: column(batch, c).to_pylist()
            keep = []
            for x, y, m, n in zip(get("x"), get("y"), get("m"), get("n")):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                last = min(x[-1], y[-1])
                x, y = x[:np.searchsorted(x, last, side="right")], y[:np.searchsorted(y, last, side="right")]
                both = len(np.intersect1d(x, y, assume_unique=True)) + min(m - len(x), n - len(y))
                keep.append((100 + percent) * both >= percent * (m + n))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    own = lambda k, s, z: heads.select(F.col("cls").alias(k), F.col("head").alias(s), F.col("size").alias(z))
    return arrow_map(pairs.join(own("a", "x", "m"), "a").join(own("b", "y", "n"), "b"), run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar."""
    def run(batches):
        for batch in batches:
            keep = [similar(*(np.frombuffer(z.as_buffer(), np.uint64) for z in xy), percent)
                    for xy in zip(column(batch, "x"), column(batch, "y"))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    own = lambda k, s: sets.select(F.col("cls").alias(k), F.col("shingles").alias(s))
    return arrow_map(pairs.join(own("a", "x"), "a").join(own("b", "y"), "b"), run, "a long, b long")


# ---------------------------------------------------------------- adaptive prefixes

def look_ups(shared: DataFrame, sizes: DataFrame, percent: int, whole: bool) -> DataFrame:
    """(token, cls, size, ell): what each class looks up. ``shared`` holds (token,
    cls, pos, root); ``whole`` says that its positions cover the full sets."""
    live = shared.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where(
        "low != high").select("token", "n")
    own = shared.join(live, "token").groupBy("cls").agg(F.collect_list(F.struct("token", "pos", "n")).alias("held"))

    def run(batches):
        for batch in batches:
            rows = {"token": [], "cls": [], "size": [], "ell": []}
            for cls, size, held in zip(*(column(batch, c) for c in ("cls", "size", "held"))):
                size, held = size.as_py(), held.values
                token, pos, n = (held.field(k).to_numpy() for k in range(3))
                most = size if whole else most_extra(size, percent) + 1
                ell, places = choose(size, pos, n, percent, min(most, max(1, size - least(size, percent))))
                rows["token"] += token[places].tolist()
                for k, v in (("cls", cls.as_py()), ("size", size), ("ell", ell)):
                    rows[k] += [v] * len(places)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema(
                [("token", pa.int64()), ("cls", pa.int64()), ("size", pa.int64()), ("ell", pa.int32())]))

    return arrow_map(own.join(sizes, "cls").select("cls", "size", "held"), run, "token long, cls long, size long, ell int")


def involved(asked: DataFrame, shared: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Classes that look something up, and those that hold such a token with a size in reach."""
    span = asked.groupBy("token").agg(F.min("size").alias("low"), F.max("size").alias("high"))
    holders = (shared.join(span, "token").select("cls", "low", "high").join(sizes, "cls")
               .where((F.col("size") >= F.col("low")) & (percent * F.col("size") <= 100 * F.col("high"))).select("cls"))
    return holders.unionByName(asked.select("cls")).distinct()


# ---------------------------------------------------------------- blocks

GROUP = ["cluster", "band", "askers", "holders"]


def band_of(size: Column, percent: int) -> Column:
    """Sizes within one factor of similarity: partners lie in the same band or the next."""
    return F.floor(F.log(size.cast("double")) / math.log(100 / percent) + 1e-9).cast("int")


def block_rows(asked: DataFrame, holders: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """One row for each block that a class takes part in: ``asks`` on the smaller
    side (with its l), or as a holder of looked-up tokens."""
    links = holders.join(asked.select("token").distinct(), "token").select("cls", F.xxhash64("token").alias("t"))
    # classes and looked-up tokens as the two sorts of nodes of one graph: class ids are even, tokens odd
    ends = links.select((F.col("cls") * 2).alias("u"), (F.col("t").bitwiseOR(F.lit(1))).alias("v"))
    clusters = components(ends, "u", "v")
    of = lambda c: clusters.where(F.col(c) % 2 == 0).select(F.shiftright(c, 1).alias("cls"), F.col("root").alias("cluster"))
    sized = staged(of("node").unionByName(of("root")).distinct().join(sets.select("cls", "size"), "cls").join(
        asked.groupBy("cls").agg(F.first("ell").alias("ell")), "cls", "left").withColumn("band", band_of(F.col("size"), percent)),
        "join-clusters")
    blocks = F.greatest(F.ceil(F.sum(8 * F.col("size")) / BLOCK_BYTES), F.ceil(F.count(F.lit(1)) / BLOCK_ROWS)).cast("int")
    # askers of a band meet the holders of the same and of the next one: both sides are cut
    asking = sized.where("ell IS NOT NULL").withColumn("band", F.explode(F.array("band", F.col("band") + 1)))
    n_ask = asking.groupBy("cluster", "band").agg(blocks.alias("n_askers"))
    n_hold = sized.groupBy("cluster", "band").agg(blocks.alias("n_holders"))
    grid = n_ask.join(n_hold, ["cluster", "band"])
    cut = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asking.join(grid, ["cluster", "band"]).select(
        "cluster", "band", cut("n_askers").alias("askers"), all_of("n_holders").alias("holders"), "cls", "ell")
    right = sized.join(grid, ["cluster", "band"]).select(
        "cluster", "band", all_of("n_askers").alias("askers"), cut("n_holders").alias("holders"), "cls", F.lit(None).cast("int").alias("ell"))
    return left.unionByName(right)


def matches(prefixes: list[np.ndarray], holders: list[np.ndarray]) -> np.ndarray:
    """How many tokens of each prefix each holder has."""
    out = np.zeros((len(prefixes), len(holders)), np.float32)
    wanted = np.unique(np.concatenate(prefixes))
    places = [np.searchsorted(wanted, x) for x in prefixes]
    found = []
    for x in holders:
        at = np.minimum(np.searchsorted(wanted, x), len(wanted) - 1)
        found.append(at[wanted[at] == x])
    held = np.bincount(np.concatenate(found), minlength=len(wanted)) > 0
    number = np.cumsum(held) - 1
    places, found = [number[p[held[p]]] for p in places], [number[p] for p in found]
    for start in range(0, int(held.sum()), COLUMNS):
        sides = []
        for rows in (places, found):
            m = np.zeros((len(rows), COLUMNS), np.float32)
            for i, p in enumerate(rows):
                m[i, p[(p >= start) & (p < start + COLUMNS)] - start] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out


def links_of(group: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links that join up all roots of a block which similar sets join."""
    get = lambda c: group.column(c).to_pylist()
    cls, root, ell, size = get("cls"), get("root"), get("ell"), np.array(get("size"))
    sets = [np.frombuffer(x, np.uint64) for x in get("shingles")]
    ask = [i for i, e in enumerate(ell) if e is not None]
    hold = [i for i, e in enumerate(ell) if e is None]
    if not ask or not hold:
        return []
    count = matches([sets[i][:least(len(sets[i]), percent) + ell[i]] for i in ask], [sets[j] for j in hold])
    small, large = size[ask][:, None], size[hold][None, :]
    order = np.array([cls[i] for i in ask])[:, None] < np.array([cls[j] for j in hold])[None, :]
    differ = np.array([root[i] for i in ask])[:, None] != np.array([root[j] for j in hold])[None, :]
    enough = count >= np.array([ell[i] for i in ask])[:, None]
    a, b = np.nonzero(enough & differ & (percent * large <= 100 * small) & ((small < large) | (small == large) & order))
    above = {r: r for r in root}

    def top(x):
        while above[x] != x:
            above[x] = x = above[above[x]]
        return x

    links = []
    for k in np.argsort(-(count[a, b] / size[ask][a]), kind="stable").tolist():
        i, j = ask[a[k]], hold[b[k]]
        x, y = top(root[i]), top(root[j])
        if x != y and similar(sets[i], sets[j], percent):
            above[x] = y
            links.append((cls[i], cls[j]))
    return links


def block_links(rows: DataFrame, sets: DataFrame, roots: DataFrame | None, percent: int) -> DataFrame:
    def run(batches):
        for group in sorted_groups(batches, GROUP):
            links = links_of(group, percent)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)], names=["a", "b"])

    own = rooted(rows, roots).join(sets, "cls").select(*GROUP, "cls", "root", "ell", "size", "shingles")
    return arrow_map(own.repartition(*GROUP).sortWithinPartitions(*GROUP), run, "a long, b long")


# ---------------------------------------------------------------- the operator

def roots_of(links: DataFrame) -> DataFrame:
    return staged(components(links, "a", "b").select(F.col("node").alias("cls"), "root"), "join-roots")


def jaccard_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE,
                    percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, digest) of every row, and (digest, component_id) of every class."""
    with intermediates() as first:
        found = staged(features(docs, doc_id, text, size, percent), "join-features")
    feats = staged(found.select("doc_id", "n_shingles", "digest"), "join-documents")
    # numbers of classes are fixed by being written
    reps = staged(found.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("size"), F.first("head").alias("head"))
        .withColumn("cls", F.monotonically_increasing_id()), "join-classes")
    first.release()
    sizes = reps.select("cls", "size")
    shared = staged(shared_tokens(tokens_of(reps, "head")), "join-shared")

    near = staged(reachable(hub_pairs(shared, sizes, percent), reps.select("cls", "size", "head"), percent), "join-hubs")
    ends = near.select(F.col("a").alias("cls")).unionByName(near.select(F.col("b").alias("cls")))
    links = staged(verified(near, full_sets(ends, reps, docs, doc_id, text, size), percent), "join-hub-links")
    roots = roots_of(links)

    asked = staged(look_ups(rooted(shared, roots), sizes, percent, whole=False), "join-asked")
    sets = full_sets(involved(asked, shared, sizes, percent), reps, docs, doc_id, text, size)
    whole = staged(rooted(shared_tokens(tokens_of(sets, "shingles")), roots), "join-shared-whole")
    # only classes that looked something up before may have a larger partner
    may_ask = asked.select("cls").distinct()
    asked = staged(look_ups(whole, sizes, percent, whole=True).join(may_ask, "cls", "left_semi"), "join-asked-whole")
    more = staged(block_links(block_rows(asked, whole, sets, percent), sets, roots, percent), "join-block-links")

    final = reps.select("cls", "digest", "doc_id").join(roots_of(links.unionByName(more)), "cls", "left").select(
        "digest", "doc_id", F.coalesce("root", "cls").alias("root"))
    smallest = final.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return feats, staged(final.join(smallest, "root").select("digest", "component_id"), "join-components")


def jaccard_join(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row; options as in :func:`jaccard_classes`."""
    feats, classes = jaccard_classes(docs, **options)
    return feats.join(classes, "digest", "left").select(
        F.nullif("doc_id", F.lit(NULL_ID)).alias("doc_id"), "n_shingles",
        F.nullif(F.coalesce("component_id", "doc_id"), F.lit(NULL_ID)).alias("component_id"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir))


OP12_SQL = components_sql(SHINGLE, PERCENT)
