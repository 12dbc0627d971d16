"""Filter interaction audit: what each of five filters removes, in every order.

1. The files of the document table arrive as micro-batches of an available-now
   stream. Four filters look at one text only (built-in functions); the fifth,
   E, asks whether a smaller id has the same text.
2. Within a task, rows with equal texts are settled first: those that are not
   the least id of them fail E for certain and leave as counts. So however many
   copies a text has, a task sends one row of it (rows that repeat the least id
   are one row with a count) and a few counts.
3. Keyed state holds, for every text (128 bits of its SHA-256), the least id so
   far and the parts and labels of its rows. When a smaller id arrives, the state
   moves to it and *retracts* what it had counted: minus one at the old mask,
   plus one at the mask with E. One state entry has the texts whose digests
   begin alike, about ``TEXTS`` of them: a call a text takes some 10 ms.
4. Each micro-batch adds its changes (part, mask, labels, n) to the part
   counters, in a folder named after the batch: a batch that runs again after a
   crash replaces its own changes. State and offsets lie in the shared folder; a
   run with the same folders goes on with new files only.
5. The counters' sum has at most 128 rows a part. Each filter is looked at
   behind each of the 16 sets of filters that may stand before it; the 120
   orders take their rows from there.

Defined results: a null text is an empty one, a null part the empty string. A
null id sorts after all ids. Rows that repeat an id and a text are equals: E
fails for none of them on their account. A document with several label rows is
good (toxic) if one of them says so; without labels it is neither. Columns
beside the ones named are not read. Empty input: empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cabwise.llm.common import SPACES, arrow_map, id_key, text_of
from cabwise.plans.lineage import tracked_path

LETTERS = "ABCDE"
REPEATED = 1 << LETTERS.index("E")
#: Micro-batches of one run over a table that is there already.
BATCHES = 4
#: Rows that a task settles among themselves at once.
SETTLE_ROWS = 1 << 17
#: Texts in one group of state: a call of Python a group and batch, not a text.
TEXTS = 1024
SETTLED = "+"  # begins the keys of counts that need no state; digests are hexadecimal
COUNTERS = "part string, mask int, good int, toxic int, n long"
ROCKS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
         "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256"}


# ---------------------------------------------------------------- one text

def text_mask(text: Column) -> Column:
    """The bits of the filters A to D that a text fails."""
    words = F.array_remove(F.split(text, f"[{SPACES}]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [n < 200, 100 * distinct.cast("long") < 50 * n.cast("long"),
             100 * capitals.cast("long") > 3 * F.char_length(text).cast("long"), text.rlike("[#$%&*|]")]
    bits = [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)]
    return sum(bits[1:], bits[0])


def label_flags(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic): one row an id."""
    says = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0))
    return (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("label_id"))
            .agg(says("quality").alias("good"), says("toxic").alias("toxic")))


def features(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, part: str) -> DataFrame:
    """(key, id, part, mask, good, toxic): no text goes further than this."""
    own = docs.select(F.substring(F.sha2(text_of(f"`{text}`"), 256), 1, 32).alias("key"), id_key(f"`{doc_id}`").alias("id"),
                      F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                      text_mask(text_of(f"`{text}`")).alias("mask"))
    return own.join(label_flags(labels), F.col("id") == F.col("label_id"), "left").select(
        "key", "id", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


# ---------------------------------------------------------------- settled within a task

SAME = ["key", "id", "part", "mask", "good", "toxic"]
COUNTED = ["part", "mask", "good", "toxic"]
ROW = "key string, id long, part string, mask int, good int, toxic int, n long"


def settle(rows: pa.Table) -> pa.Table:
    """One row for each least id of a text, and counts of all rows that fail E for certain."""
    keys = rows.column("key").combine_chunks().dictionary_encode()
    code, ids = keys.indices.to_numpy(), rows.column("id").to_numpy()
    least = np.full(len(keys.dictionary), np.iinfo(np.int64).max)
    np.minimum.at(least, code, ids)
    first = pa.array(ids == least[code])
    kept = rows.filter(first).group_by(SAME).aggregate([([], "count_all")])
    rest = rows.filter(pc.invert(first)).group_by(COUNTED).aggregate([([], "count_all")])
    labels = [f"{SETTLED}{x['mask']}{x['good']}{x['toxic']}{x['part']}" for x in rest.select(COUNTED).to_pylist()]
    rest = rest.append_column("key", pa.array(labels, pa.string())).append_column("id", pa.array(np.zeros(len(labels), np.int64)))
    return pa.concat_tables([pa.table([t.column(c) for c in (*SAME, "count_all")], names=[*SAME, "n"]) for t in (kept, rest)])


def settled_rows(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= SETTLE_ROWS:
                yield from settle(pa.Table.from_batches(held)).to_batches()
                held, size = [], 0
        if size:
            yield from settle(pa.Table.from_batches(held)).to_batches()

    return arrow_map(rows, run, ROW)


# ---------------------------------------------------------------- keyed state

def summed(rows: pa.Table, by: list[str]) -> pa.Table:
    out = rows.group_by(by).aggregate([("n", "sum")])
    return pa.table([out.column(c) for c in (*by, "n_sum")], names=[*by, "n"])


def with_mask(rows: pa.Table, mask: np.ndarray, sign: int = 1) -> pa.Table:
    columns = [rows.column("part"), pa.array(mask.astype(np.int32)), rows.column("good"), rows.column("toxic"),
               pa.array(sign * rows.column("n").to_numpy())]
    return pa.table(columns, names=[*COUNTED, "n"])


def least_ids(held: pa.Table | None, arrived: pa.Table) -> tuple[pa.Table, pa.Table]:
    """The rows of each text's least id, from those held and those that arrived,
    and the changes of the counts: new rows, and retractions of held ones."""
    both = arrived if held is None else pa.concat_tables([held, arrived])
    old = np.arange(both.num_rows) < both.num_rows - arrived.num_rows
    keys = both.column("key").combine_chunks().dictionary_encode()
    code, ids, mask = keys.indices.to_numpy(), both.column("id").to_numpy(), both.column("mask").to_numpy()
    least = np.full(len(keys.dictionary), np.iinfo(np.int64).max)
    np.minimum.at(least, code, ids)
    first = ids == least[code]
    lost, new = old & ~first, ~old
    gone = both.filter(pa.array(lost))
    fresh = both.filter(pa.array(new))
    changes = pa.concat_tables([
        with_mask(gone, mask[lost], -1), with_mask(gone, mask[lost] | REPEATED),
        with_mask(fresh, np.where(first[new], mask[new], mask[new] | REPEATED))])
    return summed(both.filter(pa.array(first)), SAME), summed(changes, COUNTED)


def update_texts(bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Changes of the part counters by the rows of one group of texts."""
    rows = pa.concat_tables([pa.table([pa.array(f[c]) for c in (*SAME, "n")], names=[*SAME, "n"]) for f in frames])
    if bucket[0].startswith(SETTLED):
        yield summed(with_mask(rows, rows.column("mask").to_numpy() | REPEATED), COUNTED).to_pandas()
        return
    held = pa.ipc.open_stream(state.get[0]).read_all() if state.exists else None
    kept, changes = least_ids(held, rows)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, kept.schema) as out:
        out.write_table(kept)
    state.update((sink.getvalue().to_pybytes(),))
    yield changes.to_pandas()


# ---------------------------------------------------------------- the stream

def part_counters(spark: SparkSession, source: str, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  part: str = "lang", batches: int = BATCHES, folder: str | None = None, conf: dict | None = None,
                  digits: int | None = None) -> DataFrame:
    """(part, mask, good, toxic, n) of the Parquet table ``source``.

    ``folder`` keeps the changes, the state and the offsets: with the same one
    and the same ``digits``, a later run reads only files that are new.
    ``digits`` of a text's digest name its group; by default so many that a group
    has ``TEXTS`` texts at most on average. ``conf`` holds settings of the state
    store for this run, as :data:`ROCKS`: state on the executors' disks for tables
    whose texts (about 60 bytes each) exceed their memory. RocksDB sets 4 MB of
    disk aside for each partition, so that it isn't the default."""
    table = spark.read.parquet(source)
    files = max(1, len(table.inputFiles()))
    if digits is None:  # the row count comes from the files' footers
        digits = max(1, math.ceil(math.log(max(1, table.count() / TEXTS), 16)))
    folder = folder or tracked_path(spark, "filter-audit")
    changes = f"{folder}/changes"

    def publish(batch: DataFrame, number: int) -> None:
        (batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
         .write.mode("overwrite").parquet(f"{changes}/batch={number:012d}"))

    # a stream can't take a single file by its plain name: a pattern that only this name fits takes files and folders
    name = source.rstrip("/")
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", -(-files // batches)).parquet(
        f"{name[:-1]}[{name[-1]}]")
    rows = settled_rows(features(stream, labels, doc_id, text, part))
    bucket = F.when(F.col("key").startswith(SETTLED), F.col("key")).otherwise(F.substring("key", 1, digits))
    moved = rows.withColumn("bucket", bucket).groupBy("bucket").applyInPandasWithState(
        update_texts, COUNTERS, "texts binary", "append", GroupStateTimeout.NoTimeout)
    settings = conf or {}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        query = (moved.writeStream.outputMode("append").foreachBatch(publish)
                 .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(changes)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], COUNTERS)  # no rows, no batch
    return (spark.read.schema(COUNTERS).parquet(changes).groupBy("part", "mask", "good", "toxic")
            .agg(F.sum("n").alias("n")).where("n != 0"))


# ---------------------------------------------------------------- all orders

def orders() -> list[tuple[int, int, str, int]]:
    """(filter, filters before it, order, step) of every step of every order: 600 rows."""
    out = []
    for order in permutations(range(len(LETTERS))):
        name = "".join(LETTERS[i] for i in order)
        out += [(1 << f, sum(1 << i for i in order[:k]), name, k + 1) for k, f in enumerate(order)]
    return out


def interactions(counters: DataFrame) -> DataFrame:
    """The audit's rows from the part counters."""
    n_filters = len(LETTERS)
    places = sorted({(f, before) for f, before, _, _ in orders()})  # 80
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.lit(b).alias("before"),
                                        F.lit(math.factorial(bin(b).count("1")) * math.factorial(n_filters - 1 - bin(b).count("1"))).alias("times"))
                               for f, b in places]))
    rows = counters.select("*", each.alias("at")).select("part", "mask", "good", "toxic", "n", "at.*")
    fails, earlier = F.col("mask").bitwiseAND(F.col("f")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long")
    placed = rows.groupBy("part", "f", "before", "times").agg(
        total(~fails & ~earlier).alias("kept"), total(fails & ~earlier).alias("removed"), total(fails & earlier).alias("redundant"),
        total(F.col("mask") == F.col("f")).alias("unique_fails"),
        total(fails & ~earlier & (F.col("good") == 1)).alias("good_lost"),
        total(fails & ~earlier & (F.col("toxic") == 1)).alias("toxic_lost"))
    shares = placed.groupBy("part", "f").agg(F.sum(F.col("removed") * F.col("times")).cast("long").alias("shapley"))
    table = counters.sparkSession.createDataFrame(orders(), "f int, before int, filter_order string, step int")
    return placed.join(shares, ["part", "f"]).join(F.broadcast(table), ["f", "before"]).select(  # 600 rows
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def filter_audit(spark: SparkSession, source: str, labels: DataFrame, **options) -> DataFrame:
    """The audit of a Parquet table; options as in :func:`part_counters`."""
    return interactions(part_counters(spark, source, labels, **options))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(spark, f"{sf_dir}/documents.parquet", spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP13_SQL = r"""
WITH docs AS (
  SELECT coalesce(doc_id, 9223372036854775807) AS id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
flags AS (SELECT doc_id AS id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY 1),
masked AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CAST(len(words) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INT)
         + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS INT)
         + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT)
         + 16 * CAST(docs.id > min(docs.id) OVER (PARTITION BY text) AS INT) AS mask
  FROM docs LEFT JOIN flags ON flags.id = docs.id),
counters AS (SELECT part, mask, good, toxic, count(*) AS n FROM masked GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS f),
perms AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.f, b.f, c.f, d.f, e.f] AS fs
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.f | b.f | c.f | d.f | e.f = 31),
steps AS (SELECT filter_order, CAST(s AS INTEGER) AS step, fs[s] AS f, coalesce(list_sum(fs[1:s - 1]), 0)::INT AS before
          FROM perms, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
found AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN mask & (f | before) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & f <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & f <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = f THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & f <> 0 AND mask & before = 0 AND good = 1 THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & f <> 0 AND mask & before = 0 AND toxic = 1 THEN n ELSE 0 END) AS toxic_lost
  FROM counters, steps GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM found"""
