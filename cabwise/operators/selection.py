"""Exact-size stratified split: the first floor(fraction * n) rows of every label by a hash.

Ranking each label's rows would bring a label to one task. Instead the place of
the cut is searched in the hash space: rows are counted by label and by the
next ``BITS`` bits of the hash (a partial aggregate: one row a cell, label and
task), the running count tells in which cell a label's cut falls, and only
that cell is looked into further. When the cells that hold the cuts have at
most ``CELL_ROWS`` rows together (two rounds for 10^9 rows a label) their hashes are
counted in order, which gives every label the hash of its first row behind the
cut. Each other row is decided where it is, by comparing hashes; only rows *at*
a cut's hash, which are repetitions of one key, move, and are numbered by prefix
sums (``operators/numbering``).

Cuts and counts stay tables throughout (there may be many labels); their joins
are left to Spark, which broadcasts a written table by its size in bytes.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabwise.operators.numbering import with_numbers
from cabwise.plans.lineage import staged

BITS, DEPTH = 12, 5          # five rounds see 60 bits of the hash
CELL_ROWS = 1_000_000
HASH, PREFIX = "__hash", "__prefix"


def row_hash(key: str, seed: int) -> Column:
    """md5 of seed ':' key, in hexadecimal; a null key counts as the empty text."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))))


def _cell(level: int) -> Column:
    """The first ``BITS`` * (level + 1) bits of the hash."""
    return F.shiftright(F.col(PREFIX), BITS * (DEPTH - 1 - level))


def _cuts(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """(label, cell, before): the cell that each label's cut falls in, and how many rows
    of the target lie before it. Labels whose target is all they have get no cell."""
    order = Window.partitionBy("label").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    running = cells.withColumn("earlier", F.coalesce(F.sum("n").over(order), F.lit(0)))  # 4096 cells a label
    return (running.join(targets, "label").where((F.col("earlier") <= F.col("left")) & (F.col("left") < F.col("earlier") + F.col("n")))
            .select("label", "cell", (F.col("left") - F.col("earlier")).alias("left"), "n"))


def cut_hashes(rows: DataFrame, fraction: Decimal | float | str, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(label, hash, take): of every label the hash of the first row that isn't
    wanted whole, and how many of the rows with this very hash are.

    ``rows`` has ``label`` and ``__hash``. A label without a row here is wanted whole."""
    share = Decimal(str(fraction))
    if not 0 <= share <= 1:
        raise ValueError("a fraction lies between 0 and 1")
    keyed = rows.select("label", HASH, F.conv(F.substring(HASH, 1, BITS * DEPTH // 4), 16, 10).cast("long").alias(PREFIX))
    counted = keyed.groupBy("label", _cell(0).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    counted = staged(counted, "split-cells")
    size = F.sum("n").cast("decimal(20,0)")
    targets = counted.groupBy("label").agg(F.floor(size * F.lit(share)).cast("long").alias("left"))
    cuts = staged(_cuts(counted, targets), "split-cuts")
    level = 0
    while level < DEPTH - 1 and (cuts.agg(F.sum("n")).first()[0] or 0) > cell_rows:
        inside = keyed.withColumn("at", _cell(level)).join(cuts.select("label", F.col("cell").alias("at")), ["label", "at"], "left_semi")
        level += 1
        cells = inside.groupBy("label", _cell(level).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
        cuts = staged(_cuts(cells, cuts.select("label", "left")), "split-cuts")
    inside = keyed.withColumn("cell", _cell(level)).join(cuts.select("label", "cell", "left"), ["label", "cell"])
    # equal hashes are one row with a count: a key that repeats often is no long run
    hashes = inside.groupBy("label", HASH, "left").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("label").orderBy(HASH).rowsBetween(Window.unboundedPreceding, -1)
    placed = hashes.withColumn("earlier", F.coalesce(F.sum("n").over(order), F.lit(0)))  # one cell a label
    return placed.where((F.col("earlier") <= F.col("left")) & (F.col("left") < F.col("earlier") + F.col("n"))).select(
        "label", F.col(HASH).alias("hash"), (F.col("left") - F.col("earlier")).alias("take"))


def exact_split_flag(df: DataFrame, fraction: Decimal | float | str = "0.75", seed: int = 1234, key: str = "doc_id",
                     label_col: str = "label", cell_rows: int = CELL_ROWS) -> DataFrame:
    """``df`` with ``is_train``: true for exactly floor(fraction * n) rows of each
    label, those with the least hashes of their key.

    Rows that repeat a key have one hash; where the cut falls among them, any of
    them fill the number. Rows without a label are never taken. ``df`` must give
    the same rows whenever it is read."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    label = F.col(f"`{label_col}`")
    hashed = row_hash(key, seed)
    cuts = staged(cut_hashes(df.where(label.isNotNull()).select(label.alias("label"), hashed.alias(HASH)), fraction, cell_rows), "split-cut")
    placed = df.withColumn(HASH, hashed).join(cuts.toDF("__label", "__cut", "__take"), label == F.col("__label"), "left")
    before = label.isNotNull() & (F.col("__cut").isNull() | (F.col(HASH) < F.col("__cut")))
    at = F.coalesce(F.col(HASH) == F.col("__cut"), F.lit(False))
    decided = placed.where(~at | (F.col("__take") == 0)).select(*columns, F.coalesce(before & ~at, F.lit(False)).alias("is_train"))
    # the repetitions of the keys at the cuts: any of them, so a random order spreads many of them over ranges
    tied = with_numbers(placed.where(at & (F.col("__take") > 0)).select(*columns, "__label", "__take"), [F.col("__label"), F.rand(7)], "__number")
    first = tied.groupBy("__label").agg(F.min("__number").alias("__first"))
    filled = tied.join(first, "__label").select(*columns, (F.col("__number") - F.col("__first") < F.col("__take")).alias("is_train"))
    return decided.unionByName(filled)


def exact_split(df: DataFrame, fraction: Decimal | float | str = "0.75", seed: int = 1234, key: str = "doc_id",
                label_col: str = "label") -> tuple[DataFrame, DataFrame]:
    """(train, test): written once, so that both see the same rows."""
    flagged = staged(exact_split_flag(df, fraction, seed, key, label_col), "split")
    return flagged.where("is_train").drop("is_train"), flagged.where("NOT is_train").drop("is_train")
