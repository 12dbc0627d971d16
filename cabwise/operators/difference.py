"""EXCEPT DISTINCT by row digests: what is taken away never moves.

``classify.except_distinct`` sends the whole rows of both sides through one
exchange. Here 128-bit digests of the rows take their place:

1. The digests of both sides are aggregated (partially in each task). Those
   that no row of ``taken`` has are written: 16 bytes for each row that stays.
2. One bit is set for each of them in a bitmap of ``FILTER_BITS`` bits at most,
   in segments of 32,768 bits. A LIMIT bounds the number of segments, which are
   broadcast. Rows of ``all_rows`` whose bit isn't set are dropped where they are read.
3. The rows left are joined to the written digests, and one of each digest stays:
   only these rows cross an exchange, and no row of ``taken`` ever does. A bitmap
   too small for its digests lets more rows through to the join; no result changes.

Equal rows have equal digests, null being equal to null, 0.0 to -0.0 (either may be
the one that stays) and NaN to NaN as in EXCEPT. Spark's hash passes over nulls and the borders of arrays, so
these are hashed along as values of their own. Two different rows of equal
digest would need 128 equal bits: the chance is 10^-17 for 10^11 rows.

Empty ``all_rows``: empty result; empty ``taken``: the distinct rows. Both inputs
must give the same rows whenever they are read (stored tables).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from cabwise.plans.lineage import staged

SEGMENT_BITS = 32_768                # of Spark's bitmap_construct_agg
FILTER_BITS = 1 << 27                # 16 MB
BITS_PER_ROW = 8
FIRST, SECOND = "__digest_1", "__digest_2"
KEYS = [FIRST, SECOND]


def _shape(col: Column, kind: DataType) -> list[Column]:
    """What Spark's hash doesn't see of a value: nulls, and where arrays end."""
    if isinstance(kind, StructType):
        return [F.isnull(col)] + [x for f in kind for x in _shape(col.getField(f.name), f.dataType)]
    if isinstance(kind, ArrayType) and not isinstance(kind.elementType, (ArrayType, StructType, MapType, VariantType)):
        return [F.coalesce(F.array_size(col), F.lit(-1)), F.transform(col, F.isnull)]
    if isinstance(kind, (ArrayType, MapType, VariantType)):
        raise TypeError(f"rows with {kind.simpleString()} have no digest; take classify.except_distinct")
    return [F.isnull(col)]


def with_digest(df: DataFrame) -> DataFrame:
    """Two 64-bit hashes of each row, and the row as a struct ``__row`` (no name in it can clash)."""
    parts = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        parts += [col, *_shape(col, field.dataType)]
    return df.select(F.xxhash64(F.lit(1), *parts).alias(FIRST), F.xxhash64(F.lit(2), *parts).alias(SECOND),
                     F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("__row"))


def segment_count(rows: int, filter_bits: int = FILTER_BITS) -> int:
    """A power of two: ``BITS_PER_ROW`` bits a row, ``filter_bits`` at most."""
    most = max(1, filter_bits // SEGMENT_BITS)
    return min(1 << max(0, (rows * BITS_PER_ROW - 1) // SEGMENT_BITS).bit_length(), 1 << (most.bit_length() - 1))


def _bit(segments: int) -> Column:
    """From 1, as Spark counts the bits of its segments."""
    return F.pmod(FIRST, F.lit(segments * SEGMENT_BITS)) + 1


def likely_members(rows: DataFrame, digests: DataFrame, segments: int) -> DataFrame:
    """Those of ``rows`` whose bit one of ``digests`` has set: all members, and few others."""
    bitmaps = digests.select(F.bitmap_bucket_number(_bit(segments)).alias("__segment"),
                             F.bitmap_bit_position(_bit(segments)).alias("__place"))
    bitmaps = bitmaps.groupBy("__segment").agg(F.bitmap_construct_agg("__place").alias("__bitmap")).limit(segments)
    place = F.bitmap_bit_position(_bit(segments)).cast("int")
    byte = F.conv(F.hex(F.substring("__bitmap", F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    tested = rows.withColumn("__segment", F.bitmap_bucket_number(_bit(segments))).join(F.broadcast(bitmaps), "__segment")
    return tested.where(F.getbit(byte, place.bitwiseAND(F.lit(7))) == 1).select(*rows.columns)


def except_by_digest(all_rows: DataFrame, taken: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """The distinct rows of ``all_rows`` that aren't in ``taken``."""
    columns = all_rows.columns
    rows = with_digest(all_rows)
    taken = taken.select(*(F.col(f"`{c}`").cast(all_rows.schema[c].dataType).alias(c) for c in columns))
    marked = rows.select(*KEYS, F.lit(False).alias("__taken")).unionByName(
        with_digest(taken).select(*KEYS, F.lit(True).alias("__taken")))
    stays = marked.groupBy(*KEYS).agg(F.max("__taken").alias("__taken")).where("NOT __taken").select(*KEYS)
    stays = staged(stays, "row-digests")
    likely = likely_members(rows, stays, segment_count(stays.count(), filter_bits))
    # an inner join (the digests are distinct): a semi-join would be moved below the bitmap's
    return likely.join(stays, KEYS).dropDuplicates(KEYS).select("__row.*")
