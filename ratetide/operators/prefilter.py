"""Semi-join of a large table against a smaller set of keys without shuffling
the large table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 32768    # bits of one bitmap row
MAX_BITS = 1 << 28     # 32 MB in all


def _with_bitmap(df: DataFrame, keys: DataFrame, key: str, max_bits: int, how: str) -> tuple[DataFrame, Column]:
    """``df`` joined with a broadcast bitmap of 16 bits per key, up to ``max_bits``,
    and the condition that a row's bit is set."""
    n = max(1, keys.count())
    bits = min(max_bits, max(BUCKET_BITS, 1 << (16 * n).bit_length()))
    place = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    bitmap = (keys.select(place.alias("_place"))
              .groupBy(F.bitmap_bucket_number("_place").alias("_bucket"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits")))
    marked = df.withColumn("_bucket", F.bitmap_bucket_number(place)).withColumn("_bit", F.bitmap_bit_position(place))
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright("_bit", 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("getbit", byte, F.pmod("_bit", F.lit(8)).cast("int"))
    return marked.join(F.broadcast(bitmap), "_bucket", how), bit == 1


def mark_few(df: DataFrame, keys: DataFrame, key: str, out: str = "_likely", max_bits: int = MAX_BITS) -> DataFrame:
    """``df`` with a flag ``out``: false where ``key`` is surely not in ``keys``.
    Nothing of ``df`` is shuffled.  ``keys`` is read twice: pass a written table."""
    marked, likely = _with_bitmap(df, keys, key, max_bits, "left")
    return marked.select(*df.columns, F.coalesce(likely, F.lit(False)).alias(out))


def likely_few(df: DataFrame, keys: DataFrame, key: str, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows of ``df`` whose ``key`` (null-safe) may be in ``keys``: all that are, and
    few others.  For a join that follows; ``keys`` is read twice."""
    marked, bit_set = _with_bitmap(df, keys, key, max_bits, "inner")
    return marked.filter(bit_set).select(*df.columns)


def semi_join_few(df: DataFrame, keys: DataFrame, key: str, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows of ``df`` whose ``key`` (null-safe) is in ``keys``.

    A bitmap with 16 bits per key, up to ``max_bits``, is broadcast and drops
    nearly all other rows where they are read, so the exact join that follows
    shuffles the likely ones only.  Where the bitmap is too small for the keys
    more rows are shuffled; the result is the same.  ``keys`` is read twice:
    pass a written table."""
    likely = likely_few(df, keys, key, max_bits)
    # an inner join with distinct keys: the optimizer would push a semi-join
    # below the bitmap, onto the whole table
    wanted = keys.select(F.col(key).alias("_wanted")).distinct()
    return likely.join(wanted, F.col(key).eqNullSafe(F.col("_wanted"))).drop("_wanted")
