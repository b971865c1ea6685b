"""Reproducible shuffle and sharding by a Feistel permutation of row numbers.

Rows get global numbers 0 .. n-1, a keyed Feistel network over Z_a x Z_b (the
smallest such grid of a*b >= n places, a = ceil(sqrt(n))) permutes them, and
cycle walking repeats it for the few places beyond n.  Place p is slot p div
shards of shard p mod shards, so shard sizes differ by one at most and where a
row lies can be computed from its number alone.

Numbers come from hash buckets: rows are counted per bucket, the buckets'
offsets are summed, and rows are ordered inside their bucket.  Rows that agree
in all key columns are one row with a count until the end, so repeated rows
never meet in one task; the numbers of a row with many copies are made in
chunks that are dealt over tasks.  Nulls are ordinary key values; rows that agree in all
key columns are interchangeable.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, let, quoted, written

ROUNDS = 6
CHUNK = 1 << 16       # copies of a row numbered by one task at once
BUCKET_ROWS = 1 << 20  # distinct rows of a bucket, about
WALKS = 64  # a walk beyond n ends at once with probability 1 - 1/sqrt(n); 64 in a row don't occur


def _div(number: Column, by: int) -> Column:
    """Whole-number division of a long, exact at any size."""
    return F.call_function("div", number, F.lit(by).cast("long"))


def feistel(number: Column, a: int, b: int, seed: int, rounds: int = ROUNDS) -> Column:
    """A permutation of 0 .. a*b-1: each round adds a hash of one half to the other."""
    def step(pair, i):
        noise = lambda x, m: F.pmod(F.xxhash64(F.lit(seed), F.lit(i), x), F.lit(m))
        left = lambda p: F.pmod(p.x + noise(p.y, a), F.lit(a))
        return let(pair, lambda p: let(left(p), lambda x: F.struct(
            x.alias("x"), F.pmod(p.y + noise(x, b), F.lit(b)).alias("y"))))

    low = F.pmod(number, F.lit(b))
    pair = F.struct(_div(number, b).alias("x"), low.cast("long").alias("y"))
    for i in range(rounds):
        pair = step(pair, i)
    return let(pair, lambda p: p.x * F.lit(b) + p.y)


def permute(number: Column, n: int, seed: int) -> Column:
    """The place of row ``number`` of ``n``: the permutation of the grid, walked
    on from places at n or beyond."""
    if n <= 1:
        return F.lit(0).cast("long")
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)
    walk = lambda p: F.when(p < n, p).otherwise(feistel(p, a, b, seed))
    walked = lambda p: F.when(p < n, p).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.lit(max(WALKS, min(a, 4096)))), p, lambda q, _: walk(q)))
    return let(let(feistel(number, a, b, seed), walked),
               lambda p: F.when(p < n, p).otherwise(F.raise_error(F.lit("cycle walking did not end"))))


def _copies(rows: DataFrame, columns: list[Column], number: str, copies: str) -> DataFrame:
    """A row for each copy, numbered from ``number`` on."""
    first, last = quoted(number), quoted(number) + quoted(copies) - 1
    few = rows.where(quoted(copies) <= CHUNK).select(*columns, F.explode(F.sequence(first, last)).alias(number))
    chunk, end = free_name(rows, "chunk"), free_name(rows, "end")
    chunks = (rows.where(quoted(copies) > CHUNK)
              .select(*columns, F.explode(F.sequence(first, last, F.lit(CHUNK).cast("long"))).alias(chunk), last.alias(end))
              .repartition(quoted(chunk)))
    many = chunks.select(*columns, F.explode(F.sequence(quoted(chunk), F.least(quoted(chunk) + CHUNK - 1, quoted(end)))).alias(number))
    return few.unionByName(many)


def shard(rows: DataFrame, keys: list[str], shards: int = 8, seed: int = 42, buckets: int | None = None) -> DataFrame:
    """``rows`` (the columns of ``keys`` only) with shard and slot (underscores are
    appended to a name that a key has).  The same rows, ``seed`` and ``buckets``
    give the same shuffle in any session; by default there are 1,024 buckets, and
    twice as many each time the distinct rows outgrow them."""
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    copies, bucket, first, number, shard_col, slot_col = (
        free_name(rows, x) for x in ("copies", "bucket", "first", "number", "shard", "slot"))
    columns = [quoted(k) for k in keys]
    distinct = written(rows.groupBy(*columns).agg(F.count("*").alias(copies)), "shard-rows")
    if buckets is None:
        buckets = max(1024, 1 << (distinct.count() // BUCKET_ROWS).bit_length())
    distinct = distinct.withColumn(bucket, F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(buckets)).cast("int"))
    sizes = distinct.groupBy(bucket).agg(F.sum(copies).alias("rows"))
    n = sizes.agg(F.sum("rows")).first()[0] or 0
    offsets = sizes.select(quoted(bucket), (F.sum("rows").over(Window.orderBy(bucket)) - F.col("rows")).alias(first))
    inside = Window.partitionBy(bucket).orderBy(*columns).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = (distinct.withColumn(number, F.sum(copies).over(inside) - quoted(copies))
               .join(offsets, bucket)  # as many rows as buckets
               .select(*columns, (quoted(first) + quoted(number)).alias(number), quoted(copies)))
    numbered = _copies(counted, columns, number, copies)
    placed = numbered.withColumn(number, permute(quoted(number), n, seed))
    return placed.select(*columns, F.pmod(quoted(number), F.lit(shards)).cast("int").alias(shard_col),
                         _div(quoted(number), shards).alias(slot_col))
