"""SimHash near-duplicates with a vantage-point tree over the fingerprints.

A text's fingerprint has a bit set where more than half of its shingle hashes
(XXH64, seed 42) have it.  Distinct fingerprints are linked when they differ in
``max_bits`` bits or fewer.  The upper vantage-point tree is fitted on a bounded
sample of fingerprints; a fingerprint lies in one leaf, its *home*, and visits
every leaf that the triangle bound can't exclude (|d(x, v) - radius| within
``max_bits`` of the boundary), so each leaf finds its exact pairs alone.  A leaf
gives a spanning forest of its links, which joins the same components as all
the links; components are then contracted in Spark.

The upper tree has a bounded number of leaves.  A leaf in which own times visiting
fingerprints are too many for one task is split again in Spark, one level of the
tree a round: the vantage point is the own fingerprint with the smallest hash, the
radius the median distance to it.  Where a split hardly shrinks a leaf (a dense
ball, in which the bound excludes nothing) its own points are compared with all its
points in blocks, a task for each pair of blocks.

Equal texts and equal fingerprints are one node, so copies are never paired.
A null or empty text has no words and the fingerprint zero, linked like any
other.  Rows with a null id get a component too, but never name it; a component
of such rows only has a null name.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, give_back, quoted, written

SAMPLE = 1 << 16     # fingerprints that the upper tree is fitted on, about
LEAF = 2048          # fingerprints in a leaf of the upper tree, about
BLOCK = 1 << 20      # distances computed at once
WORK = 1 << 32       # distances of a leaf, at most; leaves with more are split again
STUCK = 0.9          # a split that leaves so large a share in a half is the last


def fingerprint(text: str | None, shingle: int) -> int:
    words = (text or "").encode().lower().split()  # bytes: A-Z and \\x20\\x09-\\x0D only
    if not words:
        return 0
    if len(words) <= shingle:
        pieces = [b" ".join(words)]
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        pieces = [line[s:e] for s, e in zip(starts.tolist(), ends[shingle - 1:].tolist(), strict=False)]
    n = len(pieces)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(42)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 14):
        part = hashes[i:i + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = 3, out: str = "fingerprint") -> DataFrame:
    """``docs`` with the 64-bit fingerprint as a (signed) long."""
    @F.arrow_udf("long")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array((fingerprint(t.as_py(), shingle) for t in texts), pa.int64(), size=len(texts))
        give_back()

    return docs.withColumn(out, prints(quoted(text_col)))


# ------------------------------------------------------------ the upper tree
class VPTree:
    """Nodes as arrays: vantage point, radius, children (below 0: leaf -1 - i)."""

    def __init__(self, sample: np.ndarray, leaves: int, seed: int = 7):
        self.point, self.radius, self.inner, self.outer, self.leaves = [], [], [], [], 0
        rng = np.random.default_rng(seed)
        self.root = self._grow(sample, max(1, leaves), rng)
        self.point = np.array(self.point, np.uint64)

    def _grow(self, x: np.ndarray, leaves: int, rng) -> int:
        if leaves > 1 and len(x) > 1:
            v = x[rng.integers(len(x))]
            d = np.bitwise_count(x ^ v)
            r = int(np.median(d))
            near = d <= r
            if near.all():
                near = d < r
                r -= 1
            if near.any() and not near.all():
                at = len(self.point)
                for a, value in ((self.point, v), (self.radius, r), (self.inner, 0), (self.outer, 0)):
                    a.append(value)
                share = max(1, min(leaves - 1, round(leaves * near.mean())))
                self.inner[at] = self._grow(x[near], share, rng)
                self.outer[at] = self._grow(x[~near], leaves - share, rng)
                return at
        self.leaves += 1
        return -self.leaves

    def route(self, x: np.ndarray, reach: int):
        """(leaf, index in x, is home) of every leaf within ``reach`` of each x."""
        out, todo = [], [(self.root, np.arange(len(x)), np.ones(len(x), bool))]
        while todo:
            at, rows, home = todo.pop()
            if not len(rows):
                continue
            if at < 0:
                out.append((np.full(len(rows), -1 - at), rows, home))
                continue
            d = np.bitwise_count(x[rows] ^ self.point[at]).astype(np.int64)
            near = d <= self.radius[at]
            inside, outside = d - reach <= self.radius[at], d + reach > self.radius[at]
            todo.append((self.inner[at], rows[inside], (home & near)[inside]))
            todo.append((self.outer[at], rows[outside], (home & ~near)[outside]))
        return [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins a[i] and b[i]; each root is the smallest index of its set."""
    while True:
        parent = _roots(parent)
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            return parent
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(x, y)[apart], np.minimum(x, y)[apart])


def leaf_links(points: np.ndarray, home: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (point, root) of the links between a leaf's own points
    and all that visit it."""
    points, order = np.unique(points, return_index=True)  # a point is in a leaf once
    own = np.flatnonzero(home[order])
    parent = np.arange(len(points))
    step = max(1, BLOCK // max(1, len(points)))
    for i in range(0, len(own), step):
        rows = own[i:i + step]
        near = np.bitwise_count(points[rows, None] ^ points[None, :]) <= reach
        a, b = np.nonzero(near)
        a = rows[a]
        parent = _unite(parent, a[a != b], b[a != b])
    parent = _roots(parent)
    linked = np.flatnonzero(parent != np.arange(len(points)))
    return points[linked], points[parent[linked]]


def _split_leaves(routed: DataFrame, reach: int, work: int) -> DataFrame:
    """``routed`` (leaf, fingerprint, home) with every leaf of more than ``work``
    distances split again, by further levels of the tree or into pairs of blocks;
    leaves have new names.  Each pair of an own and a visiting point within
    ``reach`` still meets in a leaf."""
    side = max(1, math.isqrt(work))
    todo = routed.select(F.col("leaf").cast("string").alias("leaf"), "fingerprint", "home", F.lit(None).cast("long").alias("parent_n"))
    done = []
    while True:
        todo = written(todo, "simhash-routed")
        sizes = todo.groupBy("leaf").agg(
            F.count("*").alias("n"), F.count_if("home").alias("own"), F.first("parent_n", True).alias("parent_n"),
            F.min_by("fingerprint", F.when(F.col("home"), F.xxhash64("fingerprint"))).alias("point"))
        large = written(sizes.where(F.col("own") * F.col("n") > work), "simhash-large")
        if large.isEmpty():
            done.append(todo.select("leaf", "fingerprint", "home"))
            break
        done.append(todo.join(large.select("leaf"), "leaf", "left_anti").select("leaf", "fingerprint", "home"))
        stuck = F.coalesce(F.col("n") >= STUCK * F.col("parent_n"), F.lit(False))

        blocks = F.ceil(F.col("n") / side).cast("int")
        block, of = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int"), F.sequence(F.lit(0), F.col("blocks") - 1)
        dense = todo.drop("parent_n").join(large.where(stuck).select("leaf", blocks.alias("blocks")), "leaf").withColumn("block", block)
        name = lambda own, other: F.concat_ws("-", "leaf", own, other)
        meets = [dense.where("home").select("fingerprint", F.explode(of).alias("with"), "leaf", "block")
                 .select(name("block", "with").alias("leaf"), "fingerprint", F.lit(True).alias("home")),
                 dense.select("fingerprint", F.explode(of).alias("with"), "leaf", "block", "home")
                 .where("NOT (home AND with = block)")  # an own point is in its own block already
                 .select(name("with", "block").alias("leaf"), "fingerprint", F.lit(False).alias("home"))]
        done += meets

        far = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("point")))
        apart = (todo.drop("parent_n").join(large.where(~stuck).select("leaf", "point", "n"), "leaf")
                 .withColumn("far", far).drop("point"))
        radius = apart.where("home").groupBy("leaf").agg(F.percentile_approx("far", 0.5).alias("radius"))
        near = F.col("far") <= F.col("radius")
        half = lambda side, home: F.struct(F.concat("leaf", F.lit(side)).alias("leaf"), (F.col("home") & home).alias("home"))
        halves = F.array_compact(F.array(F.when(F.col("far") - reach <= F.col("radius"), half("i", near)),
                                         F.when(F.col("far") + reach > F.col("radius"), half("o", ~near))))
        todo = (apart.join(radius, "leaf").select("fingerprint", "n", F.explode(halves).alias("half"))
                .select("half.leaf", "fingerprint", "half.home", F.col("n").alias("parent_n")))
    return functools.reduce(DataFrame.unionByName, done)


def link_forest(prints: DataFrame, max_bits: int, sample: int = SAMPLE, leaf: int = LEAF, work: int = WORK) -> DataFrame:
    """Links (a, b) that join the same components as all pairs of the distinct
    ``fingerprint`` values within ``max_bits`` bits."""
    total = prints.count()
    chosen = prints
    if total > sample:  # by hash, so that no task has to sort or gather more than the sample
        chosen = prints.where(F.shiftrightunsigned(F.xxhash64("fingerprint"), 1) < F.lit((sample << 63) // total))
    fitted = chosen.select("fingerprint").toPandas()["fingerprint"].sort_values()
    tree = VPTree(fitted.to_numpy(np.int64).view(np.uint64),
                  min(-(-total // leaf), max(1, len(fitted) // 16)))

    def route(batches):
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            leaf_no, rows, home = tree.route(x, max_bits)
            yield pa.record_batch({"leaf": pa.array(leaf_no, pa.int32()), "fingerprint": pa.array(x[rows].view(np.int64)),
                                   "home": pa.array(home.astype(bool))})

    def links(table):
        a, b = leaf_links(table.column("fingerprint").to_numpy().view(np.uint64),
                          table.column("home").to_numpy(), max_bits)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    routed = prints.select("fingerprint").mapInArrow(route, "leaf int, fingerprint long, home boolean")
    return _split_leaves(routed, max_bits, work).groupBy("leaf").applyInArrow(links, "a long, b long")


# ------------------------------------------------------------- components
def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b): each node moves to
    its smallest neighbour, links are rewritten, until none is left.  Node
    values are hashes, so a constant share of the nodes goes in each round."""
    spark = links.sparkSession
    edges = written(links.where("a <> b").distinct(), "simhash-links")
    moves = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        step = written(both.groupBy("a").agg(F.min("b").alias("b"))
                       .select(F.col("a").alias("node"), F.least("a", "b").alias("to")), "simhash-moves")
        moves.append(step)
        edges = written(
            edges.join(step.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "simhash-links")
    if not moves:
        return spark.createDataFrame([], "node long, component long")
    found = moves[0].select("node", F.col("to").alias("component"))
    for step in moves[1:]:
        found = (found.join(step.select(F.col("node").alias("component"), "to"), "component", "left")
                 .select("node", F.coalesce("to", "component").alias("component")))
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """One row per document: id, ``text_key`` (a hash of the text), fingerprint,
    ``group`` (the same for linked documents) and ``component_id`` (the smallest
    id of the group)."""
    rows = docs.select(quoted(id_col).alias("id"), F.xxhash64(quoted(text_col)).alias("text_key"), quoted(text_col).alias("text"))
    rows = written(with_fingerprint(rows, "text", shingle).drop("text"), "simhash-rows")
    prints = written(rows.groupBy("fingerprint").agg(F.min("id").alias("least")), "simhash-prints")
    found = components(link_forest(prints, max_bits))
    nodes = (prints.join(found, prints["fingerprint"] == found["node"], "left")
             .select("fingerprint", "least", F.coalesce("component", "fingerprint").alias("group")))
    nodes = written(nodes, "simhash-nodes")
    least = nodes.groupBy("group").agg(F.min("least").alias("component_id"))
    named = nodes.join(least, "group").select("fingerprint", "group", "component_id")
    return (rows.join(named, "fingerprint")
            .select(F.col("id").alias(id_col), "text_key", "fingerprint", "group", "component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each group: the smallest id (nulls last), of
    equal ids the smallest text hash, of equal rows one."""
    found = near_duplicates(docs, id_col, text_col, shingle, max_bits)
    best = found.groupBy("group").agg(F.min(F.struct(
        quoted(id_col).isNull().alias("no_id"), quoted(id_col).alias("keep_id"),
        F.col("text_key").alias("keep_key"))).alias("best")).select("best.keep_id", "best.keep_key")
    key, rank = free_name(docs, "text_key"), free_name(docs, "copy")
    keyed = docs.withColumn(key, F.xxhash64(quoted(text_col)))
    kept = keyed.join(best, keyed[key].eqNullSafe(best["keep_key"])
                      & quoted(id_col).eqNullSafe(best["keep_id"]), "left_semi")
    copies = Window.partitionBy(quoted(id_col), key).orderBy(*(quoted(c) for c in docs.columns if docs.schema[c].dataType.typeName() != "map"))
    return kept.withColumn(rank, F.row_number().over(copies)).where(F.col(rank) == 1).drop(rank, key)
