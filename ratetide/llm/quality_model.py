"""Quality classifier: random-indexing word vectors, pooled, and a small network.

Words are hashed to ``buckets`` rows, and each row has a sparse random index
vector.  A word's vector is the sum of the index vectors of its neighbours over
*all* documents (one pass; the sums of the tasks are added in two steps).  A
document is the mean of its words' vectors, the mean of the index vectors of
its words' shapes (case, length, punctuation, repetition of the word before)
and its length.  A two-layer numpy network is fitted on labelled rows, at most
``max_rows`` of them, its temperature on a part that the fit has not seen.

The matrix has a fixed size (``buckets`` x ``dims`` numbers), whatever the
corpus.  Labels, language, source and ids are never inputs of a score.  A null
or empty text has a zero vector and gets the network's score of it; without a
labelled row every score is 0.5.  Repeated rows are scored each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, written

U = np.uint64
SHAPES = 256
CHUNK = 1 << 19
_PARTS, _SALT = 16, 64


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 14
    dims: int = 32
    spikes: int = 4          # non-zero entries of an index vector
    hidden: int = 32
    epochs: int = 40
    max_rows: int = 20_000   # labelled rows that are fitted on, at most
    seed: int = 17


# --------------------------------------------------------------- words
def _byte_classes() -> np.ndarray:
    kinds = np.arange(256, dtype=np.int16)          # punctuation: its own class
    kinds[[*range(0x30, 0x3A)]] = 1
    kinds[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 2
    kinds[[*range(0x09, 0x0E), 0x20]] = 0
    return kinds


_KIND = _byte_classes()
_CODE = (np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15)) ^ (np.arange(256, dtype=U) << U(17))
_BASE = 0x2545F4914F6CDD1D


def _powers(base: int, n: int) -> np.ndarray:
    out, step = np.ones(1, U), U(base)
    with np.errstate(over="ignore"):
        while len(out) < n:
            out = np.concatenate((out, out * step))
            step = step * step
    return out[:n]


class Words:
    """Bucket, shape and document of each word of some texts (runs of letters,
    of digits, or of one punctuation mark)."""

    def __init__(self, texts: list[bytes], buckets: int):
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        ends = np.cumsum(lens + 1)
        kinds = _KIND[data]
        edge = np.flatnonzero(np.diff(kinds)) + 1
        starts = np.concatenate(([0], edge))
        stops = np.append(edge, len(data))
        real = kinds[starts] != 0
        starts, stops = starts[real], stops[real]
        self.doc = np.searchsorted(ends, starts, side="right")
        sums = np.concatenate(([U(0)], np.cumsum(_CODE[data] * _powers(_BASE, len(data)))))
        h = (sums[stops] - sums[starts]) * _powers(pow(_BASE, -1, 1 << 64), len(data))[starts]
        h ^= h >> U(29)
        h *= U(0xD6E8FEB86659FD93)
        self.bucket = (h >> U(40)).astype(np.int64) % buckets
        first = data[starts]
        big = (first >= 0x41) & (first <= 0x5A)
        capitals = np.concatenate(([0], np.cumsum((data >= 0x41) & (data <= 0x5A))))
        size = stops - starts
        all_big = (capitals[stops] - capitals[starts] == size) & (size > 1)
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (self.doc[1:] == self.doc[:-1])
        letters = kinds[starts] == 2
        shape = np.minimum(size, 15) + 16 * big + 32 * all_big          # letters: below 64
        shape = np.where(kinds[starts] == 1, 64 + np.minimum(size, 7), shape)
        shape = np.where(~letters & (kinds[starts] != 1), 128 + (first.astype(np.int64) & 0x7F), shape)
        self.shape = np.where(same, 80, shape)


def _texts(column) -> list[bytes]:
    return [(t or "").encode() for t in column.to_pylist()]


def _pieces(texts: list[bytes]):
    """Runs of whole texts of about CHUNK bytes."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK:
            yield start, texts[start:i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def index_vectors(s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries, one row per bucket and shape."""
    rng = np.random.default_rng(s.seed)
    n = s.buckets + SHAPES
    return rng.integers(0, s.dims, (n, s.spikes)), rng.choice([-1.0, 1.0], (n, s.spikes))


def word_vectors(docs: DataFrame, text_col: str, s: Settings) -> np.ndarray:
    """The (buckets, dims) matrix of unit word vectors, counted over all documents."""
    def count(batches):
        place, sign = index_vectors(s)
        total = np.zeros(s.buckets * s.dims)
        for batch in batches:
            for _, texts in _pieces(_texts(batch.column(0))):
                w = Words(texts, s.buckets)
                near = w.doc[1:] == w.doc[:-1]
                a, b = w.bucket[:-1][near], w.bucket[1:][near]
                for x, y in ((a, b), (b, a)):
                    for k in range(s.spikes):
                        total += np.bincount(x * s.dims + place[y, k], weights=sign[y, k], minlength=len(total))
        rows = np.array_split(total, _PARTS)
        # spreads the sums; the same in each attempt of a task, so that parts computed
        # again after an executor is lost go where they went before
        salt = TaskContext.get().partitionId() % _SALT
        yield pa.record_batch({"part": pa.array(range(_PARTS), pa.int32()), "salt": pa.array([salt] * _PARTS, pa.int32()),
                               "sums": pa.array([r.tobytes() for r in rows], pa.binary())})

    def add(key, table):
        sums = None
        for x in table.column("sums"):
            v = np.frombuffer(x.as_buffer())
            sums = v.copy() if sums is None else sums + v
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "salt": pa.array([0], pa.int32()),
                         "sums": pa.array([sums.tobytes()], pa.binary())})

    kind = "part int, salt int, sums binary"
    parts = docs.select(quoted(text_col)).mapInArrow(count, kind)
    parts = parts.groupBy("part", "salt").applyInArrow(lambda key, t: add(key, t), kind)
    parts = parts.groupBy("part").applyInArrow(lambda key, t: add(key, t), kind)
    got = {r.part: np.frombuffer(bytes(r.sums)) for r in parts.collect()}  # fixed size: the matrix
    total = np.concatenate([got[i] for i in range(_PARTS)]) if got else np.zeros(s.buckets * s.dims)
    m = total.reshape(s.buckets, s.dims)
    return (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(docs: DataFrame, vectors: np.ndarray, id_col: str, text_col: str, s: Settings) -> DataFrame:
    """(id, vector as float32 bytes) of every document."""
    def run(batches):
        place, sign = index_vectors(s)
        shapes = np.zeros((SHAPES, s.dims), np.float32)
        for k in range(s.spikes):
            np.add.at(shapes, (np.arange(SHAPES), place[s.buckets:, k]), sign[s.buckets:, k])
        for batch in batches:
            texts = _texts(batch.column(1))
            out = np.zeros((len(texts), 2 * s.dims + 1), np.float32)
            for first, part in _pieces(texts):
                w = Words(part, s.buckets)
                if not len(w.doc):
                    continue
                at = np.flatnonzero(np.concatenate(([True], w.doc[1:] != w.doc[:-1])))
                n = np.diff(np.append(at, len(w.doc)))[:, None]
                rows = first + w.doc[at]
                out[rows, :s.dims] = np.add.reduceat(vectors[w.bucket], at) / n
                out[rows, s.dims:-1] = np.add.reduceat(shapes[w.shape], at) / n
                out[rows, -1] = np.log1p(n[:, 0])
            yield pa.record_batch({"id": batch.column(0), "vector": pa.array([r.tobytes() for r in out], pa.binary())})

    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, vector binary")


# --------------------------------------------------------------- network
class Network:
    """x -> tanh(x A + a) B + b, a logit; ``temperature`` divides it."""

    def __init__(self, x: np.ndarray, y: np.ndarray, s: Settings):
        rng = np.random.default_rng(s.seed)
        order = rng.permutation(len(x))
        held = order[:len(x) // 6]
        fit = order[len(x) // 6:]
        self.mean, self.scale = x[fit].mean(0), x[fit].std(0) + 1e-6
        z = (x - self.mean) / self.scale
        d = x.shape[1]
        self.p = [rng.normal(0, d ** -0.5, (d, s.hidden)), np.zeros(s.hidden), rng.normal(0, s.hidden ** -0.5, s.hidden), np.zeros(1)]
        m, v, t, self.temperature = [0.0] * 4, [0.0] * 4, 0, 1.0
        for _ in range(s.epochs):
            for rows in np.array_split(rng.permutation(fit), max(1, len(fit) // 256)):
                h = np.tanh(z[rows] @ self.p[0] + self.p[1])
                e = (_sigmoid(h @ self.p[2] + self.p[3]) - y[rows]) / len(rows)
                back = e[:, None] * self.p[2] * (1 - h * h)
                grads = [z[rows].T @ back + 1e-4 * self.p[0], back.sum(0), h.T @ e + 1e-4 * self.p[2], e.sum(keepdims=True)]
                t += 1
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.p[i] = self.p[i] - 3e-3 * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
        if len(held):
            logits = self.logit(x[held])
            loss = lambda q: np.mean(np.logaddexp(0, -logits / q * (2 * y[held] - 1)))
            self.temperature = float(min(np.geomspace(0.25, 8, 81), key=loss))

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logit(x) / self.temperature)


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def held_out(doc_id: Column) -> Column:
    """A fifth of the ids, never fitted on."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def chosen_labels(labels: DataFrame, id_col: str, label_col: str, s: Settings) -> DataFrame:
    """(label_id, label): at most ``max_rows`` ids that are fitted on.  An id with
    several labels counts once, with the smallest.  Where there are more ids, a cut
    through their hashes lets some ``max_rows`` through, on each partition alike,
    and those of the smallest hashes stay."""
    ids = (labels.select(quoted(id_col).alias("label_id"), quoted(label_col).cast("int").alias("label"))
           .where(F.col("label").isNotNull() & F.col("label_id").isNotNull() & ~held_out(F.col("label_id")))
           .groupBy("label_id").agg(F.min("label").alias("label")))
    total, hashed = ids.count(), F.xxhash64("label_id")
    if total > s.max_rows:
        spare = s.max_rows + 8 * int(s.max_rows ** 0.5)  # the cut is random: a few more than are taken
        ids = ids.where(hashed < int(-(1 << 63) + (1 << 64) * min(1.0, spare / total)) - 1)
    return ids.orderBy(hashed, "label_id").limit(s.max_rows)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", settings: Settings | None = None) -> DataFrame:
    """(id, score) of every document: the calibrated probability of label 1.
    Rows of ``labels`` whose id is ``held_out`` are not used."""
    s = settings or Settings()
    vectors = word_vectors(docs, text_col, s)
    pools = written(pooled(docs, vectors, id_col, text_col, s), "quality-vectors")
    chosen = written(chosen_labels(labels, id_col, label_col, s), "quality-labels")
    rows = (pools.join(F.broadcast(chosen), F.col("id") == F.col("label_id"))  # max_rows ids
            .groupBy("id", "label").agg(F.min("vector").alias("vector")).toPandas())
    rows = rows.sort_values(["id", "label"], kind="stable")
    network = None
    if len(rows):
        x = np.stack([np.frombuffer(v, np.float32) for v in rows["vector"]]).astype(np.float64)
        network = Network(x, rows["label"].to_numpy(np.float64), s)

    def score(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(v.as_buffer() for v in batch.column(1)), np.float32).reshape(batch.num_rows, -1)
            p = network.score(x.astype(np.float64)) if network and batch.num_rows else np.full(batch.num_rows, 0.5)
            yield pa.record_batch({"id": batch.column(0), "score": pa.array(p, pa.float64())})

    kind = pools.schema["id"].dataType.simpleString()
    return pools.mapInArrow(score, f"id {kind}, score double").withColumnRenamed("id", id_col)
