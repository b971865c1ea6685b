"""Repeated-span removal by distributed prefix doubling.

A byte is removed if a ``span``-byte string that covers it also starts in a
document with a smaller id.  Ranks are names (see ``repeats_np``): equal for
equal strings, made by doubling, so that the rank of a string of length 2h is
the pair of ranks of length h at offset h.  Spark sorts and groups the names
at growing lengths; whatever is unique at a length leaves the search:

1. 16 bytes at anchors (one anchor for about 17 bytes, chosen by content so
   that every ``span``-byte window owns one);
2. about ``2/3 span`` bytes to the left and right of the surviving anchors,
   and the whole block of windows that an anchor owns: a block that starts in
   a smaller document is settled at once, and sides that lie in equal blocks
   only leave;
3. the ``span``-byte windows that are left.

Documents stay in shards by hash, packed as compressed Arrow batches; a shard
asks each name once, with its smallest id (so a hot name costs one row per
shard, not per document), and gets bits back.  Ids never meet in one task
otherwise, and no pair of documents is ever formed.

Nulls: a null text has no bytes; a null id is neither smaller nor larger than
another, so such rows lose nothing and remove nothing.  Rows with equal ids do
not remove from each other.  Texts shorter than ``span`` lose nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats_np as R
from .common import free_name, give_back, lightly, numbered, quoted, schema_of

SHARD_BYTES = 4 << 20  # of text in a shard, about; a task holds some 15 times as much
_ASK = "bucket int, shard int, grams binary, tags binary, multi binary, keys binary, low binary"
_REPLY = "shard int, round int, bucket int, gram_bits binary, key_bits binary"


# --------------------------------------------------------------- packing
def _pack(batches):
    """Rows of a shard in a batch, as one compressed Arrow stream."""
    for batch in batches:
        shards = batch.column("shard").to_numpy(zero_copy_only=False)
        order = np.argsort(shards, kind="stable")
        rest = batch.drop_columns(["shard"])
        out_shard, out_blob = [], []
        for rows in np.split(order, np.flatnonzero(np.diff(shards[order])) + 1):
            if not len(rows):
                continue
            part = rest.take(pa.array(rows))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as w:
                w.write_batch(part)
            out_shard.append(int(shards[rows[0]]))
            out_blob.append(sink.getvalue().to_pybytes())
        yield pa.record_batch({"shard": pa.array(out_shard, pa.int32()), "rows": pa.array(out_blob, pa.binary())})
    give_back()


def _unpack(packed: pa.Table, id_col: str, text_col: str) -> pa.Table:
    """The rows of a shard, by id and text: shuffled pieces arrive in any order,
    and each round has to see the same shard."""
    parts = [pa.ipc.open_stream(b.as_buffer()).read_all() for b in packed.column("rows").combine_chunks()]
    rows = pa.concat_tables(parts)
    return rows.take(pc.sort_indices(rows, [(id_col, "ascending"), (text_col, "ascending")]))


class _Shard:
    """The documents of a shard as one byte array, searched in chunks."""

    def __init__(self, rows: pa.Table, id_col: str, text_col: str, span: int):
        self.rows, self.span, self.width = rows, span, span - R.GRAM + 1
        self.half = (self.width + 1) // 2
        self.side = span - max(self.half - 1, self.width - self.half)
        texts = rows.column(text_col).combine_chunks().cast(pa.large_binary())
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.chunk(0) if texts.num_chunks else pa.array([], pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] \
            if len(texts) else np.zeros(1, np.int64)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        self.data = data[offsets[0]:offsets[-1]]
        self.starts = (offsets[:-1] - offsets[0]).astype(np.int64)
        self.lens = np.diff(offsets).astype(np.int64)
        ids = rows.column(id_col).combine_chunks()
        if isinstance(ids, pa.ChunkedArray):
            ids = ids.chunk(0) if ids.num_chunks else pa.array([], pa.int64())
        self.known = ids.is_valid().to_numpy(zero_copy_only=False) if len(ids) else np.zeros(0, bool)
        self.ids = ids.fill_null(0).cast(pa.int64()).to_numpy() if len(ids) else np.zeros(0, np.int64)

        self._blocks()

    def _docs(self, s: int, e: int) -> np.ndarray:
        """The document of each byte of [s, e)."""
        first, last = np.searchsorted(self.starts, (s, e - 1), "right") - 1
        edges = np.concatenate(([s], self.starts[first + 1:last + 1], [e]))
        return np.repeat(np.arange(first, last + 1, dtype=np.int32), np.diff(edges))

    def _blocks(self):
        """Blocks: runs of windows of one document that own the same anchor, as
        document, first and last window and anchor (positions in ``data``)."""
        n, found = len(self.data), [(np.zeros(0, np.int64),) * 4]
        self.grams = np.empty(max(n - R.GRAM + 1, 0), np.uint64)
        last = self.starts + self.lens - self.span
        for s in range(0, max(n - self.span + 1, 0), R.CHUNK):
            e = min(s + R.CHUNK, n - self.span + 1)
            grams = R.gram_names(self.data[s:e + self.span - 1])
            self.grams[s:s + len(grams)] = grams
            docs = self._docs(s, e)
            at = np.flatnonzero((np.arange(s, e) <= last[docs]) & self.known[docs])
            if not len(at):
                continue
            own, docs = R.anchors(grams, e - s, self.width)[at], docs[at]
            new = np.ones(len(at), bool)
            new[1:] = (np.diff(own) != 0) | (np.diff(docs) != 0)
            first = np.flatnonzero(new)
            found.append((docs[first], s + at[first], s + at[np.append(first[1:], len(at)) - 1], s + own[first]))
        self.doc, self.lo, self.hi, self.at = (np.concatenate(x) for x in zip(*found, strict=True))


def _covered(n: int, starts: list[np.ndarray], ends: list[np.ndarray]) -> np.ndarray:
    """Which of ``n`` bytes lie in a run [start, end); runs may overlap."""
    depth = np.zeros(n + 1, np.int32)
    for x in starts:
        np.add.at(depth, x, 1)
    for x in ends:
        np.subtract.at(depth, x, 1)
    return np.cumsum(depth, dtype=np.int32, out=depth)[:-1] > 0


def _unique(names: np.ndarray, tags: np.ndarray):
    """Distinct names, one tag of each, whether it has several tags, and the
    index of each name among the distinct ones."""
    order = np.argsort(names)
    n, t = names[order], tags[order]
    new = np.ones(len(n), bool)
    new[1:] = n[1:] != n[:-1]
    group = np.cumsum(new) - 1
    index = np.empty(len(n), np.int64)
    index[order] = group
    # equal names stand together: several tags show as a change next to each other
    multi = np.zeros(int(group[-1]) + 1 if len(n) else 0, bool)
    multi[group[1:][(~new[1:]) & (t[1:] != t[:-1])]] = True
    return n[new], t[new], multi, index


def _unique_keys(k1, k2, ids):
    """Distinct (k1, k2) with their smallest id, and the index of each row."""
    order = np.lexsort((ids, k2, k1))
    a, b, i = k1[order], k2[order], ids[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    index = np.empty(len(a), np.int64)
    index[order] = np.cumsum(new) - 1
    return a[new], b[new], i[new], index


def _low48(names: np.ndarray) -> bytes:
    return np.ascontiguousarray(names.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from48(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.view(np.uint64).ravel()


_NO_GRAMS = (np.zeros(0, np.uint64), None, np.zeros(0, bool))
_NO_KEYS = (np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64))


def _ask_rows(shard: int, bits: int, grams=_NO_GRAMS, keys=_NO_KEYS) -> pa.Table:
    """One row per bucket with names to ask; a bucket is the top ``bits``."""
    edges = (np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    cut = lambda names: np.append(np.searchsorted(names, edges), len(names))
    (names, tags, multi), (k1, k2, low) = grams, keys
    g, k = cut(names), cut(k1)
    out = {c: [] for c in ("bucket", "shard", "grams", "tags", "multi", "keys", "low")}
    for b in np.flatnonzero((np.diff(g) > 0) | (np.diff(k) > 0)).tolist():
        gs, ks = slice(g[b], g[b + 1]), slice(k[b], k[b + 1])
        out["bucket"].append(b)
        out["shard"].append(shard)
        out["grams"].append(_low48(names[gs]))
        out["tags"].append(b"" if tags is None else _low48(tags[gs]))
        out["multi"].append(np.packbits(multi[gs]).tobytes())
        out["keys"].append(k1[ks].tobytes() + k2[ks].tobytes())
        out["low"].append(low[ks].tobytes())
    kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 5)
    return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds, strict=True)})


def _answer(round_no: int):
    def answer(asked):
        """For each asked name: has it several tags (shards, where none is
        given); for each key: does a smaller id than the asker's own have it."""
        bucket = asked.column("bucket")[0].as_py()
        shards = asked.column("shard").to_pylist()
        get = lambda c: asked.column(c).to_pylist()
        names, tags, multi, sizes, k1, k2, low, kn = [], [], [], [], [], [], [], []
        for shard, g, t, m, k, lo in zip(shards, *map(get, ("grams", "tags", "multi", "keys", "low")), strict=True):
            n, c = len(g) // 6, len(k) // 12
            names.append(_from48(g))
            tags.append(_from48(t) if t else np.full(n, shard, np.uint64))
            multi.append(np.unpackbits(np.frombuffer(m, np.uint8), count=n).astype(bool) if n else np.zeros(0, bool))
            sizes.append(n)
            k1.append(np.frombuffer(k, np.uint64, count=c))
            k2.append(np.frombuffer(k, np.uint32, offset=8 * c))
            low.append(np.frombuffer(lo, np.int64))
            kn.append(c)
        _, _, several, index = _unique(np.concatenate(names), np.concatenate(tags))
        several[index[np.concatenate(multi)]] = True
        live = several[index]
        k1, k2, low = np.concatenate(k1), np.concatenate(k2), np.concatenate(low)
        _, _, least, index = _unique_keys(k1, k2, low)
        taken = least[index] < low if len(low) else np.zeros(0, bool)
        gcut, kcut = np.cumsum(sizes)[:-1], np.cumsum(kn)[:-1]
        return pa.table({
            "shard": pa.array(shards, pa.int32()),
            "round": pa.array([round_no] * len(shards), pa.int32()),
            "bucket": pa.array([bucket] * len(shards), pa.int32()),
            "gram_bits": pa.array([np.packbits(x).tobytes() for x in np.split(live, gcut)], pa.binary()),
            "key_bits": pa.array([np.packbits(x).tobytes() for x in np.split(taken, kcut)], pa.binary()),
        })
    return answer


class _Search:
    """What a shard does in each round, given the replies of the rounds before."""

    def __init__(self, span: int, bits: int, id_col: str, text_col: str, as_text: bool):
        self.span, self.bits, self.id_col, self.text_col, self.as_text = span, bits, id_col, text_col, as_text

    def open(self, packed: pa.Table) -> _Shard:
        return _Shard(_unpack(packed, self.id_col, self.text_col), self.id_col, self.text_col, self.span)

    def _bits(self, replies: pa.Table, round_no: int, column: str, asked: np.ndarray) -> np.ndarray:
        """The replies of a round in the order of the (sorted) asked names."""
        edges = (np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits))
        cuts = np.append(np.searchsorted(asked, edges), len(asked))
        out = np.zeros(len(asked), bool)
        for b, r, x in zip(replies.column("bucket").to_pylist(), replies.column("round").to_pylist(),
                           replies.column(column).to_pylist(), strict=True):
            if r == round_no and cuts[b + 1] > cuts[b]:
                out[cuts[b]:cuts[b + 1]] = np.unpackbits(np.frombuffer(x, np.uint8), count=int(cuts[b + 1] - cuts[b]))
        return out

    # round 1: 16 bytes at anchors
    def _round1(self, shard: _Shard):
        return _unique(R.spread(shard.grams[shard.at]), shard.doc)

    def ask_grams(self, key, packed):
        names, _, multi, _ = self._round1(self.open(packed))
        return _ask_rows(key[0].as_py(), self.bits, grams=(names, None, multi))

    # round 2: both sides of live anchors, and whole blocks
    def _round2(self, shard: _Shard, replies: pa.Table):
        """Live blocks; the names of their sides (windows whose anchor is
        ``half`` or more bytes in lie over the left side, the others over the
        right one), tagged with their block; the names of whole blocks.  A side
        that lies in equal blocks only has no open windows: what they share is
        settled with the block."""
        asked, _, _, index = self._round1(shard)
        live = self._bits(replies, 1, "gram_bits", asked)[index]
        doc, lo, hi, at = (x[live] for x in (shard.doc, shard.lo, shard.hi, shard.at))
        left, right = lo <= at - shard.half, hi > at - shard.half
        sides = R.names_at(shard.grams, np.concatenate((at[left] + R.GRAM - shard.side, at[right])), shard.side)
        b1, b2 = R.check_names(shard.grams, lo, hi + self.span, 2 * self.span)
        grams = _unique(sides, np.concatenate((b1[left], b1[right])))
        keys = _unique_keys(b1, b2, shard.ids[doc])
        return (doc, lo, hi, at), left, right, grams, keys

    def ask_sides(self, key, packed, replies):
        _, _, _, grams, keys = self._round2(self.open(packed), replies)
        return _ask_rows(key[0].as_py(), self.bits, grams=grams[:3], keys=keys[:3])

    # round 3: windows that are still open
    def _round3(self, shard: _Shard, replies: pa.Table):
        """Settled blocks, and the windows that are open by name."""
        (doc, lo, hi, at), left, right, (names, _, _, gi), (k1, _, low, ki) = self._round2(shard, replies)
        side_live = self._bits(replies, 2, "gram_bits", names)[gi]
        settled = self._bits(replies, 2, "key_bits", k1)[ki] | (low[ki] < shard.ids[doc])
        left[left], right[right] = side_live[:left.sum()] & ~settled[left], side_live[left.sum():] & ~settled[right]
        turn = at - shard.half  # the last window whose anchor is that far in
        first = np.concatenate((lo[left], np.maximum(lo, turn + 1)[right]))
        last = np.concatenate((np.minimum(hi, turn)[left], hi[right]))
        sizes = last - first + 1
        window = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        ids = np.repeat(shard.ids[np.concatenate((doc[left], doc[right]))], sizes)
        w1, w2 = R.names_at(shard.grams, window, self.span), R.check_names(shard.grams, window, window + self.span, self.span)[1]
        return (lo[settled], hi[settled]), _unique_keys(w1, w2, ids), ids, window

    def ask_windows(self, key, packed, replies):
        _, keys, _, _ = self._round3(self.open(packed), replies)
        return _ask_rows(key[0].as_py(), self.bits, keys=keys[:3])

    # end: cover the bytes of repeated windows
    def cut(self, key, packed, replies):
        shard = self.open(packed)
        settled, (k1, _, low, ki), ids, at = self._round3(shard, replies)
        hit = self._bits(replies, 3, "key_bits", k1)[ki] | (low[ki] < ids)
        at = at[hit]
        del k1, low, ki, ids, hit, shard.grams  # names are done with; they are most of a task's memory
        gone = _covered(len(shard.data), [settled[0], at], [settled[1] + self.span, at + self.span])
        del settled, at
        spans, kept = [], []
        for s, n in zip(shard.starts.tolist(), shard.lens.tolist(), strict=True):
            g = gone[s:s + n]
            if not g.any():
                spans.append([])
                kept.append(shard.data[s:s + n].tobytes())
                continue
            e = np.flatnonzero(np.diff(np.concatenate(([0], g.view(np.int8), [0]))))
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(e[::2], e[1::2], strict=True)])
            kept.append(shard.data[s:s + n][~(_whole_characters(shard.data[s:s + n], g) if self.as_text else g)].tobytes())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        out = shard.rows
        return (out.append_column("n_bytes", pa.array(shard.lens, pa.int64()))
                   .append_column("spans", pa.array(spans, kind))
                   .append_column("kept", pa.array(kept, pa.binary()).cast(pa.string() if self.as_text else pa.binary())))


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """``gone`` for characters: one goes if all its bytes go."""
    first = np.flatnonzero((data & 0xC0) != 0x80)
    return np.repeat(np.logical_and.reduceat(gone, first), np.diff(np.append(first, len(data))))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   span: int = 50, out: str = "repeats", as_text: bool = False) -> DataFrame:
    """``docs`` with a struct column ``out`` (underscores are appended while
    the name is taken): ``n_bytes``, ``spans`` (maximal removed byte runs,
    ``end`` exclusive) and ``kept`` (the remaining bytes).  With ``as_text``
    ``kept`` is a string, and characters of which a byte remains stay whole."""
    if span < 2 * R.GRAM:
        raise ValueError(f"span must be {2 * R.GRAM} or more")
    out = free_name(docs, out)
    total = docs.agg(F.sum(F.octet_length(quoted(text_col)))).first()[0] or 0
    n_shards = max(8, total // SHARD_BYTES)
    bits = max(8, int(n_shards).bit_length() - 2)
    rows = numbered(docs)
    id_at, text_at = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    keyed = rows.withColumn("shard", F.pmod(F.xxhash64(id_at, text_at), F.lit(n_shards)).cast("int"))
    packed = keyed.mapInArrow(_pack, "shard int, rows binary")
    search = _Search(span, bits, id_at, text_at, as_text)

    shards = packed.groupBy("shard")
    with_replies = lambda df: shards.cogroup(df.groupBy("shard"))
    answered = lambda asks, n: asks.groupBy("bucket").applyInArrow(_answer(n), _REPLY)
    one = answered(shards.applyInArrow(lambda key, docs: lightly(search.ask_grams, key, docs), _ASK), 1)
    two = one.union(answered(with_replies(one).applyInArrow(
        lambda key, docs, replies: lightly(search.ask_sides, key, docs, replies), _ASK), 2))
    three = two.union(answered(with_replies(two).applyInArrow(
        lambda key, docs, replies: lightly(search.ask_windows, key, docs, replies), _ASK), 3))
    found = with_replies(three).applyInArrow(
        lambda key, docs, replies: lightly(search.cut, key, docs, replies),
        schema_of(rows, "n_bytes bigint", "spans array<struct<start: bigint, end: bigint>>",
                  f"kept {'string' if as_text else 'binary'}"))
    return found.select(*rows.columns, F.struct("n_bytes", "spans", "kept")).toDF(*docs.columns, out)
