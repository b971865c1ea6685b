"""Best-fit packing of tokenised documents into sequences of a fixed length.

``token_pieces`` encodes whole texts, ends each with a closing id and cuts only
what is longer than a sequence.  ``pack`` places pieces by bounded-space online
best-fit: a piece goes into the open bin with the least free space that takes
it; the open bins, a fixed number, lie in a bitset keyed by free space; where
one too many would be open, the fullest closes first.

Pieces are spread at random over groups of about ``GROUP`` rows, one Spark task
a group.  What lies in the bins still open at the end of a group (a few
hundred, however long the group) goes on to the next level, which has far fewer
groups, until one group is left; the pieces of its last open bins are placed
once more, longest first.  So only the open bins of that one group can be far
from full.  Rows are told apart by a number given when they are written, so
repeated rows and equal ids are pieces of their own and spread like any other.

A null or empty text is one piece that holds the closing id alone.  An empty
table has no pieces.
"""

from __future__ import annotations

import re
import sys
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_alphabet
from .common import free_name, numbered, quoted, schema_of, written

CAPACITY = 4096     # tokens of a sequence
BINS = 512          # open bins
GROUP = 1 << 16     # pieces placed by one task, about
CACHE = 32 << 20    # bytes of remembered pieces of a worker, about
ROWS = 1024         # texts at a time

#: The pre-tokenizer's pattern, for texts of the characters below.
LETTERS = "a-zß-öø-ÿœ"
PIECES = f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\\s{LETTERS}0-9]+"
#: Characters whose lower case, composition and class are the same in every
#: Unicode version; other words go through the library's own normalizer.
PLAIN = "[\x09-\x0d\x20-\x7eÀ-ÖØ-öø-ÿŒœ]*"


class WordEncoder:
    """Ids of texts by a BPE tokenizer file whose pre-tokenizer drops white space
    and whose normalizer lower-cases (made once per Python worker)."""

    _made: dict = {}

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.alphabet = str.maketrans({chr(b): c for b, c in enumerate(byte_alphabet())})
        self.findall, self.plain = re.compile(PIECES).findall, re.compile(PLAIN).fullmatch
        self.pieces, self.words = _Bounded(self._piece, CACHE), _Bounded(self._word, CACHE)

    def _piece(self, piece: str) -> bytes:
        raw = piece.encode().decode("latin-1").translate(self.alphabet)
        return _packed([t.id for t in self.library.model.tokenize(raw)])

    def _word(self, word: str) -> bytes:
        return _packed(self.library.encode(word, add_special_tokens=False).ids)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.findall(text.lower())))

    def encode(self, text: str | None) -> bytes:
        """The ids of the whole text, as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        marked = any(a in text for a in self.added)
        if not marked and self.plain(text):
            return self._plain(text)
        # white space ends words for the normalizer, the pattern and added tokens alike
        words = (w.decode() for w in text.encode().split())
        return b"".join(self._plain(w) if self.plain(w) and not (marked and any(a in w for a in self.added))
                        else self.words[w] for w in words)


def _packed(ids) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()


class _Bounded(dict):
    """Remembered values, emptied when their keys and values fill ``most`` bytes."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.held = make, most, 0

    def __missing__(self, key):
        value = self.make(key)
        size = 150 + len(key) + len(value)
        if size < 1024:
            if self.held + size > self.most:
                self.clear()
                self.held = 0
            self.held += size
            self[key] = value
        return value


def token_pieces(docs: DataFrame, vocabulary: str, text_col: str = "text", end_id: int = 1,
                 capacity: int = CAPACITY) -> DataFrame:
    """``docs``, a row per piece, with piece (from 0), start (ids of the document
    before it), length and ids (little-endian unsigned 32-bit).  Underscores are
    appended to a name while it is taken."""
    names = list(docs.columns)
    for base in ("piece", "start", "length", "ids"):
        names.append(free_name(docs, base))
    plain, text_at = numbered(docs), docs.columns.index(text_col)
    step, end = 4 * capacity, _packed([end_id])

    def run(batches):
        encoder = WordEncoder.of(vocabulary)
        for whole in batches:
            for i in range(0, whole.num_rows, ROWS):
                batch = whole.slice(i, ROWS)
                ids = [encoder.encode(t) + end for t in batch.column(text_at).to_pylist()]
                counts = np.array([-(-len(x) // step) for x in ids])
                cut = [x[j:j + step] for x in ids for j in range(0, len(x), step)]
                piece = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                batch = batch.take(pa.array(np.repeat(np.arange(len(ids)), counts)))
                for name, column in (("piece", pa.array(piece, pa.int32())), ("start", pa.array(piece * capacity, pa.int64())),
                                     ("length", pa.array([len(x) // 4 for x in cut], pa.int64())),
                                     ("ids", pa.array(cut, pa.binary()))):
                    batch = batch.append_column(name, column)
                yield batch

    return plain.mapInArrow(run, schema_of(plain, "piece int", "start bigint", "length bigint", "ids binary")).toDF(*names)


# ---------------------------------------------------------------- best fit
def best_fit(lengths, capacity: int = CAPACITY, bins: int = BINS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, is its bin still open) of each length, in the order given."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by free space
    bits = n_open = made = 0
    placed = np.empty((2, len(lengths)), np.int64)
    for i, length in enumerate(lengths):
        fitting = bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            at = open_bins[free].pop()
            if not open_bins[free]:
                bits ^= 1 << free
        else:
            free, at, made = capacity, made, made + 1
            if n_open == bins and length < capacity:
                fullest = (bits & -bits).bit_length() - 1
                open_bins[fullest].pop(0)
                if not open_bins[fullest]:
                    bits ^= 1 << fullest
                n_open -= 1
            n_open += 1
        placed[:, i] = at, capacity - free
        left = free - length
        if left:
            open_bins[left].append(at)
            bits |= 1 << left
        else:
            n_open -= 1
    still = np.zeros(made, bool)
    still[[at for same in open_bins for at in same]] = True
    return placed[0], placed[1], still[placed[0]] if len(lengths) else np.zeros(0, bool)


def _place(rows: np.ndarray, lengths: np.ndarray, capacity: int, bins: int, last: bool):
    """``best_fit`` in an order that depends on the rows alone; in the last group
    the pieces of open bins are placed once more, longest first."""
    order = np.argsort(rows, kind="stable")
    order = order[np.random.default_rng(len(rows)).permutation(len(order))]
    at, offset, still = (np.empty(len(rows), t) for t in (np.int64, np.int64, bool))
    at[order], offset[order], still[order] = best_fit(lengths[order].tolist(), capacity, bins)
    if last and still.any():
        rest = order[still[order]]
        rest = rest[np.argsort(-lengths[rest], kind="stable")]
        again, places, _ = best_fit(lengths[rest].tolist(), capacity, bins)
        if again.max() + 1 <= len(np.unique(at[rest])):
            at[rest], offset[rest] = again + at.max() + 1, places
    return at, offset, still & (not last)


def _placer(level: int, capacity: int, bins: int, last: bool):
    def place(key, table):
        rows, lengths = table.column("row").to_numpy(), table.column("length").to_numpy()
        at, offset, still = _place(rows, lengths, capacity, bins, last)
        number = (level << 58) + (key[0].as_py() << 22) + at  # a group has less than 2^22 bins
        return pa.table({"row": rows, "length": lengths, "sequence": number, "offset": offset, "open": still})

    return place


def pack(pieces: DataFrame, length_col: str = "length", capacity: int = CAPACITY, bins: int = BINS,
         group: int = GROUP) -> DataFrame:
    """``pieces`` (each of 1 to ``capacity`` tokens) with the columns sequence_id,
    unique per sequence, and offset, gapless from 0 in each sequence."""
    row, sequence, offset = (free_name(pieces, x) for x in ("row", "sequence_id", "offset"))
    rows = written(pieces.withColumn(row, F.monotonically_increasing_id()), "pack-pieces")
    todo = rows.select(quoted(row).alias("row"), quoted(length_col).cast("long").alias("length"))
    level, found, open_rows = 0, None, todo.count()
    while True:
        groups = max(1, -(-open_rows // group))
        last = groups == 1
        spread = todo.withColumn("group", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(groups)))
        placed = written(spread.groupBy("group").applyInArrow(
            _placer(level, capacity, bins, last), "row long, length long, sequence long, offset long, open boolean"), "pack-placed")
        closed = placed.where("not open").select("row", "sequence", "offset")
        found = closed if found is None else found.unionAll(closed)
        if last:
            break
        todo = placed.where("open").select("row", "length")
        level, open_rows = level + 1, todo.count()
    found = found.select(F.col("row").alias("place_row"), F.col("sequence").alias("place_sequence"), F.col("offset").alias("place_offset"))
    found = found.toDF(*(free_name(rows, c) for c in found.columns))
    number, sequence_of, offset_of = found.columns
    return (rows.join(found, rows[row] == found[number])
            .select(*(rows[f"`{c}`"] for c in pieces.columns), found[sequence_of].alias(sequence), found[offset_of].alias(offset)))


def sequences(packed: DataFrame, ids_col: str = "ids", sequence_col: str = "sequence_id", offset_col: str = "offset") -> DataFrame:
    """(sequence_id, ids): the packed ids of each sequence in the order of their
    offsets; a group is one sequence, so at most ``capacity`` ids."""
    parts = packed.groupBy(quoted(sequence_col).alias("sequence_id")).agg(
        F.sort_array(F.collect_list(F.struct(quoted(offset_col).alias("offset"), quoted(ids_col).alias("ids")))).alias("parts"))
    return parts.select("sequence_id", F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p.ids)), "")).alias("ids"))
