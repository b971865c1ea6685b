"""Phrase collocations counted in HAT-tries.

Each task counts the n-grams of its texts in a HAT-trie: hash containers keyed by
word numbers hang below a shallow trie over those numbers.  A container that
grows past its limit bursts: each first (then second) word that holds a good part
of it gets a container of its own.  Where the trie is full, whole subtrees, the
largest first, leave it as runs sorted by word numbers.  Spark merges the runs of
all tasks and sums the counts.  Runs are merged per whole phrase, not per first word:
one common first word would fill one partition.

Lengths are counted one after the other.  A phrase that occurs ``min_count``
times is made of shorter ones that do, so a task counts n-grams only if both
their (n-1)-grams pass a bitmap of the frequent ones.  The bitmap has 16 bits for
each, up to ``BITMAP`` bits; where it is too small, or two phrases share bits, more
n-grams are counted and the results are the same.

Texts are split into pieces and words after A-Z are lower-cased; phrases stay
within a piece.  Everything is per language (null: ``und``).  A null or empty text
has no words; repeated rows count each time.  Arithmetic is in decimals of 38
digits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, written

#: What ends a piece, what parts words.
PIECE_ENDS, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
NO_LANGUAGE = "und"
BURST = 1 << 14       # n-grams in a container
FULL = 1 << 20        # n-grams in a trie
BITMAP = 1 << 28      # bits of the filter, at most: 32 MB
SLICE = 1 << 21       # bytes of text counted at once, unless one text is longer
_EVEN = bytes(ord("\n") if b in PIECE_ENDS else ord(" ") if b in SPACES else b for b in range(256))
MIX = 0xD6E8FEB86659FD93
_BREAK = b"\xff"      # a byte that no UTF-8 text has


# ------------------------------------------------------------------ HAT-trie
class ArrayHash:
    """Counts of n-grams in a hash table of two arrays, at most half full; a place
    that is taken sends an n-gram to the next one.  Nothing is removed."""

    def __init__(self):
        self.used, self.keys, self.counts = 0, np.full(64, -1, np.int64), np.zeros(64, np.int64)

    def __len__(self) -> int:
        return self.used

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds counts of distinct n-grams."""
        if 2 * (self.used + len(keys)) > len(self.keys):
            held = self.items()
            size = 1 << (2 * (self.used + len(keys))).bit_length()
            self.used, self.keys, self.counts = 0, np.full(size, -1, np.int64), np.zeros(size, np.int64)
            self.add(*held)
        table, mask = self.keys, len(self.keys) - 1
        place = ((keys.view(np.uint64) * np.uint64(MIX)) >> np.uint64(65 - len(table).bit_length())).astype(np.int64)
        while len(keys):
            at = table[place]
            free = np.flatnonzero(at == -1)
            if len(free):  # of several n-grams at one free place the last stays
                table[place[free]] = keys[free]
                at[free] = table[place[free]]
            mine = at == keys
            self.used += int(mine[free].sum())
            self.counts[place[mine]] += counts[mine]
            rest = np.flatnonzero(~mine)
            keys, counts, place = keys[rest], counts[rest], place[rest] + 1 & mask

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        taken = np.flatnonzero(self.keys >= 0)
        return self.keys[taken], self.counts[taken]


class HatTrie:
    """Counts of n-grams packed into 63 bits, ``bits`` for each word number."""

    def __init__(self, length: int, depth: int = 0, burst: int = BURST):
        self.length, self.depth, self.burst = length, depth, burst
        self.shift = (63 // length) * (length - 1 - depth)
        self.children: dict[int, HatTrie] = {}
        self.container = ArrayHash()
        self.limit = burst

    def __len__(self) -> int:
        return len(self.container) + sum(map(len, self.children.values()))

    def _word(self, keys: np.ndarray) -> np.ndarray:
        return keys >> self.shift & ((1 << 63 // self.length) - 1)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds counts of distinct n-grams, sorted."""
        if not len(keys):  # the filter may leave nothing of a slice
            return
        if self.children:
            words = self._word(keys)
            first = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
            own = np.ones(len(keys), bool)
            for a, b, w in zip(first.tolist(), [*first[1:].tolist(), len(keys)], words[first].tolist(), strict=True):
                child = self.children.get(w)
                if child is not None:
                    child.add(keys[a:b], counts[a:b])
                    own[a:b] = False
            keys, counts = keys[own], counts[own]
        self.container.add(keys, counts)
        if len(self.container) > self.limit and self.depth < self.length - 1:
            self._split()

    def _split(self) -> None:
        """Words that hold a sixteenth of the limit or more get containers of their own."""
        keys, counts = self.container.items()
        words = self._word(keys)
        often, number = np.unique(words, return_counts=True)
        often = often[number >= max(1, self.burst // 16)]
        place = np.searchsorted(often, words)
        moved = np.append(often, -1)[place] == words
        order = np.flatnonzero(moved)[np.argsort(place[moved], kind="stable")]
        ends = np.searchsorted(place[order], np.arange(len(often) + 1)).tolist()
        for w, a, b in zip(often.tolist(), ends[:-1], ends[1:], strict=True):
            child = self.children.setdefault(w, HatTrie(self.length, self.depth + 1, self.burst))
            child.container.add(keys[order[a:b]], counts[order[a:b]])
        self.container = ArrayHash()
        self.container.add(keys[~moved], counts[~moved])
        self.limit = max(self.burst, 2 * len(self.container))

    def _all(self) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.container.items(), *(child._all() for child in self.children.values())]
        return np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])

    def spill(self, most: int):
        """Takes whole subtrees out, the largest first, until at most ``most``
        n-grams are left: (keys, counts) of each."""
        sizes = sorted([(len(child), w) for w, child in self.children.items()] + [(len(self.container), -1)], reverse=True)
        left = sum(n for n, _ in sizes)
        for n, w in sizes:
            if left <= most or not n:
                break
            if w < 0:
                held, self.container = self.container.items(), ArrayHash()
            else:
                held = self.children.pop(w)._all()
            yield held
            left -= n


# ------------------------------------------------------------------- filter
def _word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang.encode() + b"\0" + word, 42)


def _joined_hash(hashes: list[np.ndarray]) -> np.ndarray:
    """One hash of each row of word hashes."""
    out = hashes[0]
    for h in hashes[1:]:
        out = (out ^ out >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) + h
    return out


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mixed = (hashes ^ hashes >> np.uint64(31)) * np.uint64(MIX)
    mask = np.uint64(bits - 1)
    return mixed & mask, mixed >> np.uint64(32) & mask


class Filter:
    """A bitmap of the frequent phrases of one length."""

    def __init__(self, bits: int, parts: list[tuple[int, bytes]]):
        self.bits = bits
        self.bytes = np.zeros(max(bits // 8, 4096), np.uint8)
        for bucket, part in parts:
            self.bytes[bucket * 4096:bucket * 4096 + len(part)] = np.frombuffer(part, np.uint8)
        self.packed = self.bytes.tobytes()

    def has(self, hashes: np.ndarray) -> np.ndarray:
        a, b = _places(hashes, self.bits)
        at = lambda p: self.bytes[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1
        return (at(a) & at(b)).astype(bool)

    def has_one(self, h: int) -> bool:
        """``has`` for one hash, without arrays."""
        mixed, mask = (h ^ h >> 31) * MIX & (1 << 64) - 1, self.bits - 1
        a, b = mixed & mask, mixed >> 32 & mask
        return bool(self.packed[a >> 3] >> (a & 7) & self.packed[b >> 3] >> (b & 7) & 1)


def frequent_filter(frequent: DataFrame) -> Filter:
    """The bitmap of the phrases (lang, phrase), sized by their number."""
    bits = min(BITMAP, max(1 << 16, 1 << (16 * frequent.count()).bit_length()))

    def places(batches):
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            words = [[_word_hash(lang, w) for w in phrase.encode().split(b" ")] for lang, phrase in rows]
            if words:
                columns = [np.array(c, np.uint64) for c in zip(*words, strict=True)]
                for p in _places(_joined_hash(columns), bits):
                    yield pa.record_batch({"place": p.astype(np.int64)})

    place = frequent.select("lang", "phrase").mapInArrow(places, "place long").select((F.col("place") + 1).alias("place"))
    parts = place.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("part")).collect()  # BITMAP bits at most
    return Filter(bits, [(r.bucket - 1, bytes(r.part)) for r in parts])


# ----------------------------------------------------------------- counting
class _Words(dict):
    """Numbers of words from 1 on; 0 for those that the filter excludes."""

    def __init__(self, lang: str, excluded):
        super().__init__()
        self.prefix, self.excluded, self.words, self.hashes = lang.encode() + b"\0", excluded, [_BREAK], [0]
        self[_BREAK] = 0

    def __missing__(self, word):
        h = xxhash.xxh64_intdigest(self.prefix + word, 42)  # as _word_hash
        if self.excluded is not None and not self.excluded.has_one(h):
            self[word] = 0
            return 0
        self[word] = number = len(self.words)
        self.words.append(word)
        self.hashes.append(h)
        return number


class Counter:
    """Counts the n-grams of one length and language; full tries leave as sorted runs."""

    def __init__(self, lang: str, length: int, words: Filter | None, grams: Filter | None, full: int, burst: int):
        self.lang, self.length, self.grams, self.full, self.burst = lang, length, grams, full, burst
        self.excluded, self.bits, self.total = words, 63 // length, 0
        self._fresh()

    def _fresh(self):
        self.words, self.trie, self.hashed = _Words(self.lang, self.excluded), HatTrie(self.length, burst=self.burst), np.zeros(0, np.uint64)

    def add(self, texts: list[bytes]):
        """Counts the texts; yields runs (phrases, counts) where the trie is full."""
        line = _BREAK.join(texts).lower().translate(_EVEN).replace(b"\n", b" \xff ").replace(_BREAK, b" \xff ")
        words = [w for w in line.split(b" ") if w]
        step = 1 << 18
        for i in range(0, len(words), step):  # a slice takes the first words of the next along
            if len(self.words) + step + self.length >= min(1 << self.bits, 4 * self.full):
                yield from self.flush()
            part = words[i:i + step + self.length - 1]
            ids = np.fromiter(map(self.words.__getitem__, part), np.int64, len(part))
            self._count(ids, min(step, len(words) - i))
            if len(self.trie) > self.full:
                yield from self._runs(self.full // 2)

    def _count(self, ids: np.ndarray, starts: int) -> None:
        n = self.length
        if n == 1:
            self.total += int((ids[:starts] > 0).sum())
        count = len(ids) - n + 1
        if count <= 0:
            return
        ok = ids > 0
        if n > 2:
            if len(self.hashed) < len(self.words.hashes):
                self.hashed = np.array(self.words.hashes, np.uint64)
            h = self.hashed[ids]
            shorter = len(ids) - n + 2
            has = self.grams.has(_joined_hash([h[j:j + shorter] for j in range(n - 1)]))
            good = has[:-1] & has[1:]
        else:
            good = np.ones(count, bool)
        keys = np.zeros(count, np.int64)
        for j in range(n):
            good &= ok[j:j + count]
            keys = keys << self.bits | ids[j:j + count]
        self.trie.add(*np.unique(keys[good], return_counts=True))

    def _runs(self, most: int):
        words = pa.array(self.words.words, pa.binary())
        for keys, counts in self.trie.spill(most):
            order = np.argsort(keys)
            keys, counts = keys[order], counts[order]
            mask = (1 << self.bits) - 1
            columns = [words.take(pa.array(keys >> self.bits * (self.length - 1 - j) & mask)) for j in range(self.length)]
            phrases = columns[0] if self.length == 1 else pc.binary_join_element_wise(*columns, b" ")
            yield phrases, pa.array(counts)

    def flush(self):
        yield from self._runs(0)
        self._fresh()


def _counts(texts: DataFrame, length: int, words: Filter | None, grams: Filter | None, full: int, burst: int) -> DataFrame:
    """(lang, phrase, f): partial counts of the n-grams; for single words also the
    number of all words, with a null phrase.  ``texts`` is (lang, text)."""
    sc = texts.sparkSession.sparkContext
    shared = sc.broadcast((words, grams))

    def count(batches):
        counters: dict[str, Counter] = {}

        def rows(lang, runs):
            for phrases, counts in runs:
                for i in range(0, len(phrases), 1 << 16):
                    part = phrases.slice(i, 1 << 16).cast(pa.string())
                    yield pa.record_batch({"lang": pa.array([lang] * len(part), pa.string()), "phrase": part,
                                           "f": counts.slice(i, 1 << 16)})

        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            held: dict[str, int] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                by_lang.setdefault(lang, []).append(text.as_buffer().to_pybytes() if text.is_valid else b"")
                held[lang] = held.get(lang, 0) + len(by_lang[lang][-1])
                if held[lang] > SLICE:
                    yield from rows(lang, counter(counters, lang).add(by_lang.pop(lang)))
                    held[lang] = 0
            for lang, part in by_lang.items():
                yield from rows(lang, counter(counters, lang).add(part))
        for lang, c in counters.items():
            yield from rows(lang, c.flush())
            if length == 1:
                yield pa.record_batch({"lang": [lang], "phrase": pa.array([None], pa.string()), "f": pa.array([c.total], pa.int64())})

    def counter(counters, lang):
        if lang not in counters:
            counters[lang] = Counter(lang, length, *shared.value, full, burst)
        return counters[lang]

    return texts.mapInArrow(count, "lang string, phrase string, f long")


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3,
                  min_count: int = 10, full: int = FULL, burst: int = BURST) -> tuple[list[DataFrame], DataFrame]:
    """([(lang, phrase, f) of the phrases of 1, 2, ... words with ``f >= min_count``],
    (lang, n): the number of words)."""
    texts = docs.select(F.coalesce(quoted(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
                        quoted(text_col).cast("string").alias("text"))
    found, words, grams = [], None, None
    for length in range(1, max_words + 1):
        runs = _counts(texts, length, words, grams, full, burst)
        merged = runs.repartition("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
        merged = written(merged.where(F.col("phrase").isNull() | (F.col("f") >= min_count)), f"phrases-{length}")
        found.append(merged.where("phrase is not null"))
        if length == 1:
            totals = merged.where("phrase is null").select("lang", F.col("f").alias("n"))
        if length < max_words:
            grams = frequent_filter(found[-1])
            words = grams if length == 1 else words
    return found, totals


# ------------------------------------------------------------------ scoring
def _part(first: int, n: int):
    """``n`` words of the phrase from number ``first`` (from 1) on."""
    return F.array_join(F.slice(F.split("phrase", " "), first, n), " ")


def _scored(counts: list[DataFrame], length: int) -> DataFrame:
    """Phrases of ``length`` words with l, r and score of their lowest-scoring cut."""
    rows = counts[length - 1].withColumnRenamed("f", "a")
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    for k in range(1, length):
        for side, n, words in (("l", k, _part(1, k)), ("r", length - k, _part(k + 1, length - k))):
            part = counts[n - 1].select("lang", F.col("phrase").alias("part"), F.col("f").alias(f"{side}{k}"))
            rows = rows.withColumn("part", words).join(part, ["lang", "part"]).drop("part")
    rows = rows.withColumn("top", (exact("a") * exact("a")).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)"))
    for k in range(1, length):
        rows = rows.withColumn(f"under{k}", exact(f"l{k}") * exact(f"r{k}"))
    cuts = F.array(*(F.struct(F.expr(f"top div under{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"),
                              F.col(f"r{k}").alias("r")) for k in range(1, length)))
    return rows.withColumn("cut", F.array_min(cuts)).select("lang", "phrase", F.lit(length).alias("n_words"), "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3, min_count: int = 10,
                 dominated: int = 50, top: int = 2000, full: int = FULL, burst: int = BURST) -> DataFrame:
    """The ``top`` phrases of 2 to ``max_words`` words of each language: lang, rank,
    phrase, n_words, a (its count), l and r (of the two parts of its lowest-scoring
    cut), n (words of the language) and score, 1,000,000 a a / (l r) rounded down.
    A phrase goes if a longer one with at least ``dominated`` percent of its count holds it."""
    counts, totals = phrase_counts(docs, text_col, lang_col, max_words, min_count, full, burst)
    kept = None
    for length in range(2, max_words + 1):
        rows = _scored(counts, length)
        for longer in range(length + 1, max_words + 1):
            inside = counts[longer - 1].select("lang", "f", F.explode(F.array(*(
                _part(i, length) for i in range(1, longer - length + 2)))).alias("phrase"))
            most = inside.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
            rows = rows.join(most, ["lang", "phrase"], "left").where(
                F.col("most").isNull() | (100 * F.col("most") < dominated * F.col("a"))).drop("most")
        kept = rows if kept is None else kept.unionAll(rows)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "n_words", "a", "l", "r", "n", "score")
