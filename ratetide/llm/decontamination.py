"""Benchmark decontamination by winnowing, with DataFrame functions only.

A test item is looked for by its windows of ``window`` consecutive words (an
item with fewer words is one window).  Both sides keep the smallest hash of
``gram`` words in every run of ``window - gram + 1`` of them, so each shared
window has a fingerprint in common.  Fingerprints are joined, and each match is
extended to all windows that the two texts share, in one pass over each: hashes
only propose, equal words decide.  Items shorter than a window are proposed by
the hash of all their words instead; documents hash as many words at every place
for those lengths only that occur.  A bitmap of 16 bits for each document with a
match, ``BITMAP`` bits at most, keeps other texts from being shuffled; where it
is too small, more texts are, and the results are the same.

Words are maximal runs outside ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z
are lower-cased.  A null text has no words, an item without words no window.
Items with the same words are searched once.  An item without an id counts for
the words that are hit, but is not listed.  Repeated rows get the same result
each; rows with equal ids but other texts are judged by their own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, let, lower_ascii, quoted, words_of, written

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WINDOW, GRAM = 13, 6
BITMAP = 1 << 28   # bits of the candidate filter, at most: 32 MB
BUCKETS = 4096     # buckets that an item's places are dealt to, at most


def item_words(text: Column) -> Column:
    return words_of(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS)


def _grams(words: Column, k: int) -> Column:
    """Hashes of all runs of ``k`` words; ``words`` is a column or bound variable."""
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, *(F.get(words, i + j) for j in range(1, k))))
    return F.when(F.size(words) >= k, F.slice(hashes, F.lit(1), F.size(words) - (k - 1))).otherwise(
        F.array().cast("array<bigint>"))


def _winnowed(words: Column, window: int, gram: int) -> Column:
    """The distinct smallest hashes of all runs of ``window - gram + 1`` grams."""
    run = window - gram + 1

    def smallest(g):
        mins = F.transform(g, lambda h, i: F.least(h, *(F.get(g, i + j) for j in range(1, run))))
        return F.array_distinct(F.slice(mins, F.lit(1), F.size(g) - (run - 1)))

    return F.when(F.size(words) >= window, let(_grams(words, gram), smallest)).otherwise(
        F.array().cast("array<bigint>"))


def _tagged(k: int, hashes: Column) -> Column:
    return F.transform(hashes, lambda h: F.struct(F.lit(k).alias("k"), h.alias("h")))


def _fingerprints(words: Column, window: int, gram: int, short: list[int]) -> Column:
    """(k, hash) of a document: winnowed grams, and all grams of short items' lengths."""
    return F.concat(_tagged(gram, _winnowed(words, window, gram)),
                    *(_tagged(k, F.array_distinct(_grams(words, k))) for k in short))


def _hit_flags(words: Column, grams: Column, item: Column, k: int) -> Column:
    """For each run of ``k`` words (``grams``: their hashes), whether ``item`` has it.

    Linear in both texts: hashes that both have are found by a set operation,
    the item's places with such a hash are dealt to buckets, and a place of the
    document looks at its bucket only.  Equal words decide."""
    def flags(own):
        shared = F.array_intersect(grams, F.transform(own, lambda e: e.h))
        return let(shared, lambda both: F.when(F.size(both) > 0, let(
            F.filter(own, lambda e: F.array_contains(both, e.h)), lambda kept: let(
                F.least(F.size(both), F.lit(BUCKETS)), lambda n: let(
                    F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.filter(kept, lambda e: F.pmod(e.h, n) == b)),
                    lambda buckets: F.transform(grams, lambda h, i: F.exists(
                        F.get(buckets, F.pmod(h, n).cast("int")),
                        lambda e: (e.h == h) & (F.slice(item, e.j + 1, F.lit(k)) == F.slice(words, i + 1, F.lit(k))))))))))

    return let(F.transform(_grams(item, k), lambda h, j: F.struct(h.alias("h"), j.alias("j"))), flags)


def _hit_positions(words: Column, grams: dict[int, Column], item: Column, window: int) -> Column:
    """Positions of ``words`` in occurrences of the item's windows, ascending."""
    def covered(k):
        return lambda flags: F.when(F.array_contains(flags, True), F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.array_contains(
            F.slice(flags, F.greatest(i - (k - 2), F.lit(1)), F.least(F.lit(k), i + 1)), True)))

    out = F.array().cast("array<int>")
    for k, hashes in grams.items():
        fits = F.size(item) >= window if k == window else F.size(item) == k
        out = F.when(fits, let(_hit_flags(words, hashes, item, k), covered(k))).otherwise(out)
    return F.coalesce(out, F.array().cast("array<int>"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  gram: int = GRAM, out: str = "contamination") -> DataFrame:
    """``docs`` with a struct column ``out`` (underscores are appended while the
    name is taken): n_words, positions (hit words, from 0, ascending) and items
    (the ids of items with occurring windows, as sorted strings)."""
    out, key, doc_key, found = (free_name(docs, x) for x in (out, "text_key", "doc_key", "candidates"))
    classes = (items.select(quoted(item_id_col).cast("string").alias("item_id"), item_words(quoted(item_text_col)).alias("item_words"))
               .where(F.size("item_words") > 0)
               .groupBy("item_words").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
               .withColumn("class", F.xxhash64("item_words")))
    classes = written(classes, "decontam-items")
    # at most window - 1 numbers come to the driver
    short = sorted(r[0] for r in classes.select(F.size("item_words").alias("n")).where(F.col("n") < window).distinct().collect())
    own = F.when(F.size("item_words") >= window, _tagged(gram, _winnowed(F.col("item_words"), window, gram)))
    for k in short:
        own = own.when(F.size("item_words") == k, _tagged(k, _grams(F.col("item_words"), k)))
    item_prints = classes.select("class", F.inline(own))

    keyed = docs.withColumn(key, F.xxhash64(quoted(id_col), quoted(text_col)))
    doc_prints = keyed.select(quoted(key).alias(doc_key), F.inline(
        let(item_words(quoted(text_col)), lambda x: _fingerprints(x, window, gram, short))))
    pairs = doc_prints.join(item_prints, ["k", "h"]).select(doc_key, "class").distinct()
    candidates = (pairs.join(classes, "class")
                  .groupBy(doc_key).agg(F.collect_list(F.struct("item_words", "item_ids")).alias(found)))
    candidates = written(candidates, "decontam-candidates")

    def judged(words):
        sizes = sorted({window, *short})
        per_item = let(F.struct(*(_grams(words, k).alias(f"g{k}") for k in sizes)), lambda g: F.transform(
            quoted(found), lambda c: F.struct(c.item_ids.alias("ids"), _hit_positions(
                words, {k: g[f"g{k}"] for k in sizes}, c.item_words, window).alias("at"))))
        empty = F.array().cast("array<int>")
        return let(F.when(quoted(found).isNotNull(), F.filter(per_item, lambda c: F.size(c.at) > 0)), lambda hits: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.coalesce(F.sort_array(F.array_distinct(F.flatten(F.transform(hits, lambda c: c.at)))), empty).alias("positions"),
            F.coalesce(F.sort_array(F.array_distinct(F.flatten(F.transform(hits, lambda c: c.ids)))),
                       F.array().cast("array<string>")).alias("items")))

    # only texts that may have a candidate are shuffled to it
    bits = min(BITMAP, max(1 << 15, 1 << (16 * candidates.count()).bit_length()))
    place, slot, bitmap, maybe = (free_name(docs, x) for x in ("place", "bitmap_slot", "bitmap", "maybe"))
    marked = keyed.withColumn(place, F.pmod(quoted(key), F.lit(bits)) + 1).withColumn(slot, F.bitmap_bucket_number(quoted(place)))
    marked = marked.join(F.broadcast(_bitmap(candidates, doc_key, bits, slot, bitmap)), slot, "left")
    marked = marked.withColumn(maybe, _bit(quoted(bitmap), F.bitmap_bit_position(quoted(place))))
    plain = marked.where(~quoted(maybe)).withColumn(found, F.lit(None).cast(candidates.schema[found].dataType))
    likely = marked.where(quoted(maybe)).join(candidates.hint("shuffle_hash"), quoted(doc_key) == quoted(key), "left")
    columns = [quoted(c) for c in (*docs.columns, found)]
    joined = plain.select(*columns).unionAll(likely.select(*columns))
    return joined.select(*(quoted(c) for c in docs.columns), let(item_words(quoted(text_col)), judged).alias(out))


def _bitmap(candidates: DataFrame, doc_key: str, size: int, slot: str, bits: str) -> DataFrame:
    """Which of ``size`` places the candidate documents take."""
    place = candidates.select((F.pmod(quoted(doc_key), F.lit(size)) + 1).alias("place"))
    return place.groupBy(F.bitmap_bucket_number("place").alias(slot)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias(bits))


def _bit(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("getbit", byte, F.pmod(position, F.lit(8)).cast("int")) == 1, F.lit(False))


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """A twentieth of the words or more are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
