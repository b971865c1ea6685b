"""Packing against the library's own ids, a plain best fit and the rules of the layout."""

import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import EDGES, SF, long_text
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ratetide.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]


ODD = ["", " ", "It's  THE dog's, they'll", "a b c\x85d\x1ce\x1ff", "İstanbul ΟΔΟΣ ǅ ﬁ", "é ́x", "12 345٣ ½x²",
       "a<|endoftext|>b <|startoftext|> <|endoftext", "«Déjà-vu» – œuvre’s ’s", "\x00\x07ab﻿‍👩‍🚀", "ſtraße ÿ Ÿ ŉ × ÷ µ",
       "'S 'RE x'm", "\r\n\t\v\f", "日本語のテキスト、ですよ।", "x" * 5000]


def test_ids_are_the_librarys(spark):
    encoder = packing.WordEncoder.of(PATH)
    texts = ODD + [t for _, t in EDGES if t] + [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(60).collect()]
    rng = random.Random(4)
    texts += ["".join(rng.choices("aB'sT \t\n.,é̀ßΣ9<|>endoftx ", k=60)) for _ in range(300)]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() + [1] == library_ids(text), text[:80]


def plain_best_fit(lengths, capacity, bins):
    """[bin of each length]: lists of (free, age), nothing else."""
    open_bins, made, out = [], 0, []
    for n in lengths:
        fits = [b for b in open_bins if b[0] >= n]
        if fits:
            least = min(b[0] for b in fits)
            b = [b for b in fits if b[0] == least][-1]
            open_bins.remove(b)
        else:
            if len(open_bins) == bins and n < capacity:
                open_bins.remove(min(open_bins, key=lambda b: b[0]))
            b = [capacity, made]
            made += 1
        out.append(b[1])
        if b[0] > n:
            open_bins.append([b[0] - n, b[1]])
    return out


@pytest.mark.parametrize("bins", [1, 3, 1000])
def test_best_fit(bins):
    rng = random.Random(bins)
    lengths = [rng.choice([rng.randint(1, 40), rng.randint(1, 100), 100]) for _ in range(600)]
    at, offset, still = packing.best_fit(lengths, 100, bins)
    assert at.tolist() == plain_best_fit(lengths, 100, bins)
    used, open_now = defaultdict(int), set(at[still].tolist())
    for b, o, n in zip(at.tolist(), offset.tolist(), lengths, strict=True):
        assert o == used[b] and o + n <= 100
        used[b] += n
    assert len(open_now) <= bins and all(used[b] < 100 for b in open_now)


def checked(rows, capacity):
    """Gapless offsets; the number of sequences."""
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert all(o == sum(n for _, n in parts[:i]) for i, (o, _) in enumerate(parts)) and sum(n for _, n in parts) <= capacity
    return len(bins)


@pytest.mark.parametrize("group", [1 << 16, 40])
def test_pack_levels(spark, group):
    rng = random.Random(8)
    lengths = [rng.choice([rng.randint(1, 20), rng.randint(1, 64)]) for _ in range(1500)]
    pieces = spark.createDataFrame([(i // 2, n) for i, n in enumerate(lengths)], "doc_id long, length long").repartition(3)
    rows = packing.pack(pieces, capacity=64, bins=8, group=group).collect()
    assert Counter((r.doc_id, r.length) for r in rows) == Counter((i // 2, n) for i, n in enumerate(lengths))
    assert checked(rows, 64) <= 1.08 * sum(lengths) / 64


def test_pieces_and_sequences(spark, edges, clashing, no_docs):
    pieces = packing.token_pieces(edges, PATH, capacity=256)
    packed = packing.pack(pieces, capacity=256)
    rows = packed.collect()
    whole = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.piece):
        assert r.start == 256 * r.piece and len(r.ids) == 4 * r.length and 0 < r.length <= 256
        whole[r.doc_id, r.text].append(r)
    times = Counter(EDGES)
    for (i, text), parts in whole.items():
        want = library_ids(text)
        if times[i, text] == 1:
            assert np.frombuffer(b"".join(p.ids for p in parts), "<u4").tolist() == want
            assert all(p.length == 256 for p in parts[:-1])
    assert set(whole) == set(EDGES)
    n = checked(rows, 256)
    assert n <= 2 + sum(r.length for r in rows) / 256
    made = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert len(made) == n
    for r in rows:
        assert made[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == r.ids
    odd = clashing.withColumn("ids", F.lit(1)).withColumn("Row", F.lit(2)).withColumn("place_row", F.lit(3)).withColumn("offset", F.lit(4))
    out = packing.pack(packing.token_pieces(odd, PATH))
    assert out.columns == [*odd.columns, "piece", "start", "length", "ids_", "sequence_id", "offset_"]
    assert out.where("place_row = 3 and Row = 2 and offset = 4").count() == len(EDGES) + out.where("piece > 0").count()
    assert packing.pack(packing.token_pieces(no_docs, PATH)).collect() == []


def test_repeated_row(spark):
    """One row many times over, alone in the table."""
    rows = spark.range(3000).select(F.lit(7).alias("doc_id"), F.lit(3).cast("long").alias("length"))
    assert checked(packing.pack(rows, capacity=10, bins=4, group=100).collect(), 10) == 1000


def test_query(spark):
    rows = queries.op13_packing(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    n = {i: len(library_ids(t)) for i, t in docs.items()}
    got = defaultdict(int)
    for r in rows:
        got[r.doc_id] += r.length
    assert got == n and checked(rows, 4096) <= 1.01 * sum(n.values()) / 4096 + 1
