"""Decontamination of repetitive and long texts, and clashing names."""

import random
import time

import brute
from pyspark.sql import functions as F

from ratetide.llm import decontamination


def check(spark, docs, items):
    got = decontamination.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                                        spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute.decontaminate([(r.doc_id, r.text) for r in got], items)
    for r, (n, hit, ids) in zip(got, want, strict=True):
        assert (r.contamination.n_words, r.contamination.positions) == (n, hit)
        assert r.contamination["items"] == sorted(str(i) for i in ids if i is not None)
    return sum(len(h) for _, h, _ in want)


def test_repetitive_texts(spark):
    rng = random.Random(6)
    some = lambda n, k: " ".join(rng.choices("abcd"[:k], k=n))
    docs = [(i, some(rng.randint(0, 300), rng.randint(1, 4))) for i in range(60)] + [(99, "la " * 500), (98, "la " * 13), (97, "la " * 12)]
    items = [(i, some(rng.randint(1, 60), rng.randint(1, 3))) for i in range(20)] + [(99, "la " * 300), (98, "la la"), (97, "la " * 13)]
    assert check(spark, docs, items) > 1000


def test_long_repetitive_text(spark):
    docs = spark.createDataFrame([(1, "la " * 1_000_000), (2, "x " * 50)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "la " * 1000)], "item_id long, text string")
    start = time.time()
    r = decontamination.contamination(docs, items).select("doc_id", F.size("contamination.positions").alias("n")).collect()
    assert {x.doc_id: x.n for x in r} == {1: 1_000_000, 2: 0}
    assert time.time() - start < 60


def test_a_long_item_in_a_long_text(spark):
    rng = random.Random(7)
    words = lambda n: [f"w{rng.randint(0, 10 ** 6)}" for _ in range(n)]
    item = words(6000)
    docs = spark.createDataFrame([(1, " ".join(words(20_000) + item + words(20_000)))], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    start = time.time()
    r = decontamination.contamination(docs, items).select("contamination.positions").first()[0]
    assert r == list(range(20_000, 26_000))
    assert time.time() - start < 60


def test_clashing_names(spark):
    names = ("doc_key", "class", "item_words", "item_ids", "k", "h", "text_key", "bitmap", "candidates", "place")
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l m n")], "doc_id long, text string")
    docs = docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(names)))
    items = spark.createDataFrame([(5, "b c d e f g h i j k l m n o", 1)], "item_id long, text string, doc_key int")
    r = decontamination.contamination(docs, items).first()
    assert r.contamination.positions == list(range(1, 14)) and r.contamination["items"] == ["5"] and r.doc_key == 0
