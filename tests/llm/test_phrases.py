"""Collocations against plain counting of every n-gram."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import EDGES, SF
from pyspark.sql import functions as F

from ratetide.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, max_words=3, min_count=10, dominated=50, top=2000):
    """{(lang, rank): (phrase, n_words, a, l, r, n, score)} for [(lang, text)]."""
    f, n = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f.setdefault(lang, Counter()).update(zip(*(w[j:] for j in range(k)), strict=False))
    out = {}
    for lang, count in f.items():
        rows = []
        for p, a in count.items():
            if len(p) < 2 or a < min_count:
                continue
            score, k = min((1_000_000 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), p, count[p[:k]], count[p[k:]]))
        longer = Counter()
        for *_, p, _, _ in rows:
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i:i + m]] = max(longer[p[i:i + m]], count[p])
        rows = sorted(r for r in rows if 100 * longer[r[3]] < dominated * -r[1])[:top]
        for rank, (s, a, text, p, left, right) in enumerate(rows, 1):
            out[lang, rank] = (text.decode(), len(p), -a, left, right, n[lang], -s)
    return out


def result(df):
    rows = df.collect()
    got = {(r.lang, r["rank"]): (r.phrase, r.n_words, r.a, r.l, r.r, r.n, r.score) for r in rows}
    assert len(got) == len(rows)
    return got


def some_texts(seed, n=120):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "new", "york", "city", "é", "Éa", "\x00x", "a\x1cb", "日本", "z" * 300, "New"]
    return [(rng.choice(["en", "en", "fr", None, "und", ""]), "".join(
        rng.choices(vocabulary, weights=range(len(vocabulary), 0, -1))[0] + rng.choices([" ", "  ", "\t", ". ", ",", "\n", "!x ", " "], weights=[20, 2, 2, 1, 1, 1, 1, 1])[0]
        for _ in range(rng.randint(0, 80)))) for _ in range(n)]


@pytest.mark.parametrize("full,burst,max_words,min_count", [(1 << 20, 1 << 14, 3, 10), (40, 8, 3, 10), (30, 4, 4, 3), (100, 16, 2, 1)])
def test_collocations(spark, full, burst, max_words, min_count):
    """Also with tries that burst and spill all the time."""
    docs = some_texts(full) + [("en", None), (None, None), ("en", ""), ("en", " .,"), ("en", "new york city " * 500)] + [("fr", "Ah oui. ")] * 12
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    got = result(phrases.collocations(df, max_words=max_words, min_count=min_count, full=full, burst=burst, top=40))
    assert got == plain(docs, max_words, min_count, top=40) and len(got) > 20


def test_full_filter(spark, monkeypatch):
    """A bitmap that lets everything pass gives the same rows."""
    docs = some_texts(9)
    df = spark.createDataFrame(docs, "lang string, text string")
    monkeypatch.setattr(phrases.Filter, "has", lambda self, h: np.ones(len(h), bool))
    monkeypatch.setattr(phrases.Filter, "has_one", lambda self, h: True)
    assert result(phrases.collocations(df)) == plain(docs)


def test_large_counts(spark, monkeypatch):
    """Products beyond 64 bits stay exact."""
    f = {("new",): 4_000_000_007, ("york",): 3_999_999_989, ("city",): 5_000_000_029, ("new", "york"): 3_999_999_001,
         ("york", "city"): 3_000_000_019, ("new", "york", "city"): 1_999_999_500}
    tables = [spark.createDataFrame([("en", " ".join(p), c) for p, c in f.items() if len(p) == k], "lang string, phrase string, f long")
              for k in (1, 2, 3)]
    monkeypatch.setattr(phrases, "phrase_counts", lambda *a: (tables, spark.createDataFrame([("en", 10 ** 13)], "lang string, n long")))
    got = {r.phrase: (r.a, r.l, r.r, r.score) for r in phrases.collocations(spark.createDataFrame([], "lang string, text string")).collect()}
    cut = lambda a, left, right: (f[a], f[left], f[right], 1_000_000 * f[a] ** 2 // (f[left] * f[right]))
    ny, yc, nyc = ("new", "york"), ("york", "city"), ("new", "york", "city")
    want = {"new york": cut(ny, ("new",), ("york",)), "new york city": min(cut(nyc, ("new",), yc), cut(nyc, ny, ("city",)), key=lambda x: x[3])}
    assert 100 * f[nyc] < 50 * f[ny] and 100 * f[nyc] >= 50 * f[yc]
    assert got == want


def test_edges(spark, edges, clashing, no_docs):
    docs = [("en", r[1]) for r in EDGES]
    odd = clashing.select("*", *(F.lit(1).alias(c) for c in ("f", "phrase", "n", "Rank")))
    got = result(phrases.collocations(odd, min_count=3))
    assert got == plain(docs, min_count=3) and got
    assert phrases.collocations(no_docs).collect() == []


def test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text")
    assert result(phrases.collocations(docs)) == plain([tuple(r) for r in docs.collect()])


def test_spill_takes_whole_subtrees():
    trie = phrases.HatTrie(2, burst=32)
    rng = np.random.default_rng(3)
    want = Counter()
    got = Counter()
    for _ in range(30):
        keys, counts = np.unique((rng.integers(0, 6, 200) ** 2 << 31) | rng.integers(0, 90, 200), return_counts=True)
        trie.add(keys, counts)
        want.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        before = len(trie)
        for k, c in trie.spill(300):
            assert len(set((k >> 31).tolist())) == 1 or not trie.container
            got.update(dict(zip(k.tolist(), c.tolist(), strict=True)))
        assert len(trie) <= max(300, before) and len(trie) <= 300
    assert trie.children
    for k, c in trie.spill(0):
        got.update(dict(zip(k.tolist(), c.tolist(), strict=True)))
    assert got == want and len(trie) == 0


def test_a_trie_with_subtrees_takes_an_empty_slice():
    """The filter may leave no n-gram of a slice once the trie has burst."""
    trie = phrases.HatTrie(2, burst=32)
    keys = np.unique((np.arange(400) % 5 << 31) | np.arange(400))
    trie.add(keys, np.ones(len(keys), np.int64))
    assert trie.children
    trie.add(np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert len(trie) == len(keys)
