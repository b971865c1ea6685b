"""Periodic runs against a version that tries every period at every place."""

import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest import EDGES, SF, long_text
from pyspark.sql import functions as F

from ratetide.llm import periodic_runs as pr
from ratetide.llm import queries


def plain_runs(w, least=24, repeats=3):
    """{(start, length, period)} by the definition."""
    out = {}
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, repeats * q):
                out.setdefault((i, j + q), q)  # periods ascend: the smallest stays
            i = j
    return sorted((a, b - a, q) for (a, b), q in out.items())


def plain_collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_transform():
    rng = np.random.default_rng(1)
    for n in (1, 2, 8, 64):
        x = rng.integers(0, pr.PRIME, (3, n)).astype(np.uint64)
        root = pow(pr.ROOT, (pr.PRIME - 1) // n, pr.PRIME)
        want = [[sum(int(v) * pow(root, i * k, pr.PRIME) for i, v in enumerate(row)) % pr.PRIME for k in range(n)] for row in x]
        assert pr.ntt(x).tolist() == want and (pr.ntt(pr.ntt(x), inverse=True) == x).all()


def test_block_distances(monkeypatch):
    monkeypatch.setattr(pr, "POINTS", 64)  # several turns
    rng = np.random.default_rng(2)
    x = (rng.random(400) < 0.1).astype(np.uint64)
    starts = np.arange(0, 320, 8)
    for first in (1, 8):
        row, lag = pr.block_distances(x, starts, 8, first)
        want = {(i, d) for i, s in enumerate(starts) for d in range(first, first + 8) if (x[s:s + 8] == x[s + d:s + d + 8]).all()}
        assert set(zip(row.tolist(), lag.tolist(), strict=True)) == want and len(want) > 5


def periodic_text(rng):
    """Pieces of periodic and other words, some with a fault."""
    out = []
    for _ in range(rng.randint(1, 6)):
        q = rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 33, 40, 64])
        unit = rng.choices("ab" if rng.random() < 0.5 else "abcdefgh", k=q)
        part = (unit * 40)[:rng.randint(1, max(30, 4 * q))]
        if part and rng.random() < 0.3:
            part[rng.randrange(len(part))] = "x"
        out += part + rng.choices("abcdefghijkl", k=rng.choice([0, 0, 3, 20]))
    return out


@pytest.mark.parametrize("least,repeats", [(24, 3), (3, 3), (10, 4), (50, 3)])
def test_runs(least, repeats):
    rng = random.Random(least)
    texts = [periodic_text(rng) for _ in range(250)] + [[], ["a"], ["a"] * 23, ["a"] * 24, list("ab") * 300]
    fib = ["a", "ab"]
    while len(fib[-1]) < 700:
        fib.append(fib[-1] + fib[-2])
    texts += [list(fib[-1]), list("a" * 30 + "b" + "a" * 30 + "c" + "a" * 30 + "d") * 5, list(("a" * 30 + "b") * 9)]
    got = pr.text_runs([[x.encode() for x in t] for t in texts], least, repeats)
    total = 0
    for t, runs in zip(texts, got, strict=True):
        assert runs == plain_runs(t, least, repeats), t
        assert pr.collapse([x.encode() for x in t], runs).decode() == plain_collapse(t, runs)
        total += len(runs)
    assert total > 100


def test_long_texts():
    """A word a million times, a long period, and breaks of a long run."""
    start = time.time()
    one = [b"la"] * 1_000_000
    assert pr.text_runs([one]) == [[(0, 1_000_000, 1)]]
    unit = [str(i).encode() for i in range(50_000)]
    assert pr.text_runs([unit * 4 + [b"end"]]) == [[(0, 200_000, 50_000)]]
    broken = ([b"la"] * 40 + [b"di"]) * 2000 + [b"la"] * 100
    found = pr.text_runs([broken])[0]
    assert len([r for r in found if r[2] == 1]) == 2001 and (0, 82_040, 41) in found and len(found) == 2002
    assert time.time() - start < 90


def test_operator(spark, edges, clashing, no_docs):
    for docs in (edges, edges.coalesce(1)):
        rows = pr.periodic_runs(docs).collect()
        assert sorted(map(str, ((r.doc_id, r.text) for r in rows))) == sorted(map(str, EDGES))
        for r in rows:
            w = [x.decode() for x in (r.text or "").encode().split()]
            if len(w) < 3000:
                assert [tuple(x) for x in r.periodic.runs] == plain_runs(w)
            assert r.periodic.collapsed == plain_collapse(w, [tuple(x) for x in r.periodic.runs])
    odd = clashing.withColumn("Periodic", F.lit(1)).withColumn("runs", F.lit(2))
    out = pr.periodic_runs(odd)
    assert out.columns == [*odd.columns, "periodic_"] and out.count() == len(EDGES)
    assert pr.periodic_runs(no_docs).collect() == []


def test_slices(monkeypatch, spark):
    """Texts laid end to end in many slices give the same runs; text numbers hold."""
    rng = random.Random(5)
    texts = [" ".join(periodic_text(rng)) for _ in range(40)] + ["", long_text(2000)] + ["x " * 30] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for r in pr.periodic_runs(docs).collect():
        assert [tuple(x) for x in r.periodic.runs] == plain_runs(r.text.split())


def test_query(spark):
    rows = {r.doc_id: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    planted = 0
    for d in docs:
        w = [x.decode() for x in (d.text or "").encode().split()]
        h = zlib.crc32(str(d.doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            planted += 1
        if len(w) > 4000:
            continue
        runs, r = plain_runs(w), rows[d.doc_id]
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2])) if runs else (None,) * 3
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapse(w, runs).encode()).hexdigest()
    assert planted > 5
