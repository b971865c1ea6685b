"""Memory of the Python workers: what a task takes, and what it leaves behind."""

import re
import sys
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from conftest import OTHER, PROSE

from ratetide.llm import bpe, common, queries, suffix_dedup

SMALL_WORDS = [w for w in re.split(r"\W+", PROSE + OTHER) if w]


def test_cut_takes_a_small_multiple_of_its_shard():
    rng = np.random.default_rng(3)
    words = rng.choice(SMALL_WORDS, (600, 1100))
    texts = [" ".join(w) for w in words.tolist()]
    size = sum(len(t.encode()) for t in texts)
    rows = pa.record_batch({"id": pa.array(range(600), pa.int64()), "text": pa.array(texts), "shard": pa.array([0] * 600, pa.int32())})
    packed = pa.Table.from_batches(suffix_dedup._pack([rows]))
    none = pa.table({c: pa.array([], t) for c, t in (("shard", pa.int32()), ("round", pa.int32()), ("bucket", pa.int32()),
                                                     ("gram_bits", pa.binary()), ("key_bits", pa.binary()))})
    search = suffix_dedup._Search(50, 8, "id", "text", True)
    del rows, texts, words
    tracemalloc.start()
    out = search.cut((pa.scalar(0),), packed, none)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.num_rows == 600 and size > 3 << 20
    assert peak < 20 * size


def test_covered_against_plain_loops():
    rng = np.random.default_rng(5)
    for _ in range(100):
        n, k = int(rng.integers(1, 200)), int(rng.integers(0, 30))
        a = rng.integers(0, n, k)
        b = np.minimum(a + rng.integers(1, 50, k), n)
        want = np.zeros(n, bool)
        for x, y in zip(a, b, strict=True):
            want[x:y] = True
        assert (suffix_dedup._covered(n, [a[:k // 2], a[k // 2:]], [b[:k // 2], b[k // 2:]]) == want).all()


def test_bpe_tasks_leave_no_cache(spark):
    docs = spark.createDataFrame([(i, PROSE + OTHER) for i in range(64)], "doc_id long, text string").repartition(8)
    assert bpe.encode(docs, queries.vocabulary()).count() == 64

    def held(batches):
        for _ in batches:
            yield pa.record_batch({"n": pa.array([len(c.pieces) + len(c.fragments) for c in bpe.Codec._made.values()], pa.int64())})

    # the same workers run this
    left = [r.n for r in docs.select("doc_id").mapInArrow(held, "n long").collect()]
    assert left and set(left) == {0}


def test_bpe_cache_is_bounded_in_bytes(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(bpe, "CACHE_BYTES", 200, raising=False)
    codec, library = bpe.Codec(queries.vocabulary()), Tokenizer.from_file(queries.vocabulary())
    for text in (PROSE + OTHER, "x" * 5000 + " é" + "ab" * 300, PROSE):
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert sum(len(k) + len(v) for k, v in codec.pieces.items()) <= 200


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_freed_memory_is_given_back():
    if not common._trim():
        pytest.skip("this C library has no such call")

    def held():
        return int(re.search(r"Pss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) >> 10

    blocks = [b"x" * (1 << 16) for _ in range(2400)]
    after = [b"y" * 2000 for _ in range(100)]  # the heap's end stays in use
    before = held()
    blocks = blocks[::60]
    assert common.lightly(lambda a, b: a + b, 1, 2) == 3
    assert held() < before - 100 and len(after) == 100 and len(blocks) == 40
