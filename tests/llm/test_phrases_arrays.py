"""The trie's containers and the runs that leave it."""

from collections import Counter

import numpy as np
import pytest

from ratetide.llm import phrases


@pytest.mark.parametrize("span", [50, 5_000, 1 << 62])
def test_array_hash_counts(span):
    rng, table, want = np.random.default_rng(5), phrases.ArrayHash(), Counter()
    for n in (0, 1, 40, 3000, 7, 20_000):
        keys, counts = np.unique(rng.integers(0, span, n), return_counts=True)
        table.add(keys, counts)
        want.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        keys, counts = table.items()
        assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == want and len(table) == len(keys) == len(want)


def test_array_hash_with_one_place():
    """N-grams that all want one place go to the next ones, round the end too."""
    inverse = pow(phrases.MIX, -1, 1 << 64)
    keys = [h * inverse % (1 << 64) for h in range((1 << 64) - 4000, 1 << 64)]
    keys = np.unique([k for k in keys if k < 1 << 63]).astype(np.int64)[:20]
    table = phrases.ArrayHash()
    for k in (keys, keys[::2], keys[1:]):
        table.add(k, np.ones(len(k), np.int64))
    want = Counter([*keys.tolist(), *keys[::2].tolist(), *keys[1:].tolist()])
    assert dict(zip(*(a.tolist() for a in table.items()), strict=True)) == want


def test_counting_needs_no_call_for_each_ngram():
    """Adding and spilling touch whole arrays: no Python object for each n-gram."""
    import sys

    trie, calls = phrases.HatTrie(2), 0
    keys = np.unique(np.random.default_rng(1).integers(0, 300, 60_000) << 31 | np.arange(60_000))

    def count(frame, event, arg):
        nonlocal calls
        calls += 1

    sys.setprofile(count)
    try:
        for _ in range(3):
            trie.add(keys, np.ones(len(keys), np.int64))
        runs = list(trie.spill(0))
    finally:
        sys.setprofile(None)
    assert sum(len(k) for k, _ in runs) == len(keys) and all((c == 3).all() for _, c in runs)
    assert calls < len(keys)
