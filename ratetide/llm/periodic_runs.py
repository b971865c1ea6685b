"""Runs of periodic words by block convolution.

The words of many texts are numbered and laid end to end, with a number of its
own between texts, so that no run crosses them.  At dyadic scales P the line is
cut into blocks of P words.  For each block, the sums of squared differences
between it and the words P to 2P - 1 places further on (from 1 at the lowest
scale) come from one number-theoretic transform modulo a prime, exact in 64-bit
integers: a distance at which the sum is zero is an occurrence.  Any run of
period q in that range and of at least three periods holds a whole block and its
copy q places on, so none is missed.  A block is transformed only if each of its
words comes again within 2P places, without which no distance can fit.

Blocks in a row that recur at one distance are one seed.  Seeds are extended
word by word to both sides, at most a block each way (the next block does not
recur); equal words decide, so that a sum that is zero only modulo the prime
costs a comparison and changes nothing.  Seeds that lie in a run found at a lower
scale are multiples of its period and are left out, so a text of one word
repeated a million times costs a transform per scale.

A null or empty text has no words and no runs.  Texts are taken whole, whatever
their length; rows are judged one by one, so repeated rows get equal results.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import free_name, numbered, schema_of

LEAST = 24           # words of a run, at least
REPEATS = 3          # periods of a run, at least
WORDS = 1 << 18      # words laid end to end, unless one text is longer
POINTS = 1 << 20     # points transformed at once, unless one block has more
PRIME, ROOT = 2_013_265_921, 31  # 15 * 2**27 + 1 and a generator of its units


# ---------------------------------------------------------------- transform
def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo the prime."""
    out = np.ones(n, np.uint64)
    done, step = 1, base % PRIME
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = out[:more] * np.uint64(step) % PRIME
        step = step * step % PRIME
        done += more
    return out


def ntt(x: np.ndarray, inverse: bool = False) -> np.ndarray:
    """The transform of each row of ``x`` (residues as uint64; a power of two of columns)."""
    rows, n = x.shape
    root = pow(ROOT, (PRIME - 1) // n, PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    twiddles = _powers(root, max(1, n // 2))
    # self-sorting: each pass halves the length of what is left to transform
    x, half, stride = x.reshape(rows, n, 1), n // 2, 1
    while half:
        a, b = x[:, :half], x[:, half:]
        out = np.empty((rows, half, 2, stride), np.uint64)
        out[:, :, 0] = (a + b) % PRIME
        out[:, :, 1] = (a + (PRIME - b)) % PRIME * twiddles[::stride][:half, None] % PRIME
        x, half, stride = out.reshape(rows, half, 2 * stride), half // 2, 2 * stride
    x = x.reshape(rows, n)
    return x * np.uint64(pow(n, PRIME - 2, PRIME)) % PRIME if inverse else x


def block_distances(values: np.ndarray, starts: np.ndarray, block: int, first: int) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``starts``, distance) where the block at that start recurs
    ``first`` to ``first + block - 1`` places on, by sums of squared differences
    modulo the prime.  ``values`` must reach 3 blocks beyond the last start."""
    n, found = 2 * block, []
    lags = np.arange(block)
    for i in range(0, len(starts), max(1, POINTS // n)):
        at = starts[i:i + max(1, POINTS // n)]
        own = np.zeros((len(at), n), np.uint64)
        cells = values[at[:, None] + lags]
        own[:, -lags % n] = cells
        window = values[(at + first)[:, None] + np.arange(n)]
        cross = ntt(ntt(own) * ntt(window) % PRIME, inverse=True)[:, :block]
        squares = np.zeros((len(at), n + 1), np.uint64)
        np.cumsum(window * window % PRIME, axis=1, out=squares[:, 1:])
        total = (cells * cells % PRIME).sum(axis=1, dtype=np.uint64)[:, None] + squares[:, block:n] - squares[:, :block]
        row, lag = np.nonzero(total % PRIME == 2 * cross % PRIME)
        found.append((row + i, lag + first))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


# -------------------------------------------------------------------- runs
def _reach(words: np.ndarray, at: np.ndarray, distance: np.ndarray, step: int, most: int) -> np.ndarray:
    """How many places from ``at`` on (by ``step``, at most ``most``) equal the word ``distance`` further on."""
    count = np.zeros(len(at), np.int64)
    live, width = np.arange(len(at)), 16
    done = 0
    while len(live) and done < most:
        width = min(width, most - done)
        places = at[live, None] + step * (done + np.arange(width))
        inside = (places >= 0) & (places + distance[live, None] < len(words))
        places = np.where(inside, places, 0)
        same = inside & (words[places] == words[np.where(inside, places + distance[live, None], 0)])
        upto = np.where(same.all(axis=1), width, same.argmin(axis=1))
        count[live] += upto
        live = live[upto == width]
        done += width
    return count


def _scales(least: int, repeats: int, longest: int):
    """(block, first distance) of each scale; ``block`` distances each.  A run is
    ``least`` and three periods or more, so blocks of a third of ``least`` at the
    lowest scale, of the first period above, have room for one and its copy."""
    if repeats < 3:
        raise ValueError("a run needs three periods")
    block, first = 1 << max(0, (least // 3).bit_length() - 1), 1
    while max(least, repeats * first) <= longest:
        yield block, first
        block, first = (block, block) if first < block else (2 * block, 2 * block)


def find_runs(words: np.ndarray, longest: int, least: int = LEAST, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in ``words`` (numbers below 2**31; what
    parts texts occurs once), by start, then period.  ``longest`` bounds the
    length of a run."""
    n = len(words)
    if not n:
        return []
    order = np.argsort(words, kind="stable")
    again = np.full(n, n, np.int64)  # places to the next same word
    same = words[order][1:] == words[order][:-1]
    again[order[:-1][same]] = np.diff(order)[same]
    runs: dict[tuple[int, int], int] = {}
    for block, first in _scales(least, repeats, longest):
        blocks = n // block
        may = (again[:blocks * block].reshape(blocks, block) < first + block).all(axis=1)
        starts = np.flatnonzero(may) * block
        if len(starts):
            _scale(words, starts, block, first, least, repeats, runs)
    return sorted((start, end - start, period) for (start, end), period in runs.items())


def _scale(words, starts, block, first, least, repeats, runs) -> None:
    """Adds the runs with periods ``first`` to ``first + block - 1``."""
    # residues that are spread out: equal words alone have equal ones
    values = np.zeros(starts[-1] + 4 * block + first, np.uint64)
    upto = min(len(words), len(values))
    values[:upto] = (words[:upto].astype(np.uint64) * np.uint64(1_103_515_245) + np.uint64(12_345)) % PRIME
    row, distance = block_distances(values, starts, block, first)
    at = starts[row]
    fits = at + block + distance <= len(words)
    at, distance = at[fits], distance[fits]
    if not len(at):
        return
    # blocks in a row at one distance are one seed
    order = np.lexsort((at, distance))
    at, distance = at[order], distance[order]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(distance) != 0) | (np.diff(at) != block)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(at)) - 1
    start, stop, distance = at[heads], at[tails] + block, distance[heads]
    # long enough at best, and not inside a known run (a multiple of its period)
    live = stop - start + 2 * (block - 1) + distance >= np.maximum(least, repeats * distance)
    if runs:
        known = np.array(sorted((s, e) for s, e in runs))
        ends = np.maximum.accumulate(known[:, 1])
        of = np.searchsorted(known[:, 0], start, side="right") - 1
        live &= ~((of >= 0) & (ends[np.maximum(of, 0)] >= stop + distance))
    start, stop, distance = start[live], stop[live], distance[live]
    exact = np.array([np.array_equal(words[a:b], words[a + d:b + d]) for a, b, d in zip(
        start.tolist(), stop.tolist(), distance.tolist(), strict=True)], bool)
    start, stop, distance = start[exact], stop[exact], distance[exact]
    left = _reach(words, start - 1, distance, -1, block)
    right = _reach(words, stop, distance, 1, block)
    begin, end = start - left, stop + right + distance
    whole = end - begin >= np.maximum(least, repeats * distance)
    for s, e, d in zip(begin[whole].tolist(), end[whole].tolist(), distance[whole].tolist(), strict=True):
        if d < runs.get((s, e), d + 1):
            runs[s, e] = d


# ------------------------------------------------------------------- texts
class _Numbers(defaultdict):
    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def text_runs(texts: list[list[bytes]], least: int = LEAST, repeats: int = REPEATS) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given as words."""
    numbers = _Numbers()
    total = sum(map(len, texts)) + len(texts)
    line, edges, at = np.empty(total, np.int64), [], 0
    for words in texts:
        line[at:at + len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        edges.append(at)
        at += len(words) + 1
    ends = np.array(edges[1:] + [total], np.int64) - 1
    line[ends] = len(numbers) + np.arange(len(ends))
    out: list[list] = [[] for _ in texts]
    for start, length, period in find_runs(line, max(map(len, texts), default=0), least, repeats):
        text = int(np.searchsorted(ends, start))
        out[text].append((start - edges[text], length, period))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by spaces."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def _laid(batches, text_at: int):
    """Slices of the batches with about ``WORDS`` words, and their words."""
    for batch in batches:
        texts, first, held = [], 0, 0
        for i, text in enumerate(batch.column(text_at)):
            words = (text.as_py() or "").encode().split()  # \x20 and \x09-\x0D only
            if texts and held + len(words) > WORDS:
                yield batch.slice(first, i - first), texts
                texts, first, held = [], i, 0
            texts.append(words)
            held += len(words)
        if texts:
            yield batch.slice(first, len(texts)), texts


def periodic_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST, repeats: int = REPEATS,
                  out: str = "periodic") -> DataFrame:
    """``docs`` with a struct column ``out`` (underscores are appended while the name
    is taken): runs, an array of (start, length, period) by start, then period,
    counted in words; and collapsed, the words that stay when each run keeps its
    first period only, joined by one space.

    A run is a stretch of ``least`` words and ``repeats`` of its smallest period or
    more that no neighbouring word extends."""
    name, plain, text_at = free_name(docs, out), numbered(docs), docs.columns.index(text_col)
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    found_type = pa.struct([("runs", pa.list_(run)), ("collapsed", pa.string())])

    def find(batches):
        for batch, texts in _laid(batches, text_at):
            runs = text_runs(texts, least, repeats)
            rows = [{"runs": [dict(zip(("start", "length", "period"), r, strict=True)) for r in rs],
                     "collapsed": collapse(words, rs).decode()} for words, rs in zip(texts, runs, strict=True)]
            yield batch.append_column("found", pa.array(rows, found_type))

    schema = schema_of(plain, "found struct<runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>")
    return plain.mapInArrow(find, schema).toDF(*docs.columns, name)
