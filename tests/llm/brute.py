"""Plain, quadratic versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def item_words(text):
    return ITEM_WORD.findall((text or "").translate(LOWER))


def decontaminate(docs, items):
    """[(n_words, hit positions, item ids)] for [(id, text)]."""
    windows = {}
    for item_id, text in items:
        w = item_words(text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[i:i + k]), set()).add(item_id)
    out = []
    for _, text in docs:
        w, hit, ids = item_words(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                found = windows.get(tuple(w[i:i + k]))
                if found:
                    hit |= set(range(i, i + k))
                    ids |= found
        out.append((len(w), sorted(hit), ids))
    return out


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    w = WORD.findall(text)
    windows = list(zip(w, w[1:], w[2:]))  # noqa: B905
    times = Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if times[x] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def line_fails(line):
    from ratetide.llm.quality_rules import BOILERPLATE

    n = len(WORD.findall(line))
    count = lambda chars: sum(c in chars for c in line)
    return n > 0 and bool(
        100 * count("#*$%&|<>") > 20 * n or 100 * count("!?¡¿") > 30 * n + 100 or 100 * count("|»›•·→") > 25 * n
        or (n >= 4 and line.upper() == line and line.lower() != line)
        or (n >= 60 and not re.search("[.!?…。]", line))
        or (n <= 25 and re.search(BOILERPLATE, line.lower())))


def quality_kept(text):
    lost = sum(len(WORD.findall(x)) for x in (text or "").split("\n") if line_fails(x))
    n, *_, base_failed = quality(text)
    return not base_failed and 100 * lost <= 30 * n


def remove_repeats(docs, span=50):
    """[(bytes, removed flags)] for [(id, text)]."""
    least = {}
    raw = [(i, (t or "").encode()) for i, t in docs]
    for i, b in raw:
        if i is not None:
            for p in range(len(b) - span + 1):
                s = b[p:p + span]
                least[s] = min(least.get(s, i), i)
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        if i is not None:
            for p in range(len(b) - span + 1):
                if least[b[p:p + span]] < i:
                    gone[p:p + span] = b"\1" * span
        out.append((b, gone))
    return out


def kept_text(raw, gone):
    out, at = [], 0
    for c in raw.decode():
        n = len(c.encode())
        if not all(gone[at:at + n]):
            out.append(c)
        at += n
    return "".join(out)


def simhash(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def components(prints, reach=2):
    """A group number for each fingerprint."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= reach:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(len(prints))]
