"""Main-text extraction by a linear-chain CRF over the leaf blocks of a page.

A page is cut into leaf blocks: runs of text between block-level tags, each
with its open ancestors.  A conditional random field with features of ancestor
tags, their class and id words, and the block's text labels blocks as main text
or not; Viterbi decodes the page.  The field is fitted with numpy on labelled
pages, which ``labelled_pages`` makes in many layouts (articles with and without
an article tag, menus, banners, notices, adverts, forms, sidebars, comments).

Scripts, styles, templates, frames, text areas, titles, noscript, comments and
tags are never text; a noscript that is not closed is read as if it were not
there.  Text in formulas, objects, graphics and media is text of the page, which
the field judges; one that is not closed costs nothing.  Character
references are decoded, white space in a block becomes one space, blocks are
trimmed and joined in page order by a line feed; empty ones go.  A null page is
an empty text.  Cut-off pages are read as far as they go, pages of any length
whole; each page is decoded alone, so ties and repeated rows change nothing.
"""

from __future__ import annotations

import html as entities
import random
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, quoted

BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav noscript ol "
    "optgroup option p pre search section select summary table tbody td textarea tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template title noscript iframe textarea".split())
EMBEDS = frozenset("svg object canvas math audio video".split())  # inline, with text of their own
#: A tag that opens closes an open one of these, up to the nearest of the others.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)(?:>|\Z)", re.S)
NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    path: list[str]                      # open ancestors, outermost first
    names: list[frozenset]               # words of their class, id and role
    parts: list[str] = field(default_factory=list)
    linked: int = 0                      # characters inside links
    embeds: set[str] = field(default_factory=set)  # formulas, objects, media that hold some of the text

    def text(self) -> str:
        return " ".join(entities.unescape("".join(self.parts)).split())


def leaf_blocks(page: str) -> list[Block]:
    """Blocks with text, in page order."""
    blocks: list[Block] = []
    path: list[str] = []
    names: list[frozenset] = []
    inside: list[tuple[str, int]] = []       # open embeds and the ancestors they stand in
    now: Block | None = None
    links = at = 0
    end = len(page)
    while at < end:
        start = page.find("<", at)
        start = end if start < 0 else start
        m = TOKEN.match(page, start) if start < end else None
        if m is None and start < end:            # a "<" that opens nothing is text
            stop = page.find("<", start + 1)
            stop = end if stop < 0 else stop
        else:
            stop = start
        if stop > at:
            if now is None:
                now = Block(path[:], names[:])
                blocks.append(now)
            now.parts.append(page[at:stop])
            if inside and not page[at:stop].isspace():
                now.embeds.update(name for name, _ in inside)
            if links:
                now.linked += stop - at
        if m is None:
            at = stop
            continue
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in RAW:
            if not closing and not m[3].endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close else at if tag == "noscript" else end
        elif tag in EMBEDS:
            if not closing and not m[3].endswith("/"):
                inside.append((tag, len(path)))
            elif closing and any(name == tag for name, _ in inside):
                del inside[max(i for i, x in enumerate(inside) if x[0] == tag):]
        elif tag in BLOCKS:
            now, links = None, 0
            if closing:
                if tag in path:
                    cut = len(path) - 1 - path[::-1].index(tag)
                    del path[cut:], names[cut:]
                    inside = [x for x in inside if x[1] <= cut]
                continue
            if "p" in path:                       # any block ends an open paragraph
                cut = len(path) - 1 - path[::-1].index("p")
                del path[cut:], names[cut:]
            own, fence = CLOSES.get(tag, ((), ()))
            for i in range(len(path) - 1, -1, -1):
                if path[i] in fence:
                    break
                if path[i] in own:
                    del path[i:], names[i:]
                    break
            inside = [x for x in inside if x[1] <= len(path)]
            if tag not in VOID:
                found = " ".join(next(filter(None, x), "") for x in NAMES.findall(m[3])) if m[3] else ""
                path.append(tag)
                names.append(frozenset(WORD.findall(found.lower())) if found else frozenset())
        elif tag == "a":
            links = 0 if closing else 1
        elif tag in ("br", "wbr", "img", "input") and now is not None and tag != "wbr":
            now.parts.append(" ")
    return blocks


# --------------------------------------------------------------- features
CUES = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar tabs skip toc",
    "head": "header masthead banner topbar logo branding",
    "foot": "footer foot bottom copyright legal colophon",
    "side": "sidebar aside side widget widgets related recommended popular trending promo teaser",
    "ad": "ad ads advert adverts advertisement advertising sponsored sponsor adsense",
    "note": "cookie cookies consent gdpr notice notification alert modal popup overlay dialog newsletter subscribe signup paywall",
    "talk": "comment comments reply replies respond discussion disqus thread reactions reviews",
    "share": "share sharing social follow tags meta byline author rating",
    "main": "article content main post entry story body text page",
}
CUE_OF = {w: c for c, words in CUES.items() for w in words.split()}
TEXT_CUES = (
    ("copyright", re.compile(r"©|\bcopyright\b|all rights reserved", re.I)),
    ("notice", re.compile(r"cookie|consent|privacy policy|subscribe|newsletter|sign (?:in|up)|log ?in|accept all", re.I)),
    ("advert", re.compile(r"\badvert|\bsponsored\b|\bbuy now\b", re.I)),
    ("talk", re.compile(r"\bcomments?\b|\breply\b|\bsays:|\bposted by\b", re.I)),
)


def features(blocks: list[Block], texts: list[str]) -> list[list[str]]:
    out, n = [], len(blocks)
    headed = False
    for i, (b, t) in enumerate(zip(blocks, texts, strict=True)):
        own = b.path[-1] if b.path else "none"
        f = ["bias", "tag=" + own, "parent=" + (b.path[-2] if len(b.path) > 1 else "none")]
        f += ["in=" + tag for tag in {*b.path, *b.embeds}]
        f += ["cue=" + c for c in {CUE_OF[w] for words in b.names for w in words if w in CUE_OF}]
        last = next((c for words in reversed(b.names) for c in sorted(CUE_OF[w] for w in words if w in CUE_OF)), None)
        f.append("last=" + str(last))
        words = t.count(" ") + 1
        f.append("words=" + str(min(words.bit_length(), 6)))
        f.append("links=" + str(min(4, 5 * b.linked // max(1, len(t)))))
        f.append("ends=" + ("stop" if t[-1:] in ".!?…:;\"'”’)" else "open"))
        f += ["says=" + name for name, cue in TEXT_CUES if cue.search(t)]
        headed = headed or own == "h1"
        f.append("headed=" + str(headed))
        f.append("place=" + str(4 * i // max(1, n)))
        out.append(f)
    return out


# ------------------------------------------------------------ labelled pages
def labelled_pages(count: int = 240, seed: int = 5) -> list[tuple[str, list[int]]]:
    """Pages in many layouts with a label (1: main text) for each leaf block."""
    rng = random.Random(seed)
    syllables = [a + b for a in "b c d f g l m n p r s t v th st".split() for b in "a e i o u an er on".split()]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    line = lambda a=6, b=30: words(a, b).capitalize() + rng.choice([".", ".", ".", "!", "?", ""])
    link = lambda: f'<a href="/{word()}">{words(1, 3)}</a>'

    def menu():
        items = rng.randint(3, 9)
        tag = rng.choice(["nav", "nav", 'div class="menu"', 'div id="navbar"', 'ul class="breadcrumb"'])
        name = tag.split()[0]
        return f"<{tag}>" + ("<ul>" if name != "ul" else "") + "".join(f"<li>{link()}</li>" for _ in range(items)) + (
            "</ul>" if name != "ul" else "") + f"</{name}>", [0] * items

    def boxed(tags, texts):
        tag = rng.choice(tags)
        return f"<{tag}>" + "".join(texts) + f"</{tag.split()[0]}>", [0] * len(texts)

    def advert():
        return boxed(['div class="ad"', 'div class="advert"', 'div id="ads"', 'aside class="sponsored"'], [line(3, 20)])

    def notice():
        return boxed(['div class="cookie-notice"', 'div id="consent"', 'div class="newsletter popup"', 'section class="alert"'],
                     [f"<p>{line()} {rng.choice(['We use cookies', 'Subscribe', 'Accept all', ''])}</p>"])

    def header():
        return boxed(["header", 'div class="masthead"', 'div id="header"'], [f"<div>{words(1, 4)}</div>", f"<p>{line(2, 8)}</p>"][:rng.randint(1, 2)])

    def footer():
        return boxed(["footer", "footer", 'div class="footer"', 'div id="bottom"'],
                     [rng.choice([f"&copy; {word()} &middot; {line()}", f"<p>{line()}</p>", f"<p>{line(1, 4)} All rights reserved.</p>"])])

    def side():
        k = rng.randint(1, 4)
        return boxed(["aside", 'div class="sidebar"', 'div class="related"', 'section id="widgets"'],
                     [rng.choice([f"<p>{line()}</p>", f"<h3>{words(1, 5)}</h3>", f"<div>{link()}</div>"]) for _ in range(k)])

    def form():
        return boxed(["form", 'form class="search"'], [f"<label>{words(1, 3)}</label> <input type=text>", f"<button>{words(1, 2)}</button>"][:rng.randint(1, 2)])

    def talk():
        k = rng.randint(1, 5)
        return boxed(['div class="comments"', 'section id="comments"', 'div id="discussion"', 'ol class="comment-list"', 'section class="replies"'],
                     [rng.choice([f"<p>{line()}</p>", f"<div class=\"comment\"><p>{line()}</p></div>", f"<h3>{rng.choice(['Comments', words(1, 3)])}</h3>"])
                      for _ in range(k)])

    def paragraph():
        kind = rng.random()
        if kind < 0.62:
            return rng.choice(["<p>{}</p>", "<p><b>{}<br>", "<p>{}"]).format(line(1, 60)), [1]
        if kind < 0.72:
            return f"<h{rng.randint(2, 4)}>{words(1, 8)}</h{2}>".replace("</h2>", ""), [1]
        if kind < 0.8:
            k = rng.randint(2, 5)
            return "<ul>" + "".join(f"<li>{line(2, 15)}</li>" for _ in range(k)) + "</ul>", [1] * k
        if kind < 0.86:
            return f"<blockquote>{line()}</blockquote>", [1]
        if kind < 0.92:
            return f"<p>{line(4, 20)} {link()} {line(2, 10)}</p>", [1]
        if kind < 0.96:
            return f"<table><tr><td>{words(1, 4)}<td>{words(1, 4)}</table>", [1, 1]
        return rng.choice([advert, share, side])() if rng.random() < 0.6 else (f"<pre>{line()}</pre>", [1])

    def share():
        return boxed(['div class="share"', 'div class="social"'], [link() + link()])

    def article():
        tag = rng.choice(["article", "article", "article", "main", 'div class="content"', 'div id="main"',
                          'div class="post"', 'section class="entry"'])
        inner = [(f"<h1>{words(2, 12)}</h1>", [1])] if rng.random() < 0.85 else []
        inner += [paragraph() for _ in range(rng.randint(1, 12))]
        if rng.random() < 0.1:
            inner.append(talk())
        return f"<{tag}>" + "".join(x for x, _ in inner) + f"</{tag.split()[0]}>", [y for _, ys in inner for y in ys]

    pages = []
    for _ in range(count):
        before = [p() for p in rng.sample([menu, advert, notice, header, form, side], rng.randint(1, 4))]
        after = [p() for p in rng.sample([menu, advert, notice, footer, footer, side, talk, form, share], rng.randint(1, 4))]
        body = [*before, article(), *after]
        page = f"<!DOCTYPE html><html><head><title>{words(1, 6)}</title><style>p{{}}</style></head><body>" + "".join(x for x, _ in body)
        pages.append((page + rng.choice(["</body></html>", ""]), [y for _, ys in body for y in ys]))
    return pages


# ---------------------------------------------------------------- the field
class Field:
    """Weights per feature and label, and for label pairs; two labels."""

    def __init__(self, pages, epochs: int = 60, rate: float = 0.15, decay: float = 1e-3):
        rows, golds = [], []
        for page, labels in pages:
            blocks = leaf_blocks(page)
            texts = [b.text() for b in blocks]
            full = [i for i, t in enumerate(texts) if t]
            if len(full) != len(labels):
                raise ValueError("a labelled page has one label for each block with text")
            rows.append(features([blocks[i] for i in full], [texts[i] for i in full]))
            golds.append(labels)
        self.index = {f: i for i, f in enumerate(sorted({f for r in rows for b in r for f in b}))}
        longest, n = max(map(len, golds)), len(golds)
        x = np.zeros((n, longest, len(self.index)))
        y = np.zeros((n, longest), np.int64)
        mask = np.zeros((n, longest))
        for p, (r, g) in enumerate(zip(rows, golds, strict=True)):
            mask[p, :len(g)], y[p, :len(g)] = 1, g
            for i, b in enumerate(r):
                x[p, i, [self.index[f] for f in b]] = 1
        w, pair = np.zeros((len(self.index), 2)), np.zeros((2, 2))
        sums = [np.zeros_like(w), np.zeros_like(pair)]
        onehot = np.eye(2)[y] * mask[:, :, None]
        seen_pairs = np.einsum("pia,pib->ab", onehot[:, :-1], onehot[:, 1:])
        for _ in range(epochs):
            node, edges = self._expect(x @ w, pair, mask)
            grads = [np.einsum("pif,pia->fa", x, node - onehot) / n + decay * w, (edges - seen_pairs) / n + decay * pair]
            for i, (value, g) in enumerate(zip((w, pair), grads, strict=True)):  # AdaGrad
                sums[i] += g * g
                value -= rate * g / (np.sqrt(sums[i]) + 1e-8)
        self.weights = {f: (float(w[i, 0]), float(w[i, 1])) for f, i in self.index.items()}
        self.pair = pair.tolist()

    @staticmethod
    def _expect(scores, pair, mask):
        """Forward-backward over all pages at once: expected labels and pairs."""
        n, longest, _ = scores.shape
        ahead, back = np.zeros_like(scores), np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0]
        for i in range(1, longest):
            step = np.logaddexp.reduce(ahead[:, i - 1, :, None] + pair, axis=1) + scores[:, i]
            ahead[:, i] = np.where(mask[:, i, None] > 0, step, ahead[:, i - 1])
        for i in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(pair + (scores[:, i + 1] + back[:, i + 1])[:, None, :], axis=2)
            back[:, i] = np.where(mask[:, i + 1, None] > 0, step, back[:, i + 1])
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)[:, None]
        node = np.exp(ahead + back - total[:, :, None]) * mask[:, :, None]
        joint = ahead[:, :-1, :, None] + pair + (scores[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, :, None, None]
        return node, (np.exp(np.minimum(joint, 0)) * mask[:, 1:, None, None]).sum((0, 1))

    def decode(self, rows: list[list[str]]) -> list[int]:
        """Viterbi: the most likely labels of a page's blocks."""
        (p00, p01), (p10, p11) = self.pair
        a = b = 0.0
        came = []
        for i, row in enumerate(rows):
            s0 = s1 = 0.0
            for f in row:
                v = self.weights.get(f)
                if v:
                    s0 += v[0]
                    s1 += v[1]
            if i:
                f0, f1 = a + p00 < b + p10, a + p01 < b + p11
                came.append((f0, f1))
                a, b = (b + p10 if f0 else a + p00) + s0, (b + p11 if f1 else a + p01) + s1
            else:
                a, b = s0, s1
        label = int(b > a)
        out = [label] if rows else []
        for step in reversed(came):
            label = int(step[label])
            out.append(label)
        return out[::-1]

    def main_text(self, page: str | None) -> str:
        blocks = leaf_blocks(page or "")
        texts = [b.text() for b in blocks]
        full = [i for i, t in enumerate(texts) if t]
        texts = [texts[i] for i in full]
        labels = self.decode(features([blocks[i] for i in full], texts))
        return "\n".join(t for t, y in zip(texts, labels, strict=True) if y)


def extract(pages: DataFrame, html_col: str = "html", out: str = "main_text", field: Field | None = None) -> DataFrame:
    """``pages`` with the main text in ``out`` (underscores are appended while
    the name is taken); ``field`` defaults to one fitted on ``labelled_pages``."""
    field = field or Field(labelled_pages())

    @F.pandas_udf("string")
    def main_text(column: pd.Series) -> pd.Series:
        return pd.Series([field.main_text(p) for p in column], dtype=object)

    return pages.withColumn(free_name(pages, out), main_text(quoted(html_col)))
