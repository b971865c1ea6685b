"""Line-first quality rules, with DataFrame functions only.

Each line with a word is judged on its own: symbols, punctuation, shouting,
navigation and boilerplate.  Failing lines are removed; a document that loses
too large a share of its words is rejected, as is one that fails the base rules
(too few words, or too many words in repeated 3-word windows).

Words are runs of characters other than space and \\t-\\r.  A null text has no
words and no lines, so it fails the base rules.  Ties, repeated rows and extra
columns change nothing: each row is judged alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, let, quoted, words_of

SPACE = "[ \\t-\\r]+"
SYMBOLS, SHOUTS, SEPARATORS = "[#*$%&|<>]", "[!?¡¿]", "[|»›•·→]"
SUSPECT = "[#*$%&|<>!?¡¿»›•·→]"  # all of them
#: Code points that end a sentence: Unicode's Sentence_Terminal, and the ellipsis.
SENTENCE_ENDS = (
    "21 2E 3F 589 61D-61F 6D4 700-702 7F9 837 839 83D-83E 964-965 104A-104B 1362 1367-1368 166E 1735-1736 "
    "17D4-17D5 1803 1809 1944-1945 1AA8-1AAB 1B4E-1B4F 1B5A-1B5B 1B5E-1B5F 1B7D-1B7F 1C3B-1C3C 1C7E-1C7F 2024 "
    "2026 203C-203D 2047-2049 2CF9-2CFB 2E2E 2E3C 2E53-2E54 2E60-2E61 3002 A4FF A60E-A60F A6F3 A6F7 A876-A877 "
    "A8CE-A8CF A92F A9C8-A9C9 AA5D-AA5F AAF0-AAF1 ABEB FE12 FE15-FE16 FE52 FE56-FE57 FF01 FF0E FF1F FF61 "
    "10A56-10A57 10F55-10F59 10F86-10F89 11047-11048 110BE-110C1 11141-11143 111C5-111C6 111CD 111DE-111DF "
    "11238-11239 1123B-1123C 112A9 113D4-113D5 1144B-1144C 115C2-115C3 115C9-115D7 11641-11642 1173C-1173E "
    "11944 11946 11A42-11A43 11A9B-11A9C 11C41-11C42 11EF7-11EF8 11F43-11F44 16A6E-16A6F 16AF5 16B37-16B38 "
    "16B44 16D6E-16D6F 16E98 1BC9F 1DA88")
SENTENCE_END = "[" + "".join("-".join(f"\\x{{{c}}}" for c in x.split("-")) for x in SENTENCE_ENDS.split()) + "]"
BOILERPLATE = (
    "all rights reserved|cookie|privacy policy|terms of (use|service)|subscribe|newsletter|sign (in|up)|log ?in|"
    "click here|read more|share (this|on)|follow us|powered by|javascript|advertisement|copyright|"
    "^(this work is |re)?(leased|licensed) under|skip to|back to top|page not found"
)


@dataclass(frozen=True)
class LineRules:
    """Parameters of the line rules and of the verdict."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_lost_percent: int = 30
    symbol_percent: int = 20        # symbols per 100 words of a line
    shout_percent: int = 30         # "!" or "?" per 100 words
    caps_min_words: int = 4         # from here on a line needs a small letter
    nav_percent: int = 25           # separators per 100 words
    open_end_words: int = 60        # a line so long has to hold a sentence end
    boilerplate_words: int = 25     # longer lines are prose, whatever they mention


def _count_of(text: Column, one: str) -> Column:
    """Matches of ``one``, a character class."""
    return F.size(F.split(text, one)) - 1


def repeated_window_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in ``words`` (a
    column or bound variable, not an expression: it is read for each word)."""
    def windows(w):
        hashes = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return F.slice(hashes, F.lit(1), F.size(w) - 2)

    def covered(hashes):
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = lambda a: F.filter(a, lambda x, j: (x.h == F.get(a, j - 1).h) | (x.h == F.get(a, j + 1).h))
        starts = let(ranked, lambda a: F.sort_array(F.transform(twice(a), lambda x: x.i)))
        # a window covers three words; the next one may start inside it
        return let(starts, lambda s: F.aggregate(
            F.transform(s, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(s, j + 1) - p, F.lit(3)))),
            F.lit(0), lambda acc, x: acc + x))

    def count(hashes):
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered(hashes))

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(
        let(windows(words), count)).cast("long")


def _line_fails(line: Column, n: Column, r: LineRules) -> Column:
    """One line of ``n`` words, 1 at least: any rule that it breaks."""
    return ((line.rlike(SUSPECT)
             & ((100 * _count_of(line, SYMBOLS) > r.symbol_percent * n)
                | (100 * _count_of(line, SHOUTS) > r.shout_percent * n + 100)
                | (100 * _count_of(line, SEPARATORS) > r.nav_percent * n)))
            | ((n >= r.caps_min_words) & (F.upper(line) == line) & (F.lower(line) != line))
            | ((n >= r.open_end_words) & ~line.rlike("[.!?…。]") & ~line.rlike(SENTENCE_END))  # the common ones first: cheap
            | ((n <= r.boilerplate_words) & F.lower(line).rlike(BOILERPLATE)))


def judge(docs: DataFrame, text_col: str = "text", rules: LineRules | None = None, out: str = "quality") -> DataFrame:
    """``docs`` with a struct column ``out`` (underscores are appended while the
    name is taken): n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_failed_lines, n_lost_words, cleaned (the text without failing lines),
    base_failed and kept."""
    r, out = rules or LineRules(), free_name(docs, out)
    text = F.coalesce(quoted(text_col), F.lit(""))
    facts = free_name(docs, "facts")

    def line_facts(line):
        return let(words_of(line, SPACE), lambda w: let(F.size(w), lambda n: F.struct(
            line.alias("line"), w.alias("words"), n.alias("n"),
            F.when(n == 0, F.lit(False)).otherwise(_line_fails(line, n, r)).alias("fails"))))

    def summary(lines, words):
        spoken = F.filter(lines, lambda x: x.n > 0)
        failed = F.filter(lines, lambda x: x.fails)
        n = F.size(words).cast("long")
        return F.struct(
            n.alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _count_of(text, SYMBOLS).cast("long").alias("n_symbols"),
            let(F.transform(spoken, lambda x: x.line),
                lambda s: (F.size(s) - F.size(F.array_distinct(s))).cast("long")).alias("n_dup_lines"),
            repeated_window_words(words).alias("n_repeat_words"),
            F.size(failed).cast("long").alias("n_failed_lines"),
            F.aggregate(failed, F.lit(0).cast("long"), lambda acc, x: acc + x.n).alias("n_lost_words"),
            F.array_join(F.transform(F.filter(lines, lambda x: ~x.fails), lambda x: x.line), "\n").alias("cleaned"))

    judged = docs.withColumn(facts, let(F.transform(F.split(text, "\n"), line_facts), lambda lines: let(
        F.flatten(F.transform(lines, lambda x: x.words)), lambda words: summary(lines, words))))
    f = quoted(facts)
    base_failed = (f.n_words < r.min_words) | (100 * f.n_repeat_words > r.max_repeat_percent * f.n_words)
    return judged.withColumn(out, F.struct(
        f.n_words.alias("n_words"), f.word_chars.alias("word_chars"), f.n_symbols.alias("n_symbols"),
        f.n_dup_lines.alias("n_dup_lines"), f.n_repeat_words.alias("n_repeat_words"),
        f.n_failed_lines.alias("n_failed_lines"), f.n_lost_words.alias("n_lost_words"), f.cleaned.alias("cleaned"),
        base_failed.alias("base_failed"),
        (~base_failed & (100 * f.n_lost_words <= r.max_lost_percent * f.n_words)).alias("kept"))).drop(facts)
