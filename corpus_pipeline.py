"""A training-corpus pipeline over ``documents``: five stages, each one operator
of ``ratetide.llm``.  A stage takes the rows that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratetide.llm import bpe, decontamination, quality_rules, simhash, suffix_dedup
from ratetide.llm.common import free_name, quoted, read_table, written
from ratetide.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-first rules reject go; the others stay as they are."""
    out = free_name(docs, "quality")
    return quality_rules.judge(docs, out=out).where(quoted(out).kept).drop(out)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each SimHash group stays (3-word shingles, 2 bits)."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """50-byte strings that a smaller document has are cut out of the text;
    characters that lose some bytes only stay.  n_chars follows the text."""
    out = free_name(docs, "repeats")
    cut = suffix_dedup.remove_repeats(docs, span=50, out=out, as_text=True)
    text = F.when(F.col("text").isNotNull(), quoted(out).kept)
    changed = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {"text": text}
    return cut.select(*(changed[c].alias(c) if c in changed else quoted(c) for c in docs.columns))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words or more are benchmark words go."""
    out = free_name(docs, "contamination")
    found = decontamination.contamination(docs, read_table(spark, sf_dir, "benchmark"), out=out)
    c = quoted(out)
    return found.where(~decontamination.is_contaminated(F.size(c.positions), c.n_words)).drop(out)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds token_ids (little-endian unsigned 32-bit), n_tokens and whether the
    ids decode to the text."""
    ids, decoded = free_name(docs, "token_ids"), free_name(docs, "decoded")
    coded = bpe.encode(docs, vocabulary(), out=ids, decoded=decoded)
    return coded.select(*(quoted(c) for c in docs.columns), quoted(ids),
                        (F.octet_length(quoted(ids)) / 4).cast("long").alias(free_name(docs, "n_tokens")),
                        (quoted(decoded) == F.coalesce("text", F.lit(""))).alias(free_name(docs, "round_trip")))


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_spans),
    ("benchmark_decontamination", benchmark),
    ("bpe_tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; each result but the last is
    written as Parquet to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs


#: No SQL engine at hand has the token ids of the last stage; tests hold run()
#: against a brute-force version instead.
ORACLE_SQL = None
