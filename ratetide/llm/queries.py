"""Registered queries of the numbered operators: each applies its operator to the
whole of its table and derives the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, decontamination, html_extract, licences, packing, periodic_runs, phrases, quality_model,
               quality_rules, sharding, simhash, suffix_dedup, url_filters)
from .common import let, read_table, words_of

#: The rules of the URL query.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
             ("block", "com/de/")]


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_licence_scan(spark, sf_dir):
    """Best and all matching licences of every document."""
    found = licences.scan(_texts(spark, sf_dir))
    return found.select("doc_id", "licence", F.round("dice", 6).alias("dice"),
                        F.array_join("licences", ",").alias("licences"), "n_matches")


def op2_decontamination(spark, sf_dir):
    """Benchmark words hit in every document."""
    found = decontamination.contamination(_texts(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
    n_words, n_hit = F.col("contamination.n_words"), F.size("contamination.positions").cast("long")
    return found.select(
        "doc_id", n_words.alias("n_words"), n_hit.alias("n_hit"),
        F.size("contamination.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("contamination.items", ","), 256).alias("items_sha256"),
        decontamination.is_contaminated(n_hit, n_words).alias("contaminated"))


def op3_sharding(spark, sf_dir):
    """Shard and slot of every document; shard sizes differ by one row at most."""
    text = F.coalesce("text", F.lit(""))
    rows = _texts(spark, sf_dir).select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                                        F.crc32(text).alias("text_crc32"))
    return sharding.shard(rows, ["doc_id", "size", "text_crc32"], shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op4_quality_classifier(spark, sf_dir):
    """Calibrated quality score of every document."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    scores = quality_model.score_quality(_texts(spark, sf_dir), labels)
    return scores.select("doc_id", quality_model.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_quality_rules(spark, sf_dir):
    """Counts and verdict of the line-first rules for every document."""
    judged = quality_rules.judge(_texts(spark, sf_dir))
    return judged.select("doc_id", *(f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_failed_lines", "n_lost_words",
        "base_failed", "kept")))


def op6_url_filters(spark, sf_dir):
    """Verdict of every page's url."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return url_filters.judge_urls(pages, URL_RULES).select(
        "page_id", *(f"filter.{c}" for c in ("host", "path", "rule", "verdict")))


def op7_html_extraction(spark, sf_dir):
    """Main text of every page."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).select("page_id", "url", F.col("main_text").alias("text"),
                                              F.length("main_text").cast("long").alias("n_chars"))


def op8_suffix_dedup(spark, sf_dir):
    """Bytes of repeated 50-byte strings removed from every document."""
    found = suffix_dedup.remove_repeats(_texts(spark, sf_dir), span=50)
    kept = F.col("repeats.kept")
    return found.select("doc_id", F.col("repeats.n_bytes").alias("n_bytes"),
                        (F.col("repeats.n_bytes") - F.octet_length(kept)).alias("n_removed"),
                        F.size("repeats.spans").cast("long").alias("n_spans"), F.sha2(kept, 256).alias("kept_sha256"))


def op9_simhash(spark, sf_dir):
    """SimHash fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(_texts(spark, sf_dir), shingle=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op10_bpe(spark, sf_dir):
    """Token ids of every document, and the text decoded from them."""
    coded = bpe.encode(_texts(spark, sf_dir), vocabulary(), decoded="decoded")
    return coded.select("doc_id", F.expr("octet_length(token_ids) div 4").alias("n_tokens"),
                        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_phrases(spark, sf_dir):
    """The best collocations of two and three words of each language."""
    docs = read_table(spark, sf_dir, "documents").select("lang", "text")
    return phrases.collocations(docs).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _planted(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with a periodic tail in each tenth document, as the contract has it."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def tail(words):
        n = F.size(words)
        a = (g % n).cast("int")
        return let(F.struct(a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).cast("int").alias("p")), lambda x: F.array_join(
            F.transform(words, lambda w, i: F.when(i < x.a, w).otherwise(F.get(words, x.a + F.pmod(i - x.a, x.p)))), " "))

    words = words_of(F.col("text"), "[\\x20\\x09-\\x0D]+")
    planted = let(words, lambda w: F.when(F.size(w) > 0, tail(w)))
    return docs.withColumn("text", F.when(h % 10 == 0, planted).otherwise(F.col("text")))


def op12_periodic_runs(spark, sf_dir):
    """Number, strongest and digests of the periodic runs of every document."""
    found = periodic_runs.periodic_runs(_planted(_texts(spark, sf_dir)))
    runs = F.col("periodic.runs")
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.aggregate(runs, none, lambda b, r: F.when(b.isNull() | (r.length * b.period > b.length * r.period), r).otherwise(b))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    found = found.select("doc_id", F.size(runs).cast("long").alias("n_runs"), best.alias("best"),
                         F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                         F.sha2(F.col("periodic.collapsed"), 256).alias("collapsed_sha256"))
    return found.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op13_packing(spark, sf_dir):
    """Sequence and offset of every piece of every document."""
    import public_tokenizers

    pieces = packing.token_pieces(_texts(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


QUERIES = {f.__name__: f for f in (
    op1_licence_scan, op2_decontamination, op3_sharding, op4_quality_classifier, op5_quality_rules, op6_url_filters,
    op7_html_extraction, op8_suffix_dedup, op9_simhash, op10_bpe, op11_phrases, op12_periodic_runs,
    op13_packing)}
