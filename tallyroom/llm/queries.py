"""The registered queries over the given tables, and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import url_templates
from .bloom_lm import score_corpus
from .common import Shared, shared_path, table
from .edit_counts import ByteTokenizer, apply_edits, count_trees
from .embedding_dedup import near_duplicate_vectors
from .language_id import fit, identify, learnable
from .lexical_search import search
from .line_quality import line_verdicts
from .mixing import mix_sizes
from .periodic_runs import periodic_runs, plant_runs
from .piece_codec import Pieces, round_trip
from .simhash_dedup import near_duplicates
from .sql import EMBEDDINGS, LINE_QUALITY, MIXING, SEARCH
from .toxicity import fit as fit_toxicity
from .toxicity import toxicity
from .token_orc import TextTokenizer, read_token_ids, token_digest, write_token_ids

WORDS, BYTES, PIECES = "word_bpe_49k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
END_ID = 2


def op1_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = Shared(spark, TextTokenizer(public_tokenizers.path(WORDS)))
    path = shared_path(spark, "token-ids")
    write_token_ids(table(spark, sf_dir, "documents"), tokenizer, path, END_ID)
    return token_digest(read_token_ids(spark, path))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(table(spark, sf_dir, "documents")).drop("repetitions")


def sample_edits(doc_id: Column, text: Column) -> Column:
    """Three edits for a document, at places given by its id: one removes, one inserts its own beginning, one replaces."""
    text = F.coalesce(text, F.lit(""))
    spot = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    place = lambda k: F.pmod(F.shiftright(spot, k), F.length(text) + 1).cast("int")
    change = lambda at, remove, insert: F.struct(at.alias("at"), F.lit(remove).alias("remove"), insert.alias("insert"))
    return F.array(
        change(place(0), 7, F.lit("")), change(place(5), 0, F.concat(F.lit(" "), F.substring(text, 1, 20))), change(place(11), 40, F.lit("\n2024 "))
    )


def op4_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's count, and its count after three edits, with the characters encoded for them."""
    tokenizer = Shared(spark, ByteTokenizer(public_tokenizers.path(BYTES), public_tokenizers.PATTERN))
    docs = table(spark, sf_dir, "documents")
    edits = sample_edits(F.col("doc_id"), F.col("text"))
    done = apply_edits(count_trees(docs, tokenizer).withColumn("edits", edits), tokenizer)
    return done.select("doc_id", "n_tokens_before", "n_edits", F.col("done.n_tokens").alias("n_tokens"), F.col("done.encoded_chars").alias("encoded_chars"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(learnable(docs)))


def op6_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = Shared(spark, Pieces(public_tokenizers.path(PIECES)))
    return round_trip(table(spark, sf_dir, "documents"), pieces).drop("ids")


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op8_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_corpus(table(spark, sf_dir, "documents"))


def op9_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = url_templates.page_labels(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return url_templates.url_verdicts(pages)


def op10_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = line_verdicts(table(spark, sf_dir, "documents"))
    figures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "words_left")
    return verdicts.select("doc_id", *figures)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", plant_runs(F.col("doc_id"), F.col("text")).alias("text")))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    # The greatest length, then the smallest start and period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    named = found.select("doc_id", "runs", listed.alias("listed"), best.alias("best"), F.coalesce("collapsed", F.lit("")).alias("collapsed"))
    length, period = F.col("best.length"), -F.col("best.period")
    return named.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_orc, op2_embedding_dedup, op3_mix_sources, op4_edit_counts, op5_language_id, op6_piece_codec,
        op7_simhash_dedup, op8_bloom_lm, op9_url_templates, op10_line_quality, op11_toxicity, op12_periodic_runs, op13_lexical_search,
    )
}

ORACLE: dict[str, str] = {
    "op2_embedding_dedup": EMBEDDINGS,
    "op3_mix_sources": MIXING,
    "op9_url_templates": url_templates.verdict_sql(),
    "op10_line_quality": LINE_QUALITY,
    "op13_lexical_search": SEARCH,
}
