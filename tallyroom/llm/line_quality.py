"""Quality rules from the frequency of lines across documents.

Lines are normalised and hashed; for each host (the documents' source) the
distinct documents that carry a line are counted; lines above the limit are
removed, all but in the first document that has them; a document that loses
most of its words this way is rejected.  Basic per-document rules come first.

Defined results: a null text has no words and fails the base rules, as does an
empty one.  A null source is a host of its own.  A document is an id with its
text: exact copies under ids of their own count each, repeated rows once, and
null ids with one text once.  A null ``doc_id`` is never the first document of a
line; rows that share the smallest id are all the first.  Texts are read whole,
however long.  Repeated rows each get a row.  Extra columns are ignored,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.operators.hot_keys import join_per_key

from .common import null_safe, settle, text_slices

BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A line is frequent if more distinct documents of its host carry it.
MAX_DOCUMENTS = 20
#: A document is depleted if fewer than this many percent of its words remain.
LEAST_PERCENT_LEFT = 30
MIN_WORDS = 50

_FACTS = (
    "doc_id long, host string, text_hash long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
    " n_repeat_words long, lines array<long>, line_words array<int>"
)


def normal_line(line: str) -> bytes:
    """Words of a line, A-Z lowered, with single spaces."""
    return b" ".join(line.encode().lower().split())


def line_hash(normal: bytes) -> int:
    """The same signed number as Spark's xxhash64."""
    value = xxhash.xxh64_intdigest(normal, 42)
    return value - (value >> 63 << 64)


def repeat_words(words: list) -> int:
    """Words that lie in a window of three words found twice or more."""
    counts = Counter(zip(words, words[1:], words[2:], strict=False))
    if len(counts) == max(0, len(words) - 2):
        return 0
    covered, end = 0, 0
    for i, window in enumerate(zip(words, words[1:], words[2:], strict=False)):
        if counts[window] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def _text_facts(text: str) -> tuple:
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    carried: Counter = Counter()
    for line in lines:
        normal = normal_line(line)
        carried[line_hash(normal)] += normal.count(b" ") + 1
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        list(carried),
        list(carried.values()),
    )


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64()] * 5 + [pa.list_(pa.int64()), pa.list_(pa.int32())]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines", "line_words"]
    for batch in batches:
        for start, texts in text_slices(batch):
            columns = zip(*map(_text_facts, texts), strict=True)
            facts = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            keys = [batch.column(k).slice(start, len(texts)) for k in ("doc_id", "host", "text_hash")]
            yield pa.RecordBatch.from_arrays([*keys, *facts], ["doc_id", "host", "text_hash", *names])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        null_safe("source").alias("host"),
        F.xxhash64("text").alias("text_hash"),
        "text",
    )


def line_verdicts(
    docs: DataFrame,
    max_documents: int = MAX_DOCUMENTS,
    least_percent_left: int = LEAST_PERCENT_LEFT,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """One row per document: base figures, words left without frequent lines, ``removed`` line hashes, ``kept``."""
    facts = settle(_keyed(docs).mapInArrow(_facts, _FACTS).withColumn("row", F.monotonically_increasing_id()))
    lines = facts.select(
        "row", "doc_id", "host", "text_hash", F.inline(F.arrays_zip(F.col("lines").alias("line"), F.col("line_words").alias("words")))
    ).toDF("row", "doc_id", "host", "text_hash", "line", "words")
    frequent = (
        lines.select("host", "line", "doc_id", "text_hash")
        .distinct()
        .groupBy("host", "line")
        .agg(F.count("*").alias("documents"), F.min("doc_id").alias("first_doc"))
        .filter(F.col("documents") > max_documents)
        .drop("documents")
    )
    lost = (
        join_per_key(lines, frequent, ["host", "line"])
        .filter(~F.coalesce(F.col("doc_id") == F.col("first_doc"), F.lit(False)))
        .groupBy("row")
        .agg(F.sum("words").alias("lost"), F.collect_list("line").alias("removed"))
    )
    base_failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    return (
        facts.drop("lines", "line_words")
        .join(lost, "row", "left")
        .select(
            "doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            base_failed.alias("base_failed"),
            (~base_failed & (100 * left >= least_percent_left * F.col("n_words"))).alias("kept"),
            left.alias("words_left"),
            "removed",
        )
    )


def _clean(text: Column, removed: Column) -> Column:
    """``text`` without the lines whose hashes are in ``removed`` (null: unchanged)."""
    blank = r"[\x20\x09-\x0D]+"

    def stays(line: Column) -> Column:
        normal = F.trim(F.regexp_replace(F.translate(line, _UPPER, _UPPER.lower()), blank, " "))
        return (normal == "") | ~F.array_contains(removed, F.xxhash64(normal))

    return F.when(removed.isNull(), text).otherwise(F.array_join(F.filter(F.split(text, "\n"), stays), "\n"))


def keep_quality(docs: DataFrame, **limits: int) -> DataFrame:
    """The documents that pass, with their frequent lines removed and ``n_chars`` (if there) brought up to date."""
    verdicts = line_verdicts(docs, **limits)
    keys = ["doc_key", "host", "text_hash"]
    passed = (
        verdicts.filter("kept")
        .withColumn("doc_key", null_safe("doc_id"))
        .groupBy(*keys)  # repeated rows have the same verdict
        .agg(F.first("removed").alias("removed"))
    )
    packed = docs.select(
        F.struct("*").alias("doc"),
        null_safe(F.col("doc_id").cast("long")).alias("doc_key"),
        null_safe("source").alias("host"),
        F.xxhash64("text").alias("text_hash"),
    )
    kept = packed.join(passed, keys).select("doc", _clean(F.col("doc.text"), F.col("removed")).alias("text"))
    fresh = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return kept.select(*(fresh.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns))
