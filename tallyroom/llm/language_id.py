"""Language identification, word first with backoff to character n-grams.

A known word counts with its log frequency in each language.  An unseen word
falls back to the longest character n-grams of it that are known, shorter and
shorter, down to single characters.  A document's language is the one with the
highest mean over its words.

The model is fitted on a sample of the different labelled texts, chosen by a
hash; copies do not weigh.  The sample has about ``max_documents`` texts and
``max_chars`` characters at most, which bounds the model that is broadcast; it
keeps every word and every n-gram of the sample, each for the languages that
have it.

Defined results: a null text, or one without a letter, is ``und`` with score 0,
as is every text if there is nothing to learn from.  A null ``doc_id`` is in no
fold: it is neither learned from nor held out.  Ties go to the first language
in alphabetical order.  Texts are read whole, however long.  Repeated rows each get a row.  Extra columns are kept
and may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, WordTable, column_slices, fold_of, take_runs, text_slices

UNKNOWN = "und"
LONGEST_GRAM = 5
MAX_DOCUMENTS = 20_000
MAX_CHARS = 16_000_000
#: Words whose readings a worker remembers at most; beyond it starts afresh.
WORDS_KEPT = 150_000
#: Added to every count.
SMOOTHING = 0.5
#: A document's mean counts as the evidence of so many words at most; else any long text would score 1.
EVIDENCE_WORDS = 20

FOLDS, HELD_OUT = 4, 2

_LETTERS = r"[^\W\d_]+"


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case; letters that ``re`` is too old for count where there are no others."""
    return re.findall(_LETTERS, text.lower()) or regex.findall(r"\p{L}+", text.lower())


def grams_of(word: str, n: int) -> list[str]:
    padded = f" {word} " if n > 1 else word
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def hashes_of(grams: list[str]) -> np.ndarray:
    """64-bit hashes that stand for words and n-grams."""
    return np.fromiter((xxhash.xxh64_intdigest(g) for g in grams), np.uint64, len(grams))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang_of, texts in ((b.column("lang").slice(first, len(t)).to_pylist(), t) for b in batches for first, t in text_slices(b)):
        counts: dict[str, Counter] = {}
        for lang, text in zip(lang_of, texts, strict=True):
            counts.setdefault(lang, Counter()).update(words_of(text))
        for lang, words in counts.items():
            by_length = [words, *(Counter() for _ in range(LONGEST_GRAM))]
            for word, count in words.items():
                for n in range(1, LONGEST_GRAM + 1):
                    for gram in grams_of(word, n):
                        by_length[n][gram] += count
            for n, grams in enumerate(by_length):
                names = [pa.array([lang] * len(grams)), pa.array([n] * len(grams), pa.int32()), pa.array(hashes_of(list(grams)).view(np.int64))]
                yield pa.RecordBatch.from_arrays([*names, pa.array(list(grams.values()), pa.int64())], ["lang", "n", "gram", "count"])


class Model:
    """Log frequencies by language, kept for the languages that a word (length 0) or n-gram was seen in.

    ``hashes[n]`` are the sorted hashes of length n, ``ends[n]`` where each one's
    languages and values end, a value being how far the log frequency lies above
    ``defaults[n]``, that of what a language never has.
    """

    def __init__(self, langs: list[str], tables: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], defaults: np.ndarray):
        self.langs = langs
        self.hashes, self.ends, self.lang_of, self.values = zip(*tables, strict=True)
        # What no n-gram is known of counts for no language.
        self.defaults = np.concatenate([defaults, np.zeros((1, len(langs)))])

    def find(self, n: int, hashes: np.ndarray) -> np.ndarray:
        """The places of hashes of length ``n``; -1 for unknown ones."""
        known = self.hashes[n]
        if not len(known):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        return np.where(known[at] == hashes, at, -1)

    def gather(self, n: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Languages and values at the places, and how many each has."""
        ends = self.ends[n][places]
        sizes = np.diff(self.ends[n], prepend=0)[places]
        return take_runs(self.lang_of[n], ends - sizes, sizes), take_runs(self.values[n], ends - sizes, sizes), sizes

    def read(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each word the length it is known by, then language and value by turns."""
        level = np.full(len(words), LONGEST_GRAM + 1)
        open_ = np.arange(len(words))
        of, langs, values = [], [], []
        for n in (0, *range(LONGEST_GRAM, 0, -1)):
            parts = [[words[i]] if n == 0 else grams_of(words[i], n) for i in open_.tolist()]
            sizes = np.array([len(p) for p in parts], np.int64)
            places = self.find(n, hashes_of(list(chain.from_iterable(parts))))
            owner = np.repeat(open_, sizes)[places >= 0]
            lang, value, counts = self.gather(n, places[places >= 0])
            known = np.bincount(owner, minlength=len(words))
            of.append(np.repeat(owner, counts))
            langs.append(lang)
            values.append(value / known[of[-1]])
            level[open_[known[open_] > 0]] = n
            open_ = open_[known[open_] == 0]
            if not len(open_):
                break
        owner, lang, value = (np.concatenate(x) for x in (of, langs, values))
        # N-grams of one word that share a language are added up.
        cells, index = np.unique(owner * len(self.langs) + lang, return_inverse=True)
        value = np.bincount(index, weights=value, minlength=len(cells))
        lengths = 1 + 2 * np.bincount(cells // len(self.langs), minlength=len(words))
        flat = np.empty(int(lengths.sum()), np.float32)
        heads = np.zeros(len(flat), bool)
        heads[np.cumsum(lengths) - lengths] = True
        flat[heads] = level
        flat[~heads] = np.stack([cells % len(self.langs), value], axis=1).ravel()
        return flat, lengths

    @cached_property
    def seen(self) -> WordTable:
        """The readings of words met so far; it lives as long as the worker keeps the model."""
        return WordTable(self.read, limit=WORDS_KEPT, dtype=np.float32)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        words = [words_of(t) if t else [] for t in texts]
        lengths = np.array([len(w) for w in words], np.int64)
        if not self.langs or not lengths.sum():
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        flat, sizes = self.seen.gather(self.seen.index(list(chain.from_iterable(words))))
        text_of = np.repeat(np.arange(len(texts)), lengths)
        heads = np.zeros(len(flat), bool)
        heads[np.cumsum(sizes) - sizes] = True
        rows, columns = len(texts), len(self.langs)
        levels = np.bincount(text_of * len(self.defaults) + flat[heads].astype(np.int64), minlength=rows * len(self.defaults))
        lang, value = flat[~heads].reshape(-1, 2).T
        cell = np.repeat(text_of, (sizes - 1) // 2) * columns + lang.astype(np.int64)
        means = levels.reshape(rows, -1) @ self.defaults + np.bincount(cell, weights=value, minlength=rows * columns).reshape(rows, columns)
        means /= np.maximum(lengths, 1)[:, None]
        evidence = np.exp((means - means.max(axis=1, keepdims=True)) * np.minimum(lengths, EVIDENCE_WORDS)[:, None])
        best = means.argmax(axis=1)
        return (
            [self.langs[b] if n else UNKNOWN for b, n in zip(best, lengths, strict=True)],
            np.where(lengths > 0, 1 / evidence.sum(axis=1), 0.0),
        )


def learnable(docs: DataFrame) -> DataFrame:
    """Labelled documents outside the held-out fold."""
    return docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold_of("doc_id", FOLDS) != HELD_OUT))


def fit(labelled: DataFrame, max_documents: int = MAX_DOCUMENTS, max_chars: int = MAX_CHARS) -> Model:
    """A model from rows with ``lang`` and ``text``; the bounds are described above."""
    keyed = labelled.select("lang", "text", F.xxhash64("text").alias("text_hash"))
    different = keyed.groupBy("lang", "text_hash").agg(F.max(F.length("text")).alias("chars"))
    documents, chars = different.agg(F.count("*"), F.coalesce(F.sum("chars"), F.lit(0))).first()
    rate = min(1.0, max_documents / max(1, documents), max_chars / max(1, chars))
    sample = keyed.filter(F.pmod("text_hash", F.lit(1 << 30)) < int(rate * (1 << 30))).select("lang", "text").distinct()
    counts = sample.mapInArrow(_count_grams, "lang string, n int, gram long, count long")
    counted = counts.groupBy("n", "gram", "lang").agg(F.sum("count").alias("count")).toArrow()
    langs = sorted(set(counted.column("lang").unique().to_pylist()))
    number = pc.index_in(counted.column("lang"), pa.array(langs, pa.string())).to_numpy()
    lengths, count = counted.column("n").to_numpy(), counted.column("count").to_numpy()
    hashes = counted.column("gram").to_numpy().view(np.uint64)
    tables, defaults = [], []
    for n in range(LONGEST_GRAM + 1):
        rows = np.flatnonzero(lengths == n)
        rows = rows[np.lexsort((number[rows], hashes[rows]))]
        known, sizes = np.unique(hashes[rows], return_counts=True)
        room = np.bincount(number[rows], weights=count[rows], minlength=len(langs)) + SMOOTHING * (len(known) + 1)
        defaults.append(np.log(SMOOTHING / room))
        tables.append((known, np.cumsum(sizes), number[rows].astype(np.int32), np.log((count[rows] + SMOOTHING) / SMOOTHING).astype(np.float32)))
    return Model(langs, tables, np.stack(defaults))


def predictor(spark, model: Model):
    """A column function: text to ``struct<lang string, score double>``, over whole texts."""
    shared = Shared(spark, model)

    @F.arrow_udf("lang string, score double")
    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            langs, scores = [], [np.zeros(0)]
            for texts in column_slices(column):
                found, score = shared.value.predict(texts)
                langs += found
                scores.append(score)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(np.concatenate(scores))], ["lang", "score"])

    return predict


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row."""
    found = predictor(docs.sparkSession, model)
    scored = docs.select("doc_id", found("text").alias("found"))
    held_out = F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def keep_identified(docs: DataFrame, model: Model, least_score: float = 0.5) -> DataFrame:
    """The documents whose language is found with at least ``least_score``."""
    found = predictor(docs.sparkSession, model)
    packed = docs.select(F.struct("*").alias("doc"), found("text").alias("found"))
    sure = packed.filter((F.col("found.lang") != UNKNOWN) & (F.col("found.score") >= least_score))
    return sure.select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))
