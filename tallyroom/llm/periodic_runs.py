"""Maximal periodic runs of words, and texts without the repetitions.

A run is a stretch of words with smallest period q and length at least
max(12, 2 q) that no neighbouring word extends keeping q.  Words are ranked in
blocks of 2, 4, 8... by prefix doubling, which ends in the suffix array; a
block's rank is also the start of its interval there.  A run of period q holds
an aligned block whose length 2^k is at most (q + 1) / 2 together with its copy
q words later.  So each aligned block asks a wavelet tree over the suffix array
for the next place in its interval that lies in the window of distances of its
level.  Places come in arithmetic progressions, which are followed by a
longest-common-extension query instead of one by one; a progression that the
block's own run of the same difference goes through stands for multiples of that
period and is passed over.  Distances left are candidate periods; extending
block and copy to both sides by the stored ranks gives the run.  Texts are
worked on many at a time, their words numbered apart, with a mark between them
that is equal to nothing.

Defined results: a null text has no run and stays null; an empty or blank one
has none and becomes empty.  Texts are read whole, however long.  Rows are
independent of each other, so null ids, repeated rows and ties between
documents need no rule; runs are listed by start, then period.  Extra columns
are kept and may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import ragged, text_slices

LEAST_LENGTH = 12

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = "runs array<struct<start: long, length: long, period: long>>, collapsed string"


class SuffixRanks:
    """Ranks of all blocks of 1, 2, 4... words, and the places whose block is found again.

    The last word of each text must be a mark that occurs once; no block that
    occurs twice reaches over it.
    """

    def __init__(self, words: np.ndarray):
        sizes = np.bincount(words)
        rank = (np.cumsum(sizes) - sizes)[words]
        active = np.flatnonzero(sizes[words] > 1)
        self.levels, self.active = [rank.astype(np.int32)], [active]
        self.sizes = [sizes[words[active]]]
        while len(active):
            length = 1 << len(self.levels) - 1
            old, key = rank[active], rank[active].astype(np.int64) * len(words) + rank[active + length]
            order = np.argsort(key, kind="stable")
            active, key, old = active[order], key[order], old[order]
            at = np.arange(len(active))
            begins = np.concatenate([[True], key[1:] != key[:-1]])
            class_begins = np.concatenate([[True], old[1:] != old[:-1]])
            first = np.maximum.accumulate(np.where(begins, at, 0))
            rank = rank.copy()
            rank[active] = old + first - np.maximum.accumulate(np.where(class_begins, at, 0))
            group = np.diff(np.append(np.flatnonzero(begins), len(active)))
            size = np.repeat(group, group)
            active, size = active[size > 1], size[size > 1]
            self.levels.append(rank.astype(np.int32))
            self.active.append(active)
            self.sizes.append(size)

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and ``b`` on are the same."""
        same = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            same += (self.levels[k][a + same] == self.levels[k][b + same]).astype(np.int64) << k
        return same

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before ``a`` and ``b``, ``a < b``, are the same."""
        same = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a - same - (1 << k), b - same - (1 << k)
            same += ((x >= 0) & (self.levels[k][np.maximum(x, 0)] == self.levels[k][np.maximum(y, 0)])).astype(np.int64) << k
        return same


class WaveletTree:
    """A sequence of numbers below 2^bits, for range successor queries, many at a time."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            zero = (values >> bit & 1) == 0
            before = np.zeros(len(values) + 1, np.int64)
            np.cumsum(zero, out=before[1:])
            self.levels.append((bit, before))
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of the numbers at ``low`` up to ``high`` are less than ``bound``."""
        found = np.zeros(len(low), np.int64)
        for bit, before in self.levels:
            zero_low, zero_high, one = before[low], before[high], (bound >> bit & 1).astype(bool)
            found += np.where(one, zero_high - zero_low, 0)
            low, high = np.where(one, before[-1] + low - zero_low, zero_low), np.where(one, before[-1] + high - zero_high, zero_high)
        return found

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The number that ``k`` numbers at ``low`` up to ``high`` are before in order."""
        value = np.zeros(len(low), np.int64)
        for bit, before in self.levels:
            zero_low, zero_high = before[low], before[high]
            one = k >= zero_high - zero_low
            k = np.where(one, k - (zero_high - zero_low), k)
            value += one.astype(np.int64) << bit
            low, high = np.where(one, before[-1] + low - zero_low, zero_low), np.where(one, before[-1] + high - zero_high, zero_high)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray, none: int) -> np.ndarray:
        """The least number of at least ``bound`` at ``low`` up to ``high``, or ``none``, which is above all numbers."""
        smaller = self.below(low, high, np.minimum(bound, none))
        some = smaller < high - low
        found = np.full(len(low), none, np.int64)
        found[some] = self.smallest(low[some], high[some], smaller[some])
        return found


def _windows(levels: int, least: int) -> list[tuple[int, int, int]]:
    """(level, least distance, largest distance) of all levels below ``levels``.

    A run of period q and L words holds an aligned block of 2^k words and its copy if 2^(k + 1) - 1 + q <= L; each q has the largest such level.
    """
    short = [((least + 1 - q).bit_length() - 2, q) for q in range(1, least // 2 + 1)]
    windows = [(level, min(qs), max(qs)) for level in {k for k, _ in short} if (qs := [q for k, q in short if k == level])]
    for level in range(max(0, (least // 2 + 2).bit_length() - 2), levels):
        windows.append((level, max(least // 2 + 1, 2 ** (level + 1) - 1), 2 ** (level + 2) - 2))
    return [w for w in windows if w[0] < levels]


def word_runs(words: np.ndarray, text_of: np.ndarray, least: int = LEAST_LENGTH) -> np.ndarray:
    """All runs as rows (start, end, period), by start, then period.

    ``words`` are numbers that differ between texts, each text ended by a mark of its own; ``text_of`` has each word's text.
    """
    ranks = SuffixRanks(words)
    none, found = len(words), [np.zeros((0, 3), np.int64)]
    windows = _windows(len(ranks.levels), least)
    base = min((w[0] for w in windows), default=0)
    # The suffix array without the places whose block of the shortest length is alone; other intervals lose no place.
    places = np.sort(ranks.levels[-1][ranks.active[base]])
    if not len(places):
        return found[0]
    array = np.empty(len(words), np.int64)
    array[ranks.levels[-1]] = np.arange(len(words))
    tree = WaveletTree(array[places], len(words).bit_length())
    for level, nearest, farthest in windows:
        length = 1 << level
        aligned = ranks.active[level] % length == 0
        block, size = ranks.active[level][aligned], ranks.sizes[level][aligned]
        low = np.searchsorted(places, ranks.levels[level][block])
        first = tree.successor(low, low + size, block + nearest, none)
        while True:
            good = (first - block <= farthest) & (first < none)
            good[good] = text_of[first[good]] == text_of[block[good]]
            block, low, size, first = block[good], low[good], size[good], first[good]
            if not len(block):
                break
            second = tree.successor(low, low + size, first + 1, none)
            pair = np.flatnonzero(second < none)
            step, steps = np.ones(len(block), np.int64), np.zeros(len(block), np.int64)
            step[pair] = (second - first)[pair]
            near = pair[step[pair] <= length]
            stretch = ranks.forward(first[near], second[near])
            steps[near] = (second[near] + stretch - length - first[near]) // step[near]
            steps = np.minimum(steps, (block + farthest - first) // step)
            # Is the block in the progression's own run?
            through = np.zeros(len(block), bool)
            through[near] = block[near] + step[near] + ranks.forward(block[near], block[near] + step[near]) >= first[near] + length
            own = through & (first - block == step)
            emit = np.where(through, own.astype(np.int64), steps + 1)
            of = np.repeat(np.arange(len(block)), emit)
            place = np.arange(len(of)) - np.repeat(np.cumsum(emit) - emit, emit)
            a, b = block[of], first[of] + place * step[of]
            start, end = a - ranks.backward(a, b), b + ranks.forward(a, b)
            long = end - start >= np.maximum(least, 2 * (b - a))
            found.append(np.unique(np.stack([start, end, b - a], axis=1)[long], axis=0))
            first = tree.successor(low, low + size, first + steps * step + 1, none)
    runs = np.concatenate(found)
    # A stretch found with several periods has the least of them; the others are its multiples.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    runs = runs[np.concatenate([[True], (runs[1:, :2] != runs[:-1, :2]).any(axis=1)])] if len(runs) else runs
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _of_texts(texts: list[str], least: int) -> tuple[pa.ListArray, list[str]]:
    """Each text's runs, and its words without those that a run repeats."""
    split = [text.encode().split() for text in texts]
    numbers, base = [], 0
    for words in split:
        table = dict(zip(dict.fromkeys(words), count(base)))
        base += len(table) + 1
        numbers.append(np.fromiter(map(table.__getitem__, words), np.int64, len(words)))
        numbers.append(np.array([base - 1]))
    lengths = np.array([len(words) for words in split], np.int64)
    text_of = np.repeat(np.arange(len(texts)), lengths + 1)
    begins = np.cumsum(lengths + 1) - lengths - 1
    runs = word_runs(np.concatenate(numbers), text_of, least)
    of = text_of[runs[:, 0]]
    cover = np.zeros(len(text_of) + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 1], -1)
    kept = np.cumsum(cover[:-1]) == 0
    collapsed = []
    shortened = set(of.tolist())
    for i, words in enumerate(split):
        if i in shortened:
            words = list(compress(words, kept[begins[i] : begins[i] + len(words)].tolist()))
        collapsed.append(b" ".join(words).decode())
    fields = [pa.array(runs[:, 0] - begins[of]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])]
    return ragged(pa.StructArray.from_arrays(fields, fields=list(_RUN)), np.bincount(of, minlength=len(texts))), collapsed


def _runs(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_slices(batch):
                runs, collapsed = _of_texts(texts, least)
                null = batch.column("text").slice(start, len(texts)).is_null()
                text = pa.compute.if_else(null, pa.scalar(None, pa.string()), pa.array(collapsed, pa.string()))
                yield pa.RecordBatch.from_arrays([batch.column("doc").slice(start, len(texts)), runs, text], ["doc", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """All columns of ``docs`` but ``text``, with its ``runs`` (of ``least`` words or more) and the ``collapsed`` text without repetitions.

    A collapsed text keeps of each run the first period only; words are joined by one space.
    """
    others = [c for c in docs.columns if c != "text"]
    packed = docs.select(F.struct(F.lit(0).alias("row"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(others))).alias("doc"), "text")
    done = packed.mapInArrow(_runs(least), StructType([packed.schema["doc"], *StructType.fromDDL(_FOUND)]))
    return done.select(*(F.col("doc").getField(f"c{i}").alias(c) for i, c in enumerate(others)), "runs", "collapsed")


def plant_runs(doc_id: Column, text: Column) -> Column:
    """``text`` as it is, or for about a tenth of the ids with its end made periodic."""
    spot = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    g, n = F.floor(spot / 10), F.size(words)
    a = (g % n).cast("int")
    times = (F.lit(3) + g % 8).cast("int")
    p = (F.lit(1) + F.floor((n - a) / times)).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return F.when((spot % 10 == 0) & (F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")) > 0), planted).otherwise(text)
