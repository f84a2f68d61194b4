"""Language-model scores from a log-frequency Bloom filter.

Words and pairs of neighbouring words are counted over all training documents.
A count c is quantised to the level 1 + floor(log_base c), and the n-gram is
entered once with each level up to its own; so a count is read back by asking
for level 1, 2, ... until the filter says no.  A pair's probability is smoothed
towards its word's.

The filter is built in shards by the n-grams' hash, each from its own counts,
and holds every n-gram.  Up to ``MAX_FILTER_BYTES`` it is broadcast: it comes to
the driver in parts, which keeps no copy of its own once the executors can fetch
it, and is freed when the scores are stored.  A larger one stays in its shards,
and the different n-grams of each block of texts go to them and their levels come
back, which gives the same scores.  The exact base
score needs every word's count, however many words there are: words at or above
the smallest count that at most ``MAX_TOP_WORDS`` words reach are broadcast, all
others are joined.

Defined results: a null text counts as empty, which is one end token.  A null
``doc_id`` is in no fold: its text is neither learned from nor held out.
Without training documents N and V are 0, the base score of each token is
log10(0.5 / 0.5) = 0 and so is the score.  Texts are read whole, however long.
Counts of pairs are rounded apart from those of words, so ``score`` is not exactly
normalised.  Repeated rows each count and each get a row.  Extra columns are ignored, whatever their names; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.operators.hot_keys import join_per_key

from .common import Shared, fold_of, per_list, ragged, settle, shared_path, text_slices

FOLDS, HELD_OUT = 5, 1
#: The end token's name in count tables; no word holds a line break.
END = b"\n"

BASE = 1.5
BITS_PER_ENTRY = 10
PROBES = 4
#: A larger filter is not broadcast.
MAX_FILTER_BYTES = 96 << 20
#: Bytes of the filter, about, that come to the driver at a time.
PART_BYTES = 8 << 20
MAX_TOP_WORDS = 1_000_000
#: Tokens of training text per shard of the filter.
SHARD_TOKENS = 1_000_000
#: Characters of text that a task counts before it passes the counts on.
COUNT_CHARS = 24_000_000
#: Characters of text whose n-grams are looked up together in a filter that is not broadcast.
BLOCK_CHARS = 24_000_000
#: Weight of a word's own probability in that of a pair.  On held-out training documents of the given tables larger weights
#: have lower perplexity (5: 25,695, 20: 16,347, 200: 10,483), while pairs seen only twice need a small one to show.
PRIOR_WEIGHT = 20.0
_FACTOR = np.uint64(0x5851F42D4C957F2D)


def tokens_of(text: str) -> list[bytes]:
    return [*text.encode().lower().split(), END]


def _mixed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers scattered by multiplying and shifting."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs from ``starts`` to ``ends``, all at once.

    Each byte has a scattered value and is weighed by a power of an odd number;
    a run's hash is a difference of running sums, brought to the run's start.
    """
    scattered = _mixed(np.arange(1, 257, dtype=np.uint64))
    powers, inverse = np.full(len(data) + 1, _FACTOR), np.full(len(data) + 1, np.uint64(pow(int(_FACTOR), -1, 1 << 64)))
    powers[0] = inverse[0] = 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(scattered[data] * np.cumprod(powers)[:-1], out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * np.cumprod(inverse)[starts])


def _hash_lot(words: pa.Array) -> np.ndarray:
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return word_hashes(data, offsets[:-1] - offsets[0], offsets[1:] - offsets[0])


def hash_all(words: pa.Array) -> np.ndarray:
    """Hashes of an array of binary words, some tens of thousands at a time."""
    lots = (words.slice(i, 50_000) for i in range(0, len(words), 50_000))
    return np.concatenate([np.zeros(0, np.uint64), *map(_hash_lot, lots)])


_END_HASH = word_hashes(np.frombuffer(END, np.uint8), np.array([0]), np.array([1]))[0]


class Tokens:
    """The tokens of some texts: words A-Z lowered, and an end after each text."""

    def __init__(self, texts: list[str]):
        raw = [text.encode() for text in texts]
        whole = b"\n".join([*raw, b""]).lower()
        self.data = np.frombuffer(whole, np.uint8)
        blank = (self.data == 32) | ((self.data >= 9) & (self.data <= 13))
        edges = np.flatnonzero(np.diff(blank, prepend=True))
        self.starts, self.ends = edges[::2], edges[1::2]  # every text is followed by a blank
        text_ends = np.cumsum([len(r) + 1 for r in raw])
        words = np.diff(np.searchsorted(self.starts, text_ends), prepend=0)
        self.lengths = words + 1
        self.last = np.cumsum(self.lengths) - 1
        self.hashes = np.empty(int(self.lengths.sum()), np.uint64)
        self.word_at = np.ones(len(self.hashes), bool)
        self.word_at[self.last] = False
        self.hashes[self.word_at] = word_hashes(self.data, self.starts, self.ends)
        self.hashes[self.last] = _END_HASH

    def before(self) -> np.ndarray:
        """The hash of the token before each, which is the end before a text's first."""
        shifted = np.roll(self.hashes, 1)
        shifted[self.last - self.lengths + 1] = _END_HASH
        return shifted

    def word(self, place: int) -> bytes:
        return self.data[self.starts[place] : self.ends[place]].tobytes()


def pair_hashes(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return _mixed(_mixed(before) + np.uint64(0x9E3779B97F4A7C15) * words)


def level_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / math.log(BASE) + 1e-12).astype(np.int64)


def count_at(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts of each level; 0 at level 0."""
    low = np.ceil(BASE ** (np.arange(200) - 1.0) - 1e-9)
    middle = (low + np.maximum(low, np.ceil(BASE ** np.arange(200.0) - 1e-9) - 1)) / 2
    middle[0] = 0
    return middle[levels]


def _first_slot(hashes: np.ndarray, level: np.ndarray | int) -> np.ndarray:
    """Where the probes for an n-gram at a level begin; each next one is ``place * _FACTOR + 1``."""
    return _mixed(hashes + np.uint64(0xA24BAED4963EE407) * np.atleast_1d(level).astype(np.uint64))


def _slot(place: np.ndarray, bits: np.ndarray | int) -> np.ndarray:
    """The place among a shard's bits, which are fewer than 2^32."""
    return ((place >> np.uint64(32)) * np.asarray(bits, np.uint64)) >> np.uint64(32)


def _text_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[str]]:
    run, size = [], 0
    for batch in batches:
        for _, texts in text_slices(batch):
            run += texts
            size += sum(map(len, texts))
            if size > COUNT_CHARS:
                yield run
                run, size = [], 0
    if run:
        yield run


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for texts in _text_runs(batches):
        counts: Counter = Counter()
        for text in texts:
            counts.update(tokens_of(text))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])


def count_words(train: DataFrame) -> DataFrame:
    """``word`` and ``n`` over all training texts."""
    partial = train.select("text").mapInArrow(_word_counts, "word binary, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def _by_shard(hashes: np.ndarray, counts: np.ndarray, shards: int) -> pa.RecordBatch:
    shard = hashes % np.uint64(shards)
    order = np.argsort(shard, kind="stable")
    hashes, counts, shard = hashes[order], counts[order], shard[order]
    starts = np.flatnonzero(np.diff(shard.astype(np.int64), prepend=-1))
    ends = [*starts[1:], len(shard)]
    blobs = [[a[i:j].tobytes() for i, j in zip(starts, ends, strict=True)] for a in (hashes.astype("<u8"), counts.astype("<u8"))]
    return pa.RecordBatch.from_arrays(
        [pa.array(shard[starts].astype(np.int64)), pa.array(blobs[0], pa.binary()), pa.array(blobs[1], pa.binary())], ["shard", "hashes", "counts"]
    )


_BLOBS = "shard long, hashes binary, counts binary"


def _pair_counts(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _text_runs(batches):
            pairs = []
            for first in range(0, len(texts), 300):
                tokens = Tokens(texts[first : first + 300])
                pairs.append(pair_hashes(tokens.before(), tokens.hashes))
            yield _by_shard(*np.unique(np.concatenate(pairs), return_counts=True), shards)

    return run


def _word_blobs(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield _by_shard(hash_all(batch.column("word")), batch.column("n").to_numpy(), shards)

    return run


def _segments(shard_table: pa.Table) -> pa.Table:
    """A shard's part of the filter: entries and bits, from counts of ``cutoff`` on, which is 1."""
    hashes = np.frombuffer(b"".join(shard_table.column("hashes").to_pylist()), "<u8")
    counts = np.frombuffer(b"".join(shard_table.column("counts").to_pylist()), "<u8").astype(np.int64)
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    hashes, counts = hashes[starts], np.add.reduceat(counts, starts)
    levels = level_of(counts)
    entries = int(levels.sum())
    size = -(-entries * BITS_PER_ENTRY // 64) * 64
    level = np.arange(entries) - np.repeat(np.cumsum(levels) - levels, levels) + 1
    bits = np.zeros(size, bool)
    place = _first_slot(np.repeat(hashes, levels), level)
    for _ in range(PROBES):
        bits[_slot(place, size)] = True
        place = place * _FACTOR + np.uint64(1)
    row = {"shard": shard_table.column("shard")[0].as_py(), "cutoff": 1, "entries": entries, "bits": np.packbits(bits, bitorder="little").tobytes()}
    return pa.Table.from_pylist([row], pa.schema([("shard", pa.int64()), ("cutoff", pa.int32()), ("entries", pa.int64()), ("bits", pa.binary())]))


class LogFrequencyFilter:
    """The Bloom filter's shards one after another."""

    def __init__(self, shards: int, segments: dict[int, np.ndarray]):
        self._lay_out(np.array([len(segments.get(s, b"")) for s in range(shards)]))
        for shard, segment in segments.items():
            self._enter(shard, segment)

    def _lay_out(self, lengths: np.ndarray) -> None:
        """Room for as many bytes in each shard."""
        self.shards = len(lengths)
        self.sizes = 8 * lengths.astype(np.uint64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.uint64)
        self.bits = np.zeros(int(lengths.sum()), np.uint8)

    def _enter(self, shard: int, segment: np.ndarray) -> None:
        start = int(self.starts[shard]) // 8
        self.bits[start : start + len(segment)] = segment

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """For each n-gram the highest level up to which the filter has all; 0 if it has none."""
        shard = (hashes % np.uint64(self.shards)).astype(np.int64)
        sizes, starts = self.sizes[shard], self.starts[shard]
        level = np.zeros(len(hashes), np.int64)
        active = np.flatnonzero(sizes > 0)
        asked = 0
        while len(active):
            asked += 1
            place = _first_slot(hashes[active], asked)
            for _ in range(PROBES):  # most n-grams that are not there fall out at once
                at = _slot(place, sizes[active]) + starts[active]
                hit = ((self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
                active, place = active[hit], place[hit] * _FACTOR + np.uint64(1)
            level[active] = asked
        return level


class FoundLevels:
    """Levels that the filter gave for the sorted hashes of some texts."""

    def __init__(self, hashes: np.ndarray, found: np.ndarray):
        self.hashes, self.found = hashes, found

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        return self.found[np.searchsorted(self.hashes, hashes)].astype(np.int64)


class Model(LogFrequencyFilter):
    """What scoring needs: the filter, if it is broadcast, N and V, and the exact counts of the most frequent words by hash."""

    def __init__(
        self, lengths: np.ndarray, segments: Iterable[tuple[int, np.ndarray]], total: int, distinct: int, top_hashes: np.ndarray, top_counts: np.ndarray
    ):
        """``lengths``: the bytes of each shard, which ``segments`` gives one after another, so that the filter is held once."""
        self._lay_out(lengths)
        for shard, segment in segments:
            self._enter(shard, segment)
        order = np.argsort(top_hashes)
        self.total, self.distinct = total, distinct
        self.top_hashes, self.top_counts = top_hashes[order], top_counts[order]

    def exact(self, hashes: np.ndarray) -> np.ndarray:
        """Counts of words among the top; -1 for others."""
        if not len(self.top_hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.top_hashes, hashes), len(self.top_hashes) - 1)
        return np.where(self.top_hashes[at] == hashes, self.top_counts[at], -1)

    @property
    def room(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    def score(self, texts: list[str], found: FoundLevels | None = None) -> dict[str, np.ndarray]:
        tokens, levels = Tokens(texts), (found or self).levels
        lengths, last = tokens.lengths, tokens.last
        different, index = np.unique(tokens.hashes, return_inverse=True)
        counts, exact = count_at(levels(different))[index], self.exact(different)[index]
        counts_before = np.roll(counts, 1)
        counts_before[last - lengths + 1] = counts[last]  # the text's own end token
        pairs = np.minimum(count_at(levels(pair_hashes(tokens.before(), tokens.hashes))), counts_before)
        alone = (counts + 0.5) / self.room
        smoothed = (pairs + PRIOR_WEIGHT * alone) / (counts_before + PRIOR_WEIGHT)
        top = exact >= 0
        word_number = np.cumsum(tokens.word_at) - 1
        rest = np.flatnonzero(~top)
        return {
            "n_tokens": lengths,
            "top_known": per_list((exact > 0).astype(np.int64), lengths),
            "top_score": per_list(np.where(top, np.log10((np.maximum(exact, 0) + 0.5) / self.room), 0.0), lengths),
            "score": per_list(np.log10(smoothed), lengths),
            "rest_lengths": per_list((~top).astype(np.int64), lengths),
            "rest": [tokens.word(word_number[i]) if tokens.word_at[i] else END for i in rest.tolist()],
        }


class Fitted:
    """A model sent to the executors, and the figures of it that the driver keeps."""

    def __init__(self, spark: SparkSession, model: Model):
        self.shards, self.total, self.room = model.shards, model.total, model.room
        self.shared = Shared(spark, model)


def _cut(counts: np.ndarray, words: np.ndarray, most: int) -> int:
    """The smallest count that at most ``most`` words reach, from different counts and the words with each."""
    order = np.argsort(-counts)
    reached = np.searchsorted(np.cumsum(words[order]), most, "right")
    return int(counts[order[reached - 1]]) if reached else 1 << 62


def _hashed_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(hash_all(batch.column("word")).view(np.int64)), batch.column("n")], ["hash", "n"])


def _lengths(segments: DataFrame, shards: int) -> np.ndarray:
    """The bytes of each shard of a filter."""
    found, lengths = segments.select("shard", F.length("bits").alias("bytes")).toArrow(), np.zeros(shards, np.int64)
    lengths[found.column("shard").to_numpy()] = found.column("bytes").to_numpy()
    return lengths


def _in_parts(segments: DataFrame, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """The shards of a filter of ``size`` bytes, of which few are on their way to the driver at once."""
    for row in segments.coalesce(max(1, -(-size // PART_BYTES))).toLocalIterator():
        yield row["shard"], np.frombuffer(row["bits"], np.uint8)


def fit(
    docs: DataFrame, max_filter_bytes: int = MAX_FILTER_BYTES, max_top_words: int = MAX_TOP_WORDS
) -> tuple[Fitted, DataFrame, DataFrame | None]:
    """The model learned from ``docs`` (``text``), the stored exact counts of its words that are not among the top, and a filter too large for the model."""
    docs = docs.select("text")
    words = settle(count_words(docs))
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    histogram = words.groupBy("n").agg(F.count("*").alias("words")).toArrow()  # a row per distinct count
    least = _cut(histogram.column("n").to_numpy(), histogram.column("words").to_numpy(), max_top_words)
    shards = max(1, -(-total // SHARD_TOKENS))
    blobs = docs.mapInArrow(_pair_counts(shards), _BLOBS).union(words.mapInArrow(_word_blobs(shards), _BLOBS))
    segments = settle(blobs.groupBy("shard").applyInArrow(_segments, "shard long, cutoff int, entries long, bits binary").select("shard", "bits"))
    size = segments.agg(F.coalesce(F.sum(F.length("bits")), F.lit(0))).first()[0]
    large = size > max_filter_bytes
    top = words.filter(F.col("n") >= least).mapInArrow(_hashed_words, "hash long, n long").toArrow()
    model = Model(
        np.zeros(shards, np.int64) if large else _lengths(segments, shards),
        () if large else _in_parts(segments, size),
        total,
        distinct,
        top.column("hash").to_numpy().view(np.uint64),
        top.column("n").to_numpy(),
    )
    return Fitted(docs.sparkSession, model), words.filter(F.col("n") < least), segments if large else None


_SCORED = "doc_id long, n_tokens long, top_known long, top_score double, score double, rest array<binary>"


def _scored_batch(doc_ids: pa.Array | pa.ChunkedArray, found: dict[str, np.ndarray]) -> pa.RecordBatch:
    rest = ragged(pa.array(found["rest"], pa.binary()), found["rest_lengths"])
    names = ["n_tokens", "top_known", "top_score", "score"]
    return pa.RecordBatch.from_arrays([doc_ids, *(pa.array(found[n]) for n in names), rest], ["doc_id", *names, "rest"])


def _scored(shared: Shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_slices(batch):
                yield _scored_batch(batch.column("doc_id").slice(first, len(texts)), shared.value.score(texts))

    return run


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, size = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        for first, texts in text_slices(batch):
            chars = sum(map(len, texts))
            if size and size + chars > BLOCK_CHARS:
                block, size = block + 1, 0
            size += chars
            part = batch.slice(first, len(texts))
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(texts), pa.int64()), *part.columns], ["block", *part.schema.names])


def _different(block: pa.Table) -> np.ndarray:
    """The sorted hashes of a block's words and pairs."""
    hashes = [np.zeros(0, np.uint64)]
    for batch in block.to_batches():
        for _, texts in text_slices(batch):
            tokens = Tokens(texts)
            hashes.append(np.unique(np.concatenate([tokens.hashes, pair_hashes(tokens.before(), tokens.hashes)])))
    return np.unique(np.concatenate(hashes))


def _asked(shards: int):
    def run(block: pa.Table) -> pa.Table:
        hashes = _different(block)
        asked = pa.Table.from_batches([_by_shard(hashes, np.zeros(len(hashes)), shards)]).select(["shard", "hashes"])
        return asked.add_column(0, "block", pa.array([block.column("block")[0].as_py()] * len(asked), pa.int64()))

    return run


def _answered(asked: pa.Table, segment: pa.Table) -> pa.Table:
    """The levels of what all blocks ask one shard."""
    bits = {0: np.frombuffer(b.as_buffer(), np.uint8) for b in segment.column("bits")}
    part = LogFrequencyFilter(1, bits)
    levels = [part.levels(np.frombuffer(h.as_buffer(), "<u8")).astype(np.uint8).tobytes() for h in asked.column("hashes")]
    return pa.table({"block": asked.column("block"), "shard": asked.column("shard"), "levels": pa.array(levels, pa.binary())})


def _scored_block(shared: Shared):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        hashes = _different(block)
        found = np.zeros(len(hashes), np.uint8)
        in_order = b"".join(answers.sort_by("shard").column("levels").to_pylist())
        found[np.argsort(hashes % np.uint64(shared.value.shards), kind="stable")] = np.frombuffer(in_order, np.uint8)
        levels = FoundLevels(hashes, found)
        return pa.Table.from_batches(
            _scored_batch(batch.column("doc_id").slice(first, len(texts)), shared.value.score(texts, levels))
            for batch in block.to_batches()
            for first, texts in text_slices(batch)
        )

    return run


def _scored_by_blocks(keyed: DataFrame, shared: Shared, shards: int, segments: DataFrame) -> DataFrame:
    """What ``_scored`` gives, with a filter that stays in its shards.  The blocks are stored: a text must never change its block."""
    path = shared_path(keyed.sparkSession, "text-blocks")
    keyed.mapInArrow(_blocked, "block long, doc_id long, text string").write.parquet(path)
    blocks = keyed.sparkSession.read.parquet(path)
    asked = blocks.groupBy("block").applyInArrow(_asked(shards), "block long, shard long, hashes binary")
    answers = asked.groupBy("shard").cogroup(segments.groupBy("shard")).applyInArrow(_answered, "block long, shard long, levels binary")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scored_block(shared), _SCORED)


def score_texts(docs: DataFrame, model: Fitted, rest: DataFrame, segments: DataFrame | None = None) -> DataFrame:
    """Scores of ``doc_id``, ``text`` by a fitted model; ``rest`` and ``segments`` are what ``fit`` returned with it."""
    shared = model.shared
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = keyed.mapInArrow(_scored(shared), _SCORED) if segments is None else _scored_by_blocks(keyed, shared, model.shards, segments)
    scored = settle(found.withColumn("row", F.monotonically_increasing_id()))
    rare = scored.select("row", F.explode("rest").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    counted = join_per_key(rare, rest, ["word"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    per_row = counted.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rest_known"),
        F.sum(F.col("times") * F.log10((F.col("n") + 0.5) / F.lit(model.room))).alias("rest_score"),
    )
    held_out = F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return scored.join(per_row, "row", "left").select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        (F.col("top_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("top_score") + F.coalesce("rest_score", F.lit(0.0))).alias("base_score"),
        "score",
    )


def learnable(docs: DataFrame) -> DataFrame:
    """Documents outside the held-out fold."""
    return docs.filter(fold_of("doc_id", FOLDS) != HELD_OUT)


def score_corpus(docs: DataFrame) -> DataFrame:
    """Scores of all documents by a model of those outside the held-out fold."""
    model, rest, segments = fit(learnable(docs))
    scored = score_texts(docs, model, rest, segments)
    model.shared.drop()  # the scores are stored
    return scored
