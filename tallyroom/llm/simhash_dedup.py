"""SimHash near duplicates by deletion-variant signatures.

Two 64-bit fingerprints that differ in three bits or fewer agree, but for at
most one bit, in one of their two halves.  Each distinct fingerprint is indexed
under every half with one of its 32 bits left out; fingerprints that meet under
a key are compared in full.  Keys that gather more than ``BUCKET`` fingerprints
are cut again by the same rule in the bits that the key leaves open: 32, then
16.  A key of the third level leaves 11 bits open, so it can't hold more than
2,048 fingerprints; nothing is dropped at any level.

Defined results: a null, empty or blank text has fingerprint zero and is linked
like any other.  Equal texts have equal fingerprints and are one class.  A null
``doc_id`` never is a component's smallest id unless all its ids are null.
Texts are read whole, however long.  Repeated rows each get a row.  Extra columns are ignored, whatever their names;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.operators.hot_keys import join_per_key

from .common import null_safe, settle, text_slices
from .components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
#: A bucket up to this size is compared directly; a key of the third level can't exceed it.
BUCKET = 2048
SEED = 42

_ROWS_AT_ONCE = 1 << 17
#: Rows of a bucket that are compared with all of it at a time.
_NEAR_ROWS = 256


def shingle_hashes(text: str, size: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 of each run of ``size`` words (fewer words: of all), repeats included."""
    words = text.encode().lower().split()
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    whole, starts = b" ".join(words), [0, *ends]
    return [xxhash.xxh64_intdigest(whole[a : b - 1], SEED) for a, b in zip(starts, ends[size - 1 :], strict=False)]


def _bit_counts(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each run of hashes, how many have each of the 64 bits.

    Bytes are added eight at a time, in runs of at most 255 that can't overflow.
    """
    ends = np.cumsum(lengths)
    starts = ends - lengths
    cuts = np.unique(np.concatenate([starts[lengths > 0], np.arange(0, len(hashes), 255)]))
    sums = []
    for at in range(0, len(cuts), _ROWS_AT_ONCE // 255):
        some = cuts[at : at + _ROWS_AT_ONCE // 255]
        stop = cuts[at + len(some)] if at + len(some) < len(cuts) else len(hashes)
        bits = np.unpackbits(hashes[some[0] : stop].view(np.uint8), bitorder="little").view(np.uint64).reshape(-1, 8)
        sums.append(np.add.reduceat(bits, some - some[0], axis=0).view(np.uint8).reshape(-1, 64))
    counts = np.zeros((len(lengths), 64), np.int64)
    if sums:
        of = np.searchsorted(starts[lengths > 0], cuts, side="right") - 1
        whole = np.flatnonzero(np.diff(of, prepend=-1))
        counts[lengths > 0] = np.add.reduceat(np.concatenate(sums), whole, axis=0, dtype=np.int64)
    return counts


def simhashes(texts: list[str], size: int = SHINGLE_WORDS) -> np.ndarray:
    hashes = [shingle_hashes(text, size) for text in texts]
    lengths = np.array([len(h) for h in hashes], np.int64)
    flat = np.fromiter((h for each in hashes for h in each), np.uint64, int(lengths.sum()))
    bits = 2 * _bit_counts(flat, lengths) > lengths[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_slices(batch):
                keys = [batch.column(k).slice(start, len(texts)) for k in ("doc_id", "text_hash")]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(simhashes(texts, size).view(np.int64))], ["doc_id", "text_hash", "fp"])

    return run


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``text_hash`` and the fingerprint ``fp`` (as a signed long) of every row."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return keyed.mapInArrow(_fingerprints(size), "doc_id long, text_hash long, fp long")


def _signature(segment: Column, bit: Column, width: int) -> Column:
    """A segment's bits without the bit left out, marked with that bit's place."""
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit % width)
    return F.call_function("shiftleft", bit.cast("long"), F.lit(width)).bitwiseOR(segment.bitwiseAND(F.bitwise_not(one)))


def _part(fp: Column, start: Column, width: int) -> Column:
    return F.call_function("shiftrightunsigned", fp, start.cast("int")).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _variants(members: DataFrame, level: int) -> DataFrame:
    """Members under each key of a level: ``k1`` for halves, ``k2`` for quarters of the other half, ``k3`` for eighths."""
    width = {1: 32, 2: 16, 3: 8}[level]
    out = members.select("*", F.explode(F.sequence(F.lit(0), F.lit(2 * width - 1))).alias("bit"))
    segment = F.floor(F.col("bit") / width).cast("int")
    if level == 1:
        start = segment * 32
    else:  # the open half is the one that k1 doesn't hold; the open quarter is the one of it that k2 doesn't hold
        half = F.when(_part(F.col("k1"), F.lit(32), 6) < 32, 32).otherwise(0)
        start = half + segment * 16
        if level == 3:
            quarter = F.when(_part(F.col("k2"), F.lit(16), 5) < 16, 16).otherwise(0)
            start = half + quarter + segment * 8
    return out.withColumn(f"k{level}", _signature(_part(F.col("fp"), start, width), F.col("bit"), width)).drop("bit")


def _near(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Which fingerprints are within ``max_bits``, some rows at a time."""
    near = np.empty((len(fps), len(fps)), bool)
    for first in range(0, len(fps), _NEAR_ROWS):
        some = fps[first : first + _NEAR_ROWS, None] ^ fps[None, :]
        near[first : first + _NEAR_ROWS] = np.bitwise_count(some.view(np.uint64)) <= max_bits
    return near


def _least_near(near: np.ndarray) -> np.ndarray:
    """For each row of a matrix of links the smallest row that it is connected with."""
    label, none = np.arange(len(near), dtype=np.int32), np.int32(len(near))
    while True:
        least = np.concatenate([np.where(part, label[None, :], none).min(axis=1) for part in np.array_split(near, -(-len(near) // _NEAR_ROWS))])
        if (least == label).all():
            return label
        label = least


def _linked(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros((0, 2), np.int64)]
            for members in batch.column("members"):
                fps = np.unique(members.values.to_numpy())
                label = _least_near(_near(fps, max_bits))
                found.append(np.stack([fps, fps[label]], axis=1)[label != np.arange(len(fps))])
            a, b = np.concatenate(found).T
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def links(distinct: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Links ``a``, ``b`` that connect all distinct fingerprints ``fp`` within ``max_bits`` (up to 3) bits, and no others."""
    members, keys, found = distinct.select("fp"), [], []
    for level in (1, 2, 3):
        keyed, keys = _variants(members, level), [*keys, f"k{level}"]
        sizes = settle(keyed.groupBy(*keys).agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1"))
        found.append(sizes.filter((F.col("n") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select("a", "b"))
        direct = F.col("n").between(3, bucket) if level < 3 else F.col("n") > 2
        gathered = keyed.join(sizes.filter(direct).select(*keys), keys).groupBy(*keys).agg(F.collect_list("fp").alias("members"))
        found.append(gathered.select("members").mapInArrow(_linked(max_bits), "a long, b long"))
        if level < 3:
            large = sizes.filter(F.col("n") > bucket).select(*keys)
            members = settle(keyed.join(large, keys))
    both = found[0]
    for more in found[1:]:
        both = both.union(more)
    return both


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash``, ``fp``, ``component`` (its smallest fp) and ``component_id``."""
    rows = settle(fingerprints(docs, size))
    classes = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    roots = connected_components(links(classes, max_bits)).withColumnRenamed("node", "fp")
    placed = classes.join(roots, "fp", "left").withColumn("component", F.coalesce("root", "fp")).drop("root")
    placed = settle(placed)
    ids = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    located = join_per_key(placed.drop("least_id"), ids, ["component"])
    return join_per_key(rows, located, ["fp"])


def keep_one_of_each(docs: DataFrame, size: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component: the one with the smallest id, and of those the smallest text hash."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash"))
    chosen = near_duplicates(docs, size, max_bits).groupBy("component").agg(first.alias("first"))
    chosen = chosen.select(null_safe("first.doc_id").alias("doc_key"), F.col("first.text_hash").alias("text_hash"))
    packed = docs.select(
        F.struct("*").alias("doc"), null_safe(F.col("doc_id").cast("long")).alias("doc_key"), F.xxhash64("text").alias("text_hash")
    )
    kept = packed.join(chosen, ["doc_key", "text_hash"], "left_semi").dropDuplicates(["doc_key", "text_hash"])
    return kept.select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))
