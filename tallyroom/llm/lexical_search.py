"""Ranked lexical search by presence masks.

The items' terms are looked for in every document once; what is kept of a
document is its number of terms and the items' terms in it, with their counts.
Documents are then handled in blocks of bounded size.  In a block each item ors
its terms' postings into presence masks and groups the documents by mask.  A
mask's highest possible score is known from its terms' weights and the largest
count part of each term in the block, so masks are evaluated from the highest
down, until an item's tenth score can't be reached or tied by any mask left.
The blocks' best documents are ranked together at the end.  All arithmetic on
scores is in 64-bit integers.

Items are taken in lots whose terms are of bounded size; a lot's terms are all
that is broadcast.

Defined results: an item with a null or empty text, or whose terms are in no
document, has no rows; so has any item if there is no document with a term.
Equal scores are ranked by ``doc_id``, a null id last and repeated ids in any
order.  Repeated items are ranked each on their own, under their id.  Repeated
documents are documents each.  Very long texts are read whole.  Extra columns
are ignored, whatever their names; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Shared, ragged, settle, take_runs, text_slices

TOP = 10
#: Items are taken in lots of about this many characters.
LOT_CHARS = 4_000_000
#: A block ends with the batch that brings it to so many documents or so many postings.
BLOCK_DOCS, BLOCK_POSTINGS = 32_768, 2_000_000
#: An item's masks are made for so many documents at a time that they have at most this many 64-bit words.
MASK_WORDS = 2_000_000

_LETTERS = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B))
_TABLE = bytes((c + 32 if 0x41 <= c <= 0x5A else c) if c >= 0x80 or c in _LETTERS else 0x20 for c in range(256))

_POSTINGS = "doc_id long, n long, terms array<int>, counts array<long>"
_FOUND = "item int, doc_id long, score long"


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all characters beyond ASCII, with A-Z lowered."""
    return (text or "").encode().translate(_TABLE).split()


class Items:
    """The items of a lot: their terms by number, and each item's terms with repeats."""

    def __init__(self, texts: list[str | None]):
        self.number: dict[bytes, int] = {}
        self.terms, self.repeats = [], []
        for text in texts:
            counts = Counter(terms_of(text))
            self.terms.append(np.array([self.number.setdefault(t, len(self.number)) for t in counts], np.int64))
            self.repeats.append(np.array(list(counts.values()), np.int64))


class Weights:
    """What scores need of the whole corpus: the documents with a term, all their terms, and each term's weight."""

    def __init__(self, items: Items, documents: int, all_terms: int, frequency: dict[int, int]):
        self.items, self.documents, self.all_terms = items, documents, all_terms
        self.weight = np.array(
            [math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency.get(k, 0) + 1))) for k in range(len(items.number))], np.int64
        )

    def count_part(self, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        m = 25 + (75 * lengths * self.documents) // max(1, self.all_terms)
        return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


def _postings(shared: Shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.number
        for batch in batches:
            for start, texts in text_slices(batch):
                sizes, found = [], []
                for text in texts:
                    terms = terms_of(text)
                    sizes.append(len(terms))
                    counts = Counter(map(number.get, terms))
                    counts.pop(None, None)
                    found.append(counts)
                lengths = np.array([len(f) for f in found], np.int64)
                flat = [np.fromiter((x for f in found for x in part(f)), kind, int(lengths.sum())) for part, kind in ((dict.keys, np.int32), (dict.values, np.int64))]
                columns = [batch.column("doc_id").slice(start, len(texts)), pa.array(sizes, pa.int64()), *(ragged(f, lengths) for f in flat)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])

    return run


def postings(docs: DataFrame, items: Shared) -> DataFrame:
    """``doc_id``, its number of terms ``n``, and the items' ``terms`` in it with their ``counts``; documents without a term are left out."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return keyed.mapInArrow(_postings(items), _POSTINGS).filter("n > 0")


class Block:
    """The postings of a block of documents, by term."""

    def __init__(self, batches: list[pa.RecordBatch], weights: Weights):
        column = lambda name: pa.concat_arrays([b.column(name) for b in batches])
        lists = column("terms")
        lengths = np.diff(lists.offsets.to_numpy())
        of = np.repeat(np.arange(len(lengths)), lengths)
        terms = lists.flatten().to_numpy()
        order = np.argsort(terms, kind="stable")
        self.documents = len(lengths)
        self.ids = column("doc_id")
        # A null id sorts last.
        self.id_order = np.where(self.ids.is_null().to_numpy(False), np.iinfo(np.int64).max, self.ids.fill_null(0).to_numpy())
        self.term, self.doc = terms[order], of[order]
        parts = weights.count_part(column("counts").flatten().to_numpy(), column("n").to_numpy()[of])
        self.part = parts[order]
        self.starts = np.searchsorted(self.term, np.arange(len(weights.weight) + 1))
        self.most = np.zeros(len(weights.weight), np.int64)
        np.maximum.at(self.most, self.term, self.part)
        self.weights = weights

    def masks(self, terms: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """For the documents from ``low`` to ``high`` with any of the terms: their numbers, and which terms each has as 64-bit words."""
        masks = np.zeros((high - low, -(-len(terms) // 64)), np.uint64)
        for bit, term in enumerate(terms):
            holders = self.doc[self.starts[term] : self.starts[term + 1]]
            holders = holders[slice(*np.searchsorted(holders, (low, high)))]
            masks[holders - low, bit // 64] |= np.uint64(1 << bit % 64)
        docs = np.flatnonzero(masks.any(axis=1))
        return docs + low, masks[docs]

    def groups(self, terms: np.ndarray, weight: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Documents ordered by mask, with the start, the size and the highest possible score of each mask."""
        docs, masks = self.masks(terms, low, high)
        order = np.lexsort(masks.T)
        docs, masks = docs[order], masks[order]
        first = np.flatnonzero(np.concatenate([[True], (masks[1:] != masks[:-1]).any(axis=1)])) if len(docs) else np.zeros(0, np.int64)
        highest, reachable = np.zeros(len(first), np.int64), weight * self.most[terms]
        for word in range(masks.shape[1]):
            bits = np.unpackbits(masks[first, word].view(np.uint8), bitorder="little").reshape(-1, 64).astype(np.int64)
            some = reachable[64 * word : 64 * word + 64]
            highest += bits[:, : len(some)] @ some
        return docs, first, np.diff(np.append(first, len(docs))), highest

    def best(self, terms: np.ndarray, repeats: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        """The numbers and scores of the ``top`` documents for an item's terms."""
        weight = self.weights.weight[terms] * repeats
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        step = max(1, MASK_WORDS // max(1, -(-len(terms) // 64))) if len(terms) else self.documents
        for low in range(0, self.documents if len(terms) else 0, step):
            docs, first, sizes, highest = self.groups(terms, weight, low, min(low + step, self.documents))
            descending, at, lot = np.argsort(-highest, kind="stable"), 0, 4 * top
            while at < len(descending):
                # A mask that can tie with the last one found may hold a smaller id.
                if len(found) == top and highest[descending[at]] < scores[-1]:
                    break
                # Whole masks, at least one, with twice as many documents each time.
                some = descending[at : at + max(1, int(np.searchsorted(np.cumsum(sizes[descending[at:]]), lot, side="right")))]
                at, lot = at + len(some), 2 * lot
                new = np.sort(take_runs(docs, first[some], sizes[some]))
                found, scores = np.concatenate([found, new]), np.concatenate([scores, self.score(new, terms, weight)])
                keep = np.lexsort((self.id_order[found], -scores))[:top]
                keep = keep[scores[keep] > 0]
                found, scores = found[keep], scores[keep]
        return found, scores

    def score(self, docs: np.ndarray, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The scores of documents, given in ascending order."""
        total = np.zeros(len(docs), np.int64)
        for term, w in zip(terms, weight, strict=True):
            run = slice(self.starts[term], self.starts[term + 1])
            holders = self.doc[run]
            if len(holders):
                place = np.minimum(np.searchsorted(holders, docs), len(holders) - 1)
                total += np.where(holders[place] == docs, w * self.part[run][place], 0)
        return total


def _ranked(shared: Shared, top: int):
    def best(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        block, items = Block(batches, shared.value), shared.value.items
        numbers, ids, scores = [np.zeros(0, np.int32)], [block.ids.slice(0, 0)], [np.zeros(0, np.int64)]
        for item, (terms, repeats) in enumerate(zip(items.terms, items.repeats, strict=True)):
            found, score = block.best(terms, repeats, top)
            numbers.append(np.full(len(found), item, np.int32))
            ids.append(block.ids.take(pa.array(found)))
            scores.append(score)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(numbers)), pa.concat_arrays(ids), pa.array(np.concatenate(scores))], ["item", "doc_id", "score"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, size = [], 0, 0
        for batch in batches:
            held.append(batch)
            docs, size = docs + batch.num_rows, size + len(batch.column("terms").flatten())
            if docs >= BLOCK_DOCS or size >= BLOCK_POSTINGS:
                yield best(held)
                held, docs, size = [], 0, 0
        if held:
            yield best(held)

    return run


def _search_lot(docs: DataFrame, lot: list, top: int) -> DataFrame:
    spark = docs.sparkSession
    items = Items([r["text"] for r in lot])
    held = settle(postings(docs, Shared(spark, items)))
    totals = held.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    frequency = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("documents"))
    weights = Weights(items, totals["documents"], totals["terms"], {r["term"]: r["documents"] for r in frequency.collect()})
    found = held.mapInArrow(_ranked(Shared(spark, weights), top), _FOUND)
    # The best of every block meet here, item by item; Spark keeps the top rows of each map task only.
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    names = spark.createDataFrame([(k, r["item_id"]) for k, r in enumerate(lot)], "item int, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, lot_chars: int = LOT_CHARS) -> DataFrame:
    """The ``top`` documents (``doc_id``, ``text``) for each item (``item_id``, ``text``): ``item_id``, ``rank``, ``doc_id``, ``score``."""
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    chars = asked.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    lots, found = max(1, -(-chars // lot_chars)), None
    for number in range(lots):
        lot = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(lots)) == number).collect()
        part = _search_lot(docs, lot, top)
        found = part if found is None else found.union(part)
    return found
