"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import pytest

from tallyroom.llm import lexical_search
from tallyroom.llm.common import Shared
from tallyroom.llm.lexical_search import Block, Items, Weights, postings, search, terms_of

from .builders import awkward, clashing, empty

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def literal_terms(text):
    return _TERM.findall((text or "").translate(_LOWER))


def literal_search(docs, items, top=10):
    """Rows (item_id, rank, doc_id, score) by scoring every document for every item."""
    counts = [(i, Counter(literal_terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, length = len(counts), sum(c.total() for _, c in counts)
    frequency = Counter(term for _, c in counts for term in c)
    found = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counts:
            m = 100 - 75 + (75 * c.total() * n) // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * frequency[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in literal_terms(text)
                if c[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        found += [(item_id, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:top], 1)]
    return sorted(found, key=str)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", 7)
    monkeypatch.setattr(lexical_search, "MASK_WORDS", 5)


def corpus(rnd, docs, words):
    vocabulary = [f"w{k}" for k in range(words)] + ["É1", "日本", "ß"]
    weights = [1 / (1 + k) for k in range(len(vocabulary))]
    return [(i, " ".join(rnd.choices(vocabulary, weights, k=rnd.randint(0, 40)))) for i in range(docs)], vocabulary


@pytest.mark.parametrize("lot_chars", [4_000_000, 60])
def test_search_equals_scoring_everything(spark, small_blocks, lot_chars):
    rnd = random.Random(8)
    docs, vocabulary = corpus(rnd, 120, 60)
    docs += [(i + 1000, t) for i, t in docs[:30]]  # copies tie
    items = [(k, " ".join(rnd.choices(vocabulary, k=rnd.randint(1, 12)))) for k in range(12)]
    found = search(*frames(spark, docs, items), lot_chars=lot_chars)
    assert sorted((tuple(r) for r in found.collect()), key=str) == literal_search(docs, items)


def test_more_terms_than_a_mask_word_has_bits(spark, small_blocks):
    rnd = random.Random(2)
    docs, vocabulary = corpus(rnd, 60, 200)
    items = [(1, " ".join(vocabulary)), (2, " ".join(vocabulary[::-1] * 2))]
    assert sorted((tuple(r) for r in search(*frames(spark, docs, items)).collect()), key=str) == literal_search(docs, items)


def test_evaluation_stops_early(spark):
    """Masks that can't reach the tenth score aren't evaluated."""
    rnd = random.Random(5)
    docs, _ = corpus(rnd, 400, 30)
    docs = [(i, t + (" rare" if i < 15 else "")) for i, t in docs]
    items = Items(["rare w1"])
    held = postings(spark.createDataFrame(docs, "doc_id long, text string"), Shared(spark, items)).toArrow().combine_chunks().to_batches()
    frequency = Counter(t for b in held for t in b.column("terms").flatten().to_pylist())
    rows = sum(b.num_rows for b in held)
    block = Block(held, Weights(items, rows, sum(sum(b.column("n").to_pylist()) for b in held), frequency))
    asked = []
    score = block.score
    block.score = lambda docs, *a: asked.append(len(docs)) or score(docs, *a)
    found, _ = block.best(items.terms[0], items.repeats[0], 10)
    assert len(found) == 10 and sum(asked) < rows / 4


def test_terms():
    for text in ("", None, "A-b_c D1 É x\x00y ﬁ İ", "naïve ΑΣ 1,000.5"):
        assert [t.decode() for t in terms_of(text)] == literal_terms(text)


def test_awkward_tables(spark):
    docs = clashing(awkward(spark))
    items = [(1, None), (2, ""), (3, "?!"), (4, "the lazy DOG"), (4, "the lazy DOG"), (None, "word"), (5, "nowhere"), (6, "x" * 20_000), (7, "a " * 50_000)]
    table = clashing(spark.createDataFrame(items, "item_id long, text string"))
    found = sorted((tuple(r) for r in search(docs, table).collect()), key=str)
    assert found == literal_search([(r["doc_id"], r["text"]) for r in docs.collect()], items)
    assert search(docs, table.limit(0)).count() == 0
    assert search(empty(spark), table).count() == 0
