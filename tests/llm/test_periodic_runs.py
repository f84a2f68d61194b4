"""Runs of words against a literal search for every period."""

import hashlib
import random
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyroom.llm import queries
from tallyroom.llm.periodic_runs import SuffixRanks, WaveletTree, _of_texts, periodic_runs

from .builders import awkward, clashing, empty

SF_DIR = Path("/root/testdata/sf0.001")


def literal_runs(words, least=12):
    """(start, length, period): for each period the longest stretches that keep it, least period of a stretch only."""
    found = {}
    for period in range(1, len(words) // 2 + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end + period - at >= max(least, 2 * period):
                found.setdefault((at, end + period), period)
            at = max(end, at + 1)
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def literal_collapse(words, runs):
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def fibonacci(n):
    a, b = ["a"], ["a", "b"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def random_text(rnd):
    letters = "abcdefghijklmnopqrstuvwxyz"[: rnd.choice([1, 2, 2, 3, 5, 26])]
    words = [rnd.choice(letters) for _ in range(rnd.randint(0, rnd.choice([15, 60, 180])))]
    for _ in range(rnd.randint(0, 3)):
        if len(words) > 6:
            start = rnd.randrange(len(words) - 3)
            period = rnd.randint(1, max(1, (len(words) - start) // 2))
            for i in range(start, start + rnd.randint(1, len(words) - start)):
                words[i] = words[start + (i - start) % period]
    return " ".join(fibonacci(len(words)) if rnd.random() < 0.15 else words)


@pytest.mark.parametrize("least", [12, 2, 5])
def test_runs_equal_a_literal_search(least):
    rnd = random.Random(least)
    for _ in range(150):
        texts = [random_text(rnd) for _ in range(rnd.randint(1, 5))]
        runs, collapsed = _of_texts(texts, least)
        for text, found, short in zip(texts, runs.to_pylist(), collapsed, strict=True):
            want = literal_runs(text.split(), least)
            assert [(r["start"], r["length"], r["period"]) for r in found] == want, text
            assert short == literal_collapse(text.split(), want)


def test_range_successor_and_extensions():
    import numpy as np

    rnd = np.random.default_rng(4)
    values = rnd.permutation(200)
    tree = WaveletTree(values, 8)
    low = rnd.integers(0, 150, 60)
    high, bound = low + rnd.integers(1, 50, 60), rnd.integers(0, 260, 60)
    want = [min([v for v in values[a:b] if v >= x], default=200) for a, b, x in zip(low, high, bound, strict=True)]
    assert tree.successor(low, high, bound, 200).tolist() == want
    words = np.array([0, 1, 0, 1, 0, 2])  # the last is the mark
    ranks = SuffixRanks(words)
    assert ranks.forward(np.array([0, 1]), np.array([2, 3])).tolist() == [3, 2]
    assert ranks.backward(np.array([1, 2]), np.array([3, 4])).tolist() == [1, 2]


@pytest.mark.skipif(not SF_DIR.exists(), reason="test data is not installed")
def test_query_equals_a_literal_search(spark):
    found = {r["doc_id"]: tuple(r) for r in queries.QUERIES["op12_periodic_runs"](spark, str(SF_DIR)).collect()}
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(documents)
    planted = 0
    for doc_id, text in documents:
        words = (text or "").encode().split()
        if len(words) > 1200:
            continue
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        words = [w.decode() for w in words]
        runs = literal_runs(words)
        start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        listed = "".join(f"{s},{k},{p}\n" for s, k, p in runs)
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (listed, literal_collapse(words, runs))]
        exponent = None if not runs else 1000 * length // period
        assert found[doc_id] == (doc_id, len(runs), start, length, period, exponent, *digests)
    assert planted > 5


def test_awkward_tables(spark):
    table = clashing(awkward(spark))
    found = periodic_runs(table)
    assert found.columns == [*(c for c in table.columns if c != "text"), "runs", "collapsed"]
    rows = found.collect()
    assert len(rows) == table.count() and {r["doc"] for r in rows} == {"clash"}
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["runs"] == [] and by_id[1]["collapsed"] is None
    assert (by_id[2]["collapsed"], by_id[3]["collapsed"]) == ("", "")
    assert [tuple(r) for r in by_id[6]["runs"]] == [(0, 60_000, 1)] and by_id[6]["collapsed"] == "word"
    assert [r["collapsed"] for r in rows if r["doc_id"] == 5].count(by_id[5]["collapsed"]) == 2
    assert periodic_runs(empty(spark)).count() == 0
    assert periodic_runs(table.select("text")).columns == ["runs", "collapsed"]


def test_a_very_long_text(spark):
    """300,000 words with one long period, and a deep nest of runs."""
    text = " ".join(f"w{i % 70_000}" for i in range(300_000)) + " end " + " ".join(fibonacci(20_000))
    table = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = periodic_runs(table).select(F.size("runs").alias("n"), F.col("runs")[0].alias("first"), F.length("collapsed").alias("left")).first()
    assert tuple(row["first"]) == (0, 300_000, 70_000) and row["n"] > 1000 and row["left"] < len(text) / 3
