"""The pipeline, each stage against plain Python on that stage's own input."""

from collections import Counter, defaultdict
from pathlib import Path

import public_tokenizers
import pytest

import corpus_pipeline
from tallyroom.llm.line_quality import normal_line, repeat_words
from tallyroom.llm.piece_codec import Pieces

from .test_oracles import fingerprint, grouped

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test data is not installed")


def quality(rows):
    carriers, first = defaultdict(set), {}
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            if key := normal_line(line):
                carriers[r["source"], key].add((r["doc_id"], r["text"]))
                first[r["source"], key] = min(first.get((r["source"], key), r["doc_id"]), r["doc_id"])
    kept = []
    for r in rows:
        words = (r["text"] or "").encode().split()
        stays = lambda line: not (
            (k := (r["source"], normal_line(line)))[1] and len(carriers[k]) > 20 and first[k] != r["doc_id"]  # noqa: B023
        )
        text = "\n".join(line for line in (r["text"] or "").split("\n") if stays(line))
        left = len(text.encode().split())
        if len(words) >= 50 and 100 * repeat_words(words) <= 50 * len(words) and 100 * left >= 30 * len(words):
            kept.append((r["doc_id"], text))
    return sorted(kept)


def test_stages(spark):
    docs, results = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        rows = [r.asDict() for r in docs.collect()]
        docs = spark.createDataFrame((found := stage(spark, docs, str(SF_DIR))).collect(), found.schema)
        results[name] = (rows, [r.asDict() for r in docs.collect()])
    before, after = results["quality rules"]
    assert sorted((r["doc_id"], r["text"]) for r in after) == quality(before)
    before, after = results["language ID"]
    assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before} and len(after) >= 0.98 * len(before)
    before, after = results["SimHash near-dedup"]
    assert {r["doc_id"] for r in after} == set(grouped([(r["doc_id"], fingerprint(r["text"])) for r in before]).values())
    assert len(after) == len({r["doc_id"] for r in after}) < len(before)
    before, after = results["mixing sources to target weights"]
    texts = {r["doc_id"]: r["text"] for r in before}
    copies = Counter(r["doc_id"] for r in after)
    assert max(copies.values()) <= 2 and all(r["text"] == texts[r["doc_id"]] for r in after)
    size = lambda rows: sum(len(r["text"].split()) for r in rows)
    assert size(after) == pytest.approx(1.5 * size(before), rel=0.05)
    before, after = results["SentencePiece encoding and decoding"]
    pieces = Pieces(public_tokenizers.path(corpus_pipeline.PIECE_MODEL))
    want = sorted((r["doc_id"], pieces.encode([r["text"]])[0].tolist()) for r in before)
    assert sorted((r["doc_id"], r["ids"]) for r in after) == want and all(r["round_trip"] for r in after)


def test_run(spark):
    rows = corpus_pipeline.run(spark, str(SF_DIR))
    assert rows.columns == ["doc_id", "n_ids", "ids_crc32", "round_trip", "ids"] and rows.count() > 0
