"""Every operator on awkward, clashing and empty tables: one row per row, and defined results."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyroom.llm import queries
from tallyroom.llm.bloom_lm import score_corpus
from tallyroom.llm.common import Shared, shared_path
from tallyroom.llm.edit_counts import ByteTokenizer, apply_edits, count_trees
from tallyroom.llm.embedding_dedup import near_duplicate_vectors
from tallyroom.llm.language_id import fit, identify, learnable
from tallyroom.llm.line_quality import line_verdicts
from tallyroom.llm.mixing import mix_sizes
from tallyroom.llm.piece_codec import Pieces, round_trip
from tallyroom.llm.simhash_dedup import near_duplicates
from tallyroom.llm.token_orc import TextTokenizer, read_token_ids, token_digest, write_token_ids
from tallyroom.llm.url_templates import page_labels, url_verdicts

from .builders import awkward, clashing, empty


def tokens(docs):
    spark = docs.sparkSession
    path = shared_path(spark, "test-tokens")
    write_token_ids(docs, Shared(spark, TextTokenizer(public_tokenizers.path(queries.WORDS))), path, 2)
    return token_digest(read_token_ids(spark, path))


def edits(docs):
    tokenizer = Shared(docs.sparkSession, ByteTokenizer(public_tokenizers.path(queries.BYTES), public_tokenizers.PATTERN))
    return apply_edits(
        count_trees(docs, tokenizer).withColumn("edits", queries.sample_edits(F.col("doc_id"), F.col("text"))), tokenizer
    ).select("doc_id", "n_tokens_before", "done.n_tokens")


OPERATORS = {
    "tokens": tokens,
    "mix_sizes": mix_sizes,
    "edits": edits,
    "identify": lambda d: identify(d, fit(learnable(d))),
    "pieces": lambda d: round_trip(d, Shared(d.sparkSession, Pieces(public_tokenizers.path(queries.PIECES)))),
    "near_duplicates": near_duplicates,
    "score_corpus": score_corpus,
    "line_verdicts": line_verdicts,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_every_row(spark, name):
    table = awkward(spark)
    found = OPERATORS[name](clashing(table))
    ids = lambda df: sorted((r[0] is None, r[0] or 0) for r in df.select("doc_id").collect())
    assert ids(found) == ids(table)
    assert OPERATORS[name](clashing(empty(spark))).count() == 0


def one(df, doc_id):
    return [r for r in df.collect() if r["doc_id"] == doc_id][0]


def test_defined_results(spark):
    table = awkward(spark)
    ids = tokens(table)
    assert [one(ids, i)["n_tokens"] for i in (1, 2, 3, 7)][:3] == [1, 1, 1]
    languages = OPERATORS["identify"](table)
    assert [tuple(one(languages, i))[2:] for i in (1, 2, 3, 9)] == [("und", 0.0)] * 4
    assert one(languages, 4)["lang_pred"] in ("en", "ja", "xx")
    pieces = OPERATORS["pieces"](table)
    assert all(r["round_trip"] for r in pieces.collect())
    assert one(pieces, 1)["ids"] is None and one(pieces, 2)["ids"] == []
    quality = line_verdicts(table)
    assert (one(quality, 1)["n_words"], one(quality, 1)["base_failed"], one(quality, 1)["kept"]) == (0, True, False)
    assert one(quality, 6)["n_repeat_words"] == 60_000
    groups = near_duplicates(table)
    assert {one(groups, i)["fp"] for i in (1, 2, 3)} == {0}
    assert [one(groups, i)["component_id"] for i in (1, 2, 3, 4, 5)] == [1, 1, 1, 4, 4]
    scores = score_corpus(table)
    assert (one(scores, 1)["n_tokens"], one(scores, 6)["n_tokens"]) == (1, 60_001)


def test_all_ids_null(spark):
    table = awkward(spark).withColumn("doc_id", F.lit(None).cast("long"))
    assert [r["component_id"] for r in near_duplicates(table).collect()] == [None] * table.count()
    for name in ("identify", "score_corpus", "tokens", "mix_sizes"):
        assert OPERATORS[name](table).count() == table.count()


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_keep_the_columns(spark, stage):
    table = clashing(awkward(spark))
    kept = stage[1](spark, table, "")
    assert kept.columns == table.columns
    assert {r["doc"] for r in kept.select("doc").collect()} <= {"clash"}
    nothing = stage[1](spark, clashing(empty(spark)), "")
    assert nothing.columns == table.columns and nothing.count() == 0


def test_one_of_each_group_stays(spark):
    kept = corpus_pipeline.near_duplicates(spark, awkward(spark), "")
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda i: (i is None, i))
    assert ids == [-11, 1, 4, 6, 7, 8, 8, 9, 10]


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    unit = [1.0, 0.0, 0.0]
    rows = [
        (1, unit), (2, [2.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [nan, 1.0, 0.0]),
        (7, [inf, 1.0, 0.0]), (8, [None, 1.0, 0.0]), (None, unit), (9, [1.0, 0.0]), (10, [1e-300, 0.0, 0.0]), (11, [0.0, -0.0, 1.0]),
        (12, [1e300, 1e290, 0.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cls", F.lit("clash")).withColumn("vec", F.lit(1))
    found = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_duplicate_vectors(table).collect()), key=str)
    linked = {1: 5, 2: 5, 10: 5, 12: 5, None: 5}
    want = [(i, linked.get(i, 0), 1 if i in linked else i, i == 1 or i not in linked) for i, _ in rows]
    assert found == sorted(want, key=str)
    nothing = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_duplicate_vectors(nothing).count() == 0


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "http://COM", "https://a.com/x/1", "http://example.com/en/2?q#f", "http://WWW.example.com/en/3",
        "http://b.example.com/en/3", "ftp://net/es/x", "http://dotnet/es/x", "http://x.net/fr/", "http://x.net/en/#://y/", "://h/" + "s/" * 500,
    ]
    pages = clashing(spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(0, None), (None, None)], "page_id long, url string"))
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    found = url_verdicts(page_labels(pages, labels)).collect()
    got = {r["page_id"]: tuple(r)[1:5] for r in found}
    assert len(found) == len(urls) + 2
    assert [got[i] for i in (0, 2, 3)] == [("", "", None, "allow")] * 3
    assert got[4] == ("com", "", None, "allow")
    assert got[5][2:] == ("com/", "allow") and got[6] == ("example.com", "/en/2", "example.com/en/", "block")
    assert got[7] == ("www.example.com", "/en/3", "www.example.com/en/", "allow") and got[8][2:] == ("example.com/en/", "block")
    assert [got[i][2:] for i in (9, 10, 11, 12)] == [("net/es/", "block"), (None, "allow"), ("net/fr/", "block"), (None, "allow")]
    assert url_verdicts(page_labels(pages.limit(0), labels.limit(0))).count() == 0
