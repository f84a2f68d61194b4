"""Single operators against brute force, with small limits so that every branch is taken."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.orc
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tallyroom.llm import bloom_lm, edit_counts, queries, url_templates
from tallyroom.llm.common import Shared, WordTable, ragged
from tallyroom.llm.components import connected_components, spanning_links
from tallyroom.llm.embedding_dedup import near_duplicate_vectors
from tallyroom.llm.language_id import fit, grams_of, hashes_of, identify
from tallyroom.llm.line_quality import keep_quality, line_verdicts, repeat_words
from tallyroom.llm.mixing import mix, mix_sizes
from tallyroom.llm.piece_codec import LONE, Pieces, double_array
from tallyroom.llm.simhash_dedup import links, simhashes
from tallyroom.llm.token_orc import TextTokenizer, read_token_ids, write_token_ids
from tallyroom.llm.url_templates import judge_templates, path_templates

from .builders import SENTENCE, docs


def components_of(pairs):
    roots = dict(spanning_links(pairs))
    return {x: roots.get(x, x) for pair in pairs for x in pair}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 260)]
    loose = [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    pairs = chain + star + loose + [(5, 5), (8, 7), (7, 8)]
    rng.shuffle(pairs)
    found = connected_components(spark.createDataFrame(pairs, "a long, b long").repartition(8))
    got = [(r["node"], r["root"]) for r in found.collect()]
    want = {x: r for x, r in components_of([p for p in pairs if p[0] != p[1]]).items()}
    assert dict(got) == want and len(got) == len(want)


@pytest.mark.parametrize("bucket", [2, 8, 2048])
def test_links_of_close_fingerprints(spark, bucket):
    rng = random.Random(bucket)
    fps = {rng.getrandbits(64) for _ in range(60)}
    base = rng.getrandbits(64)
    for _ in range(150):  # a dense group: many share most of their bits
        fps.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 5))))
    for _ in range(60):
        fps.add(base ^ (rng.getrandbits(12) << 40))
    signed = [f - (f >> 63 << 64) for f in fps]
    found = links(spark.createDataFrame([(f,) for f in signed], "fp long"), bucket=bucket)
    got = {(min(a, b), max(a, b)) for a, b in found.collect()}
    close = [(a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) % (1 << 64)).bit_count() <= 3]
    want = components_of(close)
    assert components_of(list(got)) == want
    assert {x: want.get(x) for x, _ in got} == {x: want.get(y) for x, y in got}


def test_fingerprint_of_long_text():
    words = [f"w{i % 977}" for i in range(70_000)]
    text = " ".join(words)
    (long, short) = simhashes([text, "A b  C"])
    counts = Counter(zip(words, words[1:], words[2:], strict=False))
    import xxhash

    hashes = [(xxhash.xxh64_intdigest(" ".join(k).encode(), 42), n) for k, n in counts.items()]
    total = sum(n for _, n in hashes)
    assert int(long) == sum(1 << b for b in range(64) if 2 * sum(n for h, n in hashes if h >> b & 1) > total)
    assert int(short) == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("sizes", [{}, {"cell": 8, "max_pivots": 40, "block": 5}])
def test_vectors_by_all_pairs(spark, sizes):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 6))
    vectors = np.concatenate([centres[rng.integers(0, 12, 150)] + rng.normal(scale=0.2, size=(150, 6)), rng.normal(size=(60, 6)), centres[:3], centres[:3]])
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(vectors.astype(np.float32))]
    found = {r["vec_id"]: r for r in near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), **sizes).collect()}
    unit = vectors.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    roots = components_of(list(zip(*map(np.ndarray.tolist, np.nonzero(near)), strict=True)))
    for i in range(len(rows)):
        assert (found[i]["n_links"], found[i]["component_id"]) == (near[i].sum(), roots.get(i, i))
        assert found[i]["kept"] == (found[i]["component_id"] == i)


@pytest.mark.parametrize("sizes", [{}, {"cell": 4, "max_pivots": 9, "block": 3}])
def test_pairs_and_chains_of_vectors_are_components(spark, sizes):
    degrees = [0, 100, 117, 200, 217, 234, 251]  # cosine of 17 degrees: 0.956, of 34: 0.83
    rows = [(i, [math.cos(math.radians(d)), math.sin(math.radians(d)), 0.0]) for i, d in enumerate(degrees)]
    rows += [(7, [0.0, 0.0, 1.0]), (8, [0.0, 0.1, 1.0]), (8, [0.0, 0.1, 1.0])]
    found = near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), **sizes).collect()
    want = [(0, 0, 0), (1, 1, 1), (2, 1, 1), (3, 1, 3), (4, 2, 3), (5, 2, 3), (6, 1, 3), (7, 2, 7), (8, 2, 7), (8, 2, 7)]
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == want


@pytest.mark.parametrize("sizes", [{}, {"cell": 4, "max_pivots": 9, "block": 3}])
def test_vectors_at_the_threshold_are_linked(spark, sizes):
    vectors = [v for v in itertools.product(range(3, 16), repeat=4) if sum(v) == 38 and sum(x * x for x in v) in (396, 399, 400)]
    vectors = [(10, 10, 10, 10, 0)] + [(*v, round((400 - sum(x * x for x in v)) ** 0.5)) for v in vectors]  # length 20, product 380 with the first
    whole = [v for v in vectors if sum(x * x for x in v) == 400]
    below = (10000, 9990, 10010, 10000, 6575)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate([*whole, below])]
    found = {r["vec_id"]: r for r in near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), **sizes).collect()}
    exact = np.array([*whole, below], dtype=object)
    products, squares = exact @ exact.T, (exact * exact).sum(axis=1)
    near = 400 * products * products >= 361 * np.outer(squares, squares)
    assert len(whole) > 20 and near[0, : len(whole)].all() and not near[0, -1]
    for i in found:
        assert (found[i]["n_links"], found[i]["component_id"]) == (near[i].sum() - 1, 0 if near[i, : len(whole)].any() else i)


def test_mixing_reaches_its_targets(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 40)), None, rng.choice(["a"] * 30 + ["b", "c", None])) for i in range(3000)]
    table = docs(spark, *rows)
    found = mix_sizes(table).collect()
    by_source = {}
    for (_, text, _, source), r in zip(rows, sorted(found, key=lambda r: r["doc_id"]), strict=True):
        assert r["size"] == len(text.split()) and r["taken"] <= 2 * r["size"]
        by_source.setdefault(source, []).append(r)
    total = sum(r["size"] for r in found)
    targets = {s: rs[0]["target"] for s, rs in by_source.items()}
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    for source, rs in by_source.items():
        assert rs[0]["target"] <= 2 * rs[0]["source_size"] == 2 * sum(r["size"] for r in rs)
        assert abs(sum(r["taken"] for r in rs) - targets[source]) <= 20
    weights = {"a": 5, "b": 2, "c": 1, None: 5}
    free = [s for s, rs in by_source.items() if targets[s] < 2 * rs[0]["source_size"]]
    assert len({round(targets[s] / weights[s], 6) for s in free}) <= 1
    again = mix_sizes(table.repartition(7)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))
    copies = Counter(r["doc_id"] for r in mix(table).select("doc_id").collect())
    assert copies == Counter({r["doc_id"]: r["repetitions"] for r in found if r["repetitions"]})


def test_edits_at_every_place():
    tokenizer = edit_counts.ByteTokenizer(public_tokenizers.path(queries.BYTES), public_tokenizers.PATTERN)
    rng = random.Random(11)
    parts = ["word", " ", "  ", "\n", "\n\n", "don't", "é", "🙂", "1234", "...", "\t", "x" * 30, " a", "'s", "\x85", " "]
    for _ in range(150):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 400)))
        leaves = edit_counts.cut_leaves(text)
        assert "".join(leaves) == text
        tree = edit_counts.CountTree.of_leaves([len(x) for x in leaves], tokenizer.count(leaves))
        assert tree.tokens[1] == tokenizer.count([text])[0]
        for _ in range(6):
            at, remove = rng.randrange(0, len(text) + 2), rng.choice([0, 0, 1, 5, 300, 10_000])
            insert = "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 3, 200])))
            want = text[: min(at, len(text))] + insert + text[min(at, len(text)) + remove :]
            text, tree, _ = edit_counts.edit(text, tree, at, remove, insert, tokenizer.count)
            assert text == want and tree.chars[1] == len(text)
            assert tree.tokens[1] == (tokenizer.count([text])[0] if text else 0)


def test_backoff_to_character_grams(spark):
    rows = [(i, f"alpha beta gamma{i}", "xx") for i in range(30)] + [(100 + i, f"omega psi chi{i}", "yy") for i in range(30)]
    model = fit(docs(spark, *rows).select("lang", "text"))
    assert model.langs == ["xx", "yy"] and model.find(0, hashes_of(["alpha", "gamma3", "alphabet"])).tolist()[2] == -1
    assert len(model.hashes[0]) == 6  # digits are no letters
    assert model.predict(["alphabet", "omegas", "gamm", "zzz!", "", None, "12"])[0][:3] == ["xx", "yy", "xx"]
    assert model.predict(["", None, "12"])[0] == ["und"] * 3
    assert grams_of("ab", 3) == [" ab", "ab "]
    nothing = fit(docs(spark).select("lang", "text"))
    assert [r["lang_pred"] for r in identify(docs(spark, (1, "alpha")), nothing).collect()] == ["und"]


@pytest.mark.parametrize("most", [1000, 30])
def test_copies_do_not_weigh(spark, most):
    rows = [(i, f"alpha beta gamma{i}", "xx") for i in range(40)] + [(100 + i, f"omega psi chi{i}", "yy") for i in range(40)]
    copies = [(1000 + i, *row[1:]) for row in (rows[0], rows[50]) for i in range(300)]
    once, often = (fit(docs(spark, *r).select("lang", "text"), max_documents=most) for r in (rows, rows + copies))
    assert once.langs == often.langs == ["xx", "yy"] and np.array_equal(once.defaults, often.defaults)
    for a, b in ((once.hashes, often.hashes), (once.ends, often.ends), (once.lang_of, often.lang_of), (once.values, often.values)):
        assert all(np.array_equal(x, y) for x, y in zip(a, b, strict=True))


def test_a_sample_of_few_characters(spark):
    rows = [(i, f"alpha beta gamma{i} " * 50, "xx") for i in range(200)]
    model = fit(docs(spark, *rows).select("lang", "text"), max_chars=20_000)
    assert 2 < len(model.hashes[0]) < 60


def as_unigram(path):
    """The model file with its type set to unigram, so that the library itself solves the same problem."""

    def varint(data, at):
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            shift += 7
            at += 1
            if data[at - 1] < 128:
                return value, at

    def fields(data):
        at = 0
        while at < len(data):
            start = at
            key, at = varint(data, at)
            if key & 7 == 0:
                _, end = varint(data, at)
            elif key & 7 == 2:
                size, at = varint(data, at)
                end = at + size
            else:
                end = at + (4 if key & 7 == 5 else 8)
            yield key >> 3, start, at, end
            at = end

    with open(path, "rb") as file:
        data = file.read()
    out = b""
    for number, start, body, end in fields(data):
        if number == 2:  # the trainer's settings; their field 3 is the type
            spec = data[body:end]
            spec = b"".join(b"\x18\x01" if n == 3 else spec[a:z] for n, a, _, z in fields(spec))
            size = b""
            n = len(spec)
            while n > 127:
                size, n = size + bytes([n & 127 | 128]), n >> 7
            out += b"\x12" + size + bytes([n]) + spec
        else:
            out += data[start:end]
    return sentencepiece.SentencePieceProcessor(model_proto=out)


@pytest.fixture(scope="module")
def pieces():
    return Pieces(public_tokenizers.path(queries.PIECES))


def test_best_path_is_the_library_s(pieces):
    library = as_unigram(public_tokenizers.path(queries.PIECES))
    rng = random.Random(2)
    syllables = ["the", "ing", "er", "qu", "ß", "é", "日本", "🙂", "X", "7", ",", "a", "tion", "re", "\n"]
    texts = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 9))) + " " + rng.choice(["of the", "und", "x"]) for _ in range(400)]
    for text in texts:
        ids, lengths = pieces.encode([text])
        best = library.nbest_encode(text, nbest_size=2)[0]
        if set(pieces.byte_ids.tolist()) & set(best):
            continue  # beside an unknown character's score the library's single precision loses the others
        worth = lambda path: sum(pieces.scores[i] for i in path)
        assert worth(ids.tolist()) == pytest.approx(worth(best), rel=1e-6)  # ties may be cut differently
        assert pieces.decode(ids) == text == library.decode(ids.tolist())


def test_pieces_whole_or_cut(pieces):
    """Cutting texts into parts, side by side or one by one, doesn't change the best score."""
    rng = random.Random(4)
    texts = [SENTENCE * 3, "a" * 500, "  two  blanks ", "x\n\ny z\n", "▁ marker", "\t \n"] + ["".join(rng.choice("ab é\n") for _ in range(300)) for _ in range(20)]
    for text in texts:
        ids, _ = pieces.encode([text])
        whole, _ = pieces.encode_parts([LONE + "▁" + text.replace(" ", "▁")])
        worth = lambda path: sum(float(pieces.scores[i]) for i in path)
        assert worth(ids) == pytest.approx(worth(whole), rel=1e-9)
        assert pieces.decode(ids) == pieces.decode(whole) == text.replace("▁", " ")
    both, lengths = pieces.encode(["one two", "", "one two"])
    assert lengths[1] == 0 and both[: lengths[0]].tolist() == both[lengths[0] :].tolist()


def test_double_array():
    keys = [k.encode() for k in ("a", "ab", "abc", "b", "bcd", "é", "日本", "日", "\xff")]
    base, check, value = double_array(keys)

    def find(key):
        node = 0
        for byte in key:
            child = base[node] + byte
            if child >= len(check) or check[child] != node:
                return -1
            node = child
        return value[node]

    assert [find(k) for k in keys] == list(range(len(keys)))
    assert [find(k) for k in (b"", b"bc", b"c", b"abcd")] == [-1] * 4


def test_filter_never_forgets():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2**63, 5000, dtype=np.int64).view(np.uint64)
    counts = rng.integers(1, 1000, 5000)
    import pyarrow as pa

    shards, segments = 7, {}
    blobs = bloom_lm._by_shard(np.concatenate([hashes, hashes]), np.concatenate([counts, counts]), shards)
    for shard in range(shards):
        table = pa.Table.from_batches([blobs]).filter(pa.compute.equal(blobs.column("shard"), shard))
        segments[shard] = next(np.frombuffer(r["bits"], np.uint8) for r in bloom_lm._segments(table).to_pylist() if r["cutoff"] == 1)
    found = bloom_lm.LogFrequencyFilter(shards, segments)
    true = bloom_lm.level_of(2 * counts)
    levels = found.levels(hashes)
    assert (levels >= true).all() and (levels == true).mean() > 0.95
    assert (found.levels(rng.integers(0, 2**63, 5000, dtype=np.int64).view(np.uint64)) == 0).mean() > 0.95
    estimates = bloom_lm.count_at(true)
    assert (np.abs(estimates - 2 * counts) <= 0.3 * 2 * counts).all()


def test_tokens_and_their_hashes():
    rng = random.Random(6)
    texts = ["", "  ", "A b\n a B ", "x" * 3000, "é \x0b\x0cß\r\n\tq"] + [" ".join(rng.choice("abcABC") * rng.randrange(4) for _ in range(50)) for _ in range(20)]
    tokens, at, hashes = bloom_lm.Tokens(texts), 0, {}
    for text, length in zip(texts, tokens.lengths.tolist(), strict=True):
        words = bloom_lm.tokens_of(text)
        assert len(words) == length
        for i, word in enumerate(words):
            assert hashes.setdefault(word, tokens.hashes[at + i]) == tokens.hashes[at + i]
            assert tokens.before()[at + i] == hashes[words[i - 1] if i else b"\n"]
        at += length
    assert len(set(hashes.values())) == len(hashes) and at == len(tokens.hashes)
    import pyarrow as pa

    names = pa.array(list(hashes), pa.binary())
    assert bloom_lm.hash_all(names).tolist() == [int(h) for h in hashes.values()]
    assert bloom_lm.hash_all(names[2:5]).tolist() == [int(h) for h in list(hashes.values())[2:5]]


def test_rare_words_are_joined(spark):
    rng = random.Random(9)
    table = docs(spark, *((i, " ".join(f"w{int(rng.paretovariate(0.5))}" for _ in range(50))) for i in range(200)))
    wide = bloom_lm.score_texts(table, *bloom_lm.fit(bloom_lm.learnable(table)))
    narrow = bloom_lm.score_texts(table, *bloom_lm.fit(bloom_lm.learnable(table), max_filter_bytes=2000, max_top_words=3))
    pairs = wide.join(narrow.select("doc_id", F.col("n_known").alias("k"), F.col("base_score").alias("b")), "doc_id")
    assert all(r["n_known"] == r["k"] and r["base_score"] == pytest.approx(r["b"]) for r in pairs.collect())


def test_filter_of_any_size_gives_the_same_scores(spark, monkeypatch):
    monkeypatch.setattr(bloom_lm, "SHARD_TOKENS", 1000)
    rng = random.Random(10)
    texts = [" ".join(f"w{int(rng.paretovariate(0.5))}" for _ in range(50)) for _ in range(200)]
    table = docs(spark, *enumerate([*texts, texts[0], "", None, "never seen"])).repartition(3)
    found = []
    for bound in (1 << 30, 0):
        model, rest, segments = bloom_lm.fit(bloom_lm.learnable(table), max_filter_bytes=bound)
        assert model.shards > 5 and (segments is None) == (bound > 0)
        found.append(sorted(tuple(r) for r in bloom_lm.score_texts(table, model, rest, segments).collect()))
    assert len(found[0]) == 204 and [r[:-2] for r in found[0]] == [r[:-2] for r in found[1]]
    assert all(a[-2:] == pytest.approx(b[-2:], rel=1e-9) for a, b in zip(*found, strict=True))


def test_the_driver_keeps_no_filter(spark, monkeypatch):
    """The filter comes in parts and goes out once: the fitted model has figures only, and no broadcast is left when the scores are stored."""
    monkeypatch.setattr(bloom_lm, "SHARD_TOKENS", 1000)
    monkeypatch.setattr(bloom_lm, "PART_BYTES", 2000)
    rng = random.Random(11)
    table = docs(spark, *((i, " ".join(f"w{int(rng.paretovariate(0.5))}" for _ in range(50))) for i in range(200))).repartition(3)
    parts, dropped, in_parts, drop = [], [], bloom_lm._in_parts, Shared.drop
    monkeypatch.setattr(bloom_lm, "_in_parts", lambda segments, size: (parts.append((segments.count(), part)) or part for part in in_parts(segments, size)))
    monkeypatch.setattr(Shared, "drop", lambda self: dropped.append(self) or drop(self))
    model, rest, segments = bloom_lm.fit(bloom_lm.learnable(table))
    assert segments is None and not any(isinstance(v, np.ndarray | bytes | bytearray) for v in vars(model).values())
    assert len(parts) == parts[0][0] > 5 and len({shard for _, (shard, _) in parts}) == len(parts)
    sent = model.shared.value
    for _, (shard, bits) in parts:
        start = int(sent.starts[shard]) // 8
        assert sent.bits[start : start + len(bits)].tolist() == bits.tolist() and 8 * len(bits) == sent.sizes[shard]
    want = sorted(tuple(r) for r in bloom_lm.score_texts(table, model, rest).collect())
    assert not dropped
    found = bloom_lm.score_corpus(table)
    assert len(dropped) == 1
    assert [r[:-2] for r in want] == [tuple(r)[:-2] for r in sorted(map(tuple, found.collect()))]


def test_the_smallest_count_of_the_broadcast_words():
    rng = random.Random(12)
    for most in (0, 1, 5, 30, 1000):
        for _ in range(30):
            histogram = {rng.randrange(1, 50): rng.randrange(1, 12) for _ in range(rng.randrange(12))}
            reached = [c for c in histogram if sum(n for k, n in histogram.items() if k >= c) <= most]
            found = bloom_lm._cut(np.array([*histogram], np.int64), np.array([*histogram.values()], np.int64), most)
            assert found == min(reached, default=1 << 62)


def test_frequent_lines_go(spark):
    body = lambda i: "\n".join(" ".join(f"w{i}x{j}x{k}" for k in range(12)) for j in range(6))
    rows = [(i, f"{body(i)}\n  COMMON   line number one\t", None, "a") for i in range(30)]
    rows += [(100 + i, f"common line number one\n{body(100 + i)}", None, "b") for i in range(5)]
    rows += [(200 + i, "\n".join(" ".join(f"boiler{j}x{k}" for k in range(12)) for j in range(5)) + f"\nown {i}", None, "c") for i in range(30)]
    found = {r["doc_id"]: r for r in line_verdicts(docs(spark, *rows)).collect()}
    assert [found[i]["n_words"] - found[i]["words_left"] for i in (0, 1, 29, 100)] == [0, 4, 4, 0]
    assert all(found[i]["kept"] for i in [*range(30), 100, 200]) and not any(found[i]["kept"] for i in range(201, 230))
    kept = {r["doc_id"]: r for r in keep_quality(docs(spark, *rows)).collect()}
    assert set(kept) == {i for i, r in found.items() if r["kept"]}
    assert kept[1]["text"] == body(1) and kept[1]["n_chars"] == len(body(1)) and kept[0]["text"] == rows[0][1]


def test_a_null_id_is_never_the_first(spark):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(10))
    boiler = "\n".join(" ".join(f"boiler{j}x{k}" for k in range(12)) for j in range(5))
    rows = [(None, f"{boiler}\n{own(i)}", None, "a") for i in range(25)] + [(None if i else 7, f"{boiler}\n{own(i)}", None, "b") for i in range(25)]
    found = line_verdicts(docs(spark, *rows)).collect()
    assert [(r["doc_id"], r["words_left"], r["kept"]) for r in found if r["words_left"] > 10] == [(7, 70, True)]
    assert len(found) == 50 and sum(r["kept"] for r in found) == 1


@pytest.mark.parametrize("words, want", [("a b c", 0), ("a a a a", 4), ("a b c x a b c", 6), ("a b a b a", 5), ("", 0)])
def test_repeated_words(words, want):
    assert repeat_words(words.split()) == want


def test_templates_split_by_label(spark):
    rows = [(i, "h", f"/good/{i}", 0) for i in range(40)] + [(100 + i, "h", f"/bad/{i}", 1) for i in range(40)]
    rows += [(200 + i, "h", f"/mixed/{i}", i % 2) for i in range(40)] + [(300 + i, "o", f"/x/{i}", 0) for i in range(20)]
    found = path_templates(spark.createDataFrame(rows, "page_id long, host string, path string, bad int"))
    by_page = {r["page_id"]: r["template"] for r in found.collect()}
    assert (by_page[0], by_page[100], by_page[200], by_page[300]) == ("/good/*", "/bad/*", "/*/*", "/*/*")
    verdicts = {(r["host"], r["template"]): r["template_verdict"] for r in judge_templates(found).collect()}
    assert verdicts == {("h", "/good/*"): "allow", ("h", "/bad/*"): "block", ("h", "/*/*"): "allow", ("o", "/*/*"): "allow"}


def test_templates_part_at_any_depth(spark):
    """Branches that part below the sixth segment, also below segments that are all different."""
    rows = [(i, "h", f"/a/b/c/d/e/f/{kind}/{i}", bad) for kind, bad, first in (("good", 0, 0), ("bad", 1, 100)) for i in range(first, first + 40)]
    rows += [(200 + i, "o", f"/1/2/3/4/5/6/7/id{i}/{'xy'[i % 2]}/end/{i}", i % 2) for i in range(80)]
    rows += [(300, "h", "/a/b", None), (301, "p", "/" + "s/" * 40, 1), (302, "p", "", 0)]
    found = path_templates(spark.createDataFrame(rows, "page_id long, host string, path string, bad int"))
    by_page = {r["page_id"]: r["template"] for r in found.collect()}
    assert len(by_page) == len(rows) and found.columns == ["page_id", "host", "path", "bad", "template"]
    assert (by_page[0], by_page[100]) == ("/*" * 6 + "/good/*", "/*" * 6 + "/bad/*")
    assert (by_page[200], by_page[201]) == ("/*" * 8 + "/x/*/*", "/*" * 8 + "/y/*/*")
    assert (by_page[300], by_page[301], by_page[302]) == ("/*/*", "/*" * 40, "")
    verdicts = {(r["host"], r["template"]): r["template_verdict"] for r in judge_templates(found).collect()}
    assert verdicts["h", by_page[0]] == verdicts["o", by_page[200]] == "allow" and verdicts["h", by_page[100]] == verdicts["o", by_page[201]] == "block"


def test_templates_are_those_of_the_sql(spark):
    """Random deep paths against the SQL with as many levels as they have."""
    import duckdb
    import pyarrow as pa

    rng = random.Random(5)
    urls = [f"http://h{rng.randrange(2)}.de/" + "/".join(["s"] * 6 + [rng.choice("ab") for _ in range(rng.randrange(6))]) + f"/{i}" for i in range(1500)]
    pages = pa.table({"page_id": list(range(1500)), "url": urls})
    labels = [(i, int(rng.random() < (0.8 if "a/b/a" in u else 0.3)), 0) for i, u in enumerate(urls) if rng.random() < 0.9]
    marked = pa.table(dict(zip(("doc_id", "quality", "toxic"), map(list, zip(*labels, strict=True)), strict=True)))
    duck = duckdb.connect()
    duck.register("pages", pages)
    duck.register("labels", marked)
    want = duck.execute(url_templates.verdict_sql(max_depth=13)).fetchall()
    frames = [spark.createDataFrame(t.to_pylist()) for t in (pages, marked)]
    found = url_templates.url_verdicts(url_templates.page_labels(*frames)).select("page_id", "host", "path", "rule", "verdict", "template")
    assert sorted(tuple(r) for r in found.collect()) == sorted(want, key=lambda r: r[0])
    assert any(letter in template.split("/")[7:] for *_, template in want for letter in "ab")


def test_token_files_are_indexed(spark, tmp_path):
    path = str(tmp_path / "ids")
    table = docs(spark, *((i, f"{SENTENCE} {i}") for i in range(3000))).repartition(4)
    tokenizer = TextTokenizer(public_tokenizers.path(queries.WORDS))
    assert tokenizer.by_word and not TextTokenizer(public_tokenizers.path("byte_bpe_50k.json")).by_word
    write_token_ids(table, Shared(spark, tokenizer), path, 2)
    ids = {r["doc_id"]: r["ids"] for r in read_token_ids(spark, path).collect()}
    assert ids[17] == [*tokenizer.library.encode(f"{SENTENCE} 17", add_special_tokens=False).ids, 2] and len(ids) == 3000
    assert [r["doc_id"] for r in read_token_ids(spark, path, 17, 17).collect()] == [17]
    some = read_token_ids(spark, path, 100, 200)
    assert some.count() == 101 and "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,100)" in some._jdf.queryExecution().toString()
    files = sorted((tmp_path / "ids").glob("*.orc"))
    first_ids = [pyarrow.orc.ORCFile(f).read(["doc_id"]).column("doc_id").to_pylist() for f in files]
    assert [i for part in first_ids for i in part] == list(range(3000))


def test_word_table_starts_afresh():
    table = WordTable(lambda words: (np.array([len(w) for w in words for _ in w]), np.array([len(w) for w in words])), limit=3)
    for words in (["a", "bb"], ["ccc", "dd", "a"], ["eee", "a"], []):
        flat, lengths = table.gather(table.index(words))
        assert flat.tolist() == [len(w) for w in words for _ in w] and lengths.tolist() == [len(w) for w in words]
    assert ragged(np.arange(3), np.array([1, 0, 2])).to_pylist() == [[0], [], [1, 2]]
