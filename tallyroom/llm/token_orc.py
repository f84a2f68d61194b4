"""Token ids in ORC files: run-length encoded stripes with row indexes and Bloom filters.

Documents are dealt by ranges of their id and written in ascending order, one
row each: the part, the id, the number of ids before it in the part, its own
number of ids, and the ids.  ORC encodes the integers in runs, keeps minima and
maxima of every stripe and row group, and a Bloom filter on ``doc_id``; a read
of some documents skips what these rule out, and a full read is split by
stripes.

Defined results: a null or empty text has the end id alone.  Null ids come
first; rows with the same id are ordered by their text's hash, and repeated
rows are each written.  Texts are read whole, however long.  Extra columns are
ignored, whatever their names; an empty table gives files without rows.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator, Sequence
from functools import cached_property
from itertools import chain
from operator import attrgetter, itemgetter
from string import ascii_letters

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Shared, WordTable, ids_crc32, per_list, ragged, settle, small_side, take_runs, text_slices

SCHEMA = "part int, doc_id long, start_in_part long, n_tokens long, ids array<int>"

ORC_OPTIONS = {
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


_MARKS = "!\"#$%&()*+,-./:;=?@[]^_`{}~"
_LETTERS = ascii_letters + "".join(chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))
_RUNS = re.compile("[a-zß-öø-ÿ]+|[^a-zß-öø-ÿ ]+")
#: The kind of every code point below 256 and, last, of all others: a blank, a letter, a mark or another.
_BLANK, _LETTER, _MARK, _OTHER = range(4)
_KINDS = np.full(257, _OTHER, np.int8)
_KINDS[ord(" ")] = _BLANK
_KINDS[[ord(c) for c in _LETTERS]] = _LETTER
_KINDS[[ord(c) for c in _MARKS]] = _MARK
#: Characters that are looked at one by one, so that words of them alone need no look at their normal form.
_COMMON = range(0x21, 0x530)

_ID = attrgetter("id")

#: Texts are encoded in slices of about this many characters; a word is looked up once in each.
SLICE_CHARS = 2_000_000
#: What a worker remembers at most; beyond it starts afresh.
WORDS_KEPT, PIECES_KEPT = 1_000_000, 400_000


def _kinds(text: str) -> np.ndarray:
    """The kind of each character."""
    return _KINDS[np.minimum(np.frombuffer(text.encode("utf-32-le"), "<u4"), 256)]


def _are_simple(words: list[str]) -> np.ndarray:
    """Which words are of letters of Latin-1 and marks alone."""
    kinds = _kinds(" ".join(words))
    simple = np.ones(len(words), bool)
    simple[np.cumsum(kinds == _BLANK)[kinds == _OTHER]] = False
    return simple


def _unblank_list(words: pa.LargeBinaryArray) -> list[bytes]:
    """Words without a blank as a Python list, which takes less time at once than one by one."""
    if not len(words):
        return []
    whole = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    return pc.binary_join(whole, pa.scalar(b" ", pa.large_binary()))[0].as_py().split(b" ")


class TextTokenizer:
    """A tokenizer file of the ``tokenizers`` library, sent to the executors as text.

    If the tokenizer drops blanks and never looks across them, words are encoded
    once and remembered, and so are the pieces its pre-tokenizer makes of them;
    this gives the same ids as encoding the whole text.  A word whose normal
    form holds a blank, as one with a no-break space does, is left to the library.
    """

    PROBE = "Ab  c\n\td,e É1 it's\r\nx\x0b.y\x0c!! 12 ß I'LL\u00a0nbsp e\u0301 日本 a<|endoftext|>b 🙂🙂 ΑΣ"

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.definition = file.read()
        whole = self.library.encode(self.PROBE, add_special_tokens=False).ids
        words = [w.decode() for w in self.PROBE.encode().split()]
        self.by_word = whole == [i for w in words for i in self.library.encode(w, add_special_tokens=False).ids]
        self.simple_marks, self.names = False, {}  # a letter's characters as the model is given them
        if self.by_word and self.library.normalizer and self.library.pre_tokenizer:
            self.simple_marks = self._marks_are_simple()
            self.by_word = whole == self._encode_words(words)[0].tolist()
        else:
            self.by_word = False

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.definition)

    @cached_property
    def special(self) -> list[str]:
        return [token.content for token in self.library.get_added_tokens_decoder().values()]

    @cached_property
    def pieces(self) -> dict[str, bytes]:
        """The ids of the pieces met so far, as native integers side by side."""
        return {}

    def _encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.array([len(i) for i in ids], np.int64)
        return np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum())), lengths

    def _of_pieces(self, pieces: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces one after another, and how many each has."""
        if len(self.pieces) > PIECES_KEPT:
            self.pieces.clear()
        tokenize = self.library.model.tokenize
        for piece in set(pieces).difference(self.pieces):
            self.pieces[piece] = array("i", map(_ID, tokenize(piece))).tobytes()
        ids = list(map(self.pieces.__getitem__, pieces))
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // array("i").itemsize
        return np.frombuffer(b"".join(ids), np.intc).astype(np.int32), lengths

    @cached_property
    def tame(self) -> re.Pattern:
        """Words of characters whose normal form is neither empty nor holds a blank; so neither is theirs, nor does it."""
        normal = self.library.normalizer.normalize_str
        good = [chr(c) for c in _COMMON if normal(chr(c)).split() == [normal(chr(c))]]
        return re.compile(f"[{re.escape(''.join(good))}]+")

    def _holds_together(self, word: str) -> bool:
        """Whether a word stays one word when it is normalised."""
        if self.tame.fullmatch(word):
            return True
        normal = self.library.normalizer.normalize_str(word)
        return normal.split() == [normal]

    def _split(self, words: list[str]) -> tuple[Sequence[str], np.ndarray]:
        """The library's pieces of words that hold together, and each piece's word."""
        normal = " ".join(words)
        normal = self.library.normalizer.normalize_str(normal)
        pieces, places = zip(*self.library.pre_tokenizer.pre_tokenize_str(normal), strict=True)
        word_ends = np.cumsum([len(w) + 1 for w in normal.split(" ")])
        starts = np.fromiter(map(itemgetter(0), places), np.int64, len(places))
        return pieces, np.searchsorted(word_ends, starts, side="right")

    def _cut(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """The pieces of simple words, runs of letters and runs of marks in lower case, and each piece's word."""
        text = " ".join(words).lower()
        kinds = _kinds(text)
        begins = (kinds != _BLANK) & (np.diff(kinds, prepend=_BLANK) != 0)
        pieces = _RUNS.findall(text)
        if not text.isascii():
            named = " ".join(pieces)
            for letter, name in self.names.items():
                named = named.replace(letter, name)
            pieces = named.split(" ")
        return pieces, np.cumsum(kinds == _BLANK)[begins]

    def _marks_are_simple(self) -> bool:
        """Whether words of Latin-1's letters and these marks are cut, in lower case, into runs of letters and runs of marks."""
        letters = sorted({c for c in _LETTERS.lower() if not c.isascii()})
        pieces, of = self._split(letters)
        if of.tolist() != list(range(len(letters))) or set("".join(pieces)) & set(letters):
            return False
        self.names = dict(zip(letters, pieces, strict=True))
        words = [f"aB{m}c{m}{n}d{m}" for m in _MARKS for n in _MARKS] + ["Ab", "zQ", "the", *(m for m in _MARKS)]
        words += [w for c in _LETTERS for d in "eÉ" for w in (c, f"{c}{d}{c}", f"x{c}Y!{c}{d}")] + [f"é{m}É{m}{c}" for m in _MARKS for c in _LETTERS]
        pieces, of = self._split(words)
        runs, of_runs = self._cut(words)
        same = list(pieces) == runs and of.tolist() == of_runs.tolist()
        return same and not any(set(m) & set(_MARKS) or set(m) <= set(_LETTERS) for m in self.special)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words through the library's normaliser, pre-tokenizer and model, many at once."""
        kind = np.ones(len(words), np.int8)
        if self.simple_marks:
            kind[_are_simple(words)] = 0
        for i in np.flatnonzero(kind).tolist():
            if not self._holds_together(words[i]) or any(s in words[i] for s in self.special):
                kind[i] = 2
        simple, plain, odd = ([words[i] for i in np.flatnonzero(kind == k).tolist()] for k in (0, 1, 2))
        found = []
        if simple:
            found.append((*self._cut(simple), len(simple)))
        if plain:
            found.append((*self._split(plain), len(plain)))
        flats, lengths = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for pieces, of, count in found:
            ids, sizes = self._of_pieces(pieces)
            flats.append(ids)
            lengths.append(np.bincount(of, weights=sizes, minlength=count).astype(np.int64))
        for kept, more in zip((flats, lengths), self._encode_all(odd), strict=True):
            kept.append(more)
        flat, length = np.concatenate(flats), np.concatenate(lengths)
        place = np.empty(len(words), np.int64)
        place[np.argsort(kind, kind="stable")] = np.arange(len(words))
        return take_runs(flat, (np.cumsum(length) - length)[place], length[place]), length[place]

    @cached_property
    def table(self) -> WordTable:
        """The ids of the words met so far; it lives as long as the worker keeps the tokenizer."""
        return WordTable(lambda words: self._encode_words([w.decode() for w in words]), limit=WORDS_KEPT)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and how many each has."""
        if not self.by_word:
            return self._encode_all(texts)
        words = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = words.flatten().cast(pa.large_binary()).dictionary_encode()  # a word is looked up once for all its places
        codes, names = coded.indices.to_numpy(), _unblank_list(coded.dictionary)
        counts = words.value_lengths().to_numpy().astype(np.int64)
        index = self.table.index([n for n in names if n])
        if b"" in names:  # before a leading and after a trailing blank, and for an empty text
            nothing = names.index(b"")
            counts = per_list(codes != nothing, counts)
            codes, index = codes[codes != nothing], np.insert(index, nothing, -1)
        ids, lengths = self.table.gather(index[codes])
        return ids, per_list(lengths, counts)


def _with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(ids, np.cumsum(lengths), end_id).astype(np.int32), lengths + 1


def _encoded(shared: Shared, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, texts in text_slices(batch, chars=SLICE_CHARS):
                ids, lengths = _with_end(*shared.value.encode(texts), end_id)
                starts = before + np.cumsum(lengths) - lengths
                before += int(lengths.sum())
                columns = [
                    pa.array(np.full(len(texts), part, np.int32)),
                    batch.column("doc_id").slice(first, len(texts)),
                    pa.array(starts),
                    pa.array(lengths),
                    ragged(ids, lengths),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "start_in_part", "n_tokens", "ids"])

    return run


def write_token_ids(docs: DataFrame, shared: Shared, path: str, end_id: int) -> None:
    """Encode ``doc_id``, ``text`` with a shared ``TextTokenizer`` and write the ids to ORC files under ``path``."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    ordered = keyed.repartitionByRange("doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash")
    ordered.mapInArrow(_encoded(shared, end_id), SCHEMA).write.options(**ORC_OPTIONS).orc(path)


def read_token_ids(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """The rows written, or those with ``low <= doc_id <= high``, for which ORC's indexes and Bloom filters are used."""
    rows = spark.read.schema(SCHEMA).orc(path)
    if low is not None and low == high:
        return rows.filter(F.col("doc_id") == low)
    if low is not None:
        rows = rows.filter(F.col("doc_id") >= low)
    return rows if high is None else rows.filter(F.col("doc_id") <= high)


def part_starts(rows: DataFrame) -> DataFrame:
    """The number of ids before each part; one row per part is all that is gathered."""
    totals = rows.groupBy("part").agg(F.max(F.col("start_in_part") + F.col("n_tokens")).alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return totals.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))


def token_digest(rows: DataFrame) -> DataFrame:
    """Per document of the files its place among all ids, its number of ids and their crc32."""
    starts = small_side(settle(part_starts(rows)))
    return rows.select("part", "doc_id", "start_in_part", "n_tokens", ids_crc32("ids").alias("ids_crc32")).join(starts, "part").select(
        "doc_id", (F.col("part_start") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32"
    )
