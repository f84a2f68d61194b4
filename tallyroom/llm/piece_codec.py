"""SentencePiece encoding and decoding by a unigram Viterbi over a double-array trie.

The pieces and their scores come from a model file; the best path has the
highest sum of scores.  A character without a piece becomes its bytes' pieces
(or the unknown piece, if the model has none).  Blanks become the marker U+2581
and one is put before the text; decoding reverses both.

The texts are cut where no piece can reach across, before a run of markers and
around control characters that no piece has, so equal parts are worked out once.

Defined results: a null text has null ids, an empty one no ids.  Null ids decode
to null.  The marker character itself decodes to a blank, as the format has it.
Extra columns are kept and may have any name; an empty table gives an empty
result.  Texts of any length are encoded whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, WordTable, column_slices, crc32s, per_list, ragged

MARKER = "▁"
UNKNOWN_TEXT = " ⁇ "
#: How far below the lowest piece a character without a piece scores.
UNKNOWN_PENALTY = 10.0
#: Longer parts (in bytes) are solved one by one, shorter ones side by side.
SIDE_BY_SIDE = 192
#: How many places back a trie node looks for one that suits its children.
STRETCH = 1024
#: Stands before a part that has no blank before it; can't begin any other part, as that would be a surrogate.
LONE = "\ud800"


def double_array(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base, check and value arrays of a trie over distinct keys; a value is a key's index or -1.

    Node 0 is the root.  The child of node s by byte c is t = base[s] + c if check[t] == s.
    """
    order = sorted(range(len(keys)), key=keys.__getitem__)
    base, check, value = (np.full(1 << 12, fill, np.int32) for fill in (0, -1, -1))
    check[0], free, used = 0, 1, 1
    todo = [(0, 0, len(order), 0)]  # node, range of sorted keys below it, depth
    for node, low, high, depth in todo:
        if used + 1024 > len(base):
            base, check, value = (np.concatenate([a, np.full(len(a), fill, np.int32)]) for a, fill in ((base, 0), (check, -1), (value, -1)))
        if low < high and len(keys[order[low]]) == depth:
            value[node] = order[low]
            low += 1
        groups, at = [], low
        while at < high:
            byte, end = keys[order[at]][depth], at + 1
            while end < high and keys[order[end]][depth] == byte:
                end += 1
            groups.append((byte, at, end))
            at = end
        if not groups:
            continue
        children = np.array([g[0] for g in groups])
        while check[free] >= 0:
            free += 1
        start = free - groups[0][0]
        if len(groups) > 1 or start <= 0:
            # a free place for the first child, in the last stretch in use or right behind it, that suits the others too
            low_place = max(free, used - STRETCH)
            places = low_place + np.flatnonzero(check[low_place : used + 257] < 0) - children[0]
            places = places[places > 0]
            start = int(places[np.argmax((check[places[:, None] + children] < 0).all(axis=1))])
        base[node] = start
        check[start + children] = node
        used = max(used, start + 256)
        todo += [(start + byte, a, b, depth + 1) for byte, a, b in groups]
    return base[:used], check[:used], value[:used]


class Pieces:
    """What encoding and decoding need of a model file."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize(" Ab  cé\tﬁ") != "▁▁Ab▁▁cé\tﬁ":
            raise ValueError("only models without text normalisation and with a blank put first are supported")
        ids = range(model.get_piece_size())
        names = [model.id_to_piece(i) for i in ids]
        self.unknown = model.unk_id()
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.byte_ids = np.full(256, -1, np.int32)
        self.texts = [n.encode() for n in names]
        for i in ids:
            if model.is_byte(i):
                byte = int(names[i][1:-1], 16)
                self.byte_ids[byte], self.texts[i] = i, bytes([byte])
            elif model.is_control(i):
                self.texts[i] = b""
        self.texts[self.unknown] = UNKNOWN_TEXT.encode()
        self.base, self.check, value = double_array([names[i].encode() for i in plain])
        self.piece = np.where(value >= 0, np.array([*plain, -1], np.int32)[value], -1)
        self.scores = np.array([model.get_score(i) for i in ids], np.float64)
        self.unknown_score = self.scores[plain].min() - UNKNOWN_PENALTY
        inside = {c for i in plain for c in names[i]}
        alone = "".join(c for c in map(chr, range(32)) if c not in inside)
        self.parts, self.breaks = None, "\n" in alone
        if not any(MARKER in names[i].lstrip(MARKER) for i in plain):
            lone = f"[{re.escape(alone)}]|" if alone else ""
            self.parts = re.compile(f"{lone} +[^ {re.escape(alone)}]*|[^ {re.escape(alone)}]+")

    @cached_property
    def table(self) -> WordTable:
        """The parts met so far; it lives as long as the worker keeps the pieces."""
        return WordTable(self.encode_parts)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and how many each has."""
        parts = [self.cut(text) for text in texts]
        ids, lengths = self.table.gather(self.table.index([p for each in parts for p in each]))
        return ids, per_list(lengths, np.array([len(p) for p in parts], np.int64))

    def cut(self, text: str) -> list[str]:
        """Parts of the text, with a blank put first, that no piece crosses."""
        if not text:
            return []
        if self.parts and self.breaks and "  " not in text and MARKER not in text:
            return text.replace("\n", " \n").split(" ")  # each has lost the blank before it, but for line breaks
        text = " " + text.replace(MARKER, " ")
        parts = self.parts.findall(text) if self.parts else [text]
        return [p[1:] if p[0] == " " else "\n" + p[1:] if p[0] == "\n" else LONE + p for p in parts]

    def whole(self, part: str) -> str:
        """A part with the marker that ``cut`` left out."""
        return part if part[:1] == "\n" else part[1:] if part[:1] == LONE else MARKER + part.replace(" ", MARKER)

    def _matches(self, data: np.ndarray, ends: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and piece of every piece at every character, and of characters that need the fallback (-1)."""
        at, end, node = starts, ends, np.zeros(len(starts), np.int32)
        found, depth = [], 0
        while len(at):
            more = at + depth < end
            at, end, node = at[more], end[more], node[more]
            child = self.base[node] + data[at + depth]
            more = (child < len(self.check)) & (self.check[np.minimum(child, len(self.check) - 1)] == node) & (child > 0)
            at, end, node = at[more], end[more], child[more]
            depth += 1
            piece = self.piece[node]
            found.append((at[piece >= 0], np.full(int((piece >= 0).sum()), depth, np.int32), piece[piece >= 0]))
        at, length, piece = map(np.concatenate, zip(*found, strict=True))
        head = data[starts]
        width = np.where(head < 0x80, 1, np.where(head < 0xE0, 2, np.where(head < 0xF0, 3, 4)))
        whole = np.zeros(len(data), bool)
        whole[at[length == np.where(data[at] < 0x80, 1, np.where(data[at] < 0xE0, 2, np.where(data[at] < 0xF0, 3, 4)))]] = True
        bare = ~whole[starts]
        return (
            np.concatenate([at, starts[bare]]),
            np.concatenate([length, width[bare].astype(np.int32)]),
            np.concatenate([piece, np.full(int(bare.sum()), -1, np.int32)]),
        )

    def encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the parts one after another, and how many each part has."""
        raw = [self.whole(p).encode() for p in parts]
        sizes = np.array([len(r) for r in raw], np.int32)
        data = np.frombuffer(b"".join(raw), np.uint8).astype(np.int32)
        part_end = np.cumsum(sizes, dtype=np.int32)
        part_start = part_end - sizes
        of = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
        heads = np.flatnonzero((data & 0xC0) != 0x80).astype(np.int32)
        start, length, piece = self._matches(data, part_end[of[heads]], heads)
        gain = np.where(piece >= 0, self.scores[piece], self.unknown_score)
        # one node before every byte and one after each part's last
        source, target = start + of[start], start + length + of[start]
        best, came = np.full(len(data) + len(parts), -np.inf), np.full(len(data) + len(parts), -1, np.int64)
        best[part_start + np.arange(len(parts))] = 0
        offset = start - part_start[of[start]]
        short = sizes[of[start]] <= SIDE_BY_SIDE
        order = np.flatnonzero(short)
        order = order[np.argsort(offset[order].astype(np.int16), kind="stable")]
        bounds = [0, *(np.flatnonzero(np.diff(offset[order], append=-1)) + 1).tolist()]
        for low, high in zip(bounds, bounds[1:], strict=False):  # all edges from the same offset, over all parts
            edge = order[low:high]
            score = best[source[edge]] + gain[edge]
            better = score > best[target[edge]]
            edge = edge[better]
            best[target[edge]], came[target[edge]] = score[better], edge
        rest = np.flatnonzero(~short)
        rest = rest[np.argsort(start[rest], kind="stable")]
        for edge, a, b, g in zip(rest.tolist(), source[rest].tolist(), target[rest].tolist(), gain[rest].tolist(), strict=True):
            if best[a] + g > best[b]:
                best[b], came[b] = best[a] + g, edge
        first, node = part_start + np.arange(len(parts)), part_end + np.arange(len(parts))
        paths, alive = [], np.flatnonzero(node > first)
        while len(alive):
            edge = came[node[alive]]
            paths.append(edge)
            node[alive] = source[edge]
            alive = alive[node[alive] > first[alive]]
        taken = np.concatenate(paths) if paths else np.zeros(0, np.int64)
        taken = taken[np.argsort(start[taken])]
        return self._ids(data, start[taken], length[taken], piece[taken], of, len(parts))

    def _ids(self, data, start, length, piece, of, parts) -> tuple[np.ndarray, np.ndarray]:
        if (self.byte_ids < 0).any():
            ids = np.where(piece >= 0, piece, self.unknown)
            return ids, np.bincount(of[start], minlength=parts)
        counts = np.where(piece >= 0, 1, length)
        at = np.repeat(start, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        ids = np.where(np.repeat(piece, counts) >= 0, np.repeat(piece, counts), self.byte_ids[data[at]])
        return ids, np.bincount(of[start], weights=counts, minlength=parts).astype(np.int64)

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.texts.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(MARKER, " ")
        return text[1:] if text[:1] == " " else text


def _encoded(pieces: Pieces, texts: list[str | None]) -> pa.ListArray:
    ids, lengths = pieces.encode([t or "" for t in texts])
    lists = ragged(ids, lengths)
    return pa.compute.if_else(pa.array([t is None for t in texts]), pa.nulls(len(texts), lists.type), lists)


def _decoded(pieces: Pieces, lists: pa.ListArray) -> list[str | None]:
    return [pieces.decode(ids.values.to_numpy()) if ids.is_valid else None for ids in lists]


def encoder(shared: Shared):
    """A column function: text to its ids, by shared ``Pieces``, whose size is that of the vocabulary."""

    @F.arrow_udf("array<int>")
    def encode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.concat_arrays([_encoded(shared.value, texts) for texts in column_slices(column)] or [pa.array([], pa.list_(pa.int32()))])

    return encode


def decoder(shared: Shared):
    """A column function: ids to their text, by shared ``Pieces``."""

    @F.arrow_udf("string")
    def decode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array(_decoded(shared.value, column), pa.string())

    return decode


def _round_trips(shared: Shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for texts in column_slices(batch.column("text")):
                ids = _encoded(shared.value, texts)
                same = [d == (t and t.replace(MARKER, " ")) for d, t in zip(_decoded(shared.value, ids), texts, strict=True)]
                doc_ids = batch.column("doc_id").slice(first, len(texts))
                first += len(texts)
                yield pa.RecordBatch.from_arrays([doc_ids, crc32s(ids), pa.array(same), ids], ["doc_id", "ids_crc32", "round_trip", "ids"])

    return run


def encode(docs: DataFrame, shared: Shared) -> DataFrame:
    """``doc_id``, ``text`` and its ``ids``."""
    return docs.select("doc_id", "text", encoder(shared)("text").alias("ids"))


def decode(encoded: DataFrame, shared: Shared) -> DataFrame:
    """``doc_id``, ``text`` and ``ids`` of the rows with the ids' text as ``decoded``."""
    return encoded.select("doc_id", "text", "ids", decoder(shared)("ids").alias("decoded"))


def round_trip(docs: DataFrame, shared: Shared) -> DataFrame:
    """Per document its ids, their number and crc32, and if they decode to the text; encoded and decoded in one pass."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = keyed.mapInArrow(_round_trips(shared), "doc_id long, ids_crc32 long, round_trip boolean, ids array<int>")
    return rows.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"), "ids_crc32", "round_trip", "ids")
