"""Token counts that follow edits without encoding the whole text again.

A document's pre-tokens are kept in runs, the leaves of a segment tree whose
nodes hold the characters and tokens below them.  Leaves end where a blank
follows another character, where no pre-token can reach across.  An edit
replaces the leaves it touches, and as many neighbours as it takes for the new
stretch to begin and end at such a place; only that stretch is encoded, and the
sums above the leaves are updated.

Defined results: a null or empty text has no leaves and 0 tokens; edits apply
to it as to an empty text.  An edit beyond the end applies at the end; one that
removes more than there is removes the rest; null edits change nothing.
Repeated rows each get a row.  Extra columns are ignored, whatever their names;
an empty table gives an empty result.  Texts of any length are counted whole.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared

#: A leaf ends at the first safe place after this many characters.
LEAF = 256

#: A character that no definition calls a blank, and a blank by every definition after it.
_SAFE = re.compile(r"[^\s\x1c-\x1f\x85᠎​](?=[ \n])")

TREE = "struct<chars:array<long>,tokens:array<long>>"


class ByteTokenizer:
    """Byte-pair ranks and the pre-token pattern, sent to the executors."""

    def __init__(self, path: str, pattern: str):
        self.pattern = pattern
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}

    @cached_property
    def library(self):
        import tiktoken

        return tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})

    def count(self, texts: list[str]) -> list[int]:
        return [len(self.library.encode_ordinary(text)) for text in texts]


def cut_leaves(text: str) -> list[str]:
    leaves, start = [], 0
    while start < len(text):
        place = _SAFE.search(text, start + LEAF - 1)
        end = place.end() if place else len(text)
        leaves.append(text[start:end])
        start = end
    return leaves


class CountTree:
    """Characters and tokens of a document's leaves, with the sums of all subtrees.

    Node 1 is the root, node i has the children 2i and 2i + 1, and the leaves are
    the second half of the arrays; leaves without characters are unused.
    """

    def __init__(self, chars: list[int], tokens: list[int]):
        self.chars, self.tokens = chars, tokens

    @classmethod
    def of_leaves(cls, chars: list[int], tokens: list[int]) -> CountTree:
        width = 1
        while width < len(chars):
            width *= 2
        tree = cls([0] * width + chars + [0] * (width - len(chars)), [0] * width + tokens + [0] * (width - len(tokens)))
        for node in range(width - 1, 0, -1):
            tree._add_up(node)
        return tree

    @property
    def width(self) -> int:
        return len(self.chars) // 2

    def _add_up(self, node: int) -> None:
        for sums in (self.chars, self.tokens):
            sums[node] = sums[2 * node] + sums[2 * node + 1]

    def find(self, at: int) -> tuple[int, int]:
        """The used leaf that holds character ``at`` (or the last one) and the characters before it."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if at >= before + self.chars[node] and self.chars[node + 1]:
                before += self.chars[node]
                node += 1
        return node - self.width, before

    def replace(self, first: int, last: int, chars: list[int], tokens: list[int]) -> CountTree:
        """The tree with other leaves in place of ``first`` to ``last``; if they fit there, only the sums above them change."""
        room = last - first + 1
        if len(chars) > room:
            old = [(c, t) for c, t in zip(self.chars[self.width :], self.tokens[self.width :], strict=True)]
            kept = [*old[:first], *zip(chars, tokens, strict=True), *old[last + 1 :]]
            used = [pair for pair in kept if pair[0]]
            return CountTree.of_leaves([c for c, _ in used], [t for _, t in used])
        low, high = self.width + first, self.width + last
        self.chars[low : high + 1] = chars + [0] * (room - len(chars))
        self.tokens[low : high + 1] = tokens + [0] * (room - len(tokens))
        while low > 1:
            low, high = low // 2, high // 2
            for node in range(low, high + 1):
                self._add_up(node)
        return self

    def used_before(self, leaf: int) -> int:
        while leaf > 0 and not self.chars[self.width + leaf - 1]:
            leaf -= 1
        return leaf - 1

    def used_after(self, leaf: int) -> int:
        leaf += 1
        while leaf < self.width and not self.chars[self.width + leaf]:
            leaf += 1
        return leaf


def edit(text: str, tree: CountTree, at: int, remove: int, insert: str, count) -> tuple[str, CountTree, int]:
    """The text and tree after one edit, and how many characters were encoded for it."""
    at = min(max(at, 0), len(text))
    end = min(at + max(remove, 0), len(text))
    edited = text[:at] + insert + text[end:]
    shift = len(edited) - len(text)
    if not text:
        leaves = cut_leaves(edited)
        return edited, CountTree.of_leaves([len(x) for x in leaves], count(leaves)), len(edited)
    first, start = tree.find(at)
    last, before = tree.find(max(at, end - 1))
    stop = before + tree.chars[tree.width + last]
    while start > 0 and not _SAFE.match(edited, start - 1):
        first = tree.used_before(first)
        start -= tree.chars[tree.width + first]
    while stop < len(text) and not _SAFE.match(edited, max(0, stop + shift - 1)):
        last = tree.used_after(last)
        stop += tree.chars[tree.width + last]
    leaves = cut_leaves(edited[start : stop + shift])
    tree = tree.replace(first, last, [len(x) for x in leaves], count(leaves))
    return edited, tree, stop + shift - start


def _lists(rows: list[list[int]]) -> pa.Array:
    return pa.array(rows, pa.list_(pa.int64()))


def counter(shared: Shared):
    """A column function: text to its count tree."""

    @F.arrow_udf(TREE)
    def build(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            trees = []
            for text in column:
                leaves = cut_leaves(text.as_py() or "")
                trees.append(CountTree.of_leaves([len(x) for x in leaves], shared.value.count(leaves)))
            yield pa.StructArray.from_arrays([_lists([t.chars for t in trees]), _lists([t.tokens for t in trees])], ["chars", "tokens"])

    return build


def editor(shared: Shared):
    """A column function: text, its tree's chars and tokens, and edits to the edited text, its tree and the work done."""

    @F.arrow_udf("struct<text:string,chars:array<long>,tokens:array<long>,n_tokens:long,encoded_chars:long>")
    def apply(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, chars, tokens, edits in columns:
            rows = []
            for text, c, t, steps in zip(texts, chars, tokens, edits, strict=True):
                text, tree, work = text.as_py() or "", CountTree(c.as_py(), t.as_py()), 0
                for step in steps.as_py() or ():
                    if step is not None:
                        text, tree, encoded = edit(text, tree, step["at"] or 0, step["remove"] or 0, step["insert"] or "", shared.value.count)
                        work += encoded
                rows.append((text, tree.chars, tree.tokens, tree.tokens[1], work))
            text, chars, tokens, totals, work = zip(*rows, strict=True) if rows else ([],) * 5
            arrays = [pa.array(text, pa.string()), _lists(list(chars)), _lists(list(tokens))]
            numbers = [pa.array(np.array(n, np.int64)) for n in (totals, work)]
            yield pa.StructArray.from_arrays([*arrays, *numbers], ["text", "chars", "tokens", "n_tokens", "encoded_chars"])

    return apply


def count_trees(docs: DataFrame, shared: Shared) -> DataFrame:
    """``doc_id``, ``text`` and the ``tree`` (chars, tokens) of every row; token 1 of ``tree.tokens`` is the total."""
    return docs.select("doc_id", "text", counter(shared)("text").alias("tree"))


def apply_edits(counted: DataFrame, shared: Shared, edits: str = "edits") -> DataFrame:
    """``counted`` rows (``doc_id``, ``text``, ``tree``) with the column of edits, an array of struct<at, remove, insert>, applied in order."""
    done = editor(shared)("text", "tree.chars", "tree.tokens", edits)
    return counted.select(
        "doc_id", F.element_at("tree.tokens", 2).alias("n_tokens_before"), F.size(edits).cast("long").alias("n_edits"), done.alias("done")
    )
