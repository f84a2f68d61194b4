"""What several operators share: tables, shared storage, word tables, row keys."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

#: Documents are handled inside a task in slices of about this many characters.
SLICE_CHARS = 1_000_000
#: New words are worked out so many at a time.
AT_ONCE = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tallyroom-llm-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for what a job writes."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, where a lost executor can't take it away."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Unlike ``settle`` it also forgets the sizes that the optimiser guessed, which
    multiply in a loop of joins until they are too long to compute with.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def null_safe(column: Column | str) -> Column:
    """A text that is never null, differs for different values, and so joins null with null."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("-"))


def fold_of(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % folds


def text_slices(batch: pa.RecordBatch, column: str = "text", chars: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Whole texts (null: empty) of a batch with the first row's number, some millions of characters at a time."""
    start, size, texts = 0, 0, []
    for i, text in enumerate(batch.column(column)):
        text = text.as_py() or ""
        if texts and size + len(text) > chars:
            yield start, texts
            start, size, texts = i, 0, []
        texts.append(text)
        size += len(text)
    if texts:
        yield start, texts


def column_slices(column: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a column, some millions of characters at a time."""
    texts, size = [], 0
    for text in column:
        texts.append(text.as_py())
        size += len(texts[-1] or "")
        if size > SLICE_CHARS:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts


def crc32s(lists: pa.ListArray) -> pa.Array:
    """Unsigned crc32 of lists of ids as little-endian unsigned 32-bit integers."""
    return pa.array([zlib.crc32(ids.values.to_numpy().astype("<u4")) if ids.is_valid else None for ids in lists], pa.int64())


@F.arrow_udf(LongType())
def ids_crc32(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """A column function: ids to their crc32."""
    for column in columns:
        yield crc32s(column)


def ragged(flat: np.ndarray | pa.Array, lengths: np.ndarray) -> pa.ListArray:
    """An Arrow list per length, cut from ``flat`` in order."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), flat if isinstance(flat, pa.Array) else pa.array(flat))


def per_list(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The sum of each run of ``lengths`` values; 0 for an empty run."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def small_side(df: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """``df``, already stored, marked for broadcast if it is counted to be small; else left to the optimiser."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def take_runs(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` from ``starts``, one after another."""
    places = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    places += np.arange(len(places))
    return flat[places]


class Shared:
    """An object sent to the executors once, which each worker keeps with all that it remembers.

    Only the object's plain attributes are broadcast; its class travels with the
    function that uses it.
    """

    def __init__(self, spark: SparkSession, value: object):
        kind = type(value)
        plain = {k: v for k, v in vars(value).items() if not isinstance(getattr(kind, k, None), cached_property)}
        self.kind, self.sent = kind, spark.sparkContext.broadcast(plain)

    @property
    def value(self):
        here = vars(self.sent)
        if "_rebuilt" not in here:
            here["_rebuilt"] = self.kind.__new__(self.kind)
            vars(here["_rebuilt"]).update(self.sent.value)
        return here["_rebuilt"]

    def drop(self) -> None:
        """Free the driver's and the executors' copies, once all that used the object is stored."""
        self.sent.destroy()


class WordTable:
    """Remembers an integer sequence for each word seen, so that a frequent word is worked out once.

    ``make`` gives, for a list of new words, all their integers in one array and
    the number of integers of each.  Beyond ``limit`` words the table starts
    afresh, which bounds its memory and changes no result.
    """

    def __init__(self, make: Callable[[list], tuple[np.ndarray, np.ndarray]], limit: int = 300_000, dtype=np.int32):
        self.make, self.limit, self.dtype = make, limit, dtype
        self._clear()

    def _clear(self) -> None:
        self.at: dict = {}
        self.flat, self.lengths, self.starts = np.zeros(0, self.dtype), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def index(self, words: list) -> np.ndarray:
        """The number of each word in the table; holds until the next call."""
        if len(self.at) > self.limit:
            self._clear()
        index = np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(index < 0).tolist()
        if missing:
            absent = [words[i] for i in missing]
            fresh = list(dict.fromkeys(absent))
            made = [self.make(fresh[i : i + AT_ONCE]) for i in range(0, len(fresh), AT_ONCE)]
            flat, lengths = (np.concatenate([m[k] for m in made]) for k in (0, 1))
            self.at.update(zip(fresh, range(len(self.at), len(self.at) + len(fresh)), strict=True))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
            self.flat = np.concatenate([self.flat, flat.astype(self.dtype)])
            self.lengths = np.concatenate([self.lengths, lengths.astype(np.int64)])
            index[missing] = np.fromiter(map(self.at.__getitem__, absent), np.int64, len(absent))
        return index

    def gather(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The integers of the indexed words one after another, and how many each word has."""
        lengths = self.lengths[index]
        return take_runs(self.flat, self.starts[index], lengths), lengths
