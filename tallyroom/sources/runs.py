"""State of a feed, kept as one run per batch.

A batch adds a run and never changes another's, so a retried batch replaces
what its first try left and nothing is counted twice.  Runs are partitioned by
a column, and a reader names the partitions it needs; the files of others are
not opened.  Now and then all runs are merged into one, in a new generation
that becomes current when its manifest row is written; the generation before it
stays until the next merge, for readers that still follow it.  The row names the
last batch merged, which adds nothing more if it is retried after that.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .store import delete_folder, read_if_present

_MANIFEST_SCHEMA = "number long, generation string, feed string, batch long"
_MERGED = ("merged", -1)


class Runs:
    """The runs under ``folder``: rows of ``schema``, partitioned by its column ``part``."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, part: str) -> None:
        self.spark, self.folder, self.schema, self.part = spark, folder.rstrip("/"), schema, part

    def _manifest(self) -> list:
        """A row per merge."""
        manifest = read_if_present(self.spark, f"{self.folder}/manifest", "json", _MANIFEST_SCHEMA)
        return [] if manifest is None else manifest.collect()

    def _generations(self) -> list[tuple[int, str]]:
        """(number, name), oldest first."""
        return [(0, "first"), *sorted((r["number"], r["generation"]) for r in self._manifest())]

    def is_merged(self, feed: str, batch: int) -> bool:
        return any(r["feed"] == feed and r["batch"] >= batch for r in self._manifest())

    def _path(self, generation: str, feed: str = "", batch: int | None = None) -> str:
        root = f"{self.folder}/generation-{generation}"
        return root if batch is None else f"{root}/feed={feed}/batch={batch}"

    def write(self, rows: DataFrame, feed: str, batch: int) -> None:
        """Add the run of a batch, or replace it; a batch that is merged already adds nothing."""
        if self.is_merged(feed, batch):
            return
        path = self._path(self._generations()[-1][1], feed, batch)
        rows.select(self.schema.names).hint("rebalance", self.part).write.mode("overwrite").partitionBy(self.part).parquet(path)

    def read(self, parts: Collection | None = None, without: tuple[str, int] | None = None) -> DataFrame:
        """The rows of all runs, or of some partitions, or of all batches but one."""
        fields = [f for f in self.schema.fields if f.name != self.part]
        keys = [StructField("feed", StringType()), StructField("batch", LongType()), self.schema[self.part]]
        stored = read_if_present(self.spark, self._path(self._generations()[-1][1]), schema=StructType(fields + keys))
        if stored is None:
            return self.spark.createDataFrame([], self.schema)
        if parts is not None:
            stored = stored.filter(F.col(self.part).isin(*parts))
        if without is not None:
            stored = stored.filter(~((F.col("feed") == without[0]) & (F.col("batch") == without[1])))
        return stored.select(self.schema.names)

    def merge(self, merged: Callable[[DataFrame], DataFrame], feed: str, batch: int) -> None:
        """Replace all runs by one that holds ``merged`` of their rows.

        To be called by the one writer, when ``batch``, its last one, is complete.
        """
        if self.is_merged(feed, batch):
            return
        generations = self._generations()
        number, name = generations[-1][0] + 1, uuid.uuid4().hex[:12]
        rows = merged(self.read()).select(self.schema.names).hint("rebalance", self.part)
        rows.write.partitionBy(self.part).parquet(self._path(name, *_MERGED))
        entry = self.spark.createDataFrame([(number, name, feed, batch)], _MANIFEST_SCHEMA)
        entry.coalesce(1).write.mode("append").json(f"{self.folder}/manifest")
        for _, old in generations[:-1]:
            delete_folder(self.spark, self._path(old))
