"""Writing marts so that a reader never sees half a run.

A publish writes every table of a run under a new version and appends one
manifest row last; readers follow the newest manifest row.  A failed run
leaves files that nothing points to.  Only Spark's own readers and writers are
used, so the root may be any file system the cluster can reach.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Collection, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_MANIFEST = "manifest"
_MANIFEST_SCHEMA = "version string, published_at string, tables array<string>"


class TargetNotEmptyError(RuntimeError):
    """The target holds rows and replacing them was not requested."""


def read_if_present(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: str | StructType | None = None
) -> DataFrame | None:
    """What is stored under ``path``, or None if nothing is."""
    reader = spark.read.format(fmt)
    try:
        return (reader.schema(schema) if schema else reader).load(path)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _check_allowed(target: str, allowed_targets: Collection[str] | None) -> None:
    if allowed_targets is not None and target not in allowed_targets:
        raise ValueError(f"{target!r} is not one of the allowed targets: {', '.join(sorted(allowed_targets))}")


def guarded_write(
    df: DataFrame, target: str, replace: bool = False, allowed_targets: Collection[str] | None = None
) -> None:
    """Write Parquet to ``target``, refusing to overwrite rows unless ``replace`` is set."""
    _check_allowed(target, allowed_targets)
    current = read_if_present(df.sparkSession, target)
    if current is not None and not replace and not current.isEmpty():
        raise TargetNotEmptyError(f"{target} already holds rows; pass replace=True to overwrite them")
    df.write.mode("overwrite").parquet(target)


@contextmanager
def scratch_dir(spark: SparkSession, fallback_root: str) -> Iterator[str]:
    """A fresh folder for intermediate tables that every executor can reach, removed at the end.

    The cluster names its shared folder in ``spark.checkpoint.dir``; where it
    is unset the folder lies beside the published tables.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{fallback_root.rstrip('/')}/scratch"
    folder = f"{shared.rstrip('/')}/tallyroom-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        delete_folder(spark, folder)


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of any file system the cluster can reach, if it is there.

    Spark has no public call for this; the one use of its private gateway is here.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def feed_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps in its checkpoint for life."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()[0]


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write once and read back.

    A table with several consumers is then computed once, and a lost executor
    costs a re-read instead of a recomputation of its whole lineage.
    """
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_attempts(df: DataFrame, path: str, key: str = "order_id", keys_per_file: int = 1_000_000, row_group_bytes: int = 32 << 20) -> None:
    """Write Parquet with a Bloom filter on ``key`` in every row group.

    Ranges of ids skip nothing where ids don't grow with time; a Bloom filter
    tells for a named id which row groups can't hold it.
    """
    (
        df.write.mode("errorifexists")
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{key}", str(keys_per_file))
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .option("parquet.block.size", str(row_group_bytes))
        .parquet(path)
    )


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> DataFrame:
    """Write a table of the catalogue in ``buckets`` by ``key``, and read it.

    Tables with the same key and number of buckets are joined and grouped by
    the key without a shuffle.  A key that holds a large part of the rows makes
    one bucket large, so such keys belong elsewhere, see ``plans.by_user``.
    """
    spark = df.sparkSession
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )
    return spark.table(table)


def side_by_side(spark: SparkSession, task: Callable[[str], object], names: Iterable[str]) -> None:
    """Submit one job per name from its own thread, so that short jobs fill the gaps of long ones."""
    names = list(names)
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        list(pool.map(inheritable_thread_target(spark)(task), names))


def _manifest_rows(spark: SparkSession, root: str) -> DataFrame | None:
    return read_if_present(spark, f"{root.rstrip('/')}/{_MANIFEST}", "json", _MANIFEST_SCHEMA)


def current_version(spark: SparkSession, root: str, table: str | None = None) -> str | None:
    """The newest published version, optionally the newest that includes ``table``."""
    manifest = _manifest_rows(spark, root)
    if manifest is None:
        return None
    if table is not None:
        manifest = manifest.filter(F.array_contains("tables", table))
    return manifest.agg(F.max("version")).first()[0]


def _next_version(current: str | None) -> str:
    number = int(current.split("-")[0]) + 1 if current else 1
    return f"{number:010d}-{uuid.uuid4().hex[:8]}"


def _table_path(root: str, table: str, version: str) -> str:
    return f"{root.rstrip('/')}/{table}/version={version}"


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The published state of ``table``, or None if it never was."""
    version = current_version(spark, root, table)
    return None if version is None else spark.read.parquet(_table_path(root, table, version))


def publish_version(
    tables: Mapping[str, DataFrame],
    root: str,
    replace: bool = True,
    allowed_roots: Collection[str] | None = None,
) -> str:
    """Write all ``tables`` and make them current together; returns the version.

    With ``replace=False`` a table that already has published rows stops the
    run before anything is written.  The tables are independent, so their jobs
    are submitted side by side.
    """
    if not tables:
        raise ValueError("nothing to publish")
    _check_allowed(root, allowed_roots)
    spark = next(iter(tables.values())).sparkSession
    if not replace:
        for name in tables:
            published = read_published(spark, root, name)
            if published is not None and not published.isEmpty():
                raise TargetNotEmptyError(f"{name} already has published rows; pass replace=True to supersede them")
    version = _next_version(current_version(spark, root))

    side_by_side(
        spark, lambda name: tables[name].write.mode("errorifexists").parquet(_table_path(root, name, version)), tables
    )
    entry = [(version, dt.datetime.now(dt.timezone.utc).isoformat(), sorted(tables))]
    spark.createDataFrame(entry, _MANIFEST_SCHEMA).coalesce(1).write.mode("append").json(f"{root.rstrip('/')}/{_MANIFEST}")
    return version


def drop_old_versions(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Delete all but the newest ``keep`` versions of each published table; returns the folders removed.

    To be called when no reader follows an older version.  The manifest keeps
    its rows; readers only ever follow the newest.
    """
    if keep < 1:
        raise ValueError("at least the current version has to stay")
    manifest = _manifest_rows(spark, root)
    if manifest is None:
        return []
    published = manifest.select("version", F.explode("tables").alias("table"))
    by_table = published.groupBy("table").agg(F.sort_array(F.collect_set("version"), asc=False).alias("versions"))
    old = by_table.select("table", F.explode(F.slice("versions", keep + 1, F.greatest(F.size("versions"), F.lit(1)))).alias("version")).collect()
    folders = sorted(_table_path(root, r["table"], r["version"]) for r in old)
    for folder in folders:
        delete_folder(spark, folder)
    return folders


def write_months(df: DataFrame, day: str, target: str, replace_all: bool = False) -> None:
    """Replace whole months of a month-partitioned Parquet table, leaving other months alone.

    ``df`` must hold complete months and must not read ``target`` lazily.
    ``replace_all`` also removes the months ``df`` does not have.  Rows are
    rebalanced by month so that each month is a few well-sized files.
    """
    (
        df.withColumn("month", F.date_format(day, "yyyy-MM"))
        .hint("rebalance", "month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy("month")
        .parquet(target)
    )


def read_months(spark: SparkSession, target: str) -> DataFrame | None:
    """A table written by ``write_months``, or None if there is none."""
    stored = read_if_present(spark, target)
    return None if stored is None else stored.drop("month")
