"""Connected components of a link table, by alternating large and small stars.

Every step is a grouped minimum, which is combined before its shuffle, and a
join that can be split at run time; so one node may have any number of links.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.operators.hot_keys import join_per_key

from .common import settle


def spanning_links(links: Iterator[tuple]) -> Iterator[tuple]:
    """Fewer links that connect the same nodes: each node with its smallest peer."""
    parent: dict = {}

    def root(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return ((x, r) for x in parent if (r := root(x)) != x)


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        thin = list(spanning_links(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)))
        yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in thin], schema=batch.schema)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("least", "a"))
    return (
        join_per_key(both, least, ["a"]).filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    peers = join_per_key(links, least, ["a"]).filter(F.col("b") != F.col("least"))
    return peers.select(F.col("b").alias("a"), F.col("least").alias("b")).union(least).distinct()


def _is_stars(links: DataFrame) -> bool:
    """No node is both below and above another, and none is below two."""
    twice = links.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1")
    inner = links.select(F.col("b").alias("a")).join(links.select("a"), "a", "left_semi")
    return twice.select("a").union(inner).isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of links ``a``, ``b``: the smallest node reachable.

    Links may come in either direction and repeatedly; a link to itself counts for nothing.
    """
    links = links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = settle(links.mapInArrow(_thin, links.schema).distinct())
    while not _is_stars(links):
        links = settle(_small_star(settle(_large_star(links))))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
