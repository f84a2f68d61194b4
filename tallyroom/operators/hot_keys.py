"""Joining rows to one row per key when some keys hold a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_COMPANION = "__key_hash"


def join_per_key(rows: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``rows`` with ``per_key``, an aggregation by ``keys``, so that hot keys can be split.

    Spark splits an oversized join partition at run time only if both sides
    were shuffled for that join.  An aggregation by the same key would lend its
    own shuffle instead and pin a hot key, or all NULL keys of an outer join,
    to one task.  The hash as a second key rules that out; the price is to
    shuffle ``per_key`` once more, one row per key.
    """
    companion = F.xxhash64(*keys)
    joined = rows.withColumn(_COMPANION, companion).join(
        per_key.withColumn(_COMPANION, companion), [*keys, _COMPANION], how
    )
    return joined.drop(_COMPANION)
