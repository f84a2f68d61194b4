"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_RANK = "__attempt_rank"


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], ties: Sequence[str] = ()) -> DataFrame:
    """The first row of each key under ``order``.

    ``ties`` names columns that settle equal rows, so that a recomputed task
    picks the same row again.  NULL keys form one group.

    Because only rank 1 is kept, Spark prunes each map task to one row per key
    before the shuffle (WindowGroupLimit): a key that holds a third of the
    table reaches its reducer as one row per task, not as a third of the table.
    """
    tie_order = [F.col(c).asc_nulls_last() for c in ties]
    ranked = Window.partitionBy(*keys).orderBy(*order, *tie_order)
    return df.withColumn(_RANK, F.row_number().over(ranked)).filter(F.col(_RANK) == 1).drop(_RANK)
