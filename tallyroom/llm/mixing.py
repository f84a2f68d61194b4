"""Mixing sources to target weights by capped water-filling.

Sources share a total by weight; one whose share exceeds a number of epochs of
its own words is clamped there and the excess goes to the others by weight,
until none is above.  The level of that fixed point is the largest of the
levels reached when sources are clamped in order of words per weight, so a
window over one row per source finds it.  A document is then taken a whole
number of times, and once more if it lies, in a seeded order, in the part of
its source that makes up the remaining fraction.

Defined results: a null or empty text has size 0 and is taken as words 0.  A
null source is a source of its own, last in order.  Null ids are allowed.
Repeated rows follow each other in the order; where the target ends among them,
as many of them are taken as it needs.  Texts are read whole, however long.
Sources without a word get target 0.  Extra columns are kept and may have any name; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyroom.operators.hot_keys import join_per_key

from .common import null_safe, settle, small_side

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2.0
SEED = 17
#: Documents of a source are ordered in key ranges of about this many.
RANGE_ROWS = 10_000

_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def order_key(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """The document's place in the seeded order, as 32 hex digits."""
    blank = F.lit("")
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), blank), F.coalesce(F.md5(text), blank)))


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """One row per source of ``sized`` (``host``, ``source``, ``size``): its size, documents and target words."""
    per_source = sized.groupBy("host", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((rank - 1) % len(weights) + 1).cast("int"))
    whole, clamp_order = Window.partitionBy(), Window.orderBy("ratio", "source")
    cap = epochs * F.col("source_size")
    clamped = F.coalesce(F.sum("cap").over(clamp_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(clamp_order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return (
        per_source.withColumn("weight", weight)
        .withColumn("cap", cap)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", share * F.sum("source_size").over(whole))
        .withColumn("level", (F.col("total") - clamped) / open_weight)
        .withColumn("target", F.least("cap", F.max("level").over(whole) * F.col("weight")))
        .select("host", "source_size", "documents", "target")
    )


def _with_cuts(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets with the ``whole`` repetitions of each document, the last key that gets one more, ``cut``, and how many rows of that key do, ``last``."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = targets.withColumn("whole", whole.cast("long")).withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
    ranges = F.greatest(F.ceil(F.col("documents") / RANGE_ROWS), F.lit(1))
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    # Repeated rows have one key; they are counted here, however many they are.
    per_key = sized.groupBy("host", "key").agg(F.max("size").alias("size"), F.count("*").alias("rows"))
    placed = join_per_key(per_key, plan.select("host", "extra", "documents"), ["host"]).select(
        "host", "size", "rows", "key", "extra", F.floor(place * ranges / F.lit(2.0**32)).alias("range")
    )
    words = F.col("size") * F.col("rows")
    per_range = placed.groupBy("host", "range").agg(F.sum(words).alias("words"))
    before = F.sum("words").over(Window.partitionBy("host").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    starts = per_range.select("host", "range", F.coalesce(before, F.lit(0)).alias("start"))
    inside = F.sum(words).over(Window.partitionBy("host", "range").orderBy("key").rowsBetween(Window.unboundedPreceding, -1))
    ordered = placed.withColumn("inside", F.coalesce(inside, F.lit(0))).join(starts, ["host", "range"])
    # A row is taken if more than half of it, at least, is wanted.
    room = 2 * F.col("extra") - 2 * (F.col("start") + F.col("inside")) - F.col("size")
    fitting = F.when(F.col("size") > 0, F.least("rows", F.floor(room / (2 * F.col("size"))) + 1)).otherwise(F.col("rows"))
    cuts = ordered.filter(room >= 0).groupBy("host").agg(F.max(F.struct("key", fitting.cast("long").alias("last"))).alias("cut"))
    cuts = cuts.select("host", F.col("cut.key").alias("cut"), F.col("cut.last").alias("last"))
    return plan.drop("extra").join(cuts, "host", "left")


def mixing_plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS, seed: int = SEED):
    """(sized documents, one row per source with ``target``, ``whole``, ``cut`` and ``last``), both stored."""
    sized = settle(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            "source",
            null_safe("source").alias("host"),
            word_count(F.col("text")).alias("size"),
            order_key(F.col("doc_id").cast("long"), F.col("text"), seed).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    return sized, settle(_with_cuts(sized, settle(source_targets(sized, weights, share, epochs))))


def _last_rows(tied: DataFrame) -> DataFrame:
    """Per host the largest ``row`` that gets one more, of stored rows that have the host's cut key (``host``, ``row``, ``last``).

    Rows are counted by stretches of row numbers, and only the stretch in which
    the last one lies is numbered, so that very many repeated rows are no task's
    alone.
    """
    stretch = F.shiftright("row", 16)
    counts = tied.groupBy("host", "last", stretch.alias("stretch")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("host").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("before", F.coalesce(before, F.lit(0)))
    open_ = counts.filter((F.col("before") < F.col("last")) & (F.col("last") <= F.col("before") + F.col("n")))
    inside = tied.withColumn("stretch", stretch).join(small_side(settle(open_.select("host", "stretch", "before"))), ["host", "stretch"])
    number = F.row_number().over(Window.partitionBy("host", "stretch").orderBy("row"))
    return inside.withColumn("number", number).filter(F.col("before") + F.col("number") == F.col("last")).select("host", F.col("row").alias("last_row"))


def mix_sizes(docs: DataFrame, **parameters) -> DataFrame:
    """Per document its words, its source's words and target, the repetitions and the words taken."""
    sized, plan = mixing_plan(docs, **parameters)
    tied = sized.join(small_side(plan.select("host", "cut", "last")), "host").filter("key = cut").select("host", "row", "last")
    ends = small_side(settle(plan.join(_last_rows(tied), "host", "left")))
    once_more = F.coalesce((F.col("key") < F.col("cut")) | ((F.col("key") == F.col("cut")) & (F.col("row") <= F.col("last_row"))), F.lit(False))
    return (
        sized.join(ends, "host")
        .withColumn("repetitions", F.col("whole") + once_more.cast("int"))
        .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repetitions")).alias("taken"), "repetitions")
    )


def mix(docs: DataFrame, seed: int = SEED, **parameters) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    _, plan = mixing_plan(docs, seed=seed, **parameters)
    packed = docs.select(
        F.struct("*").alias("doc"),
        null_safe("source").alias("host"),
        order_key(F.col("doc_id").cast("long"), F.col("text"), seed).alias("key"),
    ).join(small_side(plan.select("host", "whole", "cut", "last")), "host")
    # The rows of a cut key, one or very many, are stored, so that which of them get one more holds.
    tied = settle(packed.filter("key = cut").select("doc", "host", "last", F.monotonically_increasing_id().alias("row")))
    more = tied.join(F.broadcast(_last_rows(tied.drop("doc"))), "host").filter("row <= last_row").select("doc")
    repetitions = F.col("whole") + F.coalesce(F.col("key") < F.col("cut"), F.lit(False)).cast("int")
    taken = packed.withColumn("repetitions", repetitions).filter("repetitions > 0")
    repeated = taken.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), "repetitions"))).select("doc").union(more)
    return repeated.select(*(F.col("doc").getField(c).alias(c) for c in docs.columns))
