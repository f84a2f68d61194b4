"""Near-duplicate embeddings by an exact metric range join over pivot cells.

Unit vectors whose cosine is at least c are at most eps = sqrt(2 - 2c) apart.
Pivots drawn from the data cut space into cells, each vector at home with its
nearest pivot.  If y, at home in cell j, is within eps of x, at home in cell i,
the triangle inequality gives d(x, p_j) <= d(x, p_i) + 2 eps, and x is also
within eps of the plane between the two pivots.  So x is repeated in cell j only
if both hold, and each pair of cells is settled in one of the two.  Cells are
joined independently, in pairs of blocks of bounded size.

Equal vectors are one class, compared once.  A block gives, for each class, the
number of vectors it links and one link that keeps its component together, not
all pairs.

Defined results: a vector that is null, empty, zero or has a null or non-finite
component links with nothing, and is its own component.  Only vectors of the
same length can link.  Vectors of any length are taken whole.  A null id takes no part in a component's smallest id.
Repeated rows are different vectors.  Extra columns are ignored, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.operators.hot_keys import join_per_key

from .common import settle, small_side
from .components import connected_components

COSINE = 0.95
#: Pivots are drawn so that a cell is home to a twelfth of all classes, but to this many at most and 1,024 at least, if that
#: takes no more than MAX_PIVOTS.
CELL = 8192
LEAST_CELL, LEAST_CELLS = 1024, 12
MAX_PIVOTS = 1024
#: Most rows of one side of a block, about; a block's links are a matrix of as many bytes squared.
BLOCK = 8192
#: Rows of a block that are multiplied or followed at a time.
STRIP = 512
#: Room for rounding in the bounds, which only ever adds repetitions; distances near zero are that inexact.
SLACK = 1e-6
#: Components of pairs at the threshold that are multiplied again at a time.
AGAIN = 4_000_000


def _scaled(vectors: pa.Array) -> np.ndarray:
    """Vectors in double precision, by powers of two made such that no square is lost or too large."""
    rows = np.frombuffer(b"".join(vectors.to_pylist()), "<f8").reshape(len(vectors), -1)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Unit vectors in double precision."""
    return _unit(_scaled(vectors))


def _cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cosine of each row with its partner, added up in order, so that it is the same in whatever block they meet."""

    def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.add.accumulate(a * b, axis=1)[:, -1]

    return product(left, right) / np.sqrt(product(left, left) * product(right, right))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = []
        for vector in batch.column("embedding"):
            values = np.zeros(0)
            if vector.is_valid and not vector.values.null_count:
                values = vector.values.to_numpy().astype("<f8") + 0.0  # one zero
            good = len(values) and np.isfinite(values).all() and values.any()
            packed.append(values.tobytes() if good else None)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(packed, pa.binary())], ["vec_id", "vec"])


def _assigned(pivots: dict[int, np.ndarray], eps: float):
    """Rows of classes in their home cell and in each other cell that they may reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        between = {n: np.sqrt(np.maximum(0, 2 - 2 * p @ p.T)) for n, p in pivots.items()}
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("vec").to_pylist()])
            for n in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == n)))
                cos = _matrix(part.column("vec")) @ pivots[n].T
                home = cos.argmax(axis=1)
                nearest = cos[np.arange(len(cos)), home][:, None]
                reach = np.sqrt(np.maximum(0, 2 - 2 * cos)) <= np.sqrt(np.maximum(0, 2 - 2 * nearest)) + 2 * eps + SLACK
                reach &= nearest - cos <= eps * between[n][home] + SLACK
                other, mine = np.arange(len(pivots[n]))[None, :], home[:, None]
                reach &= np.where((other + mine) % 2 == 0, mine < other, mine > other)  # one of the two cells settles a pair
                rows, cells = np.nonzero(reach)
                at = np.concatenate([np.arange(len(cos)), rows])
                columns = [
                    pa.array(np.full(len(at), n, np.int64)),
                    pa.array(np.concatenate([home, cells]).astype(np.int64)),
                    pa.array(np.arange(len(at)) < len(cos)),
                    *(part.column(c).take(pa.array(at)) for c in ("cls", "copies", "vec")),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["width", "cell", "home", "cls", "copies", "vec"])

    return run


def _strips(rows: int) -> Iterator[slice]:
    return (slice(first, first + STRIP) for first in range(0, rows, STRIP))


def _near(left: np.ndarray, right: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of two matrices of scaled vectors are linked; products are made a strip at a time.

    A product of unit vectors is rounded differently from the cosine; where that may decide, the cosine does.
    """
    near = np.empty((len(left), len(right)), bool)
    unit_left, unit_right = _unit(left), _unit(right)
    room = 4 * (left.shape[1] + 4) * np.finfo(float).eps
    for strip in _strips(len(left)):
        products = unit_left[strip] @ unit_right.T
        near[strip] = products >= cosine - room
        at = np.flatnonzero(near[strip])
        rows, columns = np.divmod(at[products.ravel()[at] < cosine + room], len(right))
        rows += strip.start
        many = max(1, AGAIN // left.shape[1])
        for i, j in ((rows[k : k + many], columns[k : k + many]) for k in range(0, len(rows), many)):
            near[i, j] = _cosines(left[i], right[j]) >= cosine
    return near


def _least_linked(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a matrix of links between rows and columns, the smallest row that each row and each column is connected with."""
    none = np.int32(near.shape[0])
    rows, columns = np.arange(near.shape[0], dtype=np.int32), np.full(near.shape[1], none)
    while True:
        least = rows.copy()
        for strip in _strips(near.shape[0]):
            columns = np.minimum(columns, np.where(near[strip], rows[strip, None], none).min(axis=0))
        for strip in _strips(near.shape[0]):
            least[strip] = np.minimum(rows[strip], np.where(near[strip], columns[None, :], none).min(axis=1))
        if (least == rows).all():
            return rows, columns
        rows = least


def _weighted(near: np.ndarray, copies_right: np.ndarray, copies_left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many vectors each row and each column links, its partners' copies counted."""
    of_rows, of_columns = np.zeros(near.shape[0], np.int64), np.zeros(near.shape[1], np.int64)
    for strip in _strips(near.shape[0]):
        of_rows[strip] = near[strip] @ copies_right
        of_columns += copies_left[strip] @ near[strip]
    return of_rows, of_columns


def _block_links(cosine: float):
    def run(block: pa.Table) -> pa.Table:
        left_side = block.column("left").to_numpy()
        left, right = block.filter(pa.array(left_side)), block.filter(pa.array(~left_side))
        alone = not len(right) and block.column("within")[0].as_py()
        if alone:
            right = left
        empty = pa.table({"cls": pa.array([], pa.string()), "links": pa.array([], pa.int64()), "peer": pa.array([], pa.string())})
        if not len(left) or not len(right):
            return empty
        near = _near(_scaled(left.column("vec").combine_chunks()), _scaled(right.column("vec").combine_chunks()), cosine)
        if alone:
            np.fill_diagonal(near, False)
        rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        if not len(rows):
            return empty
        near = near[np.ix_(rows, columns)]
        some_left, some_right = left.take(pa.array(rows)), right.take(pa.array(columns))
        links_left, links_right = _weighted(near, some_right.column("copies").to_numpy(), some_left.column("copies").to_numpy())
        if alone:
            np.fill_diagonal(near, True)  # a row and its column are one class; else two that link only each other stay apart
        least_left, least_right = _least_linked(near)
        names = some_left.column("cls")
        sides = [(some_left, links_left, least_left)]
        if not alone:
            sides.append((some_right, links_right, least_right))
        return pa.concat_tables(
            pa.table({"cls": side.column("cls"), "links": pa.array(links), "peer": names.take(pa.array(peer))})
            for side, links, peer in sides
        )

    return run


def _blocks(assigned: DataFrame, block: int) -> DataFrame:
    """Each row in every pair of blocks of its cell that it takes part in."""
    sizes = assigned.groupBy("width", "cell").agg(F.count_if("home").alias("at_home"), F.count_if(~F.col("home")).alias("guests"))
    sizes = settle(
        sizes.select("width", "cell", F.ceil(F.col("at_home") / block).alias("homes"), F.ceil(F.col("guests") / block).alias("visits"))
    )
    own = F.pmod(F.xxhash64("cls"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("visits")))
    rows = assigned.join(small_side(sizes), ["width", "cell"]).filter("homes > 0").withColumn("own", own)
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    among = rows.filter("home").select("*", F.explode(upto("homes")).alias("other")).withColumn("with_guests", F.lit(False))
    hosts = rows.filter("home and visits > 0").select("*", F.explode(upto("visits")).alias("other")).withColumn("with_guests", F.lit(True))
    guests = rows.filter("not home").select("*", F.explode(upto("homes")).alias("other")).withColumn("with_guests", F.lit(True))
    among = among.withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other"))
    among = among.withColumn("left", F.col("own") == F.col("a"))
    hosts = hosts.withColumn("a", F.col("own")).withColumn("b", F.col("other")).withColumn("left", F.lit(True))
    guests = guests.withColumn("a", F.col("other")).withColumn("b", F.col("own")).withColumn("left", F.lit(False))
    columns = ["width", "cell", "with_guests", "a", "b", "left", "cls", "copies", "vec"]
    both = among.select(*columns).union(hosts.select(*columns)).union(guests.select(*columns))
    return both.withColumn("within", ~F.col("with_guests") & (F.col("a") == F.col("b")))


def range_join(classes: DataFrame, cosine: float = COSINE, cell: int = CELL, max_pivots: int = MAX_PIVOTS, block: int = BLOCK) -> DataFrame:
    """Links of stored ``classes`` (``cls``, ``copies``, ``vec``): ``cls``, ``links`` (vectors linked in a block), ``peer`` (a class linked there, or ``cls``)."""
    pivots = {}
    for width, count in classes.groupBy(F.length("vec")).count().collect():  # a row per length of vectors
        at_home = min(cell, max(LEAST_CELL, math.ceil(count / LEAST_CELLS)))
        chosen = min(max_pivots, math.ceil(count / at_home))
        drawn = classes.filter(F.length("vec") == width).orderBy("cls").limit(chosen).select("vec").toArrow()
        pivots[width] = _matrix(drawn.column("vec").combine_chunks())
    schema = "width long, cell long, home boolean, cls string, copies long, vec binary"
    assigned = settle(classes.select("cls", "copies", "vec").mapInArrow(_assigned(pivots, math.sqrt(2 - 2 * cosine)), schema))
    blocks = _blocks(assigned, block).groupBy("width", "cell", "with_guests", "a", "b")
    return blocks.applyInArrow(_block_links(cosine), "cls string, links long, peer string")


def near_duplicate_vectors(vectors: DataFrame, cosine: float = COSINE, **sizes: int) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vec_id``, ``embedding``."""
    packed = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = settle(packed.mapInArrow(_packed, "vec_id long, vec binary").withColumn("cls", F.md5("vec")))
    good = rows.filter(F.col("vec").isNotNull())
    classes = settle(good.groupBy("cls", "vec").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least_id")))
    found = settle(range_join(classes, cosine, **sizes))
    roots = connected_components(found.select(F.col("cls").alias("a"), F.col("peer").alias("b")))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    placed = settle(
        classes.drop("vec")
        .join(links, "cls", "left")
        .join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        .select("cls", "least_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "cls").alias("root"))
    )
    ids = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    located = join_per_key(placed.drop("least_id"), ids, ["root"]).drop("root")
    linked = join_per_key(rows.filter(F.col("vec").isNotNull()).select("vec_id", "cls"), located, ["cls"])
    single = rows.filter(F.col("vec").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = linked.select("vec_id", "n_links", "component_id").union(single)
    return every.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
