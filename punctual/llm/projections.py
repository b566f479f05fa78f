"""Nearest vectors by stable random projections and a kd-tree.

The largest inner product becomes the smallest distance by one more dimension: a vector
gets the part that brings its length to the largest one, a query gets zero. Gaussian
projections to a few dimensions are 2-stable: squared projected over squared true
distance is chi-square distributed. The projections are indexed by a kd-tree, whose
upper part divides the rows into cells and whose lower part is built inside a cell.
A query takes leaves in order of projected distance, compares their vectors exactly, and
stops when a vector as near as its k-th neighbour so far would with high probability
have been met before.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.llm.vectors import matrix, usable
from punctual.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 23
DIMENSIONS = 8  # even, which gives the chi-square distribution a closed form
# Numbers in a matrix of queries by cells.
MOST_GAPS = 1 << 22
# Certainty at which a query stops.
CERTAINTY = 0.95
# The upper tree is fitted on at most this many rows; all rows are indexed.
SAMPLE_ROWS = 20_000
CELL_ROWS = 8192
MOST_CELLS = 1 << 16  # bounds the table of boxes that goes to every task to 8 MB
QUERY_ROWS = 2048
LEAF_ROWS = 256
# Scores that differ by less are compared by id; the result has the exact scores.
SAME = 1e-12

HITS = T.StructType([
    T.StructField("query", T.LongType()), T.StructField("query_id", T.LongType()),
    T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType()),
])
POINT = [
    T.StructField("row", T.LongType()), T.StructField("vec_id", T.LongType()),
    T.StructField("vector", T.ArrayType(T.DoubleType())),
    T.StructField("place", T.ArrayType(T.DoubleType())), T.StructField("cell", T.IntegerType()),
]


def chi_square(x: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Distribution function of the chi-square law with an even number of dimensions."""
    half = np.minimum(np.asarray(x, dtype=np.float64) / 2, 700)
    term, total = np.ones_like(half), np.zeros_like(half)
    for k in range(dimensions // 2):
        total += term
        term = term * half / (k + 1)
    return 1 - np.exp(-half) * total


class Tree:
    """Median splits of a sample; a complete binary tree over the projections."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.axis = np.zeros(1 << depth, dtype=np.int64)
        self.cut = np.zeros(1 << depth)
        parts = {1: sample}
        for node in range(1, 1 << depth):
            points = parts.pop(node)
            if len(points):
                self.axis[node] = np.ptp(points, axis=0).argmax()
                self.cut[node] = np.median(points[:, self.axis[node]])
            low = points[:, self.axis[node]] < self.cut[node] if len(points) else []
            parts[2 * node], parts[2 * node + 1] = points[low], points[~np.asarray(low, bool)]

    def cells(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), dtype=np.int64)
        for _ in range(self.depth):
            high = points[np.arange(len(points)), self.axis[node]] >= self.cut[node]
            node = 2 * node + high
        return (node - (1 << self.depth)).astype(np.int32)


def _project(vectors: np.ndarray, extra: np.ndarray) -> np.ndarray:
    weights = np.random.default_rng([SEED, vectors.shape[1]]).standard_normal(
        (DIMENSIONS, vectors.shape[1] + 1)
    )
    return vectors @ weights[:, :-1].T + np.outer(extra, weights[:, -1])


def _lists(values: np.ndarray) -> pa.Array:
    count, width = values.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(count + 1, dtype=np.int32) * width), pa.array(values.reshape(-1))
    )


def _index(tree: Tree | None, largest: float, of_query: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = matrix(batch.column("vector"))
            lengths = np.einsum("ij,ij->i", vectors, vectors)
            extra = np.sqrt(np.maximum(largest - lengths, 0)) * (not of_query)
            places = _project(vectors, extra)
            cells = tree.cells(places) if tree else np.zeros(len(places), np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "vec_id", "vector")), _lists(places),
                 pa.array(cells)], [f.name for f in POINT],
            )
    return run


def _gaps(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every box."""
    total = np.zeros((len(points), len(low)))
    for k in range(points.shape[1]):
        x = points[:, k, None]
        total += np.maximum(np.maximum(low[:, k] - x, x - high[:, k]), 0) ** 2
    return total


def _stops(gaps: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """The stopping test: projected distances against those of the k-th neighbours."""
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(reach > 0, gaps / reach, np.where(gaps > 0, np.inf, 0.0))
    return chi_square(np.nan_to_num(ratio, posinf=1400.0)) >= CERTAINTY


def _leaves(places: np.ndarray) -> list[np.ndarray]:
    done, parts = [], [np.arange(len(places))]
    while parts:
        own = parts.pop()
        if len(own) <= LEAF_ROWS:
            done.append(own)
            continue
        axis = np.ptp(places[own], axis=0).argmax()
        order = own[np.argsort(places[own, axis], kind="stable")]
        parts += [order[: len(order) // 2], order[len(order) // 2 :]]
    return done


def _search(k: int, largest: float):
    def run(queries: pa.Table, points: pa.Table) -> pa.Table:
        if not queries.num_rows or not points.num_rows:
            return HITS_ARROW.empty_table()
        asked, stored = matrix(queries.column("vector")), matrix(points.column("vector"))
        q_row, p_row = queries.column("row").to_numpy(), points.column("row").to_numpy()
        q_place, p_place = matrix(queries.column("place")), matrix(points.column("place"))
        bar = queries.column("bar").to_numpy().copy()  # score of the k-th neighbour so far
        length = np.einsum("ij,ij->i", asked, asked)
        leaves = _leaves(p_place)
        low = np.array([p_place[x].min(axis=0) for x in leaves])
        high = np.array([p_place[x].max(axis=0) for x in leaves])
        gaps = _gaps(q_place, low, high)
        order = np.argsort(gaps, axis=1)
        active = np.arange(len(asked))
        best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        order_of_id = np.empty(len(p_row), dtype=np.int64)  # a null id is the last
        order_of_id[pc.sort_indices(points.column("vec_id")).to_numpy()] = np.arange(len(p_row))
        for step in range(len(leaves)):
            leaf = order[active, step]
            reach = np.maximum(length[active] + largest - 2 * bar[active], 0)
            going = ~_stops(gaps[active, leaf], reach)
            active, leaf = active[going], leaf[going]
            if not len(active):
                break
            found = [best]
            for one in np.unique(leaf):
                who, rows = active[leaf == one], leaves[one]
                scores = asked[who] @ stored[rows].T
                near = (scores >= bar[who, None] - SAME) & (q_row[who, None] != p_row[rows])
                a, b = np.nonzero(near)
                found.append([who[a], rows[b], scores[a, b]])
            who, at, score = (np.concatenate(c) for c in zip(*found))
            rank = np.lexsort((order_of_id[at], -np.round(score / SAME) * SAME, who))
            who, at, score = who[rank], at[rank], score[rank]
            first = np.searchsorted(who, who)
            nth = np.arange(len(who)) - first
            keep = nth < k
            last = who[nth == k - 1]
            bar[last] = np.maximum(bar[last], score[nth == k - 1])
            best = [who[keep], at[keep], score[keep]]
        who, at, _ = best
        exact = np.einsum("ij,ij->i", asked[who], stored[at])
        return pa.Table.from_arrays([
            pa.array(q_row[who]), queries.column("vec_id").take(pa.array(who)),
            points.column("vec_id").take(pa.array(at)), pa.array(exact),
        ], schema=HITS_ARROW)
    return run


HITS_ARROW = pa.schema([
    ("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()),
])


def _visit(asked: DataFrame, points: DataFrame, counts: DataFrame, k: int, largest: float) -> DataFrame:
    """Searches the pairs of query and cell in ``asked``, in blocks of bounded size."""
    chunks = asked.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("chunks"))
    plan = materialize(counts.join(chunks, "cell"), "visits")

    def split(row: str, number: str) -> Column:
        return F.pmod(F.xxhash64(row), F.col(number)).cast("int")

    def every(number: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(number) - 1))

    left = asked.join(plan, "cell").withColumn("chunk", split("row", "chunks")).withColumn(
        "part", every("parts"))
    right = points.join(plan, "cell").withColumn("part", split("row", "parts")).withColumn(
        "chunk", every("chunks"))
    keys = ["cell", "part", "chunk"]
    return left.select(*keys, "row", "vec_id", "vector", "place", "bar").groupBy(*keys).cogroup(
        right.select(*keys, "row", "vec_id", "vector", "place").groupBy(*keys)
    ).applyInArrow(_search(k, largest), HITS)


def _other_cells(boxes: tuple[np.ndarray, np.ndarray, np.ndarray], largest: float, fields):
    cells, low, high = boxes

    step = max(1, MOST_GAPS // len(cells))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                vectors, home = matrix(batch.column("vector")), batch.column("cell").to_numpy()
                reach = np.einsum("ij,ij->i", vectors, vectors) + largest
                reach = np.maximum(reach - 2 * batch.column("bar").to_numpy(), 0)
                gaps = _gaps(matrix(batch.column("place")), low, high)
                open_cells = ~_stops(gaps, reach[:, None]) & (home[:, None] != cells)
                row, at = np.nonzero(open_cells)
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([
                    pa.array(cells[at]) if f == "cell" else taken.column(f) for f in fields
                ], fields)
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """The ``k`` rows of ``vectors(vec_id, embedding)`` with the largest inner product.

    ``is_query`` chooses the queries among the rows; candidates are all other rows than
    the query's own. Columns: ``query_id``, ``rank`` (from 1; the largest score first,
    ties to the smaller ``vec_id``), ``vec_id`` and ``score`` (inner product of the
    vectors as they are, in doubles). The search is approximate in which rows it finds;
    a query with fewer candidates gets them all.

    Vectors that are null, empty or zero, or hold a null or a value that is not finite,
    take no part. Vectors of different lengths have no inner product: a query's candidates
    are the vectors of its own length, and every length is searched for itself. Repeated
    rows are rows of their own. An empty table gives an empty result; further columns are
    ignored.
    """
    stored = materialize(vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"), usable(F.col("embedding")).alias("usable"),
    ).filter("usable").drop("usable").withColumn("row", F.monotonically_increasing_id()), "vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    lengths = stored.groupBy(F.size("vector").alias("length")).agg(
        F.count("*").alias("count"), F.max(square).alias("largest")
    ).orderBy("length").collect()  # one row for each length, mostly one
    found = [
        _nearest_of_length(
            stored if len(lengths) == 1 else stored.filter(F.size("vector") == r["length"]),
            r["count"], r["largest"], k,
        ) for r in lengths
    ]
    return reduce(DataFrame.unionByName, found) if found else _nearest_of_length(stored, 0, 0.0, k)


def _nearest_of_length(stored: DataFrame, count: int, largest: float, k: int) -> DataFrame:
    """The search among ``count`` vectors of one length, the longest of which has the
    square ``largest``."""
    layout = T.StructType(POINT)
    plain = stored.select("row", "vec_id", "vector")
    depth = min(int(math.log2(MOST_CELLS)), max(0, math.ceil(math.log2(max(count, 1) / CELL_ROWS))))
    tree = None
    if depth:
        share = min(1.0, SAMPLE_ROWS / count)
        sample = plain.filter(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(share * (1 << 30)))
        places = sample.limit(SAMPLE_ROWS).mapInArrow(_index(None, largest, False), layout)
        tree = Tree(np.array([r["place"] for r in places.select("place").collect()]), depth)
    points = materialize(plain.mapInArrow(_index(tree, largest, False), layout), "points")
    counts = materialize(points.groupBy("cell").agg(
        F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("parts"),
        *[agg(F.col("place")[i]).alias(f"{name}{i}") for i in range(DIMENSIONS)
          for name, agg in (("low", F.min), ("high", F.max))],
    ), "cells")
    boxes = counts.collect()  # at most MOST_CELLS rows
    queries = materialize(
        stored.filter("is_query").select("row", "vec_id", "vector").mapInArrow(
            _index(tree, largest, True), layout
        ).withColumn("bar", F.lit(float("-inf"))), "queries",
    )
    first = materialize(_visit(queries, points, counts.select("cell", "parts"), k, largest), "first")
    nth = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    kth = first.withColumn("rank", F.row_number().over(nth)).filter(F.col("rank") == k).select(
        F.col("query").alias("row"), F.col("score").alias("kth")
    )
    hits = first
    if len(boxes) > 1:
        fields = [*layout.names, "bar"]
        barred = queries.drop("bar").join(kth, "row", "left").withColumn(
            "bar", F.coalesce("kth", F.lit(float("-inf")))
        ).select(fields)
        table = tuple(np.array(c) for c in (
            [b["cell"] for b in boxes],
            [[b[f"low{i}"] for i in range(DIMENSIONS)] for b in boxes],
            [[b[f"high{i}"] for i in range(DIMENSIONS)] for b in boxes],
        ))
        asked = barred.mapInArrow(
            _other_cells((table[0].astype(np.int32), table[1], table[2]), largest, fields),
            T.StructType([*POINT, T.StructField("bar", T.DoubleType())]),
        )
        asked = materialize(asked, "asked")
        hits = first.unionByName(_visit(asked, points, counts.select("cell", "parts"), k, largest))
    ranked = hits.withColumn("rank", F.row_number().over(nth)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
