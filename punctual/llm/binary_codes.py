"""Near-duplicate vectors by randomised-rotation binary codes.

A unit vector is turned by random rotations; the signs of its parts are its code. Bits
of the code name buckets, in several tables; pairs that share a bucket are candidates.
For a candidate pair, the sign code of one vector, its stored correction factor and the
other vector give an unbiased estimate of their inner product, with a confidence bound.
Where the bound cannot reach the wanted cosine the pair is dropped; all others are
computed exactly. Pairs stay inside the tasks: what leaves them are counts per vector
and one edge per vector to the smallest one of its group.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.llm.graph import components
from punctual.llm.vectors import matrix, rotations, usable
from punctual.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 71
# A pair at the threshold shares no bucket with at most this probability.
MISSED = 1e-6
# Members of a bucket that meet in one block; larger buckets are compared in blocks.
BLOCK_ROWS = 256
# Width of the confidence bound, in units of the estimate's error.
SIGMAS = 6.0
# Pairs that are held at a time.
PAIRS = 1 << 16

FOUND = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("n_links", T.LongType()),
    T.StructField("root", T.LongType()),
])


def plan_tables(similarity: float, most: int) -> tuple[int, int]:
    """Bits per bucket and number of tables, for groups of up to ``most`` vectors.

    Unrelated vectors share a bucket by chance; two bits more than the group's size
    asks for keep that rare at any size.
    """
    bits = min(max(8, math.ceil(math.log2(max(most, 2))) + 2), 30)
    agree = (1 - math.acos(similarity) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(MISSED) / math.log1p(-agree)))


def _encode(bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            codes = np.zeros((batch.num_rows, tables), dtype=np.int32)
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                if dim not in turns:
                    turns[dim] = rotations(int(dim), -(-bits * tables // int(dim)), SEED)
                vectors = matrix(batch.column("vector").take(pa.array(own)))
                signs = (vectors @ turns[dim].T)[:, : bits * tables] > 0
                codes[own] = signs.reshape(len(own), tables, bits) @ (1 << np.arange(bits))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * tables),
                pa.array(codes.reshape(-1)),
            )
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "grp", "dim", "vector")), lists],
                ["row", "grp", "dim", "vector", "codes"],
            )
    return run


class _Block:
    """Rows of whole blocks of one dimension, sorted by block."""

    def __init__(self, batch: pa.RecordBatch, similarity: float):
        self.similarity = similarity
        self.row = batch.column("row").to_numpy()
        self.grp = batch.column("grp").to_numpy()
        self.table = batch.column("tbl").to_numpy()
        self.side = batch.column("chunk").to_numpy()
        self.crossed = batch.column("crossed").to_numpy(zero_copy_only=False)
        self.codes = batch.column("codes").flatten().to_numpy().reshape(len(self.row), -1)
        vectors = matrix(batch.column("vector"))
        self.vectors = vectors / np.linalg.norm(vectors, axis=1)[:, None]
        dim = self.vectors.shape[1]
        self.turned = (self.vectors @ rotations(dim, 1, SEED).T).astype(np.float32)
        self.signs = np.where(self.turned > 0, 1, -1).astype(np.float32) / np.float32(dim**0.5)
        # The inner product of a vector and its code: the correction factor.
        self.factor = np.einsum("ij,ij->i", self.signs, self.turned)
        spread = (1 - self.factor.astype(np.float64) ** 2).clip(0) / max(dim - 1, 1)
        self.bound = SIGMAS * np.sqrt(spread) / self.factor + 1e-5

    def linked(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that are links, each in the first table only in which it meets."""
        keep = (self.row[a] != self.row[b]) & (self.grp[a] == self.grp[b])
        keep &= ~self.crossed[a] | (self.side[a] != self.side[b])
        a, b = a[keep], b[keep]
        first = (self.codes[a] == self.codes[b]).argmax(axis=1) == self.table[a]
        a, b = a[first], b[first]
        for _ in range(2):  # by the code of one, then by that of the other
            estimate = np.einsum("ij,ij->i", self.signs[a], self.turned[b]) / self.factor[a]
            near = estimate + self.bound[a] >= self.similarity
            a, b = b[near], a[near]
        exact = np.einsum("ij,ij->i", self.vectors[a], self.vectors[b]) >= self.similarity
        return a[exact], b[exact]


def _pairs(block: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of positions with the same value, some at a time; ``block`` is sorted."""
    size = len(block)
    ends = np.searchsorted(block, block, side="right")
    left = ends - np.arange(size) - 1  # partners that follow
    start = 0
    while start < size:
        stop = max(start + 1, int(np.searchsorted(
            np.cumsum(left[start:]), PAIRS, side="right") + start))
        count = left[start:stop]
        a = np.repeat(np.arange(start, stop), count)
        before = np.cumsum(count) - count
        b = a + 1 + np.arange(len(a)) - np.repeat(before, count)
        if len(a):
            yield a, b
        start = stop


def _roots(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest connected position of every position."""
    root = np.arange(size)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _compare(similarity: float):
    def found(part: pa.RecordBatch) -> pa.RecordBatch:
        dims = part.column("dim").to_numpy()
        rows, counts, tops = [], [], []
        for dim in np.unique(dims):
            own = part.take(pa.array(np.flatnonzero(dims == dim)))
            data = _Block(own, similarity)
            ids, at = np.unique(data.row, return_inverse=True)
            links = [data.linked(a, b) for a, b in _pairs(own.column("block").to_numpy())]
            a = at[np.concatenate([x for x, _ in links])] if links else at[:0]
            b = at[np.concatenate([y for _, y in links])] if links else at[:0]
            number = np.bincount(a, minlength=len(ids)) + np.bincount(b, minlength=len(ids))
            some = np.flatnonzero(number)
            rows.append(ids[some])
            counts.append(number[some])
            tops.append(ids[_roots(len(ids), a, b)[some]])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c).astype(np.int64)) for c in (rows, counts, tops)],
            FOUND.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            block = held.column("block").to_numpy()
            whole = int(np.searchsorted(block, block[-1]))  # the last block may go on
            if whole:
                yield found(held.slice(0, whole).combine_chunks().to_batches()[0])
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield found(held.combine_chunks().to_batches()[0])
    return run


def near_vectors(vectors: DataFrame, similarity: float = 0.98) -> DataFrame:
    """Links among the rows of ``vectors(vec_id, embedding, label)``.

    Two rows are linked when their labels are equal and not null, their vectors have the
    same length and the cosine is at least ``similarity``. Columns: ``vec_id``,
    ``n_links`` (other rows linked directly), ``component_id`` (smallest ``vec_id``
    reachable, itself included) and ``kept`` (``vec_id`` is the ``component_id``).

    Vectors that are null, empty or zero, or hold a null or a value that is not finite,
    link with nothing. Repeated rows are rows of their own and link with each other. A
    null ``vec_id`` takes part, but names a component only if no other id does. An
    empty table gives an empty result; further columns are ignored.
    """
    stored = materialize(vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(usable(F.col("embedding")), F.col("embedding").cast("array<double>")).alias("vector"),
        F.col("label").cast("long").alias("grp"), F.monotonically_increasing_id().alias("row"),
    ), "vectors")
    sound = stored.filter("vector is not null and grp is not null").withColumn(
        "dim", F.size("vector")
    )
    most = sound.groupBy("grp", "dim").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    bits, tables = plan_tables(similarity, most)
    layout = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("grp", T.LongType()),
        T.StructField("dim", T.IntegerType()), T.StructField("vector", T.ArrayType(T.DoubleType())),
        T.StructField("codes", T.ArrayType(T.IntegerType())),
    ])
    coded = materialize(
        sound.select("row", "grp", "dim", "vector").mapInArrow(_encode(bits, tables), layout),
        "codes",
    )
    placed = coded.select("row", "grp", "dim", F.posexplode("codes").alias("tbl", "code"))
    placed = placed.select("row", "tbl", F.xxhash64("grp", "dim", "tbl", "code").alias("bucket"))
    counts = placed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    chunks = F.ceil(F.col("n") / BLOCK_ROWS).cast("int")
    members = placed.join(counts, "bucket").withColumn("chunks", chunks).withColumn(
        "chunk", F.pmod(F.xxhash64("row", "bucket"), F.col("chunks")).cast("int")
    )
    # Block (i, j) holds chunks i and j of a bucket, block (i, i) only the one.
    blocks = members.withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    ).select(
        "row", "tbl", "chunk", (F.col("chunk") != F.col("other")).alias("crossed"),
        F.xxhash64("bucket", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("block"),
    )
    compared = blocks.join(coded, "row").repartition("block").sortWithinPartitions("block")
    found = materialize(compared.select(
        "block", "row", "tbl", "chunk", "crossed", "grp", "dim", "vector", "codes"
    ).mapInArrow(_compare(similarity), FOUND), "found")
    links = found.groupBy("row").agg(F.sum("n_links").alias("n_links"))
    roots = components(found.select(F.col("root").alias("a"), F.col("row").alias("b")))
    placed_rows = stored.select("row", "vec_id").join(
        roots.withColumnRenamed("node", "row"), "row", "left"
    ).withColumn("root", F.coalesce("root", "row"))
    named = materialize(placed_rows, "rooted")
    least = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return named.join(least, "root").join(links, "row", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
