"""Packing token sequences by cutting-stock column generation.

A document longer than a sequence fills whole sequences first; what is left, or a
shorter document, is one piece. Lengths are counted in classes. The linear program over
patterns (which classes share a sequence) is solved by column generation: a knapsack
dynamic program finds the pattern that the current prices favour most. Patterns are
rounded down, the few pieces left over are packed best-fit, and the pieces of a class,
ranked, take the places that the patterns have for their class.

Only the counts by class, at most one row per class, come to the driver.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 2048
CLASSES = 512  # lengths are rounded up to a multiple of LENGTH / CLASSES
END_ID = 1
# The program stops when the patterns need at most this share more than any could.
GAP = 5e-4
MOST_COLUMNS = 2000
# Runs of white space this long go round the pattern, whose backtracking stack ends at a
# million characters. The class is \s of the pattern; Python's holds U+001C to U+001F too.
LONG_RUN = 1 << 16
_RUN = re.compile(
    "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN
)

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()),
])


def _encoder(vocabulary: str | None):
    """The byte-level BPE with 50,257 ids, from its file of ranks."""
    import base64

    import public_tokenizers
    import tiktoken

    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding(
        "byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
        special_tokens={},
    )


def _ids(encoder, text: str) -> np.ndarray:
    """Ids of a text. The pattern makes one piece of a run of white space, less its last
    character if a word follows; long runs are cut out as that piece."""
    if len(text) < LONG_RUN:
        return encoder.encode_to_numpy(text)
    out, at = [], 0
    for run in _RUN.finditer(text):
        end = run.end() - (run.end() < len(text))
        out.append(encoder.encode_to_numpy(text[at : run.start()]))
        out.append(np.array(encoder._encode_single_piece(text[run.start() : end]), np.uint32))
        at = end
    out.append(encoder.encode_to_numpy(text[at:]))
    return np.concatenate(out)


def _cut(vocabulary: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        for batch in batches:
            out: list[tuple] = []
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, batch.column("text")):
                own = np.append(_ids(encoder, text.as_py() or ""), END_ID).astype("<u4")
                for start in range(0, len(own), LENGTH):
                    part = own[start : start + LENGTH]
                    out.append((doc_id, start, len(part), zlib.crc32(part.tobytes()), len(own)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out)], PIECES.names
                )
    return run


def _best_pattern(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Knapsack: the number of each size that fits into ``room`` at the highest price."""
    worth = np.zeros(room + 1)
    choice = np.full(room + 1, -1)
    for space in range(1, room + 1):
        worth[space] = worth[space - 1]
        fits = np.searchsorted(sizes, space, side="right")
        if fits:
            values = worth[space - sizes[:fits]] + prices[:fits]
            best = int(values.argmax())
            if values[best] > worth[space] + 1e-12:
                worth[space], choice[space] = values[best], best
    pattern = np.zeros(len(sizes))
    space = room
    while space > 0:
        if choice[space] < 0:
            space -= 1
        else:
            pattern[choice[space]] += 1
            space -= sizes[choice[space]]
    return float(worth[room]), pattern


def _first_columns(need: np.ndarray, sizes: np.ndarray, room: int) -> np.ndarray:
    """A start for the program: full patterns, large sizes first, one per size.

    Each pattern is used until one of its sizes has run out, so the columns are
    triangular in the order in which the sizes run out.
    """
    left, columns = need.copy(), np.zeros((len(sizes), len(sizes)))
    prices = sizes * (1 + sizes / (8.0 * room))
    while (left > 0).any():
        here = np.flatnonzero(left > 0)
        _, some = _best_pattern(prices[here], sizes[here], room)
        pattern = np.zeros(len(sizes))
        pattern[here] = some
        used = np.flatnonzero(pattern)
        times = left[used] / pattern[used]
        left[used] = left[used] - times.min() * pattern[used]
        out = used[np.abs(times - times.min()) <= 1e-9 * times.max()]
        left[out] = 0
        columns[:, out[0]] = pattern
        for k in out[1:]:
            columns[k, k] = room // sizes[k]
    return columns


def cutting_stock(counts: dict[int, int], room: int) -> list[tuple[int, dict[int, int]]]:
    """Patterns ``(times, {size: number})`` that hold every counted size exactly once.

    ``counts`` maps a size from 1 to ``room`` to its number of pieces. The tables have
    at most ``room`` rows and columns, however many pieces there are.
    """
    sizes = np.array(sorted(s for s, n in counts.items() if n > 0))
    if not len(sizes):
        return []
    need = np.array([counts[s] for s in sizes], dtype=np.float64)
    columns = _first_columns(need, sizes, room)
    inverse = np.linalg.inv(columns)
    for _ in range(MOST_COLUMNS):
        times = inverse @ need
        prices = inverse.sum(axis=0)  # every sequence costs one
        worth, pattern = _best_pattern(np.maximum(prices, 0), sizes, room)
        # The prices, scaled to be fair for every pattern, bound any solution from below.
        if worth <= 1 + 1e-9 or times.sum() * (1 - 1 / worth) <= GAP * times.sum():
            break
        change = inverse @ pattern
        rising = change > 1e-9
        steps = np.full(len(sizes), np.inf)
        steps[rising] = np.maximum(times[rising], 0) / change[rising]
        leaving = int(steps.argmin())
        columns[:, leaving] = pattern
        pivot = inverse[leaving] / change[leaving]
        inverse -= np.outer(change, pivot)
        inverse[leaving] = pivot
    whole = np.floor(np.maximum(inverse @ need, 0) + 1e-6).astype(np.int64)
    plan, left = [], need.astype(np.int64)
    for k in np.argsort(-(columns * sizes[:, None]).sum(axis=0), kind="stable"):
        own = columns[:, k].astype(np.int64)
        used = own > 0
        n = min(int(whole[k]), int((left[used] // own[used]).min()))
        if n > 0:
            left -= n * own
            plan.append((n, {int(sizes[i]): int(own[i]) for i in np.flatnonzero(used)}))
    return plan + _best_fit(sizes, left, room)


def _best_fit(sizes, left, room) -> list[tuple[int, dict[int, int]]]:
    """The pieces that rounding left over, large ones first, each into the fullest place."""
    open_rows: dict[int, list[dict[int, int]]] = {}
    for size, n in zip(sizes[::-1].tolist(), left[::-1].tolist()):
        for _ in range(n):
            space = min((s for s in open_rows if s >= size and open_rows[s]), default=None)
            row = open_rows[space].pop() if space is not None else {}
            row[size] = row.get(size, 0) + 1
            open_rows.setdefault((room if space is None else space) - size, []).append(row)
    return [(1, row) for rows in open_rows.values() for row in rows]


def _place(slots: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], fields: list[str]):
    """Sequence of a piece from its class and its rank in the class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, ranks = (batch.column(c).to_numpy() for c in ("kind", "rank"))
            sequence = np.zeros(len(kinds), dtype=np.int64)
            for kind in np.unique(kinds):
                own = kinds == kind
                starts, number, first = slots[int(kind)]
                at = np.searchsorted(starts, ranks[own], side="right") - 1
                sequence[own] = first[at] + (ranks[own] - starts[at]) // number[at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f) for f in fields[:-1]), pa.array(sequence)], fields
            )
    return run


def pack(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Pieces of all texts of ``docs(doc_id, text)``, packed into sequences.

    Per piece: ``doc_id``, ``start`` (ids of the document before it), ``length``,
    ``ids_crc32`` (of its ids as little-endian 32-bit integers), ``doc_tokens``,
    ``sequence_id`` and ``offset`` (place in the sequence, without gaps from 0). A
    document is its byte-level BPE ids and then id 1; special tokens written in a text
    are ordinary text. ``vocabulary`` is the file of ranks, by default the public one.

    A null or empty text is one piece with id 1 alone. Repeated rows are packed as
    often as they occur, a null ``doc_id`` stays null. An empty table gives an empty
    result; further columns are ignored.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    cut = slim.mapInArrow(_cut(vocabulary), PIECES)
    kind = F.ceil(F.col("length") * CLASSES / LENGTH).cast("int")
    pieces = materialize(cut.select(
        "*", kind.alias("kind"), F.monotonically_increasing_id().alias("piece"),
        F.spark_partition_id().alias("part"),
    ), "pieces")
    # A rank is the number in its part plus the numbers in earlier parts.
    parts = materialize(pieces.groupBy("kind", "part").agg(F.count("*").alias("n")), "parts")
    earlier = Window.partitionBy("kind").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = parts.select("kind", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    counts = {r["kind"]: r["n"] for r in parts.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    listed: dict[int, list[tuple[int, int, int]]] = {k: [] for k in counts}
    taken = dict.fromkeys(counts, 0)
    sequences = 0
    for times, pattern in cutting_stock(counts, CLASSES):
        for size, number in pattern.items():
            listed[size].append((taken[size], number, sequences))
            taken[size] += times * number
        sequences += times
    slots = {k: tuple(np.array(c, dtype=np.int64) for c in zip(*v)) for k, v in listed.items()}
    inside = F.row_number().over(Window.partitionBy("kind", "part").orderBy("piece")) - 1
    ranked = pieces.withColumn("inside", inside).join(before, ["kind", "part"]).withColumn(
        "rank", F.col("before") + F.col("inside")
    ).select(*PIECES.names, "piece", "kind", "rank")
    layout = T.StructType([
        *PIECES.fields, T.StructField("piece", T.LongType()), T.StructField("sequence_id", T.LongType()),
    ])
    placed = ranked.mapInArrow(_place(slots, layout.names), layout)
    earlier = Window.partitionBy("sequence_id").orderBy("piece").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop("piece")
