"""Ranked lexical search by dense blocks of exact integers.

Items are taken in blocks. The terms of a tile of items are its compact vocabulary; the
tile is a dense matrix of term weights times counts. The impacts of the documents of a
chunk on that vocabulary are another one, and their product, by BLAS in double precision,
holds the scores. All entries are integers; a vocabulary is cut so that no partial sum can
reach 2^53, so products are exact, and tiles are added as 64-bit integers. Every task keeps
the best documents of each item, ties by id included, and only these are shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.llm.terms import Terms
from punctual.llm.tokens import text_chunks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A block of items ends when it has so many items or bytes of text; its tables go to all
# tasks. A single longer text is a block of its own.
BLOCK_ITEMS, BLOCK_BYTES = 4096, 1 << 22
TILE_ITEMS, TILE_TERMS, TILE_DOCS = 256, 4096, 512
# An impact is 10^9 tf div (1000 tf + 8 m), so less than this.
MOST_IMPACT = 10**6
EXACT = 2**53
# Parts into which the candidates of an item fall before they meet.
PARTS = 64
_LAST = np.iinfo(np.int64).max

COUNTS = T.StructType([T.StructField("term", T.LongType()), T.StructField("n", T.LongType())])
BEST = T.StructType([
    T.StructField("item", T.IntegerType()), T.StructField("doc_id", T.LongType()),
    T.StructField("score", T.LongType()),
])


def term_counts(terms: Terms, vocabulary: np.ndarray, data, offsets) -> tuple:
    """Text, term (place in the sorted ``vocabulary``) and occurrences of each pair found,
    and the number of all terms of each text."""
    words = terms.words(data, offsets)
    n = np.diff(words.first)
    size = max(len(vocabulary), 1)
    if not len(vocabulary) or not len(words.hashes):
        none = np.zeros(0, np.int64)
        return none, none, none, n
    place = np.minimum(np.searchsorted(vocabulary, words.hashes), size - 1)
    found = vocabulary[place] == words.hashes
    both, times = np.unique(
        words.text_of_word()[found] * size + place[found], return_counts=True
    )
    return both // size, both % size, times, n


class Block:
    """Items with their vocabulary: sorted hashes, and counts as (item, term, times)."""

    def __init__(self, item_ids: list, texts: list[str | None]):
        terms = Terms()
        self.item_ids = item_ids
        array = pa.array([t or "" for t in texts], pa.large_string())
        parts = [(row, *_hashes(terms, data, offsets))
                 for row, _, data, offsets in text_chunks(array)]
        hashes = [h for _, h, _ in parts]
        self.vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
        item = np.concatenate([row + t for row, _, t in parts]) if parts else np.zeros(0, np.int64)
        size = max(len(self.vocabulary), 1)
        place = np.searchsorted(self.vocabulary, np.concatenate(hashes)) if hashes else item
        both, self.times = np.unique(item * size + place, return_counts=True)
        self.item, self.term = both // size, both % size

    def tiles(self, weights: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """``(first item, terms, matrix)``: items by terms, entries weight times count.

        The sums of a matrix row times the largest impact stay below 2^53; a single entry
        beyond it makes an integer matrix, which numpy multiplies without BLAS.
        """
        out, value = [], weights[self.term] * self.times
        for first in range(0, len(self.item_ids), TILE_ITEMS):
            own = (self.item >= first) & (self.item < first + TILE_ITEMS) & (value > 0)
            item, term, entry = self.item[own] - first, self.term[own], value[own]
            rows = min(TILE_ITEMS, len(self.item_ids) - first)
            terms = np.unique(term)
            start = 0
            while start < len(terms):
                stop = min(start + TILE_TERMS, len(terms))
                while True:
                    inside = (term >= terms[start]) & (term <= terms[stop - 1])
                    most = int(np.bincount(item[inside], entry[inside].astype(float)).max())
                    exact = most * MOST_IMPACT < EXACT // 2
                    if exact or stop == start + 1:
                        break
                    stop = start + (stop - start) // 2
                matrix = np.zeros((rows, stop - start), np.float64 if exact else np.int64)
                matrix[item[inside], np.searchsorted(terms[start:stop], term[inside])] = entry[inside]
                out.append((first, terms[start:stop], matrix))
                start = stop
        return out


def _hashes(terms: Terms, data, offsets) -> tuple[np.ndarray, np.ndarray]:
    words = terms.words(data, offsets)
    return words.hashes, words.text_of_word()


def blocks(items: DataFrame) -> Iterator[Block]:
    """Blocks of ``items(item_id, text)``, read partition by partition."""
    ids, texts, held = [], [], 0
    for item_id, text in items.toLocalIterator():
        size = len((text or "").encode())
        if ids and (len(ids) >= BLOCK_ITEMS or held + size > BLOCK_BYTES):
            yield Block(ids, texts)
            ids, texts, held = [], [], 0
        ids.append(item_id)
        texts.append(text)
        held += size
    if ids:
        yield Block(ids, texts)


def _count(vocabulary: np.ndarray):
    """Documents by term, and, as terms -1 and -2, those with a term and all terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, df = Terms(), np.zeros(len(vocabulary), np.int64)
        docs = total = 0
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column("text")):
                _, term, _, n = term_counts(terms, vocabulary, data, offsets)
                df += np.bincount(term, minlength=len(vocabulary))
                docs += int((n > 0).sum())
                total += int(n.sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, [-1, -2])), pa.array(np.append(df[some], [docs, total]))],
            COUNTS.names,
        )
    return run


def statistics(docs: DataFrame, vocabulary: np.ndarray) -> tuple[int, int, np.ndarray]:
    """N, L and the documents that hold each term of the sorted vocabulary."""
    rows = docs.select("text").mapInArrow(_count(vocabulary), COUNTS).groupBy("term").agg(
        F.sum("n").alias("n")
    ).collect()  # one row per term of the block
    found = dict(rows)
    df = np.zeros(len(vocabulary), np.int64)
    for term, n in rows:
        if term >= 0:
            df[term] = n
    return found.get(-1, 0), found.get(-2, 0), df


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


class _Best:
    """The best ``k`` documents of every item so far, ties by the smaller id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.scores = np.zeros((items, k), np.int64)
        self.ids = np.full((items, k), _LAST)
        self.used = np.zeros(items, np.int64)

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores``: items from ``first`` on by documents."""
        if not self.k:
            return
        own = slice(first, first + len(scores))
        least = np.where(self.used[own] < self.k, 1, self.scores[own, -1])
        items, docs = np.nonzero(scores >= least[:, None])
        stops = np.searchsorted(items, np.arange(len(scores) + 1))
        for i in np.unique(items):
            some, row = docs[stops[i] : stops[i + 1]], first + i
            value = np.concatenate([self.scores[row, : self.used[row]], scores[i, some]])
            name = np.concatenate([self.ids[row, : self.used[row]], ids[some]])
            order = np.lexsort((name, -value))[: self.k]
            self.used[row] = len(order)
            self.scores[row, : len(order)] = value[order]
            self.ids[row, : len(order)] = name[order]


def impacts(times: np.ndarray, text: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """Impact of each occurrence count, by whole numbers as large as it takes."""
    sizes, which = np.unique(n, return_inverse=True)
    m = np.array([100 - 75 + 75 * int(s) * docs // max(total, 1) for s in sizes], np.int64)
    return 10**9 * times // (1000 * times + 8 * m[which][text])


def _search(vocabulary: np.ndarray, tiles: list, items: int, docs: int, total: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, best = Terms(), _Best(items, k)
        for batch in batches:
            ids = batch.column("doc_id").fill_null(_LAST).to_numpy()
            for row, stop, data, offsets in text_chunks(batch.column("text")):
                text, term, times, n = term_counts(terms, vocabulary, data, offsets)
                impact = impacts(times, text, n, docs, total)
                for start in range(0, stop - row, TILE_DOCS):
                    end = min(start + TILE_DOCS, stop - row)
                    near = slice(*np.searchsorted(text, [start, end]))
                    _add_tiles(
                        best, tiles, text[near] - start, term[near], impact[near],
                        ids[row + start : row + end], len(vocabulary),
                    )
        item, rank = np.nonzero(np.arange(k) < best.used[:, None])
        name = best.ids[item, rank]
        yield pa.RecordBatch.from_arrays([
            pa.array(item.astype(np.int32)), pa.array(name, mask=name == _LAST),
            pa.array(best.scores[item, rank]),
        ], BEST.names)
    return run


def _add_tiles(best: _Best, tiles, text, term, impact, ids, size) -> None:
    place = np.full(size, -1)
    at = 0
    while at < len(tiles):
        first, scores = tiles[at][0], None
        while at < len(tiles) and tiles[at][0] == first:
            _, own, matrix = tiles[at]
            place[own] = np.arange(len(own))
            here = place[term] >= 0
            dense = np.zeros((len(own), len(ids)), matrix.dtype)
            dense[place[term[here]], text[here]] = impact[here]
            place[own] = -1
            part = (matrix @ dense).astype(np.int64)
            scores = part if scores is None else scores + part
            at += 1
        best.add(first, scores, ids)


def _top(found: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _block_results(docs: DataFrame, block: Block, id_field: T.StructField, k: int) -> DataFrame:
    n_docs, total, df = statistics(docs, block.vocabulary)
    tiles = block.tiles(term_weights(n_docs, df))
    found = docs.mapInArrow(
        _search(block.vocabulary, tiles, len(block.item_ids), n_docs, total, k), BEST
    )
    near = _top(
        found.withColumn("part", F.spark_partition_id() % PARTS), k, "item", "part"
    ).drop("rank", "part")
    # At most BLOCK_ITEMS rows.
    layout = T.StructType([
        T.StructField("item", T.IntegerType()), T.StructField("item_id", id_field.dataType)
    ])
    names = docs.sparkSession.createDataFrame(list(enumerate(block.item_ids)), layout)
    return _top(near, k, "item").join(F.broadcast(names), "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"
    )


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents of ``docs(doc_id, text)`` for each of ``items(item_id, text)``.

    Columns ``item_id``, ``rank`` (from 1), ``doc_id`` and ``score``; only scores above 0,
    equal ones by ascending ``doc_id``, a null id last. With N the documents with a term,
    L all their terms, n the terms of a document and tf the occurrences of a term: the
    weight of a term is floor(1000 ln((2N + 2) / (2 df + 1))), a document's m is
    25 + (75 n N) div L, and its score sums weight * (10^9 tf div (1000 tf + 8 m)) over
    the item's terms, repetitions included.

    A null, empty or blank text has no term: as a document it is in no result, as an item
    it has none. Repeated rows are documents or items of their own; repeated items have
    equal ranks twice. Empty tables give an empty result; further columns are ignored.
    Items may be more than fit one block: every block is a pass over the documents.
    """
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    asked = items.select("item_id", F.col("text").cast("string").alias("text"))
    out = None
    for block in blocks(asked):
        part = _block_results(slim, block, asked.schema["item_id"], k)
        out = part if out is None else out.unionByName(part)
    if out is not None:
        return out
    layout = T.StructType([
        asked.schema["item_id"], T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType()),
    ])
    return docs.sparkSession.createDataFrame([], layout)
