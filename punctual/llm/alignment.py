"""Alignment of the tokens of two tokenizers, text by text.

Two pointers walk through the token ends of a text, one per tokenizer; where the ends
agree, the two tokens are linked and the text is cut. One numpy state vector holds the
pointers of all texts of a chunk and moves them in lockstep; texts that are through leave
the vector. Ends are compared, so a byte range of a text can be walked on its own: a long
text is several entries of the vector, and the number of steps is bounded.

How often two ids are linked is counted over all texts. The most frequent pairs, a bounded
number, are looked up in the tasks; all others by a join.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.llm.packing import _encoder, _ids
from punctual.llm.tokens import _BASE, _INVERSE, _powers, mix, text_chunks
from punctual.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of text that are walked at a time; a task holds some hundred bytes for each.
CHUNK_BYTES = 1 << 18
LANE_BYTES = 512
# Encoded stretches that a task remembers; beyond it, it forgets all of them.
REMEMBERED = 1 << 20
# Pairs of ids that are looked up in the tasks.
HEAD_PAIRS = 1 << 16

DIGESTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_a", T.LongType()),
    T.StructField("n_b", T.LongType()), T.StructField("n_groups", T.LongType()),
    T.StructField("n_links", T.LongType()), T.StructField("groups_sha256", T.StringType()),
    T.StructField("pairs", T.ArrayType(T.LongType())),
    T.StructField("times", T.ArrayType(T.IntegerType())),
])
TOKENS = T.StructType([
    T.StructField("a_ids", T.ArrayType(T.IntegerType())),
    T.StructField("b_ids", T.ArrayType(T.IntegerType())),
    T.StructField("link_a", T.ArrayType(T.IntegerType())),
    T.StructField("link_b", T.ArrayType(T.IntegerType())),
    T.StructField("cuts", T.ArrayType(T.LongType())),
])


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and stretches encoded before.

    A stretch starts at a blank between two characters that are no white space, or at the
    start of a text, and goes up to the next. No token of either tokenizer reaches over
    such a blank: A's pattern starts a piece there and none of B's pieces has a blank after
    another character. So equal stretches have equal tokens.
    """

    def __init__(self, ranks: str | None = None, pieces: str | None = None):
        import public_tokenizers
        import sentencepiece

        self.a = _encoder(ranks)
        self.b = sentencepiece.SentencePieceProcessor(
            model_file=pieces or public_tokenizers.path("piece_bpe_32k.model")
        )
        self.a_bytes = [self.a.decode_single_token_bytes(i) for i in range(self.a.n_vocab)]
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_sizes = np.array([len(t) for t in self.a_bytes])
        self.b_sizes = np.array([len(t) for t in self.b_bytes])
        values = np.random.default_rng(41).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.values = values * np.uint64(2) + np.uint64(1)
        self.powers = self.inverse = np.ones(1, np.uint64)
        self._forget()

    def _piece(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        if self.b.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # sorted
        self.slot = np.zeros(0, np.int64)  # of each hash
        self.good = np.zeros(0, bool)  # by slot: both tokenizers give back the bytes
        self.flat = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.bounds = [np.zeros(1, np.int64), np.zeros(1, np.int64)]  # by slot

    def stretches(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all stretches, and whether one may be encoded next to others."""
        size = len(data)
        wide = np.concatenate([[0, 0], data, [0]]).astype(np.uint8)
        last, lead = wide[1 : size + 2], wide[: size + 1]  # before each place
        seen = (last > 0x20) & (last < 0x7F)
        seen |= (last >= 0x80) & (last < 0xC0) & (lead >= 0xC3) & (lead < 0xE0)
        follow = wide[2:]  # at each place
        ahead = (follow > 0x20) & (follow < 0x7F) | (follow >= 0xC3) & (follow < 0xE1) | (follow >= 0xE4)
        cut = np.zeros(size + 1, bool)
        cut[:size] = (data == 0x20) & seen[:size] & ahead[1:]
        cut[offsets] = True
        starts = np.flatnonzero(cut)
        return starts[:-1], ahead[starts[:-1] + 1] & seen[starts[1:]]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of every stretch, and where each text's stretches begin."""
        starts, free = self.stretches(data, offsets)
        ends = np.append(starts[1:], len(data))
        if len(self.powers) <= len(data):
            self.powers = _powers(_BASE, len(data) + 1)
            self.inverse = _powers(_INVERSE, len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], dtype=np.uint64, out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) + len(distinct) > REMEMBERED:
            self._forget()
        place = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = place < len(self.hashes)
        known[inside] = self.hashes[place[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            at = first[new]
            found = [raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())]
            slots = self._learn(found, free[at])
            self.hashes = np.insert(self.hashes, place[new], distinct[new])
            self.slot = np.insert(self.slot, place[new], slots)
        slot = self.slot[np.searchsorted(self.hashes, distinct)]
        return slot[which], np.searchsorted(starts, offsets)

    def _learn(self, found: list[bytes], free: np.ndarray) -> np.ndarray:
        """Encode stretches that are not known; their slots. Free ones come first."""
        order = np.argsort(~free, kind="stable")
        found = [found[i] for i in order.tolist()]
        sizes = np.array([len(t) for t in found])
        together = int(free.sum())
        joined = b"".join(found[:together])
        ids = self.a.encode_to_numpy(joined.decode()).astype(np.int32)
        stops = np.searchsorted(np.cumsum(self.a_sizes[ids]), np.cumsum(sizes[:together])) + 1
        single = [_ids(self.a, t.decode()).astype(np.int32) for t in found[together:]]
        counts_a = np.append(np.diff(stops, prepend=0), [len(i) for i in single]).astype(np.int64)
        lists = self.b.encode([t[1:].decode() for t in found], num_threads=1)
        counts_b = np.array([len(i) for i in lists], np.int64)
        flat_b = np.fromiter(chain.from_iterable(lists), np.int32, int(counts_b.sum()))
        sides = (
            (np.concatenate([ids, *single]), counts_a, self.a_sizes, self.a_bytes),
            (flat_b, counts_b, self.b_sizes, self.b_bytes),
        )
        text, good = joined + b"".join(found[together:]), np.ones(len(found), bool)
        for side, (flat, counts, token_sizes, token_bytes) in enumerate(sides):
            good &= self._gives_back(found, text, sizes, flat, counts, token_sizes, token_bytes)
            self.bounds[side] = np.append(
                self.bounds[side], self.bounds[side][-1] + np.cumsum(counts)
            )
            self.flat[side] = np.append(self.flat[side], flat)
        slots = np.empty(len(found), np.int64)
        slots[order] = len(self.good) + np.arange(len(found))
        self.good = np.append(self.good, good)
        return slots

    @staticmethod
    def _gives_back(found, text, sizes, flat, counts, token_sizes, token_bytes) -> np.ndarray:
        """Whether the tokens of each stretch are its bytes."""
        stops = np.cumsum(counts)
        through = np.concatenate([[0], np.cumsum(token_sizes[flat])])
        if (through[stops] == np.cumsum(sizes)).all() and b"".join(
            map(token_bytes.__getitem__, flat.tolist())
        ) == text:
            return np.ones(len(found), bool)
        parts = zip(found, (stops - counts).tolist(), stops.tolist())
        return np.array([
            b"".join(map(token_bytes.__getitem__, flat[a:b].tolist())) == t for t, a, b in parts
        ], bool)

    def tokens(self, side: int, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches in a row, and where each stretch's begin."""
        starts = self.bounds[side][slots]
        counts = self.bounds[side][slots + 1] - starts
        first = np.concatenate([[0], np.cumsum(counts)])
        at = np.repeat(starts - first[:-1], counts) + np.arange(first[-1])
        return self.flat[side][at], first


def lockstep(
    end_a: np.ndarray, end_b: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``end_a`` and ``end_b`` (rising) with equal values, for values over ``low``
    up to ``high`` of each lane; all lanes move at once. Sorted."""
    a, stop_a = (np.searchsorted(end_a, v, side="right") for v in (low, high))
    b, stop_b = (np.searchsorted(end_b, v, side="right") for v in (low, high))
    links_a, links_b = [], []
    live = (a < stop_a) & (b < stop_b)
    while True:
        if not live.all():  # leave out those that are through
            a, b, stop_a, stop_b = a[live], b[live], stop_a[live], stop_b[live]
        if not len(a):
            break
        here_a, here_b = end_a[a], end_b[b]
        cut = here_a == here_b
        links_a.append(a[cut])
        links_b.append(b[cut])
        a = a + (here_a <= here_b)
        b = b + (here_b <= here_a)
        live = (a < stop_a) & (b < stop_b)
    partner = np.full(len(end_a), -1)
    for own, other in zip(links_a, links_b):
        partner[own] = other
    linked = np.flatnonzero(partner >= 0)
    return linked, partner[linked]


class Aligned:
    """Tokens and links of a chunk of texts.

    ``ids`` and ``first``: per side the tokens of all texts and where each text's begin;
    ``link_a`` and ``link_b``: linked tokens; ``links``: where each text's links begin;
    ``ends``: byte offset in the chunk's tokens at which each link's tokens end.
    """

    def __init__(self, tokenizers: Tokenizers, data: np.ndarray, offsets: np.ndarray):
        texts = len(offsets) - 1
        slots, of_text = tokenizers.encode(data, offsets)
        text = np.repeat(np.arange(texts), np.diff(of_text))
        sound = np.bincount(text, ~tokenizers.good[slots], minlength=texts) == 0
        sound &= np.diff(offsets) > 1  # more than the blank before the text
        slots, text = slots[sound[text]], text[sound[text]]
        of_text = np.searchsorted(text, np.arange(texts + 1))
        self.ids, self.first, ends = [], [], []
        for side, sizes in enumerate((tokenizers.a_sizes, tokenizers.b_sizes)):
            ids, first = tokenizers.tokens(side, slots)
            self.ids.append(ids)
            self.first.append(first[of_text])
            ends.append(np.cumsum(sizes[ids]))
        # Byte ranges of texts, of sound ones only, and the lanes in them.
        through = np.concatenate([[0], np.cumsum(np.where(sound, np.diff(offsets), 0))])
        lanes = -(-np.diff(through) // LANE_BYTES)
        number = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        low = np.repeat(through[:-1], lanes) + number * LANE_BYTES
        high = np.minimum(low + LANE_BYTES, np.repeat(through[1:], lanes))
        self.link_a, self.link_b = lockstep(*ends, low, high)
        self.links = np.searchsorted(self.link_a, self.first[0])
        self.ends = ends[0][self.link_a] if len(ends[0]) else self.link_a
        self.from_byte = through[:-1]

    def written_groups(self, digits: np.ndarray, widths: np.ndarray) -> tuple[bytes, np.ndarray]:
        """All groups in decimal, and where each text's part ends, a separator included."""
        sizes = [len(i) for i in self.ids]
        places, marks = [], []
        for side, (own, other) in enumerate(((self.link_a, self.link_b), (self.link_b, self.link_a))):
            last = np.zeros(sizes[side], np.int32)
            last[own] = 1
            group = np.cumsum(last, dtype=np.int32) - last
            # Tokens of the other side before it: of earlier groups, for B of its own too.
            passed = np.concatenate([[0], other + 1])[group + side]
            places.append(np.arange(sizes[side]) + passed)
            marks.append(np.array([ord(","), ord("|;"[side])], np.uint8)[last])
        total = sum(sizes)
        ids, mark = np.empty(total, np.int32), np.empty(total, np.uint8)
        for place, own, sign in zip(places, self.ids, marks):
            ids[place], mark[place] = own, sign
        table, own = digits[ids], widths[ids]
        flat = table.reshape(-1)
        flat[np.arange(0, len(flat), table.shape[1]) + own] = mark
        stops = np.concatenate([[0], np.cumsum(own + 1)])[self.first[0] + self.first[1]]
        return flat[flat != 0].tobytes(), stops


def _decimals(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of 0 to ``count`` - 1, with room for a separator, and their numbers."""
    widths = np.array([len(str(i)) for i in range(count)])
    digits = np.zeros((count, widths.max() + 1), np.uint8)
    for i in range(count):
        digits[i, : widths[i]] = np.frombuffer(str(i).encode(), np.uint8)
    return digits, widths


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))


def _digest(ranks: str | None, pieces: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(ranks, pieces)
        digits, widths = _decimals(max(len(tokenizers.a_bytes), len(tokenizers.b_bytes)))
        for batch in batches:
            for row, stop, data, offsets in text_chunks(batch.column("text"), CHUNK_BYTES):
                found = Aligned(tokenizers, data, offsets)
                written, stops = found.written_groups(digits, widths)
                view = memoryview(written)
                digest = [
                    hashlib.sha256(view[a : b - 1]).hexdigest() if b > a else ""
                    for a, b in zip(stops[:-1].tolist(), stops[1:].tolist())
                ]
                texts, links = stop - row, np.diff(found.links)
                own = np.repeat(np.arange(texts), links)
                a, b = found.ids[0][found.link_a], found.ids[1][found.link_b]
                # Distinct pairs of each text; both vocabularies hold less than 2^20 ids.
                both, times = np.unique((own << 40) | (a.astype(np.int64) << 20) | b, return_counts=True)
                bounds = np.searchsorted(both >> 40, np.arange(texts + 1))
                pair = (both >> 20 & 0xFFFFF) << 32 | both & 0xFFFFF
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(row, texts),
                    pa.array(np.diff(found.first[0])), pa.array(np.diff(found.first[1])),
                    pa.array(links), pa.array(links), pa.array(digest, pa.string()),
                    _lists(pair, bounds, pa.int64()), _lists(times, bounds, pa.int32()),
                ], DIGESTS.names)
    return run


def _align(ranks: str | None, pieces: str | None, fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(ranks, pieces)
        for batch in batches:
            for row, stop, data, offsets in text_chunks(batch.column("text"), CHUNK_BYTES):
                found = Aligned(tokenizers, data, offsets)
                own = np.repeat(np.arange(stop - row), np.diff(found.links))
                yield pa.RecordBatch.from_arrays([
                    batch.column("row").slice(row, stop - row),
                    _lists(found.ids[0], found.first[0], pa.int32()),
                    _lists(found.ids[1], found.first[1], pa.int32()),
                    _lists(found.link_a - found.first[0][own], found.links, pa.int32()),
                    _lists(found.link_b - found.first[1][own], found.links, pa.int32()),
                    _lists(found.ends - found.from_byte[own], found.links, pa.int64()),
                ], fields)
    return run


def _with_blank(docs: DataFrame):
    return F.concat(F.lit(" "), F.coalesce(docs["text"].cast("string"), F.lit("")))


def align(docs: DataFrame, ranks: str | None = None, pieces: str | None = None) -> DataFrame:
    """Tokens and links of every row of ``docs(doc_id, text)``.

    ``row`` (all columns of ``docs``), ``a_ids`` and ``b_ids`` (tokens of a blank and the
    text), ``link_a`` and ``link_b`` (places, from 0, of tokens that end together) and
    ``cuts`` (the byte offsets where they end). ``ranks`` and ``pieces`` are the files of
    the two vocabularies, by default the public ones. Texts without tokens as in ``aligned``.
    """
    held = docs.select(F.struct("*").alias("row"), _with_blank(docs).alias("text"))
    layout = T.StructType([held.schema["row"], *TOKENS.fields])
    return held.mapInArrow(_align(ranks, pieces, layout.names), layout)


def pair_counts(digests: DataFrame) -> DataFrame:
    """``pair`` (A's id times 2^32 plus B's), ``n`` (links that hold it) and ``best``
    (whether no pair of the same id of B has more)."""
    counts = materialize(
        digests.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n")), "counts",
    ).withColumn("b", F.col("pair").bitwiseAND(F.lit(2**32 - 1)))
    # One row per id of B's vocabulary at most.
    highest = counts.groupBy("b").agg(F.max("n").alias("highest"))
    return counts.join(F.broadcast(highest), "b").select(
        "pair", "n", (F.col("n") == F.col("highest")).alias("best")
    )


def _head(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At most HEAD_PAIRS pairs, those with the largest counts, sorted by pair.

    The least count is found from the numbers of pairs by size class, some hundred rows.
    """
    level = F.floor(F.log2("n") * 16)
    sizes = counts.groupBy(level.alias("level")).count().collect()
    held, least = 0, None
    for number, size in sorted(sizes, reverse=True):
        held += size
        if held > HEAD_PAIRS:
            break
        least = number
    rows = sorted(counts.filter(level >= least).collect()) if least is not None else []
    pair, n, best = ([r[i] for r in rows] for i in range(3))
    return np.array(pair, np.int64), np.array(n, np.int64), np.array(best, bool)


def _look_up(pair: np.ndarray, n: np.ndarray, best: np.ndarray, fields: list[str]):
    """Sums over the pairs of the head; the other pairs stay in the lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy()
            own = lists.flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            if len(pair):
                place = np.minimum(np.searchsorted(pair, own), len(pair) - 1)
                found = pair[place] == own
                many = times[found].astype(np.int64)
                sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
                np.add.at(sums[0], row[found], many * best[place[found]])
                np.add.at(sums[1], row[found], many * n[place[found]])
            else:
                found = np.zeros(len(own), bool)
                sums = [np.zeros(batch.num_rows, np.int64)] * 2
            bounds = np.concatenate([[0], np.cumsum(np.bincount(row[~found], minlength=batch.num_rows))])
            new = {
                "pairs": _lists(own[~found], bounds, pa.int64()),
                "times": _lists(times[~found], bounds, pa.int32()),
                "head_best": pa.array(sums[0]), "head_sum": pa.array(sums[1]),
            }
            yield pa.RecordBatch.from_arrays(
                [new[f] if f in new else batch.column(f) for f in fields], fields
            )
    return run


def aligned(docs: DataFrame, ranks: str | None = None, pieces: str | None = None) -> DataFrame:
    """Digest of the alignment of every row of ``docs(doc_id, text)``.

    ``doc_id``, ``n_a`` and ``n_b`` (tokens of a blank and the text), ``n_groups`` (parts
    between byte offsets where tokens of both end), ``n_links`` (tokens that end together),
    ``n_best`` (links whose pair no other pair of the same id of B exceeds in the whole
    table), ``count_sum`` (of the links' pair counts) and ``groups_sha256`` (of the groups
    as ``a1,a2|b1;a3|b2,b3``). Special tokens written in a text are ordinary text.

    A text that is null or empty, or whose tokens do not give back the text's bytes on
    either side, has no tokens: zeros and ''. Repeated rows count as often as they are
    there; a null id stays null. An empty table gives an empty result; further columns are
    ignored.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _with_blank(docs).alias("text"))
    digests = materialize(
        slim.mapInArrow(_digest(ranks, pieces), DIGESTS)
        .withColumn("number", F.monotonically_increasing_id()), "digests",
    )
    counts = materialize(pair_counts(digests), "pairs")
    layout = T.StructType([
        *digests.schema.fields, T.StructField("head_best", T.LongType()),
        T.StructField("head_sum", T.LongType()),
    ])
    marked = materialize(digests.mapInArrow(_look_up(*_head(counts), layout.names), layout), "marked")
    rest = marked.select("number", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "number", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times")
    )
    # Pairs outside the head are rare, so no key of this join is hot.
    sums = rest.join(counts, "pair").groupBy("number").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"),
    )
    none = F.lit(0)
    return marked.join(sums, "number", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("head_best") + F.coalesce("more_best", none)).alias("n_best"),
        (F.col("head_sum") + F.coalesce("more_sum", none)).alias("count_sum"),
        "groups_sha256",
    )
