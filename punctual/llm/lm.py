"""Language-model scores of a hashed maximum-entropy model with class-factored softmax.

P(word | history) = P(class | history) * P(word | class, history). The most frequent words are
classes of their own; every other word falls into a class by its last bytes, which also
places words that were never seen. Endings that follow the same words are one class
(k-means over a bounded table of co-occurrences). The class softmax adds up weights of hashed features
of the history: a bias, the three previous words one by one (the second and third are
skip features) and the pair of the last two. It is trained by gradient updates that all
tasks make on their own texts; after each round the tasks' updates are averaged.

Inside a class, a hierarchical softmax leads to the word: a binary tree over the bits of
the word's hash, as deep as the vocabulary asks for. The odds of a branch are those of the
counts below it, changed by weights of hashed features: each node together with the
previous word, and with the pair of the last two. They are learnt along with those of the
classes. The few words that share a leaf have their smoothed relative frequencies there.

Sums over words outside the bounded head list come from a join of the written word
counts, so that no vocabulary is sent whole to a task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.llm.cuts import cuts
from punctual.llm.tokens import Tokenizer, Words, mix, text_chunks
from punctual.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# At most this many frequent words travel with the tasks, at 16 bytes each.
HEAD_WORDS = 1 << 17
SINGLE_WORDS = 31  # frequent words that are classes of their own, besides the end
ENDING_CLASSES = 32
ENDINGS = 4096  # hashed endings, the last three bytes of a word
PRIOR = 20.0  # observations that the average profile counts as
PROFILE = 128  # hash buckets of the preceding word, by which endings are compared
CLASSES = 1 + SINGLE_WORDS + ENDING_CLASSES
CONTEXT_WORDS = 4096  # frequent words that features tell apart
ROWS = 1 << 13  # hashed feature rows, of one weight per class
FEATURES = 4  # besides the bias
BIAS = 0  # the row that all tokens share
ROUNDS = 3
STEP = 0.25
BATCH = 2048
COUNT_BITS = 36
TREE_DEPTH = 12  # bits of a word's hash that tell the words of a class apart, at most
LEAF_WORDS = 4  # distinct words of a leaf, at least, on average
TREE_BITS = 19  # hashed weights of tree nodes with features, as a power of two
TREE_FEATURES = (0, 3)  # the previous word and the pair, by column
KNOWN_WORDS = 1 << 13  # words that a task counts by look-up
KNOWN_SLOTS = 1 << 17
BLOCKS = 64  # parts in which the updates of the weights are averaged

END = np.uint64(1)  # the hash that stands for the end of a text

COUNTS = T.StructType([
    T.StructField("word", T.LongType()), T.StructField("ending", T.IntegerType()),
    T.StructField("n", T.LongType()),
])
PROFILES = T.StructType([
    T.StructField("block", T.IntegerType()), T.StructField("counts", T.BinaryType()),
])
UPDATES = T.StructType([
    T.StructField("block", T.IntegerType()), T.StructField("tokens", T.LongType()),
    T.StructField("delta", T.BinaryType()),
])
SCORES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("head_known", T.LongType()),
    T.StructField("head_sum", T.DoubleType()), T.StructField("single_sum", T.DoubleType()),
    T.StructField("norm_sum", T.DoubleType()), T.StructField("class_sum", T.DoubleType()),
    T.StructField("tail", T.ArrayType(T.StructType([
        T.StructField("word", T.LongType()), T.StructField("k", T.LongType()),
    ]))),
])


def _endings(words: Words, data: np.ndarray) -> np.ndarray:
    """Hashed last three bytes of every word, A-Z as a-z."""
    lower = np.arange(256, dtype=np.uint64)
    lower[65:91] = lower[97:123]
    out = np.zeros(len(words.hashes), dtype=np.uint64)
    for back in (1, 2, 3):
        at = words.ends - back
        inside = at >= words.starts
        value = np.where(inside, lower[data[np.maximum(at, 0)]], np.uint64(0))
        out = out * np.uint64(257) + value
    return (mix(out) % np.uint64(ENDINGS)).astype(np.int32)


@dataclass
class Head:
    """The frequent words, most frequent first, with their training counts."""

    hashes: np.ndarray
    counts: np.ndarray

    def table(self) -> _Table:
        return _Table(self.hashes)


class _Table:
    """Finds the rank of a hash by one look-up; two words never share a slot."""

    def __init__(self, hashes: np.ndarray, slots: int = 1 << 21):
        self.mask = np.uint64(slots - 1)
        self.hashes = np.append(hashes, np.uint64(0))
        self.rank = np.full(slots, len(hashes), dtype=np.int32)
        # Written backwards, so that the more frequent word keeps a shared slot.
        place = (hashes & self.mask).astype(np.int64)[::-1]
        self.rank[place] = np.arange(len(hashes), dtype=np.int32)[::-1]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Rank of each hash; the number of words for one that is not listed."""
        rank = self.rank[(hashes & self.mask).astype(np.int64)]
        return np.where(self.hashes[rank] == hashes, rank, len(self.hashes) - 1)


def _tokens(tokenizer: Tokenizer, data, offsets, groups: np.ndarray):
    """Hash and ending class of every token, ends included, and where texts begin."""
    words = tokenizer.words(data, offsets)
    texts = len(words.first) - 1
    first = words.first + np.arange(texts + 1)
    hashes = np.full(first[-1], END, dtype=np.uint64)
    ending = np.full(first[-1], -1, dtype=np.int32)
    at = np.arange(len(words.hashes)) + words.text_of_word()
    hashes[at] = words.hashes
    ending[at] = groups[_endings(words, data)]
    return hashes, ending, first


def _features(rank: np.ndarray, ending: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Feature rows of every token, from the three tokens before it in its text."""
    own = np.where(rank < CONTEXT_WORDS, rank, CONTEXT_WORDS + 1 + ending)
    total, start = len(own), CONTEXT_WORDS
    place = np.arange(total) - np.repeat(first[:-1], np.diff(first))
    out = np.empty((total, FEATURES), dtype=np.uint16)
    # All that a history word can be is hashed once.
    kinds = np.arange(1, CONTEXT_WORDS + ENDING_CLASSES + 2, dtype=np.uint64)
    pair = np.zeros(total, dtype=np.uint64)
    seeds = (np.uint64(p) for p in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
    for k, seed in enumerate(seeds):
        before = np.full(total, start, dtype=np.int64)
        before[k + 1 :] = own[: max(total - k - 1, 0)]
        before[place <= k] = start
        hashed = mix(kinds * seed)
        out[:, k] = _row(hashed).take(before)
        if k < 2:
            pair += (hashed * np.uint64(3 - 2 * k)).take(before)
    out[:, 3] = _row(mix(pair))
    return out


def _row(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(ROWS - 1)).astype(np.uint16) + np.uint16(1)


def _classes(rank: np.ndarray, ending: np.ndarray) -> np.ndarray:
    single = rank < SINGLE_WORDS
    out = np.where(single, rank + 1, 1 + SINGLE_WORDS + ending)
    out[ending < 0] = 0
    return out


SHORT_RUN = 16  # rows of a run that are added run by run together
SURE = 1e-8  # sums of products of factors that are this large are exact


def _fresh(values: np.ndarray) -> np.ndarray:
    """A copy with numpy's own dtype object.

    Arrays that travelled to a task carry an equal but different one, with which
    ``np.add.at`` leaves its fast path: 69 ns an element measured, against 3.6.
    """
    return values.astype(np.float32)


def _run_sums(values: np.ndarray, rows: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``values[rows]`` over runs that begin at ``lead``, and the runs' order.

    As ``np.add.reduceat``, which took more than half the time of a step: the k-th rows of all
    runs are added at once; the rest of long runs is gathered at once and added run by run.
    """
    counts = np.diff(lead, append=len(rows))
    order = np.argsort(-counts, kind="stable")
    start, counts = lead[order], counts[order]
    above = np.searchsorted(-counts, -np.arange(SHORT_RUN + 1))  # runs with more than k rows
    sums = values.take(rows[start], axis=0)
    for k in range(1, SHORT_RUN):
        some = int(above[k])
        sums[:some] += values.take(rows[start[:some] + k], axis=0)
    long = int(above[SHORT_RUN])
    if long:
        left = counts[:long] - SHORT_RUN
        ends = np.cumsum(left)
        at = np.arange(ends[-1]) + np.repeat(start[:long] + SHORT_RUN - ends + left, left)
        every, rest = values.take(rows[at], axis=0), np.empty((long, values.shape[1]), values.dtype)
        first = 0
        for run, end in enumerate(ends.tolist()):
            np.add.reduce(every[first:end], axis=0, out=rest[run])
            first = end
        sums[:long] += rest
    return sums, order


class Softmax:
    """Class probabilities of batches of tokens, in arrays that are used again."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.total, self.part = (np.empty((BATCH, CLASSES), np.float32) for _ in range(2))

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        """One row per token; valid until the next call."""
        total, part = self.total[: len(features)], self.part[: len(features)]
        columns = features.T.astype(np.intp)
        np.take(self.weights, columns[0], axis=0, out=total, mode="clip")
        total += self.weights[BIAS]
        for k in range(1, FEATURES):
            np.take(self.weights, columns[k], axis=0, out=part, mode="clip")
            total += part
        total -= total.max(axis=1, keepdims=True)
        np.exp(total, out=total)
        total /= total.sum(axis=1, keepdims=True)
        return total

    def learn(self, squares: np.ndarray, features: np.ndarray, classes: np.ndarray) -> None:
        """One gradient step per batch, with a step size per weight."""
        for at in range(0, len(classes), BATCH):
            own, kind = features[at : at + BATCH], classes[at : at + BATCH]
            slope = self.probabilities(own)
            slope[np.arange(len(kind)), kind] -= 1
            slope *= np.float32(len(kind) ** -0.5)
            flat = own.reshape(-1)
            order = np.argsort(flat, kind="stable")
            flat = flat[order]
            lead = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
            sums, runs = _run_sums(slope, order // FEATURES, lead)
            self._step(squares, flat[lead][runs].astype(np.intp), sums)
            self._step(squares, np.array([BIAS]), slope.sum(axis=0, keepdims=True))

    def _step(self, squares: np.ndarray, rows: np.ndarray, slope: np.ndarray) -> None:
        seen = squares.take(rows, axis=0)
        seen += slope * slope
        squares[rows] = seen
        np.sqrt(seen, out=seen)
        slope /= seen
        slope *= np.float32(STEP)
        changed = self.weights.take(rows, axis=0)
        changed -= slope
        self.weights[rows] = changed


class Chances:
    """Class probabilities by weights that stay as they are.

    The exponential of a sum of rows is the product of their exponentials, which are
    taken once per row. A row's largest weight cancels, so no factor is above one.
    """

    def __init__(self, weights: np.ndarray):
        self.model = Softmax(weights)
        self.factors = np.exp(weights - weights.max(axis=1, keepdims=True))
        self.ones = np.ones(CLASSES, np.float32)

    def of(self, features: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Probability of each token's class."""
        out = np.empty(len(classes), np.float32)
        columns = features.T.astype(np.intp)
        for at in range(0, len(classes), BATCH):
            some, kind = columns[:, at : at + BATCH], classes[at : at + BATCH]
            # The arrays of the model are free until an unsure token needs it.
            product, part = self.model.total[: len(kind)], self.model.part[: len(kind)]
            np.take(self.factors, some[0], axis=0, out=product, mode="clip")
            product *= self.factors[BIAS]
            for k in range(1, FEATURES):
                np.take(self.factors, some[k], axis=0, out=part, mode="clip")
                product *= part
            sums = product @ self.ones
            unsure = np.flatnonzero(sums < SURE)
            sums[unsure] = 1
            found = product[np.arange(len(kind)), kind] / sums
            if len(unsure):
                found[unsure] = self.model.probabilities(features[at + unsure])[
                    np.arange(len(unsure)), kind[unsure]
                ]
            out[at : at + BATCH] = found
        return out


class Tree:
    """Hierarchical softmax over the words inside the ending classes.

    ``sums`` holds the smoothed counts of each class (row) and leaf; without weights, the
    product of the branches is a leaf's share of its class.
    """

    def __init__(self, weights: np.ndarray, sums: np.ndarray):
        self.weights, self.leaves = weights, sums.shape[1]
        self.depth = self.leaves.bit_length() - 1
        self.logs = np.log10(sums)
        self.prior = np.zeros(sums.shape, np.float32)  # by node, of which the first is 1
        for level in range(self.depth, 0, -1):
            self.prior[:, 1 << (level - 1) : 1 << level] = np.log(sums[:, 1::2] / sums[:, ::2])
            sums = sums[:, ::2] + sums[:, 1::2]

    def leaf(self, hashes: np.ndarray) -> np.ndarray:
        """Leaf of each word: the highest bits of its hash."""
        if not self.depth:
            return np.zeros(len(hashes), np.int64)
        return (hashes >> np.uint64(64 - self.depth)).astype(np.int64)

    def _paths(self, features: np.ndarray, ending: np.ndarray, leaf: np.ndarray):
        """Branches taken, log odds of the right ones and places of their weights, one row
        per level."""
        heap = (leaf + self.leaves) >> np.arange(self.depth, -1, -1)[:, None]
        right = (heap[1:] & 1).astype(np.float32)
        node = heap[:-1] + ending.astype(np.int64) * self.leaves
        odds = self.prior.reshape(-1).take(node)
        # The hash of node and feature is a product, so it is added up from theirs.
        odd = 0x9E3779B97F4A7C15
        nodes = node.view(np.uint64) * np.uint64((odd << 18) % (1 << 64))
        places = np.empty((len(TREE_FEATURES), *node.shape), np.int64)
        for k, column in enumerate(TREE_FEATURES):
            key = (features[:, column].astype(np.uint64) << np.uint64(2)) + np.uint64(k)
            own = places[k].view(np.uint64)
            np.add(nodes, key * np.uint64(odd), out=own)
            own >>= np.uint64(64 - TREE_BITS)
            odds += self.weights.take(places[k])
        return right, odds, places

    def log_chances(self, features: np.ndarray, ending: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """Log10 probability of each word's leaf in its class."""
        out = np.zeros(len(leaf))
        for at in range(0, len(leaf), BATCH):
            part = slice(at, at + BATCH)
            right, odds, _ = self._paths(features[part], ending[part], leaf[part])
            odds *= 1 - 2 * right
            with np.errstate(over="ignore"):
                loss = np.log((1 + np.exp(odds)).prod(axis=0, dtype=np.float64))
            above = np.flatnonzero(np.isinf(loss))
            loss[above] = np.logaddexp(0, odds[:, above]).sum(axis=0, dtype=np.float64)
            out[part] = loss / -np.log(10)
        return out

    def learn(self, squares: np.ndarray, features: np.ndarray, ending: np.ndarray, leaf: np.ndarray) -> None:
        """One gradient step per batch, with a step size per weight."""
        for at in range(0, len(leaf) if self.depth else 0, BATCH):
            part = slice(at, at + BATCH)
            right, odds, places = self._paths(features[part], ending[part], leaf[part])
            # Token by token, so that sums have the same order whatever the layout.
            slope = (1 / (1 + np.exp(-odds)) - right).T.reshape(-1)
            slope *= np.float32(len(leaf[part]) ** -0.5)
            places = places.swapaxes(1, 2).reshape(len(TREE_FEATURES), -1)
            square = slope * slope
            for own in places:
                np.add.at(squares, own, square)
            slope *= np.float32(STEP)
            for own in places:
                np.subtract.at(self.weights, own, slope / np.sqrt(squares.take(own)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokenizer = Tokenizer()
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    ends = held = 0
    # The frequent words of the first chunk are counted by look-up, the others by sorting.
    table: _Table | None = None
    known = seen = np.zeros(0, np.int64)

    def merged(parts):
        hashes = np.concatenate([p[0] for p in parts])
        packed = np.concatenate([p[1] for p in parts])
        order = np.argsort(hashes)
        hashes, packed = hashes[order], packed[order]
        lead = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        # Endings take the low bits, counts the rest.
        counts = np.add.reduceat(packed >> 12, lead)
        return hashes[lead], counts << 12 | (packed[lead] & 4095)

    def rows(parts):
        hashes, packed = merged(parts)
        return pa.RecordBatch.from_arrays([
            pa.array(hashes.view(np.int64)), pa.array((packed & 4095).astype(np.int32)),
            pa.array(packed >> 12),
        ], COUNTS.names)

    for batch in batches:
        for _, _, data, offsets in text_chunks(batch.column("text")):
            words = tokenizer.words(data, offsets)
            ends += len(offsets) - 1
            if table:
                rank = table.find(words.hashes)
                seen += np.bincount(rank, minlength=len(seen))
                words = words.some(np.flatnonzero(rank == len(known)))
            if len(words.hashes):
                one = np.int64(1) << 12 | _endings(words, data).astype(np.int64)
                kept.append(merged([(words.hashes, one)]))
                held += len(kept[-1][0])
            if not table and len(words.hashes):
                often = kept[-1][1].argsort()[: -KNOWN_WORDS - 1 : -1]
                table, known = _Table(kept[-1][0][often], KNOWN_SLOTS), kept[-1][1][often] & 4095
                hashes, seen = kept[-1][0][often], np.zeros(len(known) + 1, np.int64)
            if held > 1 << 21:
                kept = [merged(kept)]
                if len(kept[0][0]) > 1 << 20:
                    yield rows(kept)
                    kept = []
                held = sum(len(k[0]) for k in kept)
    if table:
        kept.append((hashes, seen[:-1] << 12 | known))
    if kept:
        yield rows(kept)
    yield pa.RecordBatch.from_arrays(
        [pa.array([int(END)], pa.int64()), pa.array([-1], pa.int32()), pa.array([ends], pa.int64())],
        COUNTS.names,
    )


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each ending follows a word of each hash bucket."""
    tokenizer = Tokenizer()
    seen = np.zeros(ENDINGS * PROFILE, dtype=np.int64)
    for batch in batches:
        for _, _, data, offsets in text_chunks(batch.column("text")):
            words = tokenizer.words(data, offsets)
            before = (words.hashes[:-1] % np.uint64(PROFILE)).astype(np.int64)
            cell = _endings(words, data)[1:] * PROFILE + before
            text = words.text_of_word()
            seen += np.bincount(cell[text[1:] == text[:-1]], minlength=len(seen))
    parts = seen.reshape(BLOCKS, -1)
    yield pa.RecordBatch.from_arrays([
        pa.array(np.arange(BLOCKS, dtype=np.int32)),
        pa.array([p.tobytes() for p in parts], pa.binary()),
    ], PROFILES.names)


def _add_profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(*(c.to_pylist() for c in batch.columns)):
            part = np.frombuffer(counts, np.int64)
            sums[block] = sums[block] + part if block in sums else part.copy()
    yield pa.RecordBatch.from_arrays([
        pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())
    ], PROFILES.names)


def _ending_groups(seen: np.ndarray) -> np.ndarray:
    """Class of every ending: k-means over the square roots of its relative profile.

    Profiles of rare endings are drawn towards the average one.
    """
    totals = seen.sum(axis=1)
    average = seen.sum(axis=0) / max(totals.sum(), 1)
    points = np.sqrt((seen + PRIOR * average) / (totals + PRIOR)[:, None])
    # Start from frequent endings that differ most from those chosen before.
    weight = np.sqrt(totals)
    centres = points[[int(totals.argmax())]]
    far = ((points - centres[0]) ** 2).sum(axis=1)
    for _ in range(ENDING_CLASSES - 1):
        centres = np.vstack([centres, points[int((far * weight).argmax())]])
        far = np.minimum(far, ((points - centres[-1]) ** 2).sum(axis=1))
    for _ in range(25):
        groups = ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
        for k in range(ENDING_CLASSES):
            own = groups == k
            if weight[own].sum() > 0:
                centres[k] = np.average(points[own], axis=0, weights=weight[own])
    return groups.astype(np.int32)


def ending_groups(texts: DataFrame) -> np.ndarray:
    """Ending classes from all ``texts(text)``; the table has a fixed size."""
    summed = texts.mapInArrow(_profile, PROFILES).repartition(BLOCKS, "block").mapInArrow(
        _add_profiles, PROFILES
    )
    seen = np.zeros((BLOCKS, ENDINGS * PROFILE // BLOCKS))
    for block, counts in summed.collect():  # one row per block
        seen[block] = np.frombuffer(counts, np.int64)
    return _ending_groups(seen.reshape(ENDINGS, PROFILE))


def _train(
    weights: np.ndarray, inner: np.ndarray, head: Head, groups: np.ndarray, sums: np.ndarray
):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, table = Tokenizer(), head.table()
        own, tree = _fresh(weights), Tree(_fresh(inner), sums)
        model, squares = Softmax(own), np.full(own.shape, 0.1, np.float32)
        tree_squares = np.full(inner.shape, 0.1, np.float32)
        tokens = 0
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column("text")):
                hashes, ending, first = _tokens(tokenizer, data, offsets, groups)
                rank = table.find(hashes)
                features, kind = _features(rank, ending, first), _classes(rank, ending)
                model.learn(squares, features, kind)
                inside = np.flatnonzero(kind > SINGLE_WORDS)
                tree.learn(
                    tree_squares, features[inside], ending[inside], tree.leaf(hashes[inside])
                )
                tokens += len(hashes)
        if tokens:
            change = np.concatenate([(own - weights).reshape(-1), tree.weights - inner])
            delta = change.reshape(BLOCKS, -1).astype(np.float16)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(BLOCKS, dtype=np.int32)),
                pa.array(np.full(BLOCKS, tokens)),
                pa.array([d.tobytes() for d in delta], pa.binary()),
            ], UPDATES.names)
    return run


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean of each weight's updates over the tasks that changed it, by their tokens."""
    sums: dict[int, np.ndarray] = {}
    sizes: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, tokens, delta in zip(*(c.to_pylist() for c in batch.columns)):
            change = np.frombuffer(delta, np.float16).astype(np.float64)
            if block not in sums:
                sums[block], sizes[block] = np.zeros(len(change)), np.zeros(len(change))
            sums[block] += tokens * change
            sizes[block] += tokens * (change != 0)
    blocks = list(sums)
    yield pa.RecordBatch.from_arrays([
        pa.array(blocks, pa.int32()), pa.array([0] * len(blocks), pa.int64()),
        pa.array([
            (sums[b] / np.maximum(sizes[b], 1)).astype(np.float16).tobytes() for b in blocks
        ], pa.binary()),
    ], UPDATES.names)


def _tail_lists(text: np.ndarray, hashes: np.ndarray, tail: np.ndarray, texts: int) -> pa.ListArray:
    """The distinct words among the tokens at ``tail``, and how often they occur, by text."""
    order = tail[np.lexsort((hashes[tail], text[tail]))]
    own, words = text[order], hashes[order]
    lead = np.flatnonzero(
        np.append(True, (own[1:] != own[:-1]) | (words[1:] != words[:-1]))[: len(order)]
    )
    pairs = pa.StructArray.from_arrays([
        pa.array(words[lead].view(np.int64)), pa.array(np.diff(lead, append=len(order))),
    ], ["word", "k"])
    first = np.append(0, np.cumsum(np.bincount(own[lead], minlength=texts)))
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pairs)


def _score(
    weights: np.ndarray, inner: np.ndarray, head: Head, groups: np.ndarray, sums: np.ndarray
):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, table, model = Tokenizer(), head.table(), Chances(_fresh(weights))
        tree = Tree(_fresh(inner), sums)
        logs = np.append(np.log10(head.counts + 1.0), 0.0)
        for batch in batches:
            for row, stop, data, offsets in text_chunks(batch.column("text")):
                hashes, ending, first = _tokens(tokenizer, data, offsets, groups)
                rank = table.find(hashes)
                features, kind = _features(rank, ending, first), _classes(rank, ending)
                chance = model.of(features, kind)
                text = np.repeat(np.arange(stop - row), np.diff(first))

                def total(values):
                    return np.bincount(text, values, minlength=stop - row)

                listed = rank < len(head.hashes)
                single = kind <= SINGLE_WORDS
                inside = np.flatnonzero(~single)
                own, leaf = ending[inside], tree.leaf(hashes[inside])
                norms, chances = (np.zeros(len(kind)) for _ in range(2))
                norms[inside] = tree.logs.reshape(-1).take(own * tree.leaves + leaf)
                chances[inside] = tree.log_chances(features[inside], own, leaf)
                lists = _tail_lists(text, hashes, np.flatnonzero(~listed), stop - row)
                ids = batch.slice(row, stop - row)
                yield pa.RecordBatch.from_arrays([
                    ids.column("doc_id"), ids.column("held_out"), pa.array(np.diff(first)),
                    pa.array(total(listed).astype(np.int64)), pa.array(total(logs[rank])),
                    pa.array(total(np.where(single, logs[rank], 0.0))),
                    pa.array(total(norms)),
                    pa.array(total(
                        np.log10(np.maximum(chance.astype(np.float64), 1e-30)) + chances
                    )),
                    lists,
                ], SCORES.names)
    return run


def _average_updates(updates: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Averaged updates of all weights, of classes and of trees; the model is small,
    whatever the corpus."""
    averaged = updates.repartition(BLOCKS, "block").mapInArrow(_average, UPDATES)
    delta = np.zeros((BLOCKS, (ROWS * CLASSES + (1 << TREE_BITS)) // BLOCKS), dtype=np.float32)
    for block, _, values in averaged.collect():  # one row per block
        delta[block] = np.frombuffer(values, np.float16)
    flat = delta.reshape(-1)
    return flat[: ROWS * CLASSES].reshape(ROWS, CLASSES), flat[ROWS * CLASSES :]


def _tree_depth(words: int) -> int:
    """Levels of the trees for so many words in all ending classes."""
    share = words // (ENDING_CLASSES * LEAF_WORDS)
    return min(max(share.bit_length() - 1, 0), TREE_DEPTH)


def _leaf_sums(rest: DataFrame, groups: np.ndarray, depth: int) -> np.ndarray:
    """Smoothed counts of every class and leaf, from ``rest(word, ending, n)``: every word
    has one added, and a word that was not seen counts one in every leaf."""
    kinds = rest.sparkSession.createDataFrame(
        list(enumerate(groups.tolist())), "ending int, kind int"
    )
    leaf = F.shiftrightunsigned("word", 64 - depth) if depth else F.lit(0).cast("long")
    summed = rest.join(F.broadcast(kinds), "ending").groupBy("kind", leaf.alias("leaf")).agg(
        F.sum(F.col("n") + 1).alias("n")
    )
    sums = np.ones((ENDING_CLASSES, 1 << depth))
    for kind, place, n in summed.collect():  # one row per class and leaf at most
        sums[kind, place] += n
    return sums


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, ending, n)`` of ``texts(text)``; the end of a text is a word too."""
    # A task's rows are sums already, so they are not summed again before the shuffle.
    counts = texts.mapInArrow(_count, COUNTS).repartition("word").groupBy("word").agg(
        F.max("ending").alias("ending"), F.sum("n").alias("n")
    ).filter("n > 0")
    return materialize(counts, "words")


def _head(counts: DataFrame) -> Head:
    """The most frequent words, fewer than HEAD_WORDS of them, and in any case the end and
    the CONTEXT_WORDS most frequent ones, among them the single words."""
    place = F.lit(2**COUNT_BITS - 1) - F.least("n", F.lit(2**COUNT_BITS - 1))
    placed = counts.select("word", "n", place.alias("place"))
    units = placed.groupBy("place").agg(F.count("*").alias("amount")).withColumn("grp", F.lit(0))
    wanted = counts.sparkSession.range(1).select(
        F.lit(0).alias("grp"), F.lit(float(HEAD_WORDS)).alias("wanted")
    )
    # Words as frequent as the last one may be many; they stay out, unless needed anyway.
    last = cuts(units, wanted, COUNT_BITS).select("place").first()
    frequent = placed.filter(F.col("place") < last["place"]) if last else placed
    needed = placed.orderBy(F.desc("n"), F.desc("word")).limit(CONTEXT_WORDS)
    end = placed.filter(F.col("word") == int(END))
    listed = {(n, word) for part in (frequent, needed, end) for word, n, _ in part.collect()}
    rows = sorted(listed, reverse=True)
    hashes = np.array([w for _, w in rows], dtype=np.int64).view(np.uint64)
    return Head(hashes, np.array([n for n, _ in rows], dtype=np.float64))


def scores(docs: DataFrame) -> DataFrame:
    """Log10 probability of every text of ``docs(doc_id, text)``.

    Rows are learnt from unless crc32 of the id as text leaves 2 when divided by seven.
    Columns: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known`` (tokens that occur in
    the training texts), ``train_tokens``, ``base_score`` (unigram model with one added
    to every count) and ``score`` (this model), both log10.

    A null text is an empty one: its only token is the end. A row with a null id is
    learnt from. Repeated rows count as often as they occur and score alike. An empty
    table gives an empty result; further columns are ignored.
    """
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(remainder == 2, F.lit(False)).alias("held_out"),
    )
    training = texts.filter("not held_out").select("text", F.xxhash64("doc_id", "text").alias("h"))
    counts = word_counts(training.select("text"))
    head = _head(counts)
    single = head.hashes[head.hashes != END][:SINGLE_WORDS]
    # Single words first, then the end.
    own_class = np.isin(head.hashes, single)
    order = np.argsort(np.where(own_class, 0, np.where(head.hashes == END, 1, 2)), kind="stable")
    head = Head(head.hashes[order], head.counts[order])
    chosen = [int(h) for h in single.view(np.int64)]

    groups = ending_groups(training.select("text"))
    kinds = counts.withColumn("own", F.col("word").isin(chosen + [int(END)])) if chosen else (
        counts.withColumn("own", F.col("word") == int(END))
    )
    totals = np.ones(CLASSES)
    train_tokens = vocabulary = inside = 0
    summed = kinds.groupBy("own", "ending").agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    for own, ending, n, v in summed.collect():  # at most two rows per ending
        train_tokens, vocabulary = train_tokens + n, vocabulary + v
        if not own:
            totals[1 + SINGLE_WORDS + groups[ending]] += n
            inside += v
    sums = _leaf_sums(kinds.filter("not own"), groups, _tree_depth(inside))
    for rank in range(len(single)):
        totals[1 + rank] += head.counts[rank]
    is_end = head.hashes == END
    totals[0] += head.counts[is_end].sum()
    weights = np.zeros((ROWS, CLASSES), dtype=np.float32)
    weights[BIAS] = np.log(totals / totals.sum())
    inner = np.zeros(1 << TREE_BITS, dtype=np.float32)
    for step in range(ROUNDS):
        part = training.filter(F.pmod("h", F.lit(ROUNDS)) == step).select("text")
        classes, nodes = _average_updates(
            part.mapInArrow(_train(weights, inner, head, groups, sums), UPDATES)
        )
        weights, inner = weights + classes, inner + nodes
    scored = materialize(
        texts.mapInArrow(_score(weights, inner, head, groups, sums), SCORES).withColumn(
            "row", F.monotonically_increasing_id()
        ), "scored",
    )
    tail = scored.select("row", F.inline("tail"))
    known = tail.join(counts.select("word", "n"), "word").groupBy("row").agg(
        F.sum("k").alias("tail_known"), F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("tail_sum"),
    )
    base_norm = float(np.log10(train_tokens + vocabulary + 1.0))
    tail_sum = F.coalesce("tail_sum", F.lit(0.0))
    return scored.drop("tail").join(known, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("head_sum") + tail_sum - F.col("n_tokens") * F.lit(base_norm)).alias("base_score"),
        (F.col("class_sum") + F.col("head_sum") - F.col("single_sum") + tail_sum
         - F.col("norm_sum")).alias("score"),
    )
