"""Toxic documents by multiple-instance learning.

A document is a bag of sentences. Every sentence has a probability, logistic in its hashed
features; a document is toxic unless all its sentences are not, so their probabilities are
combined by noisy-or. Only documents have labels: the gradient shares the blame of a toxic
one among its sentences by their probabilities, and the sentences that took it are the
offending ones.

Features are terms and the beginnings of terms. Those with no evidence at document level
are left out before training, so a round passes over short lists and its sums are one row
per feature.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.llm.terms import Terms, sentence_of
from punctual.llm.tokens import mix, text_chunks
from punctual.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FEATURE_BITS = 20
PREFIXES = (3, 4, 5, 6)  # bytes
# Evidence (twice the log-likelihood ratio of document counts) that a feature needs, and
# the number of features with most evidence that are trained.
EVIDENCE = 15.0
# At most this many labelled rows are examples, the first by a hash of the id. Their ids go
# to all tasks, so that no text is shuffled.
TRAIN_ROWS = 30_000
FEATURES = 1 << 14
ROUNDS = 25
STEP = 0.7
FIRST_BIAS, BIAS_STEP = -7.0, 0.5
PENALTY = 1e-3
THRESHOLD = 0.3

BAGS = T.StructType([
    T.StructField("toxic", T.BooleanType()), T.StructField("plain", T.LongType()),
    T.StructField("ends", T.ArrayType(T.IntegerType())),
    T.StructField("features", T.ArrayType(T.IntegerType())),
])
COUNTS = T.StructType([T.StructField("feature", T.IntegerType()), T.StructField("n", T.LongType())])
SUMS = T.StructType([
    T.StructField("feature", T.IntegerType()), T.StructField("gradient", T.DoubleType()),
])
SENTENCE = T.StructType([
    T.StructField("sentence", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("stop", T.LongType()), T.StructField("probability", T.DoubleType()),
])


class Model:
    """Weights of the trained features (sorted), the bias, and the number of bags."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, bias: float):
        self.features, self.weights, self.bias = features, weights, bias


class _Sentences:
    """Sentences of a chunk of texts with their features, each counted once.

    ``text`` is the text of every sentence, ``first`` and ``last`` its byte range, ``of``
    the sentence of every feature.
    """

    def __init__(self, terms: Terms, data: np.ndarray, offsets: np.ndarray):
        words = terms.words(data, offsets)
        number = sentence_of(data, words)
        size = words.ends - words.starts
        sums = terms.prefix_sums(data)
        hashes, of = [words.hashes], [np.arange(len(size))]
        for length in PREFIXES:
            some = np.flatnonzero(size > length)
            starts = words.starts[some]
            hashes.append(mix(
                terms.part_hashes(sums, starts, starts + length) + np.uint64(length)
            ))
            of.append(some)
        feature = (np.concatenate(hashes) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
        begins = np.flatnonzero(np.diff(number, prepend=-1))
        sentence = np.cumsum(np.isin(np.arange(len(number)), begins)) - 1
        both = np.unique((sentence[np.concatenate(of)] << FEATURE_BITS) | feature)
        self.of, self.features = both >> FEATURE_BITS, both & ((1 << FEATURE_BITS) - 1)
        self.text = words.text_of_word()[begins]
        self.first = words.starts[begins]
        stops = np.append(begins[1:], len(number)) - 1 if len(begins) else begins
        self.last = words.ends[stops]

    def kept(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in ``features`` (sorted), and sentence, of the features found there."""
        if not len(features):
            return self.of[:0], self.of[:0]
        place = np.minimum(np.searchsorted(features, self.features), len(features) - 1)
        found = features[place] == self.features
        return place[found], self.of[found]

    def log_clean(self, model: Model) -> np.ndarray:
        """Log of the probability that a sentence is not toxic."""
        place, of = self.kept(model.features)
        value = np.bincount(of, model.weights[place], minlength=len(self.text)) + model.bias
        return -np.logaddexp(0, value)


def _count(some: np.ndarray | None):
    """Texts by feature; with ``some`` (sorted) only of these features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, counts = Terms(), np.zeros(1 << FEATURE_BITS, np.int64)
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column("text")):
                found = _Sentences(terms, data, offsets)
                if some is None:
                    features, of = found.features, found.of
                else:
                    place, of = found.kept(some)
                    features = some[place]
                both = np.unique((found.text[of] << FEATURE_BITS) | features)
                counts += np.bincount(both & ((1 << FEATURE_BITS) - 1), minlength=len(counts))
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(counts[seen])], COUNTS.names
        )
    return run


def _evidence(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Twice the log-likelihood ratio of the counts, 0 where the feature speaks against."""
    rows, having = n_toxic + n_clean, toxic + clean

    def part(seen, expected):
        return seen * np.log(np.where(seen > 0, seen / np.maximum(expected, 1e-300), 1.0))

    total = (
        part(toxic, having * n_toxic / rows) + part(clean, having * n_clean / rows)
        + part(n_toxic - toxic, (rows - having) * n_toxic / rows)
        + part(n_clean - clean, (rows - having) * n_clean / rows)
    )
    return np.where(toxic * n_clean > clean * n_toxic, 2 * total, 0.0)


def _by_feature(texts: DataFrame, some: np.ndarray | None, least: int) -> tuple:
    rows = texts.select("text").mapInArrow(_count(some), COUNTS).groupBy("feature").agg(
        F.sum("n").alias("n")
    ).filter(F.col("n") >= least).collect()  # one row per feature
    rows.sort()
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)


def _chosen(train: DataFrame, n_toxic: int, n_clean: int) -> np.ndarray:
    """Features with most evidence, sorted."""
    most = n_toxic * np.log((n_toxic + n_clean) / n_toxic)  # of a feature of all toxic texts
    least = max(2, int(EVIDENCE / 2 / max(most / n_toxic, 1e-9) / 2))
    features, toxic = _by_feature(train.filter("toxic"), None, least)
    seen, n = _by_feature(train.filter("not toxic"), features, 1)
    clean = np.zeros(len(features), np.int64)
    clean[np.searchsorted(features, seen)] = n
    evidence = _evidence(toxic, clean, n_toxic, n_clean)
    order = np.lexsort((features, -evidence))[:FEATURES]
    return np.sort(features[order[evidence[order] >= EVIDENCE]])


def _bags(features: np.ndarray):
    """Per text the number of sentences without a feature and the features of the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
            for row, stop, data, offsets in text_chunks(batch.column("text")):
                found = _Sentences(terms, data, offsets)
                place, of = found.kept(features)
                some, counts = np.unique(of, return_counts=True)
                text, texts = found.text[some], stop - row
                all_of = np.bincount(found.text, minlength=texts)
                in_text = np.bincount(text, minlength=texts)
                into = np.bincount(text, counts, minlength=texts).astype(np.int64)
                # Where each sentence ends in its text's list.
                through = np.cumsum(counts)
                before = np.concatenate([[0], np.cumsum(into)])[text]
                cuts = np.concatenate([[0], np.cumsum(in_text)]).astype(np.int32)
                lists = np.concatenate([[0], np.cumsum(into)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(toxic[row:stop]), pa.array((all_of - in_text).astype(np.int64)),
                    pa.ListArray.from_arrays(
                        pa.array(cuts), pa.array((through - before).astype(np.int32))
                    ),
                    pa.ListArray.from_arrays(pa.array(lists), pa.array(place.astype(np.int32))),
                ], BAGS.names)
    return run


def bag_gradient(
    toxic: np.ndarray, plain: np.ndarray, sentence_bag: np.ndarray, of: np.ndarray,
    place: np.ndarray, weights: np.ndarray, bias: float,
) -> tuple[np.ndarray, float]:
    """Gradient of the negative log-likelihood of bags by weights and bias.

    ``plain``: sentences without features per bag. ``sentence_bag``: bag of each other
    sentence; ``of`` and ``place``: sentence and weight of each feature.
    """
    value = np.bincount(of, weights[place], minlength=len(sentence_bag)) + bias
    p, p_plain = 1 / (1 + np.exp(-value)), 1 / (1 + np.exp(-bias))
    log_clean = np.bincount(sentence_bag, -np.logaddexp(0, value), minlength=len(plain))
    log_clean = log_clean - plain * np.logaddexp(0, bias)
    clean = np.exp(log_clean)
    blame = np.where(toxic, -clean / np.maximum(-np.expm1(log_clean), 1e-12), 1.0)
    own = p * blame[sentence_bag]
    gradient = np.bincount(place, own[of], minlength=len(weights))
    return gradient, float(own.sum() + (blame * plain).sum() * p_plain)


def _gradient(weights: np.ndarray, bias: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, of_bias = np.zeros(len(weights)), 0.0
        for batch in batches:
            ends, lists = batch.column("ends"), batch.column("features")
            bags = np.repeat(np.arange(batch.num_rows), ends.value_lengths().to_numpy())
            starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            through = starts[bags] + ends.flatten().to_numpy()
            of = np.repeat(np.arange(len(bags)), np.diff(through, prepend=0))
            gradient, part = bag_gradient(
                batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool),
                batch.column("plain").to_numpy(), bags, of, lists.flatten().to_numpy(),
                weights, bias,
            )
            total += gradient
            of_bias += part
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.append(some, -1).astype(np.int32)), pa.array(np.append(total[some], of_bias)),
        ], SUMS.names)
    return run


def train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> Model:
    """Model of ``docs(doc_id, text)`` with a label in ``labels(doc_id, toxic)``.

    The examples are TRAIN_ROWS labelled rows at most, with their whole texts; an id with
    different labels counts as toxic. Rows whose label or id is null are no examples.
    Without both kinds of examples no sentence is suspect: the model has no features.
    """
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        (F.max("toxic") == 1).alias("toxic")
    ).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    # Written once, as the texts are read three times.
    examples = materialize(
        docs.select("doc_id", text).join(F.broadcast(known), "doc_id").select("text", "toxic"),
        "examples",
    )
    counts = {r[0]: r[1] for r in examples.groupBy("toxic").count().collect()}
    n_toxic, n_clean = counts.get(True, 0), counts.get(False, 0)
    none = np.zeros(0, np.int64)
    if not n_toxic or not n_clean:
        return Model(none, np.zeros(0), FIRST_BIAS)
    features = _chosen(examples, n_toxic, n_clean)
    bags = materialize(examples.mapInArrow(_bags(features), BAGS), "bags")
    weights, bias = np.zeros(len(features)), FIRST_BIAS
    squares, bias_square, rows = np.full(len(features), 1e-8), 1e-8, n_toxic + n_clean
    for _ in range(rounds):
        sums = bags.mapInArrow(_gradient(weights, bias), SUMS).groupBy("feature").agg(
            F.sum("gradient")
        ).collect()  # one row per feature
        gradient, of_bias = PENALTY * weights, 0.0
        for feature, total in sums:
            if feature < 0:
                of_bias = total / rows
            else:
                gradient[feature] += total / rows
        squares += gradient**2
        bias_square += of_bias**2
        # Evidence only speaks for toxicity: weights stay at or above 0.
        weights = np.maximum(weights - STEP * gradient / np.sqrt(squares), 0)
        bias -= BIAS_STEP * STEP * of_bias / np.sqrt(bias_square)
    return Model(features, weights, bias)


def _score(model: Model, fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for row, stop, data, offsets in text_chunks(batch.column("text")):
                found = _Sentences(terms, data, offsets)
                log_clean = np.bincount(
                    found.text, found.log_clean(model), minlength=stop - row
                )
                score[row:stop] = -np.expm1(log_clean)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f) for f in fields[:-1]), pa.array(np.clip(score, 0, 1))], fields
            )
    return run


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``score``, the probability that the text is
    toxic. A text without terms, empty or null has score 0."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = docs.select(F.struct("*").alias("row"), text.alias("text"))
    layout = T.StructType([held.schema["row"], T.StructField("score", T.DoubleType())])
    return held.mapInArrow(_score(model, ["row", "score"]), layout)


def _locate(model: Model, least: float, fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            for row, _, data, offsets in text_chunks(batch.column("text")):
                found = _Sentences(terms, data, offsets)
                p = -np.expm1(found.log_clean(model))
                within = np.arange(len(p)) - np.searchsorted(found.text, found.text)
                some = np.flatnonzero(p >= least)
                text = found.text[some]
                # Characters start at bytes that continue none.
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                start = chars[found.first[some]] - chars[offsets[text]]
                stop = chars[found.last[some]] - chars[offsets[text]]
                keep = batch.column("row").take(pa.array(text + row))
                yield pa.RecordBatch.from_arrays([
                    keep, pa.array(within[some].astype(np.int32)), pa.array(start),
                    pa.array(stop), pa.array(p[some]),
                ], fields)
    return run


def offending_sentences(docs: DataFrame, model: Model, least: float = THRESHOLD) -> DataFrame:
    """Sentences with a probability of at least ``least``: all columns of ``docs`` in
    ``row``, and ``sentence`` (its number in the text, from 0, among those with a term),
    ``start`` and ``stop`` (code points, from the first term to the end of the last),
    ``probability`` and ``excerpt``.

    A toxic text need not have one: many sentences of little suspicion add up as well.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = docs.select(F.struct("*").alias("row"), text.alias("text"))
    layout = T.StructType([held.schema["row"], *SENTENCE.fields])
    found = held.mapInArrow(_locate(model, least, layout.names), layout)
    return found.withColumn("excerpt", F.expr("substring(row.text, start + 1, stop - start)"))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all rows of ``docs(doc_id, text)`` by a model of the rows not held out.

    Columns: ``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from a score
    of 0.3 on). Only the text is an input of a score, so equal texts have equal scores.

    A null, empty or blank text has score 0. Repeated rows come as often as they are there
    and a null id stays null; it has no label. Without toxic or without clean labelled rows
    the features stay out and only the number of sentences counts. An empty table gives an
    empty result; further columns are ignored.
    """
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    seen = ~held_out(F.col("doc_id"))
    model = train(slim.filter(seen), labels.filter(seen))
    return scored(slim, model).select(
        F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"),
        "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
