"""Quality selection by importance resampling.

Two generative models of hashed word n-grams are fitted: one on target texts, one on all
texts. The log importance weight of a text is the mean log ratio of its n-grams under the
two, for a text of a common length, so that long texts do not win or lose by length alone.
Adding Gumbel noise and taking the largest k is a sample without replacement in
proportion to the weights.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.llm.cuts import cuts
from punctual.llm.tokens import Tokenizer, mix, text_chunks
from punctual.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Buckets of hashed n-grams; the model is two counts per bucket.
BUCKETS = 1 << 16
PLACE_BITS = 60
# At most this many labelled rows are the target sample.
TARGET_ROWS = 20_000
# Length, in n-grams, for which the importance weights are stated.
COMMON_LENGTH = 100

COUNTS = T.StructType([
    T.StructField("bucket", T.IntegerType()), T.StructField("target", T.LongType()),
    T.StructField("raw", T.LongType()),
])


def _grams(tokenizer: Tokenizer, data, offsets) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and all pairs of neighbours, and the text of each."""
    words = tokenizer.words(data, offsets)
    text = words.text_of_word()
    one = words.hashes
    pair = mix(one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:])
    same = text[:-1] == text[1:]
    mask = np.uint64(BUCKETS - 1)
    buckets = np.concatenate([one & mask, (pair & mask)[same]]).astype(np.int64)
    return buckets, np.concatenate([text, text[:-1][same]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokenizer = Tokenizer()
    target, raw = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        chosen = batch.column("is_target").to_numpy(zero_copy_only=False).astype(bool)
        for row, _, data, offsets in text_chunks(batch.column("text")):
            buckets, text = _grams(tokenizer, data, offsets)
            raw += np.bincount(buckets, minlength=BUCKETS)
            own = buckets[chosen[row + text]]
            target += np.bincount(own, minlength=BUCKETS)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(some.astype(np.int32)), pa.array(target[some]), pa.array(raw[some])],
        COUNTS.names,
    )


def log_ratios(docs: DataFrame, target_ids: DataFrame) -> np.ndarray:
    """Log of the target over the raw probability of every bucket, add-one smoothed.

    ``docs(doc_id, text)`` are all counted. ``target_ids(doc_id)`` must be bounded: the
    planner may send it to every task.
    """
    ids = target_ids.select("doc_id").distinct().withColumn("is_target", F.lit(True))
    marked = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left").select(
        "text", F.coalesce("is_target", F.lit(False)).alias("is_target")
    )
    counts = marked.mapInArrow(_count, COUNTS).groupBy("bucket").agg(
        F.sum("target").alias("target"), F.sum("raw").alias("raw")
    )
    target, raw = np.ones(BUCKETS), np.ones(BUCKETS)
    for bucket, of_target, of_raw in counts.collect():  # one row per bucket
        target[bucket] += of_target
        raw[bucket] += of_raw
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def _score(ratios: np.ndarray, fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer()
        for batch in batches:
            weight = np.zeros(batch.num_rows)
            for row, stop, data, offsets in text_chunks(batch.column("text")):
                buckets, text = _grams(tokenizer, data, offsets)
                total = np.bincount(text, ratios[buckets], minlength=stop - row)
                grams = np.bincount(text, minlength=stop - row)
                weight[row:stop] = COMMON_LENGTH * total / np.maximum(grams, 1)
            noise = batch.column("noise").to_numpy().view(np.uint64)
            uniform = ((noise >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
            key = weight - np.log(-np.log(uniform))
            # Order-preserving integers: flip the bits of negative keys, then let the
            # largest key have the smallest place.
            bits = key.view(np.int64)
            rising = np.where(bits < 0, ~bits, bits ^ np.int64(-(2**63))).view(np.uint64)
            place = (~rising >> np.uint64(64 - PLACE_BITS)).astype(np.int64)
            own = {"log_weight": weight, "key": key, "place": place}
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[f]) if f in own else batch.column(f) for f in fields], fields
            )
    return run


def scored(docs: DataFrame, ratios: np.ndarray, seed: int = 5) -> DataFrame:
    """``row`` (all columns of ``docs``), ``log_weight``, ``key`` and ``place``.

    The noise comes from the id and the text, so equal rows get equal keys.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = docs.select(
        F.struct("*").alias("row"), text.alias("text"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), text).alias("noise"),
    )
    layout = T.StructType([
        held.schema["row"], T.StructField("log_weight", T.DoubleType()),
        T.StructField("key", T.DoubleType()), T.StructField("place", T.LongType()),
    ])
    return held.mapInArrow(_score(ratios, layout.names), layout)


def target_sample(labels: DataFrame, rows: int = TARGET_ROWS) -> DataFrame:
    """At most ``rows`` ids of good, not toxic documents, the first by a hash of the id."""
    good = labels.filter("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null")
    return good.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def good_share(labels: DataFrame) -> float:
    """Share of good documents: the upper end (two standard errors) of what the labels
    say, so that a small number of labels does not cost good documents. Without labels 1."""
    rated = labels.filter("quality is not null")
    n, good = rated.agg(F.count("*"), F.count_if(F.col("quality") == 1)).first()
    if not n:
        return 1.0
    share = good / n
    return min(1.0, share + 2 * (share * (1 - share) / n) ** 0.5)


def _last_place(scores: DataFrame, share: float) -> int:
    """Place of the k-th largest key; k is the share of all rows, rounded up."""
    k = float(np.ceil(share * scores.count()))
    units = scores.groupBy("place").agg(F.count("*").alias("amount")).withColumn("grp", F.lit(0))
    wanted = scores.sparkSession.range(1).select(F.lit(0).alias("grp"), F.lit(k).alias("wanted"))
    found = cuts(units, wanted, PLACE_BITS).select("place").first()
    return found["place"] if found else -1


def selection(docs: DataFrame, labels: DataFrame, share: float | None = None) -> DataFrame:
    """Score and choice of every row of ``docs(doc_id, text)``.

    Columns: ``doc_id``, ``log_weight``, ``key`` (weight plus noise) and ``selected``,
    true for the ``share`` (default: that of the good labels) of rows with the largest
    keys. ``labels(doc_id, quality, toxic)`` name the target texts.

    Only texts that are not toxic are the target, but ``share`` counts every good row, so
    toxic rows of good quality stay: all 195 held out of sf0.1, with half of the labels.
    This is no filter of toxic texts. A smaller ``share`` loses clean rows before them.

    A null or blank text has no n-gram and weight 0. Rows that are equal in id and text
    have equal keys; rows that tie with the last one are all selected. Without target
    rows all weights follow the raw texts alone. An empty table gives an empty result;
    further columns are ignored.
    """
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    scores = materialize(
        scored(slim, log_ratios(slim, target_sample(labels))).select(
            F.col("row.doc_id").alias("doc_id"), "log_weight", "key", "place"
        ), "scores",
    )
    last = _last_place(scores, good_share(labels) if share is None else share)
    return scores.withColumn("selected", F.col("place") <= last).drop("place")


def selected_documents(
    docs: DataFrame, labels: DataFrame, share: float | None = None
) -> DataFrame:
    """The selected rows of ``docs`` with all their columns.

    The keys are computed again instead of joined, so that no text is shuffled.
    """
    ratios = log_ratios(docs, target_sample(labels))
    places = materialize(scored(docs, ratios).select("place"), "places")
    last = _last_place(places, good_share(labels) if share is None else share)
    return scored(docs, ratios).filter(F.col("place") <= last).select("row.*")
