"""Near duplicates by one-permutation hashing, banded buckets and star-shaped edges.

Method: every shingle is hashed once; the upper part of the hash is its bin, and a bin
keeps its smallest hash (one-permutation hashing). An empty bin takes the value of a
filled one that is first in a random order of its own (densification with a hash per
bin). Runs of bins are the bands, and equal bands are a bucket.

A bucket proposes one edge per member, to its centre, and not all pairs. Every edge is
confirmed on the full sets. What a star could miss is then looked for: where a bucket
still holds several components, the classes outside its main component are compared with
those that share an early member of the set, ranked from rare to frequent; this filter is
exact. So two members of a bucket that are linked always end up connected.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.llm.graph import components
from punctual.llm.tokens import SEED, Tokenizer, mix, shingles, text_chunks
from punctual.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BANDS = 40
WORD_BYTE = r"[^\x20\x09-\x0D]"

SIGNATURE = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text_key", T.LongType()),
    T.StructField("n_shingles", T.LongType()),
    T.StructField("set_key", T.BinaryType()),
    T.StructField("bands", T.ArrayType(T.LongType())),
])
SET = T.StructType([
    T.StructField("set_key", T.BinaryType()),
    T.StructField("shingles", T.ArrayType(T.LongType())),
])


def rows_per_band(similarity: float) -> int:
    """Bins in a band: a pair at the threshold is missed once in 10^5 at most."""
    return max(1, next(
        (r for r in range(10, 0, -1) if (1 - similarity**r) ** BANDS <= 1e-5), 1
    ))


def _sets(texts: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Sorted distinct shingles of every text, chunk by chunk with the first row."""
    tokenizer = Tokenizer()
    for row, stop, data, offsets in text_chunks(texts):
        hashes, first = shingles(tokenizer.words(data, offsets), size)
        yield row, [np.unique(hashes[first[i] : first[i + 1]]) for i in range(stop - row)]


def _set_keys(flat: np.ndarray, first: np.ndarray) -> np.ndarray:
    """128 bits per set, sums of two hashes of its members."""
    keys = np.zeros((len(first) - 1, 2), dtype=np.uint64)
    filled = np.flatnonzero(np.diff(first))
    if len(filled):
        for k in range(2):
            spread = mix(flat + np.uint64(k * 0x632BE59BD9B4E019 + 1))
            keys[filled, k] = np.add.reduceat(spread, first[filled])
    return keys


def _signatures(flat, first, bins, orders):
    """Densified bins of every set that is not empty; other rows stay zero."""
    count = len(first) - 1
    text = np.repeat(np.arange(count), np.diff(first))
    place = ((flat >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    slot = text * bins + place
    lead = np.ones(len(slot), dtype=bool)
    lead[1:] = slot[1:] != slot[:-1]  # members are sorted, so the first is the smallest
    out = np.zeros(count * bins, dtype=np.uint64)
    full = np.zeros(count * bins, dtype=bool)
    out[slot[lead]], full[slot[lead]] = flat[lead], True
    out, full = out.reshape(count, bins), full.reshape(count, bins)
    for i in np.flatnonzero(~full.all(axis=1)):
        filled = np.flatnonzero(full[i])
        if len(filled):
            empty = np.flatnonzero(~full[i])
            out[i, empty] = out[i, filled[orders[np.ix_(empty, filled)].argmin(axis=1)]]
    return out


def _bands(signatures: np.ndarray, rows: int) -> np.ndarray:
    count, bins = signatures.shape
    grouped = mix(signatures).reshape(count, bins // rows, rows)
    out = np.broadcast_to(
        np.arange(bins // rows, dtype=np.uint64) + np.uint64(1), grouped.shape[:2]
    ).copy()
    for k in range(rows):
        out = (out + grouped[:, :, k]) * np.uint64(0xD6E8FEB86659FD93)
    return mix(out)


def _sign(size: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = BANDS * rows
        rng = np.random.default_rng(SEED)
        orders = np.argsort(rng.random((bins, bins)), axis=1).astype(np.int32)
        for batch in batches:
            for row, sets in _sets(batch.column("text"), size):
                first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                flat = np.concatenate(sets)
                bands = _bands(_signatures(flat, first, bins, orders), rows).view(np.int64)
                ids = batch.slice(row, len(sets))
                keys = pa.array(
                    [k.tobytes() for k in _set_keys(flat, first)], pa.binary()
                )
                sizes = np.diff(first)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS),
                    pa.array(bands.reshape(-1)),
                )
                yield pa.RecordBatch.from_arrays(
                    [ids.column("doc_id"), ids.column("text_key"),
                     pa.array(sizes.astype(np.int64)), keys, lists], SIGNATURE.names,
                )
    return run


def _list_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in _sets(batch.column("text"), size):
                first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                flat = np.concatenate(sets)
                keys = pa.array(
                    [k.tobytes() for k in _set_keys(flat, first)], pa.binary()
                )
                lists = pa.ListArray.from_arrays(
                    pa.array(first.astype(np.int32)), pa.array(flat.view(np.int64))
                )
                yield pa.RecordBatch.from_arrays([keys, lists], SET.names)
    return run


def _enough(least: Column, union: Column, percent: int) -> Column:
    return 100 * least >= percent * union


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links among ``pairs(a, b, n_a, n_b)``, by their full sets."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(
            F.col("class_id").alias(side), F.col("shingles").alias(f"s_{side}")
        ), side)
    shared = F.size(F.array_intersect("s_a", "s_b")).cast("long")
    links = pairs.select("a", "b", "n_a", "n_b", shared.alias("shared"))
    union = F.col("n_a") + F.col("n_b") - F.col("shared")
    return materialize(
        links.filter(_enough(F.col("shared"), union, percent)).select("a", "b"), "confirmed"
    )


def _stars(members: DataFrame) -> DataFrame:
    """One pair per member of a bucket, with the bucket's centre.

    The centre is the member that meets most others in all its buckets: in a group of
    copies of one text with changes of their own, that is the least changed one.
    """
    meets = members.groupBy("class_id").agg(F.sum("n").alias("meets")).select(
        "class_id",
        (F.col("meets") * 4096 + F.pmod(F.xxhash64("class_id"), F.lit(4096))).alias("meets"),
    )
    weighed = materialize(members.join(meets, "class_id"), "weighed")
    centres = weighed.groupBy("bucket").agg(F.max_by("class_id", "meets").alias("centre"))
    return members.select("bucket", "class_id").join(centres, "bucket").select(
        F.least("centre", "class_id").alias("a"), F.greatest("centre", "class_id").alias("b")
    )


def _sized(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs whose set sizes allow a link."""
    pairs = pairs.filter("a < b").distinct()
    for side in ("a", "b"):
        pairs = pairs.join(classes.select(
            F.col("class_id").alias(side), F.col("n_shingles").alias(f"n_{side}")
        ), side)
    return pairs.filter(
        _enough(F.least("n_a", "n_b"), F.greatest("n_a", "n_b"), percent)
    ).select("a", "b", "n_a", "n_b")


def _left_open(members: DataFrame, links: DataFrame) -> DataFrame:
    """Classes of buckets that still hold several components.

    ``root`` is the component, ``outside`` whether the class is outside the largest
    component of one of its buckets. Of two classes that share a bucket and are not
    connected, one at least is outside.
    """
    roots = components(links).withColumnRenamed("node", "class_id")
    rooted = materialize(members.join(roots, "class_id", "left").select(
        "bucket", "class_id", F.coalesce("root", "class_id").alias("root")
    ), "rooted")
    parts = rooted.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    main = parts.groupBy("bucket").agg(
        F.count("*").alias("parts"), F.max_by("root", "n").alias("main")
    ).filter("parts > 1").drop("parts")
    return materialize(rooted.join(main, "bucket").groupBy("class_id", "root").agg(
        F.max(F.col("root") != F.col("main")).alias("outside")
    ), "open")


def _prefix_pairs(left_open: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of open classes, one of them outside, that can still reach the similarity.

    Members of a set are ranked from rare to frequent. Two sets that share enough have
    their first common member early in both: what follows it must suffice for the
    overlap that the two sizes ask for. No pair that can be a link is left out.
    """
    listed = sets.join(left_open, "class_id").select(
        "class_id", "root", "outside", F.size("shingles").cast("long").alias("n"),
        F.explode("shingles").alias("member"),
    )
    often = listed.groupBy("member").agg(F.count("*").alias("often")).filter("often > 1")
    # A member of one set only has no partner, but keeps its early rank.
    ranked = listed.join(often, "member", "left").withColumn("at", F.row_number().over(
        Window.partitionBy("class_id").orderBy(F.coalesce("often", F.lit(1)), "member")
    ))
    early = ranked.filter(
        F.col("often").isNotNull() & _enough(F.col("n") - F.col("at") + 1, F.col("n"), percent)
    )
    early = materialize(early.select("class_id", "root", "outside", "n", "member", "at"), "early")
    one, two = early.filter("outside").alias("x"), early.alias("y")
    n_x, n_y = F.col("x.n"), F.col("y.n")
    shared = F.least(n_x - F.col("x.at"), n_y - F.col("y.at")) + 1
    met = one.join(two, (F.col("x.member") == F.col("y.member"))
                   & (F.col("x.root") != F.col("y.root"))
                   & _enough(F.least(n_x, n_y), F.greatest(n_x, n_y), percent)
                   & _enough(shared, n_x + n_y - shared, percent))
    return met.select(
        F.least("x.class_id", "y.class_id").alias("a"),
        F.greatest("x.class_id", "y.class_id").alias("b"),
    )


def _class_links(classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links that connect all linked classes which share a bucket."""
    banded = classes.select("class_id", F.explode(F.array_distinct("bands")).alias("bucket"))
    counts = banded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = materialize(banded.join(counts, "bucket"), "members")
    wanted = materialize(
        classes.join(members.select("class_id").distinct(), "class_id").select(
            "class_id", "set_key", "source"
        ), "wanted",
    )
    # Texts are shuffled at every size, also where the list is still small.
    one = wanted.select("source.*").hint("merge")
    texts = docs.join(
        one, (docs.text_key == one.text_key) & docs.doc_id.eqNullSafe(one.doc_id), "left_semi"
    ).select("text")
    # Repeated rows give a set more than once.
    sets = texts.mapInArrow(_list_sets(size), SET).dropDuplicates(["set_key"])
    sets = materialize(
        wanted.join(sets, "set_key").select("class_id", "shingles"), "sets"
    )
    stars = materialize(_sized(_stars(members), classes, percent), "stars")
    found = _confirm(stars, sets, percent)
    # The star of a bucket of two was its only pair.
    left_open = _left_open(members.filter("n > 2"), found)
    more = _sized(_prefix_pairs(left_open, sets, percent), classes, percent)
    more = materialize(more.join(stars, ["a", "b"], "left_anti"), "more")
    return found.unionByName(_confirm(more, sets, percent))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.xxhash64(text).alias("text_key"),
    )


def _rooted_rows(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Signatures of all rows, and ``(set_key, root, component_id)`` of all sets."""
    keyed = _keyed(docs)
    rows = rows_per_band(percent / 100)
    signed = materialize(keyed.mapInArrow(_sign(size, rows), SIGNATURE), "signatures")
    grouped = signed.filter("n_shingles > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("least_id"),
        F.min(F.struct("text_key", "doc_id")).alias("source"),
        F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
    )
    classes = materialize(
        materialize(grouped, "grouped").withColumn("class_id", F.monotonically_increasing_id()),
        "classes",
    )
    roots = components(_class_links(classes, keyed, size, percent))
    member = classes.select("class_id", "set_key", "least_id").join(
        roots.withColumnRenamed("node", "class_id"), "class_id", "left"
    ).withColumn("root", F.coalesce("root", "class_id"))
    named = member.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labels = materialize(member.select("set_key", "root").join(named, "root"), "labels")
    return signed, labels


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
) -> DataFrame:
    """Component of near duplicates for every row of ``docs(doc_id, text)``.

    Two texts are linked when their sets of ``size``-word shingles share at least
    ``percent`` hundredths of their union. Columns: ``doc_id``, ``n_shingles`` (set
    size), ``component_id`` (smallest ``doc_id`` reachable by links, itself included)
    and ``kept`` (``doc_id`` is the ``component_id``).

    Texts with equal sets are one class, however many they are; only classes meet in
    buckets. Null and blank texts have an empty set and link with nothing. A text with
    fewer words than a shingle is one shingle. Repeated rows are returned as often as
    they occur, and all rows with the smallest ``doc_id`` are kept. A null ``doc_id``
    takes part, but never names a component unless no other id does; such a row is
    kept only if its component has no other id. An empty table gives an empty result;
    further columns are ignored.
    """
    signed, labels = _rooted_rows(docs, size, percent)
    filled = signed.filter("n_shingles > 0").join(labels, "set_key").select(
        "doc_id", "n_shingles", "component_id"
    )
    empty = signed.filter("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return filled.unionByName(empty).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with all its columns, one row per component of near duplicates.

    The row with the smallest ``doc_id`` stays (a null id is the last); among rows with
    that id the one with the smallest text hash, and of equal rows one. Null and blank
    texts are nobody's duplicates and all stay. Only ids and hashes are shuffled to find
    the rows; texts move once, to meet the list of those that go.
    """
    signed, labels = _rooted_rows(docs, size, percent)
    order = F.struct(
        F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("doc_id"),
        F.col("text_key").alias("text_key"),
    )
    first = signed.filter("n_shingles > 0").join(labels, "set_key").groupBy("root").agg(
        F.min(order).alias("first")
    )
    pair = F.xxhash64(F.lit(1), F.col("doc_id"), F.col("text_key"))
    kept = materialize(
        first.select("first.doc_id", "first.text_key").select("text_key", pair.alias("pair_key")),
        "kept",
    )
    held = docs.select(
        F.struct("*").alias("row"), F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("text").cast("string")).alias("text_key"),
        F.col("doc_id").cast("long").alias("doc_id"),
    ).withColumn("pair_key", pair)
    worded = F.coalesce(F.col("text").rlike(WORD_BYTE), F.lit(False))
    blank = held.filter(~worded).select("row.*")
    # Equal rows meet in their task first; what is left is joined where it already is.
    single = held.filter(worded).select("row", "text_key", "pair_key").dropDuplicates(
        ["text_key", "pair_key"]
    )
    return single.join(kept, ["text_key", "pair_key"], "left_semi").select("row.*").unionByName(blank)
