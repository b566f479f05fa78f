"""Line deduplication over overlapping windows of three lines.

Every three consecutive lines of a text are a window. A window that occurs before, in
the order of documents and positions, is a repetition; all lines that a repetition
covers are removed. A removed line always equals an earlier line that stays, so nothing
is lost altogether. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.session import materialize

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _windows(docs: DataFrame) -> DataFrame:
    """One row per window: the document's key, the position and 128 bits of hash."""
    held = docs.select("doc_id", "text_key", _lines(F.col("text")).alias("lines")).filter(
        F.size("lines") >= WINDOW
    )
    starts = F.explode(F.sequence(F.lit(0), F.size("lines") - WINDOW))
    placed = held.select("doc_id", "text_key", "lines", starts.alias("pos"))
    own = [F.col("lines")[F.col("pos") + k] for k in range(WINDOW)]
    return placed.select(
        "doc_id", "text_key", "pos", F.xxhash64(*own).alias("h1"),
        F.xxhash64(F.lit(1), *own).alias("h2"),
    )


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_key, removed)``: positions of the lines to remove, from 0.

    ``docs`` has ``doc_id``, ``text`` and ``text_key``. Only counts are kept for windows
    that occur once; one that fills a large part of all documents is counted per task
    before the shuffle.
    """
    windows = materialize(_windows(docs), "windows")
    often = windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    found = materialize(windows.join(often, ["h1", "h2"]), "repeated")
    # A null id comes last.
    order = F.struct(
        F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("doc_id"),
        F.col("text_key").alias("text_key"), F.col("pos").alias("pos"),
    )
    first = found.groupBy("h1", "h2").agg(F.min(order).alias("first"))
    later = found.join(first, ["h1", "h2"]).filter(order != F.col("first"))
    starts = later.groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias("starts"))
    covered = F.array_distinct(F.flatten(F.transform(
        "starts", lambda at: F.sequence(at, at + (WINDOW - 1))
    )))
    return materialize(starts.select("doc_id", "text_key", covered.alias("removed")), "removed")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns, ``text`` without repeated lines, and two more.

    ``n_lines`` is the number of lines of the text, ``n_removed`` how many of them went.
    Lines end at a line feed; the remaining ones are joined as they were. Documents are
    ordered by ``doc_id`` (null last), then by a hash of the text; the first occurrence
    of a window stays.

    A null text stays null and has no lines. A text of fewer lines than a window stays
    as it is. If all lines go, the text is empty. Rows that are the same in id and text
    are one document: what happens to one happens to all. An empty table gives an empty
    result. Existing columns called ``n_lines`` or ``n_removed`` are replaced.
    """
    text = F.col("text").cast("string")
    slim = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_key"))
    removed = repeated_lines(slim)
    kept = [F.col(f"row.{c}").alias(c) for c in docs.columns if c not in ("n_lines", "n_removed")]
    held = docs.select(F.struct("*").alias("row"), F.xxhash64(text).alias("key"))
    # Texts meet their list by a shuffle at every size, also where the list is still small.
    joined = held.join(
        removed.hint("merge"),
        (held["key"] == removed["text_key"]) & held["row.doc_id"].eqNullSafe(removed["doc_id"]),
        "left",
    ).select("row", "removed")
    lines = _lines(F.col("row.text").cast("string"))
    left = F.array_join(F.filter(
        lines, lambda _, at: ~F.array_contains(F.col("removed"), at)
    ), "\n")
    cleaned = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(left)
    return joined.select(
        *[cleaned.alias("text") if name == "text" else column
          for name, column in zip([c for c in docs.columns if c not in ("n_lines", "n_removed")], kept)],
        F.when(F.col("row.text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
    )
