"""Date patterns of text columns, found from all their values.

A value's shape is what is left when every run of digits is one mark. Each candidate
pattern has a shape. Per shape the extremes of its numbers are aggregated in one pass; a
pattern is out if its month, day, hour, minute or second would have to hold a number that
it cannot, or its year one of another length. What is left may be one pattern, none, or
several: then the values fit all of them, and that is reported.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.session import materialize

# Patterns that are tried, and the numbers that each of their fields holds.
PATTERNS = [
    "M/d/yyyy H:mm", "d/M/yyyy H:mm", "M/d/yyyy H:mm:ss", "d/M/yyyy H:mm:ss", "M/d/yyyy",
    "d/M/yyyy", "yyyy-M-d H:mm:ss", "yyyy-M-d H:mm", "yyyy-M-d'T'H:mm:ss", "yyyy-M-d",
    "yyyy/M/d", "d.M.yyyy", "d.M.yyyy H:mm", "d-M-yyyy", "M-d-yyyy",
]
LIMITS = {"y": (0, 9999), "M": (1, 12), "d": (1, 31), "H": (0, 23), "m": (0, 59), "s": (0, 59)}
MARK = "#"
MOST_PARTS = 6
LONGEST = 32  # characters; no candidate is longer


def fields(pattern: str) -> list[str]:
    """Letters of the pattern's fields, in order, with their repetition."""
    return [m[0] for m in re.finditer(r"([yMdHms])\1*", re.sub("'[^']*'", "", pattern))]


def shape(pattern: str) -> str:
    marked = "".join(
        part if quoted else re.sub(r"([yMdHms])\1*", MARK, part)
        for quoted, part in enumerate_quoted(pattern)
    )
    return marked


def enumerate_quoted(pattern: str) -> list[tuple[bool, str]]:
    """Parts of a pattern outside and inside single quotes."""
    return [(bool(i % 2), part) for i, part in enumerate(pattern.split("'"))]


def shape_counts(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column and shape of a candidate: ``n`` values, and for each of its numbers the
    extremes ``low``, ``high``, ``short`` and ``long`` (of its digits). Values of other
    shapes are counted under a null shape."""
    known = sorted({shape(p) for p in PATTERNS})
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("value")) for c in columns
    ])).alias("p")
    values = raw.select(pairs).select("p.*").filter("value is not null")
    marked = F.when(
        F.length("value") <= LONGEST, F.regexp_replace("value", "[0-9]+", MARK)
    )
    parts = F.regexp_extract_all("value", F.lit("([0-9]+)"), F.lit(1))
    shaped = values.select(
        "column_name", F.when(marked.isin(known), marked).alias("shape"), parts.alias("parts")
    )
    def number(i: int) -> Column:
        return F.get("parts", F.lit(i)).try_cast("long")

    extremes = []
    for i in range(MOST_PARTS):
        width = F.length(F.get("parts", F.lit(i)))
        extremes.append(F.struct(
            F.min(number(i)).alias("low"), F.max(number(i)).alias("high"),
            F.min(width).alias("short"), F.max(width).alias("long"),
        ))
    return shaped.groupBy("column_name", "shape").agg(
        F.count("*").alias("n"), F.array(*extremes).alias("parts")
    )


def _holds(pattern: str) -> Column:
    """Whether all values of the pattern's shape can be read by it."""
    fits = F.lit(True)
    for i, letters in enumerate(fields(pattern)):
        part, (low, high) = F.col("parts")[i], LIMITS[letters[0]]
        fits = fits & (part["low"] >= low) & (part["high"] <= high)
        if letters == "yyyy":
            fits = fits & (part["short"] == 4) & (part["long"] == 4)
        elif len(letters) == 2:
            fits = fits & (part["short"] == 2) & (part["long"] == 2)
        else:
            fits = fits & (part["long"] <= 2)
    return fits


def format_report(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column and candidate pattern whose shape occurs.

    ``n_present`` values of the column, ``n_shape`` of the pattern's shape, ``possible``
    (no value contradicts) and ``n_rivals``, the other possible patterns of that shape:
    more than none means that the values cannot tell.
    """
    # Some rows per column, which are read several times; the values are read once.
    counts = materialize(shape_counts(raw, columns), "shapes")
    totals = counts.groupBy("column_name").agg(F.sum("n").alias("n_present"))
    candidates = F.explode(F.array(*[
        F.struct(
            F.lit(p).alias("pattern"), F.lit(shape(p)).alias("of_shape"),
            F.when(F.col("shape") == shape(p), _holds(p)).otherwise(False).alias("possible"),
        ) for p in PATTERNS
    ])).alias("c")
    rows = counts.select("column_name", "shape", "n", candidates).filter("shape = c.of_shape")
    judged = rows.select(
        "column_name", "c.pattern", "shape", F.col("n").alias("n_shape"),
        F.coalesce("c.possible", F.lit(False)).alias("possible"),
    )
    # At most as many rows as patterns per column.
    possible = judged.filter("possible").groupBy("column_name", "shape").agg(
        F.count("*").alias("_possible")
    )
    return judged.join(possible, ["column_name", "shape"], "left").join(totals, "column_name").select(
        "column_name", "pattern", "n_present", "n_shape", "possible",
        (F.coalesce("_possible", F.lit(0)) - F.col("possible").cast("int")).cast("long")
        .alias("n_rivals"),
    )


def infer_patterns(
    raw: DataFrame, columns: Sequence[str], prefer: str | None = None
) -> dict[str, list[str]]:
    """Patterns by which the values of each column are read, the most frequent first.

    A column with values of several shapes has several. If two patterns are possible for
    a shape, the one that ``prefer`` names (such as 'M/d/yyyy') by its first three fields
    is taken; without it the tie is an error.
    """
    found: dict[str, dict[str, tuple[int, list[str]]]] = {c: {} for c in columns}
    for row in format_report(raw, columns).filter("possible").collect():
        own = found[row["column_name"]].setdefault(shape(row["pattern"]), (row["n_shape"], []))
        own[1].append(row["pattern"])
    out = {}
    for column, shapes in found.items():
        chosen = []
        for n, names in sorted(shapes.values(), key=lambda s: (-s[0], s[1])):
            kept = names
            if len(names) > 1 and prefer:
                kept = [p for p in names if fields(p)[:3] == fields(prefer)[:3]]
            if len(kept) != 1:
                raise ValueError(f"the dates of {column!r} fit {sorted(names)} alike")
            chosen += kept
        out[column] = chosen
    return out
