"""Whether a logit can be estimated, and the equations that its estimate solves.

A maximum-likelihood logit has no finite estimate if a level or a number separates late
from other orders, and no unique one if a term is a sum of others. Both are found from
counts by level before a fit. After it, every term's sum over the observed outcomes must
equal the sum over the fitted probabilities.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INTERCEPT = "Intercept"


class NotEstimable(ValueError):
    """The data do not determine the coefficients."""


def _pairs(columns: Sequence[str]) -> Column:
    """Array of (factor, level) of a row."""
    return F.array(*[
        F.struct(F.lit(c).alias("factor"), F.col(c).cast("string").alias("level")) for c in columns
    ])


def level_counts(rows: DataFrame, categorical: Sequence[str], label: str) -> DataFrame:
    """``factor``, ``level``, ``n_rows`` and ``n_positive`` for every level."""
    cells = rows.groupBy(*categorical).agg(
        F.count("*").alias("n"), F.sum(label).alias("positive")
    )
    return cells.select(F.explode(_pairs(categorical)).alias("p"), "n", "positive").groupBy(
        "p.factor", "p.level"
    ).agg(F.sum("n").alias("n_rows"), F.sum("positive").cast("bigint").alias("n_positive"))


def separations(
    rows: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str
) -> list[str]:
    """Terms that separate the outcomes: levels with one outcome only, and numbers whose
    range in one outcome ends where that in the other begins."""
    found = []
    if categorical:
        one = F.col("n_positive").isin(0) | (F.col("n_positive") == F.col("n_rows"))
        found += [
            f"{r['factor']}_{r['level']}" for r in
            level_counts(rows, categorical, label).filter(one).orderBy("factor", "level").collect()
        ]
    if numeric:
        ranges = rows.groupBy(label).agg(*[
            f(c).alias(f"{name}_{c}") for c in numeric for name, f in (("low", F.min), ("high", F.max))
        ]).collect()
        if len(ranges) == 2:
            a, b = ranges
            found += [
                c for c in numeric
                if a[f"high_{c}"] <= b[f"low_{c}"] or b[f"high_{c}"] <= a[f"low_{c}"]
            ]
    return found


def aliased_terms(rows: DataFrame, categorical: Sequence[str]) -> list[str]:
    """Level terms that are sums of earlier terms and of the intercept.

    The levels form a graph whose edges are the cells with orders. Counts of orders by
    pairs of levels, a table as large as the number of levels squared, tell which terms
    depend on the earlier ones: those that elimination leaves without a remainder.
    """
    cells = rows.groupBy(*categorical).agg(F.count("*").alias("n"))
    listed = cells.select("n", _pairs(categorical).alias("p"))
    pairs = listed.select("n", F.explode("p").alias("a"), "p").select(
        "n", "a", F.explode("p").alias("b")
    ).groupBy("a", "b").agg(F.sum("n").alias("n")).collect()
    levels = sorted({tuple(r["a"]) for r in pairs}, key=lambda t: (list(categorical).index(t[0]), t[1]))
    # The first level of each factor is its base.
    first = {f: min(lv for g, lv in levels if g == f) for f in categorical}
    terms = [t for t in levels if t[1] != first[t[0]]]
    at = {t: i + 1 for i, t in enumerate(terms)}
    gram = np.zeros((len(terms) + 1, len(terms) + 1))
    for r in pairs:
        a, b, n = tuple(r["a"]), tuple(r["b"]), r["n"]
        if a in at and b in at:
            gram[at[a], at[b]] = n
        if a == b and a in at:
            gram[0, at[a]] = gram[at[a], 0] = n
    gram[0, 0] = sum(r["n"] for r in pairs if r["a"] == r["b"] and r["a"]["factor"] == categorical[0])
    size = np.diag(gram).copy()
    aliased = []
    for k in range(len(gram)):
        if gram[k, k] <= 1e-9 * max(size[k], 1):
            aliased.append("{}_{}".format(*terms[k - 1]))
            continue
        column = gram[:, k] / gram[k, k]
        column[: k + 1] = 0
        gram -= np.outer(column, gram[k])
    return aliased


def check_estimable(
    rows: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str
) -> None:
    """Raise ``NotEstimable`` with the names of the terms at fault."""
    separated = separations(rows, categorical, numeric, label)
    if separated:
        raise NotEstimable(f"these terms have one outcome only: {separated}")
    if len(categorical) > 1:
        aliased = aliased_terms(rows, categorical)
        if aliased:
            raise NotEstimable(f"these terms are sums of others: {aliased}")


def score_equations(
    rows: DataFrame, fitted: DataFrame, categorical: Sequence[str],
    numeric: Sequence[str], label: str,
) -> DataFrame:
    """Observed against expected sums of every level and number.

    ``fitted(term, coefficient)`` are the rows of ``stats.logit``, one per term. Columns:
    ``term`` (``factor_level``, base levels included, a number's name, or the intercept),
    ``n_rows``, ``observed`` (sum over the outcomes) and ``expected`` (over the fitted
    probabilities).
    """
    weights = {r["term"]: r["coefficient"] for r in fitted.select("term", "coefficient").collect()}
    clean = rows.select(
        F.col(label).cast("double").alias(label), *categorical,
        *[F.col(c).cast("double") for c in numeric],
    ).dropna()
    value = F.lit(weights[INTERCEPT])
    for factor in categorical:
        own = {t.removeprefix(f"{factor}_"): w for t, w in weights.items() if t.startswith(f"{factor}_")}
        if own:
            listed = F.create_map(*[F.lit(x) for pair in own.items() for x in pair])
            value = value + F.coalesce(F.try_element_at(listed, F.col(factor)), F.lit(0.0))
    value = reduce(lambda v, c: v + F.lit(weights[c]) * F.col(c), numeric, value)
    scored = clean.withColumn("_p", 1 / (1 + F.exp(-value)))
    terms = [F.struct(F.lit(INTERCEPT).alias("term"), F.lit(1.0).alias("x"))]
    terms += [
        F.struct(F.concat_ws("_", F.lit(c), F.col(c)).alias("term"), F.lit(1.0).alias("x"))
        for c in categorical
    ]
    terms += [F.struct(F.lit(c).alias("term"), F.col(c).alias("x")) for c in numeric]
    each = scored.select(label, "_p", F.explode(F.array(*terms)).alias("t"))
    return each.groupBy(F.col("t.term").alias("term")).agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col(label) * F.col("t.x")).alias("observed"),
        F.sum(F.col("_p") * F.col("t.x")).alias("expected"),
    )
