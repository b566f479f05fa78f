"""Classifier quality, computed from counts by distinct score.

``score_counts`` is the only step that sees scored rows. It counts before the shuffle,
so a score shared by many rows is one row afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.functions.scalar import risk_band
from punctual.operators.ordered import running_totals

EXACT = "decimal(38,0)"


def score_counts(scored: DataFrame, label: str, score: str = "score") -> DataFrame:
    """Positive and negative rows by distinct score; rows without either are left out."""
    known = scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    return known.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("n_pos"),
        F.count_if(F.col(label) != 1).alias("n_neg"),
    )


def _curve(counts: DataFrame) -> DataFrame:
    """Counts by descending score with the true and false positives before each."""
    running = running_totals(counts, F.desc("score"), ["n_pos", "n_neg"])
    return running.withColumn("tp", F.col("n_pos_before") + F.col("n_pos")).withColumn(
        "fp", F.col("n_neg_before") + F.col("n_neg")
    )


def _double(column: str) -> Column:
    return F.col(column).cast("double")


def _precision(tp: Column, fp: Column) -> Column:
    """Share of true positives; 1 where nothing is selected yet."""
    return F.coalesce(F.try_divide(tp, tp + fp), F.lit(1.0))


def pr_curve(counts: DataFrame) -> DataFrame:
    """Precision and recall by threshold, and the end point (recall 0, precision 1).

    The end point has no threshold.
    """
    curve = _curve(counts)
    total = counts.agg(F.sum("n_pos").cast("double")).scalar()
    points = curve.select(
        F.col("score").alias("threshold"),
        _precision(_double("tp"), _double("fp")).alias("precision"),
        F.try_divide(_double("tp"), total).alias("recall"),
    )
    end = counts.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(end)


def areas(counts: DataFrame) -> DataFrame:
    """One row with both areas, from one pass over the curve.

    ROC: equal scores count half; the sums are exact integers. Precision-recall: the
    trapezoid rule.
    """
    def wide(column: str) -> Column:
        return F.col(column).cast("decimal(18,0)")

    pairs = (wide("n_neg") * (2 * wide("n_pos_before") + wide("n_pos"))).cast(EXACT)
    before = _precision(_double("n_pos_before"), _double("n_neg_before"))
    after = _precision(_double("tp"), _double("fp"))
    sums = _curve(counts).agg(
        F.sum(pairs).cast("double").alias("twice"),
        F.sum(_double("n_pos") * (before + after) / 2).alias("area"),
        F.sum("n_pos").cast("double").alias("p"),
        F.sum("n_neg").cast("double").alias("q"),
    )
    return sums.select(
        F.try_divide(F.col("twice"), 2.0 * F.col("p") * F.col("q")).alias("roc_auc"),
        F.try_divide(F.col("area"), F.col("p")).alias("pr_auc"),
    )


def roc_auc(counts: DataFrame) -> DataFrame:
    return areas(counts).select("roc_auc")


def pr_auc(counts: DataFrame) -> DataFrame:
    return areas(counts).select("pr_auc")


def confusion(counts: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row: tn, fp, fn, tp at a threshold."""
    chosen = F.col("score") >= threshold

    def total(column: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0))

    return counts.agg(
        total("n_neg", ~chosen).cast("double").alias("tn"),
        total("n_neg", chosen).cast("double").alias("fp"),
        total("n_pos", ~chosen).cast("double").alias("fn"),
        total("n_pos", chosen).cast("double").alias("tp"),
    )


def classification_report(counts: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support by class, with accuracy and both means.

    A ratio with an empty denominator is 0.
    """
    def safe(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    tn, fp, fn, tp = (F.col(c) for c in ["tn", "fp", "fn", "tp"])
    table = confusion(counts, threshold).select(
        "*", (tn + fp).alias("s0"), (tp + fn).alias("s1"),
        safe(tn, tn + fn).alias("p0"), safe(tn, tn + fp).alias("r0"),
        safe(tp, tp + fp).alias("p1"), safe(tp, tp + fn).alias("r1"),
    )
    p0, r0, p1, r1 = (F.col(c) for c in ["p0", "r0", "p1", "r1"])
    table = table.select(
        "*", safe(2 * p0 * r0, p0 + r0).alias("f0"), safe(2 * p1 * r1, p1 + r1).alias("f1"),
        (F.col("s0") + F.col("s1")).alias("n"),
    )
    n, s0, s1 = F.col("n"), F.col("s0"), F.col("s1")
    accuracy = safe(tp + tn, n)

    def row(name: str, *values: Column) -> Column:
        names = ["precision", "recall", "f1_score"]
        return F.struct(
            F.lit(name).alias("class"),
            *[v.alias(c) for v, c in zip(values, names)],
            values[3].cast("bigint").alias("support"),
        )

    def weighted(a: str, b: str) -> Column:
        return safe(F.col(a) * s0 + F.col(b) * s1, n)

    rows = [
        row("0", p0, r0, F.col("f0"), s0),
        row("1", p1, r1, F.col("f1"), s1),
        row("accuracy", accuracy, accuracy, accuracy, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (F.col("f0") + F.col("f1")) / 2, n),
        row("weighted avg", weighted("p0", "p1"), weighted("r0", "r1"),
            weighted("f0", "f1"), n),
    ]
    return table.select(F.inline(F.array(*rows)))


def risk_bands(counts: DataFrame) -> DataFrame:
    """Rows and positive rows by band of the score."""
    return counts.groupBy(risk_band(F.col("score")).alias("risk_band")).agg(
        F.sum(F.col("n_pos") + F.col("n_neg")).alias("n_orders"),
        F.sum("n_pos").alias("n_late"),
    )
