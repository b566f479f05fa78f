import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from punctual.plans import evaluate as ev


def counted(spark, scores, labels):
    df = spark.createDataFrame(list(zip(scores, labels)), "score double, y int")
    return df, ev.score_counts(df, "y")


def reference(scores, labels):
    """ROC-AUC by counting pairs, PR-AUC by walking the thresholds."""
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    roc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    area, recall, precision = 0.0, 0.0, 1.0
    for t in sorted(set(scores), reverse=True):
        tp = sum(p >= t for p in pos)
        fp = sum(n >= t for n in neg)
        r, pr = tp / len(pos), tp / (tp + fp)
        area += (r - recall) * (pr + precision) / 2
        recall, precision = r, pr
    return roc, area


def test_ties(spark):
    _, counts = counted(spark, [0.8, 0.8, 0.4, 0.2], [1, 0, 1, 0])
    assert ev.roc_auc(counts).first()[0] == 0.625
    assert ev.pr_auc(counts).first()[0] == pytest.approx(0.666667, abs=1e-6)


def test_areas_by_brute_force_and_spark_ml(spark):
    rng = random.Random(3)
    labels = [int(rng.random() < 0.4) for _ in range(400)]
    scores = [round(0.3 * y + 0.7 * rng.random(), 2) for y in labels]
    df, counts = counted(spark, scores, labels)
    roc, pr = reference(scores, labels)
    assert ev.roc_auc(counts).first()[0] == pytest.approx(roc, abs=1e-12)
    assert ev.pr_auc(counts).first()[0] == pytest.approx(pr, abs=1e-12)
    spark_ml = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="y", numBins=0
    ).evaluate(df)
    assert ev.roc_auc(counts).first()[0] == pytest.approx(spark_ml, abs=1e-9)


def test_curve_ends_at_recall_zero_precision_one(spark):
    _, counts = counted(spark, [0.9, 0.5, 0.1], [1, 0, 1])
    points = ev.pr_curve(counts).collect()
    assert len(points) == 4
    end = [p for p in points if p["threshold"] is None]
    assert (end[0]["precision"], end[0]["recall"]) == (1.0, 0.0)
    assert max(p["recall"] for p in points) == 1.0


def test_one_class_has_no_area(spark):
    _, counts = counted(spark, [0.9, 0.5], [1, 1])
    assert ev.roc_auc(counts).first()[0] is None
    _, none = counted(spark, [0.9, 0.5], [0, 0])
    assert ev.pr_auc(none).first()[0] is None


def test_report(spark):
    _, counts = counted(spark, [0.9, 0.6, 0.5, 0.4, 0.1], [1, 0, 1, 1, 0])
    rows = {r["class"]: r for r in ev.classification_report(counts).collect()}
    assert rows["1"]["precision"] == pytest.approx(2 / 3)
    assert rows["1"]["recall"] == pytest.approx(2 / 3)
    assert rows["0"]["precision"] == pytest.approx(1 / 2)
    assert rows["0"]["support"] == 2 and rows["1"]["support"] == 3
    assert rows["accuracy"]["f1_score"] == pytest.approx(3 / 5)
    assert rows["macro avg"]["precision"] == pytest.approx((2 / 3 + 1 / 2) / 2)
    assert rows["weighted avg"]["recall"] == pytest.approx((2 / 3 * 3 + 1 / 2 * 2) / 5)


def test_empty_denominators_are_zero(spark):
    _, counts = counted(spark, [0.1, 0.2], [1, 0])
    rows = {r["class"]: r for r in ev.classification_report(counts).collect()}
    assert rows["1"]["precision"] == 0.0 and rows["1"]["f1_score"] == 0.0


def test_rows_without_label_or_score_do_not_count(spark):
    df = spark.createDataFrame([(0.5, 1), (None, 1), (0.5, None)], "score double, y int")
    assert [tuple(r) for r in ev.score_counts(df, "y").collect()] == [(0.5, 1, 0)]


def test_bands(spark):
    _, counts = counted(spark, [0.61, 0.6, 0.41, 0.4, 0.4], [1, 1, 0, 0, 1])
    got = {r["risk_band"]: (r["n_orders"], r["n_late"]) for r in ev.risk_bands(counts).collect()}
    assert got == {"high": (1, 1), "moderate": (2, 1), "low": (2, 1)}
