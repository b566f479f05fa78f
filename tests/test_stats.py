import math
import random
import statistics

import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from punctual.plans import stats


def table(spark, *cells):
    return spark.createDataFrame(
        list(cells), "row_value string, column_value string, n bigint"
    )


def by_hand(counts):
    """Statistic and degrees of freedom of a full table of counts."""
    rows = [sum(r) for r in counts]
    columns = [sum(c) for c in zip(*counts)]
    total = sum(rows)
    chi2 = 0.0
    dof = (len(rows) - 1) * (len(columns) - 1)
    for i, row in enumerate(counts):
        for j, n in enumerate(row):
            expected = rows[i] * columns[j] / total
            gap = abs(n - expected)
            if dof == 1:
                gap -= min(0.5, gap)
            chi2 += gap * gap / expected
    return chi2, dof


@pytest.mark.parametrize("counts", [
    [[10, 20], [30, 40]],
    [[10, 0], [30, 40]],
    [[0, 5], [7, 0], [3, 9]],
    [[1, 2, 3], [0, 5, 0], [4, 0, 6], [9, 9, 9]],
    [[50, 50], [50, 50]],
])
def test_chi_square_equals_the_full_table(spark, counts):
    cells = [(f"r{i}", f"c{j}", n) for i, row in enumerate(counts)
             for j, n in enumerate(row) if n]
    got = stats.chi_square_of(table(spark, *cells)).first()
    chi2, dof = by_hand(counts)
    assert got["chi2"] == pytest.approx(chi2, abs=1e-9)
    assert got["dof"] == dof
    assert got["n_orders"] == sum(map(sum, counts))


def test_yates_only_for_two_by_two(spark):
    got = stats.chi_square_of(
        table(spark, ("a", "x", 10), ("a", "y", 20), ("b", "x", 30), ("b", "y", 40))
    ).first()
    assert got["chi2"] == pytest.approx(0.446429, abs=1e-6)


def test_one_category_gives_no_evidence(spark):
    got = stats.chi_square_of(table(spark, ("a", "x", 10), ("a", "y", 20))).first()
    assert (got["chi2"], got["dof"], got["p_value"]) == (0.0, 0, 1.0)


def test_chi_square_agrees_with_spark_ml(spark, given):
    orders = stats.order_features(given)
    ours = stats.chi_square(orders, "order_region").first()
    indexed = StringIndexer(inputCol="order_region", outputCol="i").fit(orders).transform(orders)
    vectors = VectorAssembler(inputCols=["i"], outputCol="v").transform(indexed)
    theirs = ChiSquareTest.test(vectors, "v", stats.LABEL, flatten=True).first()
    assert ours["chi2"] == pytest.approx(theirs["statistic"], rel=1e-9)
    assert ours["dof"] == theirs["degreesOfFreedom"]
    assert ours["p_value"] == pytest.approx(theirs["pValue"], rel=1e-6)


def test_welch_by_hand_and_without_nulls(spark):
    late, on_time = [1.0, 2.0, 4.0, 8.0], [3.0, 3.5, 9.0]
    rows = [(1, x) for x in late] + [(0, x) for x in on_time] + [(1, None), (None, 5.0)]
    got = stats.welch(
        spark.createDataFrame(rows, "late_delivery_risk int, total_sales double")
    ).first()
    a = statistics.variance(late) / 4
    b = statistics.variance(on_time) / 3
    assert (got["n_late"], got["n_on_time"]) == (4, 3)
    assert got["t"] == pytest.approx(
        (statistics.mean(late) - statistics.mean(on_time)) / math.sqrt(a + b))
    assert got["dof"] == pytest.approx((a + b) ** 2 / (a * a / 3 + b * b / 2))
    assert 0 < got["p_value"] < 1


def test_welch_needs_two_values_per_group(spark):
    rows = spark.createDataFrame([(1, 1.0), (0, 2.0), (0, 3.0)],
                                 "late_delivery_risk int, total_sales double")
    got = stats.welch(rows).first()
    assert got["t"] is None and got["p_value"] is None


def test_logit_solves_the_score_equations(spark):
    rng = random.Random(1)
    effect = {"First Class": 0.0, "Same Day": 1.2, "Standard Class": -1.0}
    data = []
    for _ in range(1500):
        mode, region = rng.choice(list(effect)), rng.choice(["A", "B"])
        sales = rng.uniform(10, 500)
        p = 1 / (1 + math.exp(-(0.3 + effect[mode] + 0.001 * sales)))
        data.append((int(rng.random() < p), mode, region, sales))
    df = spark.createDataFrame(
        data, "late_delivery_risk int, shipping_mode string, order_region string, "
              "total_sales double")
    terms = {r["term"]: r for r in stats.logit(df).collect()}
    # The alphabetically first level of each factor is the base.
    assert set(terms) == {
        "shipping_mode_Same Day", "shipping_mode_Standard Class", "order_region_B",
        "total_sales", "Intercept",
    }
    beta = {t: r["coefficient"] for t, r in terms.items()}
    residual = {t: 0.0 for t in terms}
    log_likelihood = 0.0
    for y, mode, region, sales in data:
        x = {"Intercept": 1.0, "total_sales": sales,
             "order_region_B": float(region == "B"),
             "shipping_mode_Same Day": float(mode == "Same Day"),
             "shipping_mode_Standard Class": float(mode == "Standard Class")}
        p = 1 / (1 + math.exp(-sum(beta[t] * v for t, v in x.items())))
        log_likelihood += math.log(p if y else 1 - p)
        for t, v in x.items():
            residual[t] += v * (y - p)
    assert all(abs(r) < 0.05 for r in residual.values())
    one = terms["Intercept"]
    assert one["log_likelihood"] == pytest.approx(log_likelihood, abs=1e-3)
    assert one["pseudo_r2"] == pytest.approx(1 - log_likelihood / one["null_log_likelihood"], abs=1e-6)
    same_day = terms["shipping_mode_Same Day"]
    assert same_day["z"] == pytest.approx(same_day["coefficient"] / same_day["std_error"], rel=1e-6)
    assert same_day["ci_low"] < same_day["coefficient"] < same_day["ci_high"]


def test_logit_with_a_single_region(spark):
    rng = random.Random(2)
    rows = [(rng.randint(0, 1), rng.choice("ab"), "only", rng.random()) for _ in range(200)]
    df = spark.createDataFrame(
        rows, "late_delivery_risk int, shipping_mode string, order_region string, "
              "total_sales double")
    assert {r["term"] for r in stats.logit(df).collect()} == {
        "shipping_mode_b", "total_sales", "Intercept"}


def test_features_are_one_row_per_order(given):
    features = stats.order_features(given)
    assert features.count() == features.select("order_id").distinct().count()
    assert features.filter(F.col("total_sales").isNull()).count() == 0
