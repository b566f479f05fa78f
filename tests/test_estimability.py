import random

import pytest

from punctual.plans import estimability as es
from punctual.plans import stats

COLUMNS = "late_delivery_risk int, shipping_mode string, order_region string, total_sales double"


def orders(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def sound_rows(seed=1, n=400):
    rng = random.Random(seed)
    return [
        (int(rng.random() < 0.3 + 0.1 * m), f"m{m}", f"r{r}", rng.random() * 100)
        for m, r in ((rng.randrange(3), rng.randrange(4)) for _ in range(n))
    ]


def test_sound_data_and_their_equations(spark):
    df = orders(spark, sound_rows())
    factors, numbers = ["shipping_mode", "order_region"], ["total_sales"]
    es.check_estimable(df, factors, numbers, stats.LABEL)
    fitted = stats.logit(df)
    rows = es.score_equations(df, fitted, factors, numbers, stats.LABEL).collect()
    assert {r["term"] for r in rows} == {
        "Intercept", "total_sales", *(f"shipping_mode_m{i}" for i in range(3)),
        *(f"order_region_r{i}" for i in range(4))}
    for r in rows:
        assert r["observed"] == pytest.approx(r["expected"], rel=1e-4, abs=1e-3)
    total = next(r for r in rows if r["term"] == "Intercept")
    assert total["n_rows"] == 400 and total["observed"] == sum(r[0] for r in sound_rows())


def test_equations_tell_a_wrong_fit(spark):
    df = orders(spark, sound_rows())
    fitted = stats.logit(df, ["shipping_mode"], [])
    wrong = spark.createDataFrame(
        [(r["term"], r["coefficient"] + 0.5) for r in fitted.collect()], "term string, coefficient double")
    rows = es.score_equations(df, wrong, ["shipping_mode"], [], stats.LABEL).collect()
    assert all(r["expected"] > r["observed"] + 1 for r in rows)


def test_a_level_with_one_outcome_is_named(spark):
    rows = sound_rows() + [(1, "m1", "only late", 5.0)] * 3 + [(0, "never", "r1", 5.0)]
    with pytest.raises(es.NotEstimable, match="order_region_only late.*shipping_mode_never"):
        stats.logit(orders(spark, rows))


def test_a_number_that_separates_is_named(spark):
    rows = [(y, m, r, x + 1000 * y) for y, m, r, x in sound_rows()]
    assert es.separations(orders(spark, rows), [], ["total_sales"], stats.LABEL) == ["total_sales"]
    with pytest.raises(es.NotEstimable, match="total_sales"):
        stats.logit(orders(spark, rows))


def test_levels_that_are_sums_of_others_are_named(spark):
    """Two groups of modes and regions that never meet: one term too many."""
    rows = []
    for mode, region in (("m0", "r0"), ("m0", "r1"), ("m1", "r1"), ("m2", "r2"), ("m2", "r3"), ("m3", "r3")):
        rows += [(i % 2, mode, region, float(i % 7)) for i in range(20)]
    df = orders(spark, rows)
    assert es.aliased_terms(df, ["shipping_mode", "order_region"]) == ["order_region_r3"]
    with pytest.raises(es.NotEstimable, match="sums of others.*order_region_r3"):
        stats.logit(df)
    joined = orders(spark, rows + [(i % 2, "m0", "r3", 1.0) for i in range(4)])
    assert es.aliased_terms(joined, ["shipping_mode", "order_region"]) == []


def test_a_copy_of_a_factor_is_named(spark):
    rows = [(y, m, f"r{m}", x) for y, m, _, x in sound_rows()]
    assert es.aliased_terms(orders(spark, rows), ["shipping_mode", "order_region"]) == [
        "order_region_rm1", "order_region_rm2"]
