"""The maintained summary of orders: read instead of the order table, and kept up to date."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from punctual import schema
from punctual.functions.scalar import leading_digits, whole_bound
from punctual.plans import diagnose as dg
from punctual.plans import star, stats
from punctual.sources.warehouse import Warehouse
from punctual.streaming import incremental

QUESTIONS = {
    "region": dg.late_rate_by_region,
    "mode": dg.late_rate_by_mode,
    "region and mode": dg.late_rate_region_mode,
    "value": dg.late_rate_by_order_value,
    "weekday": dg.late_rate_by_ship_weekday,
    "days": dg.actual_vs_scheduled_by_mode,
    "selected": lambda w: dg.late_rate_selected_regions(w, ["North"]),
    "stats": dg.region_mode_stats,
    "table": dg.region_mode_table,
    "pivot": lambda w: dg.late_rate_pivot(w, ["First Class", "Same Day"]),
    "overall": dg.overall_late_rate,
    "chi-square of mode": lambda w: stats.chi_square_of_orders(w, "shipping_mode"),
    "chi-square of region": lambda w: stats.chi_square_of_orders(w, "order_region"),
}

ROWS = [
    {"order_id": i, "order_region": f"R{i % 3}", "late_delivery_risk": [0, 1, 1, None][i % 4],
     "shipping_mode": ["First Class", "Same Day", None][i % 5 % 3], "sales": 70 * i,
     "days_for_shipping_real": i % 6 or None}
    for i in range(1, 25)
]
MORE = [
    {"order_item_id": 100 + i, "order_id": o, "order_region": "R9", "late_delivery_risk": 0,
     "sales": 45}
    for i, o in enumerate([3, 3, 17, 30, 31, None])
]


def rows(df):
    """Sorted rows; sums of doubles depend on the order of their summands."""
    return sorted(
        repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in df.collect()
    )


@pytest.mark.parametrize("name", QUESTIONS)
def test_questions_read_the_summary_only(given, name):
    read = QUESTIONS[name](given).inputFiles()
    assert any(f"/{schema.SUMMARY}-" in f for f in read)
    assert not any("/order_grain-" in f or "/fact_order_items-" in f for f in read)


def test_answers_equal_those_of_a_new_build_after_batches(spark, house, staging):
    whole = house(*ROWS, *MORE)
    grown = house(*ROWS)
    for part in (MORE[:2], MORE[2:]):
        incremental.load_batch(grown, staging(*part))
        incremental.refresh_orders(grown)
    last = Warehouse.open(spark, grown.root)
    for name, question in QUESTIONS.items():
        assert rows(question(last)) == rows(question(whole)), name
    kept = last.table(schema.SUMMARY)
    assert rows(kept) == rows(star.order_summary(last.table("order_grain"), last.buckets))


def test_until_a_refresh_the_summary_stays_with_the_order_table(house, staging):
    w = house(*ROWS)
    before = rows(dg.overall_late_rate(w))
    incremental.load_batch(w, staging(*MORE))
    assert rows(dg.overall_late_rate(w)) == before
    incremental.refresh_orders(w)
    assert dg.overall_late_rate(w).first()["n_orders"] == len(ROWS) + 3


def test_rows_of_untouched_buckets_are_not_counted_again(house, staging, monkeypatch):
    w = house(*ROWS)
    counted = []
    plain = star.order_summary
    monkeypatch.setattr(star, "order_summary", lambda orders, buckets: (
        counted.append({r[0] for r in orders.select("order_id").collect()}),
        plain(orders, buckets))[1])
    incremental.load_batch(w, staging({"order_item_id": 200, "order_id": 7, "sales": 1}))
    incremental.refresh_orders(w)
    (read,) = counted
    assert 7 in read and len(read) < len(ROWS)


def test_a_warehouse_without_summary_answers_and_gets_one(spark, house, staging):
    w = house(*ROWS)
    wanted = {n: rows(q(w)) for n, q in QUESTIONS.items()}
    del w._tables[schema.SUMMARY]
    assert {n: rows(q(w)) for n, q in QUESTIONS.items()} == wanted
    incremental.refresh_orders(w)
    assert schema.SUMMARY in Warehouse.open(spark, w.root)
    assert {n: rows(q(w)) for n, q in QUESTIONS.items()} == wanted


def test_limits_of_any_digits_give_the_same_buckets(house):
    w = house(*ROWS, {"order_id": 90, "sales": "0.5"}, {"order_id": 91, "sales": "-3"},
              {"order_id": 92, "sales": None})
    def plain(limits):
        orders = w.table("order_grain").filter("order_id is not null")
        keyed = orders.withColumn("b", dg.value_bucket(F.col("total_sales"), limits))
        return sorted((r[0], r[1]) for r in keyed.groupBy("b").count().collect())
    for limits in [[100, 300, 600], [1, 250, 1400], [123, 457], [99, 100, 101]]:
        got = sorted((r[0], r[1]) for r in dg.late_rate_by_order_value(w, limits).collect())
        assert got == plain(limits), limits


def test_leading_digits_keep_round_limits_apart(spark):
    values = [Decimal(v) for v in ["-7.5", "0", "0.99", "1", "9.99", "10", "99.99", "100", "109.99",
                                   "110", "1234.5", "99999.99", "100000", "12345678901234567.25"]]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v decimal(28,2)")
    got = df.select("v", leading_digits(F.col("v")).alias("d")).collect()
    for limit in [n * 10**k for n in range(1, 100) for k in range(17)]:
        assert whole_bound(limit)
        assert all((r["v"] < limit) == (r["d"] < limit) for r in got if r["v"] is not None)
    assert got[-1]["d"] is None
    assert not any(map(whole_bound, [101, 1234, 0.5, -10, 0]))


def test_empty_tables(spark, house, staging):
    w = house(*ROWS[:1])
    w.write("order_grain", w.table("order_grain").limit(0))
    w.write(schema.SUMMARY, star.order_summary(w.table("order_grain"), w.buckets))
    assert dg.late_rate_by_region(w).count() == 0
    assert dg.overall_late_rate(w).first()["n_orders"] == 0
