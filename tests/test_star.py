import datetime

from pyspark.sql.types import DecimalType

from punctual import schema
from punctual.plans import quality, star


def test_order_grain_counts_an_order_once(house):
    late = {"order_id": 1, "late_delivery_risk": 1}
    w = house(late, late, late, {"order_id": 2, "late_delivery_risk": 0})
    orders = star.v_orders(w.table("order_grain"))
    assert orders.count() == 2
    assert orders.agg({"late_delivery_risk": "avg"}).first()[0] == 0.5
    fact = w.table("fact_order_items")
    assert fact.agg({"late_delivery_risk": "avg"}).first()[0] == 0.75


def test_inconsistent_order_keeps_the_first_item_and_is_reported(house):
    w = house({"order_item_id": 9, "late_delivery_risk": 1},
              {"order_item_id": 3, "late_delivery_risk": 0}, {"order_id": 2})
    first = w.table("order_grain").filter("order_id = 1").first()
    assert first["late_delivery_risk"] == 0
    broken = quality.inconsistent_orders(w.table("fact_order_items")).collect()
    assert [r["order_id"] for r in broken] == [1]
    counts = {r["field"]: r["n_inconsistent"] for r in quality.order_constancy(w).collect()}
    assert counts["late_delivery_risk"] == 1 and counts["order_status"] == 0


def test_a_null_among_values_is_a_disagreement(house):
    w = house({"payment_type": None}, {"payment_type": "CASH"})
    counts = {r["field"]: r["n_inconsistent"] for r in quality.order_constancy(w).collect()}
    assert counts["payment_type"] == 1


def test_place_with_null_city(house):
    rows = [{"order_city": None}, {"order_city": None, "order_id": 2}]
    safe = house(*rows)
    assert safe.table("dim_geography").count() == 1
    assert safe.table("fact_order_items").filter("geography_id is null").count() == 0
    literal = house(*rows, null_safe=False)
    assert literal.table("fact_order_items").filter("geography_id is null").count() == 2


def test_latest_customer_version_wins(house):
    w = house(
        {"customer_segment": "Corporate", "order_date": datetime.date(2018, 2, 1)},
        {"customer_segment": "Consumer", "order_date": datetime.date(2018, 1, 1)},
        {"customer_segment": "Aged", "order_date": None},
        {"customer_id": None},
    )
    assert [r["customer_segment"] for r in w.table("dim_customer").collect()] == ["Corporate"]


def test_repeated_item_key_is_loaded_once(house):
    w = house({"order_item_id": 5}, {"order_item_id": 5}, {"order_item_id": 6})
    assert w.table("stg_orders").count() == 3
    assert w.table("fact_order_items").count() == 2


def test_dates_play_two_roles(house):
    w = house({})
    row = w.table("fact_order_items").first()
    days = {r["date_id"]: r for r in w.table("dim_date").collect()}
    assert days[row["order_date_id"]]["full_date"] == datetime.date(2018, 1, 30)
    shipped = days[row["shipping_date_id"]]
    assert (shipped["year"], shipped["month"], shipped["day"], shipped["weekday"]) == (
        2018, 1, 31, "Wednesday",
    )


def test_foreign_key_report(spark, house):
    w = house({}, {"customer_id": None}, {"product_card_id": 11})
    known = w.table("dim_product").filter("product_card_id <> 11")
    w.write("dim_product", spark.createDataFrame(known.collect(), known.schema))
    report = {r["foreign_key"]: r for r in quality.foreign_keys(w).collect()}
    assert report["customer_id"]["n_null"] == 1 and report["customer_id"]["n_orphans"] == 0
    assert report["product_card_id"]["n_orphans"] == 1
    assert all(r["n_rows"] == 3 for r in report.values())


def test_key_report_counts_nulls_and_repeats(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "k int")
    row = quality.key_report(df, ["k"], "t").first()
    assert tuple(row) == ("t", 5, 1, 1, 2)


def test_views_answer_sql(house, spark):
    """Items, revenue and late orders per order weekday, over the registered views."""
    w = house(
        {"sales": 99}, {"sales": 1}, {"order_id": 2, "sales": 700, "late_delivery_risk": 0},
        {"order_id": 3, "sales": 5, "order_date": datetime.date(2018, 2, 2)},
    )
    star.register_views(w)
    got = spark.sql("""
        WITH items AS (
          SELECT order_date_id, count(*) AS n_items, sum(sales) AS revenue
          FROM fact_order_items GROUP BY order_date_id
        ), late AS (
          SELECT order_date_id, count_if(late_delivery_risk = 1) AS n_late
          FROM v_orders GROUP BY order_date_id
        )
        SELECT weekday, n_items, CAST(revenue AS INT), n_late
        FROM dim_date d JOIN items i ON i.order_date_id = d.date_id
        JOIN late l ON l.order_date_id = d.date_id ORDER BY full_date""").collect()
    assert [tuple(r) for r in got] == [("Tuesday", 3, 800, 1), ("Friday", 1, 5, 1)]


def test_built_tables_have_the_declared_types(given, house):
    layouts = {
        "given": (given, schema.table_schemas(schema.TEXT, DecimalType(18, 2))),
        "made": (house({}), schema.table_schemas()),
    }
    for w, declared in layouts.values():
        for name, layout in declared.items():
            got = [(f.name, f.dataType) for f in w.table(name).schema]
            assert got == [(f.name, f.dataType) for f in layout], name


def test_failed_build_publishes_nothing(spark, staging):
    import pytest
    from punctual.session import scratch_path
    from punctual.sources.warehouse import Warehouse

    root = scratch_path(spark, "house")
    star.build(spark, staging({}), root)
    with pytest.raises(Exception):
        star.build(spark, staging({}, {}).drop("order_city"), root)
    assert Warehouse.open(spark, root).table("stg_orders").count() == 1
