"""Staging to dimensions, fact and the order-grain table."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual import schema
from punctual.functions.scalar import leading_digits, same_key, weekday_name
from punctual.operators import key_filter
from punctual.operators.keys import attach_key, drop_repeats, first_by, with_dense_id
from punctual.session import dropped_shuffles, dropped_tables, materialize
from punctual.sources.warehouse import Warehouse, bucket_of


def _latest_attributes(staging: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """One row per key: the version with the latest order date, then by attributes.

    The versions are reduced by a hash aggregate first; only distinct versions are
    compared per key.
    """
    versions = (
        staging.filter(F.col(key).isNotNull())
        .groupBy(key, *attributes).agg(F.max("order_date").alias("_seen"))
    )
    undated = F.lit(2**31 - 1)
    newest = F.coalesce(-F.unix_date("_seen"), undated)
    return first_by(versions, [key], [newest]).select(key, *attributes)


def dim_customer(staging: DataFrame) -> DataFrame:
    return _latest_attributes(staging, "customer_id", schema.CUSTOMER_ATTRIBUTES)


def dim_product(staging: DataFrame) -> DataFrame:
    return _latest_attributes(staging, "product_card_id", schema.PRODUCT_ATTRIBUTES)


def places(staging: DataFrame) -> DataFrame:
    return staging.select(*schema.GEOGRAPHY).distinct()


def shipping_modes(staging: DataFrame) -> DataFrame:
    return staging.select("shipping_mode").filter("shipping_mode is not null").distinct()


def calendar_days(staging: DataFrame) -> DataFrame:
    """Distinct order and shipping days with their parts."""
    ordered = staging.select(F.col("order_date").alias("full_date"))
    shipped = staging.select(F.col("shipping_date").alias("full_date"))
    days = ordered.union(shipped).filter("full_date is not null").distinct()
    return days.select(
        "full_date",
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.dayofmonth("full_date").alias("day"),
        weekday_name(F.col("full_date")).alias("weekday"),
    )


# Dimension: rows from staging, natural key, numbered key.
NUMBERED = {
    "dim_geography": (places, schema.GEOGRAPHY, "geography_id"),
    "dim_shipping_mode": (shipping_modes, ["shipping_mode"], "shipping_mode_id"),
    "dim_date": (calendar_days, ["full_date"], "date_id"),
}


def numbered(name: str, staging: DataFrame) -> DataFrame:
    """A dimension with a surrogate key."""
    rows, natural, key = NUMBERED[name]
    return with_dense_id(rows(staging), natural, key)


DIMENSIONS = {
    "dim_customer": dim_customer,
    "dim_product": dim_product,
    **{name: partial(numbered, name) for name in NUMBERED},
}


def fact_order_items(
    staging: DataFrame,
    geography: DataFrame,
    modes: DataFrame,
    dates: DataFrame,
    null_safe: bool = True,
) -> DataFrame:
    """Staging rows with the keys of their dimensions; no row is lost.

    Rows without an item key stay too; the key report counts them.

    ``null_safe=False`` gives the literal ``=`` join on the five place columns, which
    leaves the key empty as soon as one of them is null.
    """
    keyed = attach_key(
        staging, geography, [(c, c) for c in schema.GEOGRAPHY],
        "geography_id", "geography_id", null_safe,
    )
    keyed = attach_key(
        keyed, modes, [("shipping_mode", "shipping_mode")],
        "shipping_mode_id", "shipping_mode_id",
    )
    for day in ["order_date", "shipping_date"]:
        keyed = attach_key(keyed, dates, [(day, "full_date")], "date_id", f"{day}_id")
    return keyed.select(
        "order_item_id", "order_id", "customer_id", "product_card_id", "geography_id",
        "shipping_mode_id", "order_date_id", "shipping_date_id",
        *schema.DELIVERY, *schema.MEASURES, "payment_type",
    )


ORDER_FIELDS = [c for c in schema.V_ORDERS if c != "order_id"] + [
    "days_for_shipping_real", "days_for_shipment_sched",
]


def order_grain(fact: DataFrame, clustered: DataFrame | None = None) -> DataFrame:
    """One row per order: the first item's order-level fields, and item sums.

    Items are summed by order and order-level fields first, in a hash aggregate with
    fixed-width buffers. In sound orders the fields agree, so that is one row per order
    and nothing else is read. Only orders whose items disagree are looked up again, to
    find the item with the smallest key.

    ``clustered`` holds the rows of ``fact`` with the items of an order close together, as
    the buckets of the written fact do not: then a task sends one row per order, not one
    per item.
    """
    fields = ORDER_FIELDS
    versions = materialize(
        order_versions(fact if clustered is None else clustered, fields), "versions"
    )
    per_order = versions.groupBy("order_id").agg(
        F.count("*").alias("_versions"),
        F.sum("_sales").cast(versions.schema["_sales"].dataType).alias("total_sales"),
        F.max("days_for_shipment_sched").alias("max_days_sched"),
    )
    mixed = materialize(
        per_order.filter("_versions > 1").select(F.col("order_id").alias("_mixed")), "mixed"
    )
    here = same_key([F.col("order_id")], [F.col("_mixed")], null_safe=True)
    agreed = versions.join(mixed, here, "left_anti").select("order_id", *fields, "_sales")
    sums = {"total_sales": F.col("_sales"), "max_days_sched": F.col("days_for_shipment_sched")}
    one = agreed.select("order_id", *fields, *[v.alias(k) for k, v in sums.items()])
    if mixed.isEmpty():
        return one
    first = fact.join(mixed, here, "left_semi").groupBy("order_id").agg(
        F.min(F.struct("order_item_id", *fields)).alias("_first")
    )
    several = first.withColumnRenamed("order_id", "_mixed").join(
        per_order.filter("_versions > 1"), here
    )
    return one.unionByName(several.select(
        "order_id", *[F.col(f"_first.{c}").alias(c) for c in fields],
        "total_sales", "max_days_sched",
    ))


def order_versions(fact: DataFrame, fields: list[str]) -> DataFrame:
    """Sales by order and order-level fields."""
    return fact.groupBy("order_id", *fields).agg(F.sum("sales").alias("_sales"))


def merge_orders(parts: DataFrame, fact: DataFrame) -> DataFrame:
    """One row per order from several partial ones, in the columns of ``order_grain``.

    Sales add up and promised days take the maximum; parts can be merged in any order and
    grouping. Where the order-level fields of an order's parts agree, they stay, and the
    items of ``fact`` are not read. Only for orders whose parts disagree it is looked up
    which item is the first.
    """
    kind = parts.schema["total_sales"].dataType
    sums = [F.sum("total_sales").cast(kind).alias("total_sales"),
            F.max("max_days_sched").alias("max_days_sched")]
    versions = materialize(parts.groupBy("order_id", *ORDER_FIELDS).agg(*sums), "versions")
    mixed = materialize(
        versions.groupBy(F.col("order_id").alias("_mixed")).agg(F.count("*").alias("_versions"), *sums)
        .filter("_versions > 1"), "mixed",
    )
    if mixed.isEmpty():
        return versions
    here = same_key([F.col("order_id")], [F.col("_mixed")], null_safe=True)
    keys = mixed.select("_mixed")
    first = fact.join(keys, here, "left_semi").groupBy("order_id").agg(
        F.min(F.struct("order_item_id", *ORDER_FIELDS)).alias("_first")
    )
    several = first.join(mixed, here).select(
        "order_id", *[F.col(f"_first.{c}").alias(c) for c in ORDER_FIELDS],
        "total_sales", "max_days_sched",
    )
    return versions.join(keys, here, "left_anti").unionByName(several)


def order_summary(orders: DataFrame, buckets: int) -> DataFrame:
    """Counts of orders by bucket of the order table, late flag and three sets of keys.

    ``part`` names the set of a row: ``place_mode``, ``ship_day`` or ``value``, the first
    two digits of the order's total. Every order counts once in each. Coarser questions
    add the counts up. A bucket's rows depend on the orders of that bucket alone, so they
    can be replaced together with it. The number of rows is bounded by the dimensions.
    """
    real, sched = "days_for_shipping_real", "days_for_shipment_sched"
    keyed = orders.select(
        bucket_of(schema.BUCKETED["order_grain"], buckets).alias("order_bucket"),
        F.col("order_id").isNotNull().alias("has_order"),
        "geography_id", "shipping_mode_id", "shipping_date_id",
        leading_digits(F.col("total_sales")).alias("value_bin"),
        "late_delivery_risk", real, sched, "total_sales",
    )
    shared = ["order_bucket", "has_order", "late_delivery_risk"]
    own = {
        "place_mode": ["geography_id", "shipping_mode_id"],
        "ship_day": ["shipping_date_id"],
        "value": ["value_bin"],
    }
    part = F.lit(None).cast("string")
    for name, keys in own.items():
        part = F.when(F.grouping(keys[0]) == 0, name).otherwise(part)
    counted = keyed.groupingSets(
        [[F.col(c) for c in [*shared, *keys]] for keys in own.values()],
        *[F.col(c) for c in [*shared, *sum(own.values(), [])]],
    ).agg(
        part.alias("part"), F.count("*").alias("n"),
        F.sum(real).alias("sum_real"), F.count(real).alias("n_real"),
        F.sum(sched).alias("sum_sched"), F.count(sched).alias("n_sched"),
        F.min("total_sales").alias("smallest"),
    )
    return counted.select(*schema.table_schemas()[schema.SUMMARY].fieldNames())


def v_orders(orders: DataFrame) -> DataFrame:
    """The nine columns of the published order view."""
    return orders.select(*schema.V_ORDERS)


def register_views(house: Warehouse, prefix: str = "") -> None:
    """Temporary views, so that SQL text can name the tables and the order view."""
    for name in schema.table_schemas():
        if name not in ("order_grain", schema.TOUCHED, schema.FACT_FILTER, schema.SUMMARY):
            house.table(name).createOrReplaceTempView(prefix + name)
    v_orders(house.table("order_grain")).createOrReplaceTempView(prefix + "v_orders")


def filter_of(house: Warehouse, name: str, paths: list[str]) -> DataFrame:
    """Key filters of some folders of a table."""
    key = schema.BUCKETED[name]
    filters = house.spark.createDataFrame([], key_filter.LAYOUT)
    for root in sorted({p.rsplit("/", 1)[0] for p in paths}):
        own = [p for p in paths if p.rsplit("/", 1)[0] == root]
        rows = key_filter.filter_rows(house.part(name, own), key, root, house.buckets)
        filters = filters.unionByName(rows)
    return filters


def write_filter(house: Warehouse, name: str) -> None:
    house.write(schema.FACT_FILTER, filter_of(house, name, house.paths(name)))


def build(
    spark: SparkSession, staging: DataFrame, root: str, null_safe: bool = True
) -> Warehouse:
    """Write all tables anew and publish them together.

    The dimensions do not depend on each other; their jobs are submitted together. The disk
    holds the shuffle of one step at a time.
    """
    house = Warehouse(spark, root)
    with dropped_shuffles(spark, staging.sparkSession), dropped_tables(spark):
        staged = house.write("stg_orders", staging)
        with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
            list(pool.map(lambda d: house.write(d[0], d[1](staged)), DIMENSIONS.items()))
        fact = fact_order_items(
            drop_repeats(staged, ["order_item_id"], [F.col("order_id")]),
            house.table("dim_geography"), house.table("dim_shipping_mode"),
            house.table("dim_date"), null_safe,
        )
        items = house.write("fact_order_items", fact, gather=False)
        write_filter(house, "fact_order_items")
        orders = house.write(
            "order_grain", order_grain(items, clustered=fact), gather=False
        )
        house.write(schema.SUMMARY, order_summary(orders, house.buckets))
        house.write(schema.TOUCHED, spark.createDataFrame([], orders.schema))
    return house.publish()
