"""Constraint checks and profiles. Spark enforces no keys, so they are reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual import schema
from punctual.sources.warehouse import Warehouse

# Fact column, dimension, key of the dimension.
FOREIGN_KEYS = [
    ("customer_id", "dim_customer", "customer_id"),
    ("product_card_id", "dim_product", "product_card_id"),
    ("geography_id", "dim_geography", "geography_id"),
    ("shipping_mode_id", "dim_shipping_mode", "shipping_mode_id"),
    ("order_date_id", "dim_date", "date_id"),
    ("shipping_date_id", "dim_date", "date_id"),
]
PRIMARY_KEYS = {
    "dim_customer": ["customer_id"],
    "dim_product": ["product_card_id"],
    "dim_geography": ["geography_id"],
    "dim_shipping_mode": ["shipping_mode_id"],
    "dim_date": ["date_id"],
    "fact_order_items": ["order_item_id"],
}
NATURAL_KEYS = {
    "dim_geography": schema.GEOGRAPHY,
    "dim_shipping_mode": ["shipping_mode"],
    "dim_date": ["full_date"],
}
ORDER_FIELDS = [
    "geography_id", "shipping_mode_id", "order_date_id", "shipping_date_id",
    "days_for_shipping_real", "days_for_shipment_sched", "late_delivery_risk",
    "delivery_status", "order_status", "payment_type",
]


def key_report(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Rows, rows without a key, repeated keys, and rows beyond the first per key."""
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("n_null_keys"),
        F.count_if(F.col("n") > 1).alias("n_repeated_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_surplus_rows"),
    ).select(F.lit(label).alias("key_name"), "*")


def primary_keys(house: Warehouse) -> DataFrame:
    reports = [
        key_report(house.table(t), keys, t) for t, keys in PRIMARY_KEYS.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def natural_keys(house: Warehouse) -> DataFrame:
    reports = [
        key_report(house.table(t), keys, t) for t, keys in NATURAL_KEYS.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def reference_report(
    rows: DataFrame, column: str, referred: DataFrame, key: str, label: str
) -> DataFrame:
    """Rows by reference: all, empty, and without a row to refer to.

    Rows are counted per value before the join, so the column is shuffled as distinct
    values only.
    """
    used = rows.groupBy(F.col(column).alias("_k")).agg(F.count("*").alias("n"))
    there = referred.select(F.col(key).alias("_d")).distinct().withColumn("_hit", F.lit(True))
    matched = used.join(there, F.col("_k") == F.col("_d"), "left")
    orphan = F.col("_k").isNotNull() & F.col("_hit").isNull()
    return matched.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("n_orphans"),
    ).select(F.lit(label).alias("foreign_key"), "*")


def foreign_keys(house: Warehouse) -> DataFrame:
    """The references of the fact."""
    fact = house.table("fact_order_items")
    return reduce(DataFrame.unionByName, [
        reference_report(fact, column, house.table(dim), key, column)
        for column, dim, key in FOREIGN_KEYS
    ])


def varying_fields(
    items: DataFrame, key: str = "order_id", fields: Sequence[str] = tuple(ORDER_FIELDS)
) -> DataFrame:
    """One row per order, one flag per order-level field: do its items disagree?

    A null among values counts as a disagreement. Values are compared by 64-bit hashes,
    whose smallest and largest fit a hash aggregate; texts would make it sort the items.
    """
    def varies(c: str):
        digest = F.xxhash64(F.col(c).isNull(), F.col(c))
        return (F.min(digest) != F.max(digest)).alias(c)

    return items.groupBy(key).agg(*[varies(c) for c in fields])


def inconsistent_orders(fact: DataFrame) -> DataFrame:
    """Orders that break the assumption behind the order view."""
    any_field = reduce(lambda a, b: a | b, [F.col(c) for c in ORDER_FIELDS])
    return varying_fields(fact).filter(any_field)


def order_constancy(house: Warehouse) -> DataFrame:
    """Number of orders with disagreeing items, by field."""
    flags = varying_fields(house.table("fact_order_items"))
    counted = flags.agg(
        F.count("*").alias("n_orders"), *[F.count_if(c).alias(c) for c in ORDER_FIELDS]
    )
    return counted.unpivot("n_orders", ORDER_FIELDS, "field", "n_inconsistent")


def profile(df: DataFrame) -> DataFrame:
    """Type and non-null count by column, in one pass."""
    types = dict(df.dtypes)
    counted = df.agg(
        F.count("*").alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]
    )
    long = counted.unpivot("_rows", df.columns, "column_name", "n_non_null")
    entries = [F.lit(x) for pair in types.items() for x in pair]
    return long.select(
        "column_name",
        F.create_map(*entries)[F.col("column_name")].alias("data_type"),
        F.col("_rows").alias("n_rows"),
        "n_non_null",
    )
