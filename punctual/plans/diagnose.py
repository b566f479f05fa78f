"""Where and why are orders late?

Order-grain questions read the summary that is written with the order table, counts of
orders by dimension keys, and add these up; the order table is not scanned. Joins to the
dimensions see one row per key combination, so a region with a large share of the
orders makes no large join partition, whatever the join strategy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual import schema
from punctual.functions.scalar import (
    in_list, ratio, rounded_rate, rounded_ratio, value_bucket, whole_bound,
)
from punctual.plans import star
from punctual.sources.warehouse import Warehouse

VALUE_LIMITS = [100, 300, 600]
MIN_ITEMS = 200


def counts_by(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows, rows with a known flag, and late rows by key."""
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count("late_delivery_risk").alias("n_known"),
        F.sum("late_delivery_risk").alias("n_late"),
    )


def summary(house: Warehouse, part: str) -> DataFrame:
    """Counts of orders by one set of keys and the late flag."""
    if schema.SUMMARY in house:
        counts = house.table(schema.SUMMARY)
    else:  # published before there was one
        counts = star.order_summary(house.table("order_grain"), house.buckets)
    return counts.filter(F.col("part") == part)


def _sums() -> list:
    flag = F.col("late_delivery_risk")
    return [
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(flag.isNotNull(), F.col("n"))), F.lit(0)).alias("n_known"),
        F.sum(flag * F.col("n")).alias("n_late"),
    ]


def order_counts(house: Warehouse, part: str, *keys: str) -> DataFrame:
    """Orders, orders with a known flag, and late ones, from the summary."""
    return summary(house, part).groupBy(*keys).agg(*_sums())


def regroup(counts: DataFrame, *keys: str) -> DataFrame:
    """Counts added up over coarser keys."""
    return counts.groupBy(*keys).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ["n", "n_known", "n_late"]]
    )


def late_rates(counts: DataFrame, *keys: str, n_name: str = "n_orders") -> DataFrame:
    rate = rounded_rate(F.col("n_late"), F.col("n_known"))
    return counts.select(*keys, F.col("n").alias(n_name), rate.alias("late_rate"))


def with_region(counts: DataFrame, house: Warehouse, column: str = "order_region") -> DataFrame:
    places = house.table("dim_geography").select("geography_id", column)
    return counts.join(places, "geography_id")


def with_mode(counts: DataFrame, house: Warehouse) -> DataFrame:
    return counts.join(house.table("dim_shipping_mode"), "shipping_mode_id")


def cells(house: Warehouse, region: str = "order_region") -> DataFrame:
    """Counts by region and mode."""
    keyed = order_counts(house, "place_mode", "geography_id", "shipping_mode_id")
    return regroup(
        with_mode(with_region(keyed, house, region), house), region, "shipping_mode"
    )


def late_rate_by_region(house: Warehouse) -> DataFrame:
    keyed = order_counts(house, "place_mode", "geography_id")
    counts = regroup(with_region(keyed, house), "order_region")
    return late_rates(counts, "order_region").orderBy(
        F.desc_nulls_first("late_rate"), "order_region"
    )


def late_rate_by_mode(house: Warehouse) -> DataFrame:
    keyed = order_counts(house, "place_mode", "shipping_mode_id")
    return late_rates(with_mode(keyed, house), "shipping_mode").orderBy(
        F.desc_nulls_first("late_rate"), "shipping_mode"
    )


def late_rate_region_mode(house: Warehouse) -> DataFrame:
    return late_rates(cells(house), "order_region", "shipping_mode").orderBy(
        F.asc_nulls_last("order_region"), F.desc_nulls_first("late_rate"), "shipping_mode"
    )


def avg_order_value_region_mode(house: Warehouse) -> DataFrame:
    """Item sales summed to orders, then averaged by region and mode."""
    totals = house.table("fact_order_items").groupBy(
        "order_id", "geography_id", "shipping_mode_id"
    ).agg(F.sum("sales").alias("total_sales"))
    keyed = totals.groupBy("geography_id", "shipping_mode_id").agg(
        F.sum("total_sales").alias("value"), F.count("total_sales").alias("n")
    )
    named = with_mode(with_region(keyed, house), house)
    summed = named.groupBy("order_region", "shipping_mode").agg(
        # Digits for sums up to 10^21; the quotient then has 17 decimals to round.
        F.sum("value").cast("decimal(30,9)").alias("value"), F.sum("n").alias("n")
    )
    average = rounded_ratio(F.col("value"), F.col("n"), 2)
    return summed.select(
        "order_region", "shipping_mode", average.alias("avg_order_value")
    ).orderBy(F.asc_nulls_last("order_region"), "shipping_mode")


def late_rate_by_order_value(
    house: Warehouse, limits: Sequence[int] = VALUE_LIMITS
) -> DataFrame:
    """Late rates by value bucket.

    The summary answers limits with two digits and zeros, such as 100 or 250000; other
    limits need the values themselves.
    """
    if all(whole_bound(limit) for limit in limits):
        orders, value = summary(house, "value").filter("has_order"), F.col("value_bin")
    else:
        orders, value = house.table("order_grain").filter("order_id is not null").select(
            "late_delivery_risk", "total_sales", F.lit(1).alias("n"),
            F.col("total_sales").alias("smallest"),
        ), F.col("total_sales")
    bucket = value_bucket(value, limits)
    counts = orders.withColumn("sales_bucket", bucket).groupBy("sales_bucket").agg(
        *_sums(), F.min("smallest").alias("smallest")
    )
    return late_rates(counts.orderBy(F.asc_nulls_last("smallest")), "sales_bucket")


def worst_categories(
    house: Warehouse, min_items: int = MIN_ITEMS, top: int = 10, level: str = "category_name"
) -> DataFrame:
    """Categories, or departments, with the highest late rate, at item grain on purpose."""
    keyed = counts_by(house.table("fact_order_items"), "product_card_id")
    products = house.table("dim_product").select("product_card_id", level)
    counts = regroup(keyed.join(products, "product_card_id"), level)
    rates = late_rates(counts.filter(F.col("n") >= min_items), level, n_name="n_order_items")
    return rates.orderBy(F.desc_nulls_first("late_rate"), level).limit(top)


def late_rate_by_ship_weekday(house: Warehouse) -> DataFrame:
    keyed = order_counts(house, "ship_day", "shipping_date_id")
    days = house.table("dim_date").select(
        F.col("date_id").alias("shipping_date_id"), "weekday"
    )
    counts = regroup(keyed.join(days, "shipping_date_id"), "weekday")
    return late_rates(counts, "weekday").orderBy(
        F.desc_nulls_first("late_rate"), "weekday"
    )


def actual_vs_scheduled_by_mode(house: Warehouse) -> DataFrame:
    keyed = summary(house, "place_mode").groupBy("shipping_mode_id").agg(
        *[F.sum(c).alias(c) for c in ("sum_real", "n_real", "sum_sched", "n_sched")]
    )

    def mean(c: str):
        return rounded_rate(F.col(f"sum_{c}"), F.col(f"n_{c}"), 2)

    return with_mode(keyed, house).select(
        "shipping_mode",
        mean("real").alias("avg_actual_days"),
        mean("sched").alias("avg_scheduled_days"),
    ).orderBy("shipping_mode")


def late_rate_selected_regions(house: Warehouse, regions: Sequence[str]) -> DataFrame:
    """Region by mode for chosen regions; an empty choice selects all."""
    chosen = cells(house).filter(in_list(F.col("order_region"), regions))
    return late_rates(chosen, "order_region", "shipping_mode").orderBy(
        F.asc_nulls_last("order_region"), "shipping_mode"
    )


def region_mode_stats(house: Warehouse, region: str = "order_region") -> DataFrame:
    """Unrounded rates by region and mode, as the allocation reads them."""
    rate = ratio(F.col("n_late"), F.col("n_known"))
    return cells(house, region).select(
        region, "shipping_mode", F.col("n").alias("n_orders"), rate.alias("late_rate")
    )


def region_mode_table(house: Warehouse, regions: Sequence[str] = ()) -> DataFrame:
    """The statistics of chosen regions, worst cells first."""
    chosen = region_mode_stats(house).filter(in_list(F.col("order_region"), regions))
    return chosen.orderBy(
        F.desc_nulls_first("late_rate"), "order_region", "shipping_mode"
    )


def late_rate_pivot(
    house: Warehouse, modes: Sequence[str] | None = None, regions: Sequence[str] = ()
) -> DataFrame:
    """One row per region, one rate column per mode.

    Without ``modes`` all modes of the data have a column, which takes one more query;
    a list chooses columns and fixes their order.
    """
    stats = region_mode_stats(house).filter(in_list(F.col("order_region"), regions))
    chosen = None if modes is None else list(modes)
    wide = stats.groupBy("order_region").pivot("shipping_mode", chosen).agg(
        F.first("late_rate")
    )
    return wide.orderBy("order_region")


def overall_late_rate(house: Warehouse) -> DataFrame:
    total = summary(house, "place_mode").agg(*_sums())
    return late_rates(total)


def distinct_regions(house: Warehouse) -> DataFrame:
    return house.table("dim_geography").select("order_region").distinct().orderBy(
        F.asc_nulls_last("order_region")
    )


def distinct_modes(house: Warehouse) -> DataFrame:
    return house.table("dim_shipping_mode").select("shipping_mode").distinct().orderBy(
        "shipping_mode"
    )
