"""Rates of small groups, pulled toward the overall rate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.functions.scalar import lookup, ratio
from punctual.sources.retail import SCHEDULES
from punctual.sources.warehouse import Warehouse

STRENGTH = 100.0


def what_if_cells(house: Warehouse, schedule: str, region: str = "order_region") -> DataFrame:
    """Region by mode statistics under another promise per mode.

    Lateness is taken from the actual days, so no order needs to be loaded again.
    """
    places = house.table("dim_geography").select("geography_id", region)
    return _cells(house, schedule, [(places, "geography_id")], region)


def monthly_cells(house: Warehouse, schedule: str, region: str = "order_region") -> DataFrame:
    """The same per region and order month; the region column reads ``place yyyy-mm``.

    Orders without a region or an order date have no region.
    """
    places = house.table("dim_geography").select("geography_id", F.col(region).alias("_place"))
    months = house.table("dim_date").select(
        F.col("date_id").alias("order_date_id"), F.date_format("full_date", "yyyy-MM").alias("_month")
    )
    return _cells(
        house, schedule, [(places, "geography_id"), (months, "order_date_id")], region,
        F.concat("_place", F.lit(" "), "_month"),
    )


def _cells(house, schedule, dimensions, region, name=None) -> DataFrame:
    """Counts by the keys of the dimensions first, then by the region's name."""
    keys = [key for _, key in dimensions]
    orders = house.table("order_grain").groupBy(
        *keys, "shipping_mode_id", "days_for_shipping_real"
    ).agg(F.count("*").alias("n"))
    for dimension, key in dimensions:
        orders = orders.join(dimension, key, "left" if name is not None else "inner")
    named = orders.join(house.table("dim_shipping_mode"), "shipping_mode_id")
    if name is not None:
        named = named.withColumn(region, name)
    late = F.col("days_for_shipping_real") > lookup(SCHEDULES[schedule], F.col("shipping_mode"))
    counts = named.groupBy(region, "shipping_mode").agg(
        F.sum("n").alias("n_orders"),
        F.sum(F.when(late.isNotNull(), F.col("n"))).alias("n_known"),
        F.sum(F.when(late, F.col("n")).otherwise(0)).alias("n_late"),
    )
    return counts.select(
        region, "shipping_mode", "n_orders",
        ratio(F.col("n_late"), F.col("n_known")).alias("late_rate"),
    )


def shrink(stats: DataFrame, strength: float = STRENGTH) -> DataFrame:
    """Add ``global_rate`` and ``late_rate_adjusted``.

    The adjusted rate is a mean of the own rate, weighted by the orders, and the
    overall rate, weighted by ``strength``.
    """
    rated = stats.filter("late_rate is not null")
    overall = rated.agg(
        ratio(F.sum(F.col("n_orders") * F.col("late_rate")), F.sum("n_orders"))
    )
    with_global = stats.withColumn("global_rate", overall.scalar())
    n = F.col("n_orders").cast("double")
    adjusted = (n * F.col("late_rate") + strength * F.col("global_rate")) / (n + strength)
    return with_global.withColumn("late_rate_adjusted", adjusted)


def largest_shifts(shrunk: DataFrame, keys: Sequence[str], top: int = 8) -> DataFrame:
    """Groups that shrinkage moved most."""
    shift = F.abs(F.col("late_rate_adjusted") - F.col("late_rate"))
    return shrunk.select(
        *keys, "n_orders", "late_rate", "late_rate_adjusted", shift.alias("shift")
    ).orderBy(F.desc_nulls_first("shift"), *keys).limit(top)


def baseline(shrunk: DataFrame) -> DataFrame:
    """Expected late orders of the current mix, from raw and from adjusted rates."""
    n = F.col("n_orders")
    return shrunk.agg(
        F.sum("n_orders").alias("n_orders"),
        F.sum(n * F.col("late_rate")).alias("baseline_late"),
        F.sum(n * F.col("late_rate_adjusted")).alias("baseline_late_adjusted"),
    )
