"""Running totals over a whole table without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.session import materialize


def running_totals(df: DataFrame, order: Column, values: Sequence[str]) -> DataFrame:
    """Add ``<value>_before``: the sum of ``value`` over all earlier rows.

    ``order`` must be unique per row. The rows are range-partitioned, in as many ranges
    as the session has shuffle partitions, and written, which fixes the partition
    numbers. Running sums inside a partition then start at the total of the earlier
    partitions; only those totals, one row per partition, meet in one task.
    """
    def sums_before(window: Window) -> list[Column]:
        earlier = window.rowsBetween(Window.unboundedPreceding, -1)
        return [F.coalesce(F.sum(v).over(earlier), F.lit(0)) for v in values]

    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Sampling and sorting read the rows twice, so they are written before.
    ranged = materialize(df, "unordered").repartitionByRange(ranges, order)
    placed = materialize(ranged.withColumn("_part", F.spark_partition_id()), "ranges")
    totals = placed.groupBy("_part").agg(*[F.sum(v).alias(v) for v in values])
    offsets = totals.select("_part", *[
        total.alias(f"_s_{v}")
        for v, total in zip(values, sums_before(Window.orderBy("_part")))
    ])
    joined = placed.join(offsets, "_part")
    within = sums_before(Window.partitionBy("_part").orderBy(order))
    return joined.select(*df.columns, *[
        (F.col(f"_s_{v}") + total).alias(f"{v}_before")
        for v, total in zip(values, within)
    ])
