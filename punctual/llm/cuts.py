"""Where a running total reaches a given amount, without sorting the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctual.session import materialize

DIGIT_BITS = 12


def cuts(units: DataFrame, wanted: DataFrame, bits: int) -> DataFrame:
    """The place at which each group's running total reaches its wanted amount.

    ``units(grp, place, amount)``: ``place`` is an integer from 0 below 2^bits, ``bits``
    a multiple of twelve, and ``amount`` is not negative. ``wanted(grp, wanted)`` has one
    row per group. Result, for groups whose total reaches a positive wanted amount:
    ``grp``, ``wanted``, ``place`` (the first one at which the running total is at least
    ``wanted``), ``before`` (the total of smaller places) and ``at`` (that of the place).

    Twelve bits are decided at a time: a round sums the amounts by their next digit
    among the rows that agree with the digits found so far. A task sends at most 4,096
    sums per group, so a group that holds most rows is no hot spot.
    """
    if bits % DIGIT_BITS:
        raise ValueError(f"bits must be a multiple of {DIGIT_BITS}")
    found = wanted.filter("wanted > 0").select(
        "grp", "wanted", F.lit(0).cast("long").alias("place"),
        F.lit(0).cast("double").alias("before"),
    )
    through = Window.partitionBy("grp").orderBy("digit").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    for shift in range(bits - DIGIT_BITS, -1, -DIGIT_BITS):
        prefix = F.shiftright("place", shift + DIGIT_BITS)
        sums = (
            units.select("grp", "place", "amount").withColumn("prefix", prefix)
            .join(
                found.select("grp", prefix.alias("prefix"), F.col("place").alias("base"),
                             "wanted", "before"),
                ["grp", "prefix"],
            )
            .groupBy("grp", "base", "wanted", "before",
                     F.shiftright("place", shift).bitwiseAND(2**DIGIT_BITS - 1).alias("digit"))
            .agg(F.sum("amount").cast("double").alias("at"))
        )
        running = sums.withColumn("through", F.col("before") + F.sum("at").over(through))
        digit = F.shiftleft(F.col("digit").cast("long"), shift)
        found = materialize(
            running.filter("through >= wanted and through - at < wanted").select(
                "grp", "wanted", (F.col("base") + digit).alias("place"),
                (F.col("through") - F.col("at")).alias("before"), "at",
            ), "cuts",
        )
    return found
