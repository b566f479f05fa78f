"""One shipping mode per region: least expected late orders under a cost budget.

All budgets are answered from one table: the undominated (cost, late) totals over all
regions. It is built some regions at a time. Each step extends every partial plan by the
modes of these regions and drops plans that cost no less and deliver no better than
another. Scenarios, such as months or markets, are independent and go through the
same steps side by side.

With many regions, dual bounds (``allocate_bounds``) first decide what they can: regions
with one mode left are summed up, the steps go over the others only, and partial plans
that no longer can be the best of any budget are dropped. The result is the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.functions.scalar import lookup
from punctual.plans import allocate_bounds as ab
from punctual.session import materialize

# Relative cost of a shipment by mode.
COST_INDEX = {
    "Same Day": 4.0,
    "First Class": 3.0,
    "Second Class": 2.0,
    "Standard Class": 1.0,
}
BUDGETS = [1.5, 2.0, 2.5, 3.0]

# Cost ranges in which the partial plans of a scenario are compared side by side.
COST_RANGES = 1024
# Regions that are added between two searches for dominated plans. Four modes each make
# 64 times as many plans before a search, at a third of the searches.
REGIONS_PER_STEP = 3
# From so many regions on, bounds are worth their jobs. With them, few plans pass each
# region, so more regions are added before a search.
REGIONS_FOR_BOUNDS = 30
REGIONS_PER_BOUNDED_STEP = 8


def _within(cost: Column, limit: Column) -> Column:
    """``cost <= limit``, blind to rounding in the limit."""
    return cost <= limit + F.abs(limit) * 1e-12


def region_options(
    stats: DataFrame,
    rate: str,
    region: str,
    scenario: Sequence[str],
    cost_index: dict[str, float],
    unobserved: str,
) -> DataFrame:
    """One row per scenario and region: ``volume`` and the array of its modes.

    The volume of a region counts its orders in all modes, also in modes without a
    cost. A mode that a region has no history for is no candidate; with
    ``unobserved='global'`` it is one, at the overall rate.
    """
    here = [*scenario, region]
    places = stats.groupBy(*here).agg(F.sum("n_orders").cast("double").alias("volume"))
    modes = F.explode(F.array(*[F.lit(m) for m in cost_index])).alias("shipping_mode")
    pairs = places.select(*here, "volume", modes).join(
        stats.select(*here, "shipping_mode", F.col(rate).alias("_rate")),
        [*here, "shipping_mode"], "left",
    )
    if unobserved == "global":
        overall = stats.agg(F.max("global_rate")).scalar()
        pairs = pairs.withColumn("_rate", F.coalesce("_rate", overall))
    elif unobserved != "exclude":
        raise ValueError(f"unobserved must be 'exclude' or 'global', not {unobserved!r}")
    option = F.struct(
        "shipping_mode",
        (F.col("volume") * lookup(cost_index, F.col("shipping_mode"))).alias("cost"),
        (F.col("volume") * F.col("_rate")).alias("late"),
    )
    return pairs.groupBy(*here, "volume").agg(
        F.sort_array(F.collect_list(F.when(F.col("_rate").isNotNull(), option)))
        .alias("options")
    )


def _steps(listed: DataFrame, region: str, scenario: Sequence[str]) -> DataFrame:
    """Number the regions of each scenario; ``cost_to_come`` is the least cost of the later."""
    cheapest = F.array_min(F.transform("options", lambda o: o["cost"]))
    by_region = Window.partitionBy(*scenario).orderBy(F.asc_nulls_first(region))
    later = by_region.rowsBetween(1, Window.unboundedFollowing)
    return listed.select(
        "*",
        F.row_number().over(by_region).alias("step"),
        F.coalesce(F.sum(cheapest).over(later), F.lit(0.0)).alias("cost_to_come"),
    )


def undominated(points: DataFrame, scenario: Sequence[str], top: Column) -> DataFrame:
    """Points with fewer late orders than every point that costs no more.

    Points are compared within ranges of the cost, up to ``top``, first, then with the
    best of all cheaper ranges, so that no task sees a whole scenario. What is left of
    the ranges is written.
    """
    def better_before(keys: Sequence[str], *order: str) -> Column:
        window = Window.partitionBy(*keys).orderBy(*order)
        return F.min("late").over(window.rowsBetween(Window.unboundedPreceding, -1))

    share = F.coalesce(F.try_divide(F.col("cost"), top), F.lit(0.0))
    within = F.least(F.floor(share * COST_RANGES), F.lit(COST_RANGES))
    keys = [*scenario, "_range"]
    marked = points.withColumn("_range", within).withColumn(
        "_best", better_before(keys, "cost", "late", "plan")
    )
    local = materialize(marked.filter("_best is null or late < _best").drop("_best"), "local")
    minima = local.groupBy(*keys).agg(F.min("late").alias("late"))
    cheaper = minima.withColumn("_best", better_before(scenario, "_range")).drop("late")
    joined = local.join(cheaper, keys)
    return joined.filter("_best is null or late < _best").drop("_best", "_range")


def frontier(
    listed: DataFrame,
    region: str,
    scenario: Sequence[str],
    budgets: Sequence[float],
    dearest: float = max(COST_INDEX.values()),
) -> DataFrame:
    """Undominated (cost, late, plan) totals over all regions of each scenario.

    ``listed`` holds the options of every region. Partial plans that cannot stay within
    the highest budget, even with the cheapest modes from here on, are dropped as well,
    and so are, with many regions, those that no budget's best plan can grow from; this
    loses no best plan. ``dearest`` is the largest cost index, which bounds the cost.
    """
    listed = materialize(listed, "listed")
    plan_type = f"array<struct<{region}:string,recommended_mode:string>>"
    points = listed.groupBy(*scenario).agg(F.sum("volume").alias("total_volume")).select(
        *scenario, "total_volume", F.lit(0.0).alias("cost"), F.lit(0.0).alias("late"),
        F.array().cast(plan_type).alias("plan"),
    )
    most = listed.groupBy(*scenario).count().agg(F.max("count")).first()[0] or 0
    bounded = most >= REGIONS_FOR_BOUNDS
    if bounded:
        listed = ab.undecided(listed, region, scenario, budgets)
        only = F.get("options", F.lit(0))
        decided = listed.filter(F.size("options") == 1).groupBy(*scenario).agg(
            F.sum(only["cost"]).alias("_cost"), F.sum(only["late"]).alias("_late"),
            F.collect_list(F.struct(
                F.col(region).cast("string").alias(region),
                only["shipping_mode"].alias("recommended_mode"),
            )).alias("_plan"),
        )
        listed = ab.with_rests(listed.filter(F.size("options") != 1), region, scenario)
        points = points.join(materialize(decided, "decided"), list(scenario), "left").select(
            *scenario, "total_volume", F.coalesce("_cost", "cost").alias("cost"),
            F.coalesce("_late", "late").alias("late"), F.coalesce("_plan", "plan").alias("plan"),
        )
    choices = materialize(_steps(listed, region, scenario), "choices")
    last = choices.agg(F.max("step")).first()[0] or 0
    # A scenario with fewer regions passes through unchanged.
    idle = F.array(F.struct(
        F.lit(None).cast("string").alias("shipping_mode"),
        F.lit(0.0).alias("cost"), F.lit(0.0).alias("late"),
    ))

    def extended(plans: DataFrame, step: int) -> DataFrame:
        here = choices.filter(F.col("step") == step).select(
            *scenario, region, "options", "cost_to_come", *["bounds"] * bounded
        )
        grown = plans.join(here, list(scenario), "left").withColumn(
            "_o", F.explode(F.coalesce("options", idle))
        )
        choice = F.struct(F.col(region).cast("string").alias(region),
                          F.col("_o.shipping_mode").alias("recommended_mode"))
        cost, late = (F.col(c) + F.col(f"_o.{c}") for c in ("cost", "late"))
        plan = F.when(F.col("_o.shipping_mode").isNull(), F.col("plan")).otherwise(
            F.array_append("plan", choice)
        )
        at_least = cost + F.coalesce("cost_to_come", F.lit(0.0))
        grown = grown.filter(_within(at_least, max(budgets) * F.col("total_volume")))
        if bounded:
            grown = grown.filter(F.col("_o.shipping_mode").isNull() | ab.may_be_best(
                cost, late, F.col("bounds")
            ))
        return grown.select(
            *scenario, "total_volume", cost.alias("cost"), late.alias("late"), plan.alias("plan")
        )

    stride = REGIONS_PER_BOUNDED_STEP if bounded else REGIONS_PER_STEP
    for start in range(1, last + 1, stride):
        steps = range(start, min(start + stride, last + 1))
        points = undominated(
            reduce(extended, steps, points), scenario, F.col("total_volume") * dearest
        )
    return materialize(points, "frontier")


def allocate(
    stats: DataFrame,
    budgets: Sequence[float] = tuple(BUDGETS),
    rate: str = "late_rate_adjusted",
    region: str = "order_region",
    scenario: Sequence[str] = (),
    cost_index: dict[str, float] | None = None,
    unobserved: str = "exclude",
) -> DataFrame:
    """Best plan per scenario and budget.

    ``stats`` has scenario columns, region, shipping_mode, n_orders, late_rate and the
    ``rate`` column. A budget limits the mean cost index per order. A budget that no
    plan meets gives a row with ``feasible`` false and no plan.

    A null in a scenario column is a value like any other. Orders without a region
    cannot be assigned; they count in ``n_orders`` and in the baselines only.
    """
    # One text per scenario: nulls in its columns do not get lost in joins.
    name = F.to_json(F.struct(*scenario)) if scenario else F.lit("all")
    rows = materialize(stats.withColumn("_scenario", name), "cells")
    keys, costs = ["_scenario"], cost_index or COST_INDEX
    placed = rows.filter(F.col(region).isNotNull())
    listed = region_options(placed, rate, region, keys, costs, unobserved)
    points = frontier(listed, region, keys, budgets, max(costs.values()))

    each = F.explode(F.array(*[F.lit(float(b)) for b in budgets])).alias("budget")
    affordable = points.select("*", each).filter(
        _within(F.col("cost"), F.col("budget") * F.col("total_volume"))
    )
    best = affordable.groupBy(*keys, "budget").agg(
        F.min(F.struct("late", "cost", "plan")).alias("best")
    )
    totals = rows.groupBy(*keys, *scenario).agg(
        F.sum("n_orders").alias("n_orders"),
        F.sum(F.col("n_orders") * F.col("late_rate")).alias("baseline_late"),
        F.sum(F.col("n_orders") * F.col(rate)).alias("baseline_late_adjusted"),
    )
    answered = totals.select("*", each).join(best, [*keys, "budget"], "left")
    percent = 100 * F.try_divide(F.col("best.late"), F.col("baseline_late"))
    return answered.select(
        *scenario, "budget", F.col("best").isNotNull().alias("feasible"),
        F.col("best.cost").alias("total_cost"), F.col("best.late").alias("expected_late"),
        F.col("n_orders").cast("bigint").alias("n_orders"),
        "baseline_late", "baseline_late_adjusted",
        percent.alias("pct_of_baseline"), (percent - 100).alias("delta_pct"),
        F.col("best.plan").alias("plan"),
    )


def assignment(allocated: DataFrame, scenario: Sequence[str] = ()) -> DataFrame:
    """One row per region with its recommended mode."""
    return allocated.filter("feasible").select(*scenario, "budget", F.inline("plan"))


def allocate_large(
    stats: DataFrame,
    budgets: Sequence[float] = tuple(BUDGETS),
    rate: str = "late_rate_adjusted",
    region: str = "order_region",
    cost_index: dict[str, float] | None = None,
    unobserved: str = "exclude",
) -> tuple[DataFrame, DataFrame]:
    """Summary per budget and assignment per region, for very many regions at once.

    The plan may be above the best one, by ``gap`` at most, which is never more than
    what one upgrade of one region saves (``next_saved``). The regions are compared by
    range, never in one task. Arguments are those of ``allocate``.
    """
    placed = materialize(stats.filter(F.col(region).isNotNull()), "cells")
    listed = region_options(placed, rate, region, [], cost_index or COST_INDEX, unobserved)
    return ab.allocate_many(listed, region, budgets)
