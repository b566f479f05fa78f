"""Bounds for the allocation of modes, and plans for very many regions.

The efficient modes of a region are the corners of the lower hull of its (cost, late)
points. Going from one corner to the next is an upgrade: it costs more and saves late
orders. Upgrades are ranked by what they save per cost; running sums over ranges of the
ranking tell how far a budget reaches. The upgrade that no longer fits prices the budget:
with its saving per cost as the price, every region on its own gives a lower bound for any
plan (the dual bound). The plan of all upgrades that fit is at most that one upgrade above
the bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.operators.ordered import running_totals
from punctual.session import materialize

# Savings per cost are ranked with this many digits, so that ties are ties everywhere.
DIGITS = 9


def hull(options: Column) -> Column:
    """Corners of the lower hull of an array of options, by rising cost.

    Of options with equal cost and late orders the first mode stays. A corner saves more
    per cost against each cheaper option than any dearer one saves against it.
    """
    def worse(o: Column) -> Column:
        return F.exists(options, lambda p: (p["cost"] <= o["cost"]) & (p["late"] <= o["late"]) & (
            (p["cost"] < o["cost"]) | (p["late"] < o["late"])
            | (p["shipping_mode"] < o["shipping_mode"])
        ))

    by_cost = F.array_sort(F.transform(
        F.filter(options, lambda o: ~worse(o)),
        lambda o: F.struct(o["cost"].alias("cost"), o["late"].alias("late"),
                           o["shipping_mode"].alias("shipping_mode")),
    ))

    def corner(o: Column) -> Column:
        into = F.array_min(F.transform(
            F.filter(by_cost, lambda p: p["cost"] < o["cost"]),
            lambda p: (p["late"] - o["late"]) / (o["cost"] - p["cost"]),
        ))
        out = F.array_max(F.transform(
            F.filter(by_cost, lambda q: q["cost"] > o["cost"]),
            lambda q: (o["late"] - q["late"]) / (q["cost"] - o["cost"]),
        ))
        return F.coalesce(into, F.lit(float("inf"))) > F.coalesce(out, F.lit(-1.0))

    return F.filter(by_cost, corner)


def with_hulls(choices: DataFrame) -> DataFrame:
    """``choices`` with the column ``corners``, written."""
    return materialize(choices.withColumn("corners", hull(F.col("options"))), "hulls")


def upgrades(hulls: DataFrame, region: str, scenario: Sequence[str]) -> DataFrame:
    """One row per upgrade: scenario, region, ``step`` (from 1), ``shipping_mode`` (the new
    one), ``cost`` and ``saved`` (both against the corner before) and ``per_cost``."""
    steps = F.transform(
        F.slice("corners", 2, F.greatest(F.size("corners") - 1, F.lit(0))),
        lambda o, i: F.struct(
            (i + 1).alias("step"), o["shipping_mode"].alias("shipping_mode"),
            (o["cost"] - F.col("corners")[i]["cost"]).alias("cost"),
            (F.col("corners")[i]["late"] - o["late"]).alias("saved"),
        ),
    )
    rows = hulls.select(*scenario, region, F.inline(steps))
    return rows.withColumn("per_cost", F.round(F.col("saved") / F.col("cost"), DIGITS))


def ranked_upgrades(hulls: DataFrame, region: str, scenario: Sequence[str]) -> DataFrame:
    """Upgrades with ``through``: the cost of all upgrades of the scenario up to this one.

    The best per cost come first, then by region and step. Corners of a region save less
    and less per cost, so its upgrades come in their order.
    """
    rows = upgrades(hulls, region, scenario)
    place = F.struct(*scenario, (-F.col("per_cost")).alias("rank"), region, "step")
    running = running_totals(rows.withColumn("_place", place), F.col("_place"), ["cost"])
    # The running sum goes over all scenarios; costs are positive, so the smallest sum is
    # that at which a scenario begins.
    begins = running.groupBy(*scenario).agg(F.min("cost_before").alias("_begin")) \
        if scenario else None
    if begins is None:
        return running.withColumn("through", F.col("cost_before") + F.col("cost")).drop(
            "_place", "cost_before"
        )
    return running.join(begins, list(scenario)).withColumn(
        "through", F.col("cost_before") - F.col("_begin") + F.col("cost")
    ).drop("_place", "cost_before", "_begin")


def budget_bounds(
    hulls: DataFrame, ranked: DataFrame, budgets: Sequence[float], scenario: Sequence[str]
) -> DataFrame:
    """Per scenario and budget what the ranking says.

    ``spendable`` (the budget in cost units), ``feasible``, ``cost`` and ``late`` of the
    plan of all upgrades that fit, ``price`` (saving per cost of the first that does not, 0
    if all fit), ``bound`` (no plan within the budget has fewer late orders) and
    ``next_saved`` (what the first upgrade that does not fit would save).
    """
    cheapest = F.get("corners", F.lit(0))
    base = hulls.groupBy(*scenario).agg(
        F.sum(cheapest["cost"]).alias("base_cost"), F.sum(cheapest["late"]).alias("base_late"),
        F.sum("volume").alias("total_volume"), F.count("*").alias("n_regions"),
        F.bool_and(F.size("corners") > 0).alias("complete"),
    )
    each = F.explode(F.array(*[F.lit(float(b)) for b in budgets])).alias("budget")
    asked = base.select("*", each).withColumn(
        "spendable", F.col("budget") * F.col("total_volume")
    )
    slack = F.col("spendable") * (1 + 1e-12) - F.col("base_cost")
    asked = materialize(
        asked.withColumn("slack", slack).withColumn(
            "feasible", F.col("complete") & (F.col("slack") >= 0)
        ), "asked",
    )
    keys = [*scenario, "budget"]
    wanted = asked.select(*keys, "slack").filter("slack >= 0")
    offered = ranked.select(*scenario, "cost", "saved", "per_cost", "through")
    pairs = offered.join(wanted, list(scenario)) if scenario else offered.crossJoin(
        F.broadcast(wanted)  # one row per budget
    )
    fits = F.col("through") <= F.col("slack")
    reach = pairs.groupBy(*keys).agg(
        F.sum(F.when(fits, F.col("cost"))).alias("spent"),
        F.sum(F.when(fits, F.col("saved"))).alias("saved"),
        F.count_if(fits).alias("n_upgrades"),
        F.min(F.when(~fits, F.struct("through", "per_cost", "saved"))).alias("next"),
    )
    none = F.lit(0.0)
    spent, saved = (F.coalesce(c, none) for c in ("spent", "saved"))
    price = F.coalesce(F.col("next.per_cost"), none)
    late = F.col("base_late") - saved
    return asked.join(reach, keys, "left").select(
        *keys, "feasible", "spendable", "n_regions",
        F.coalesce("n_upgrades", F.lit(0)).alias("n_upgrades"),
        F.when(F.col("feasible"), F.col("base_cost") + spent).alias("cost"),
        F.when(F.col("feasible"), late).alias("late"),
        F.when(F.col("feasible"), price).alias("price"),
        F.when(F.col("feasible"), late - price * (F.col("slack") - spent)).alias("bound"),
        F.when(F.col("feasible"), F.coalesce(F.col("next.saved"), none)).alias("next_saved"),
    )


def allocate_many(
    choices: DataFrame, region: str, budgets: Sequence[float], scenario: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Plans for very many regions: the summary per budget, and the assignment.

    ``choices`` has scenario, region, ``volume`` and ``options`` (mode, cost, late).
    The plan of a budget takes the upgrades in the order of the ranking as far as it
    reaches; ``gap`` is its distance from the dual bound, never more than ``next_saved``.
    """
    hulls = with_hulls(choices)
    ranked = materialize(ranked_upgrades(hulls, region, scenario), "ranked")
    bounds = materialize(budget_bounds(hulls, ranked, budgets, scenario), "bounds")
    reached = bounds.filter("feasible").select(
        *scenario, "budget", (F.col("spendable") * (1 + 1e-12)).alias("_spendable")
    )
    base = hulls.groupBy(*scenario).agg(F.sum(F.get("corners", F.lit(0))["cost"]).alias("_base"))
    limits = (reached.join(base, list(scenario)) if scenario else reached.crossJoin(base)).select(
        *scenario, "budget", (F.col("_spendable") - F.col("_base")).alias("_slack")
    )
    # One row per scenario and budget; scenarios are as many as the caller decides.
    keys = [*scenario, region, "budget"]
    taken = (ranked.join(limits, list(scenario)) if scenario else ranked.crossJoin(F.broadcast(limits)))
    last = taken.filter("through <= _slack").groupBy(*keys).agg(
        F.max(F.struct("step", "shipping_mode")).alias("_last")
    )
    first = hulls.select(
        *scenario, F.col(region), F.get("corners", F.lit(0))["shipping_mode"].alias("_first")
    )
    every = first.join(limits, list(scenario)) if scenario else first.crossJoin(F.broadcast(limits))
    plan = every.join(last, keys, "left").select(
        *scenario, "budget", region,
        F.coalesce("_last.shipping_mode", "_first").alias("recommended_mode"),
    )
    return bounds.withColumn("gap", F.col("late") - F.col("bound")), plan


def _tolerance(best: Column, price: Column, spendable: Column) -> Column:
    """Room for rounding in sums of this size."""
    return (1 + F.abs(best) + price * spendable) * 1e-9


def undecided(
    choices: DataFrame, region: str, scenario: Sequence[str], budgets: Sequence[float]
) -> DataFrame:
    """Regions with the options that an optimal plan of some budget may still take.

    With a price on cost, every region has a cheapest option; another one raises the bound
    by what it costs more. It stays if for some budget the raised bound is within the plan
    that is already known. ``bounds`` holds per budget: ``price``, ``spendable``, ``best``
    (late orders of the known plan) and ``least`` (the region's priced minimum).
    """
    hulls = with_hulls(choices)
    ranked = materialize(ranked_upgrades(hulls, region, scenario), "ranked")
    known = budget_bounds(hulls, ranked, budgets, scenario).filter("feasible")
    listed = known.groupBy(*scenario).agg(F.collect_list(F.struct(
        "price", "spendable", F.col("late").alias("best"), F.col("bound").alias("bound")
    )).alias("_known"))  # one per budget
    joined = hulls.join(materialize(listed, "known"), list(scenario), "left")

    def priced(o: Column, b: Column) -> Column:
        return o["late"] + b["price"] * o["cost"]

    bounds = F.transform(
        F.coalesce("_known", F.array().cast(listed.schema["_known"].dataType)),
        lambda b: F.struct(
            b["price"].alias("price"), b["spendable"].alias("spendable"),
            b["best"].alias("best"), b["bound"].alias("bound"),
            F.array_min(F.transform("options", lambda o: priced(o, b))).alias("least"),
        ),
    )
    with_bounds = joined.withColumn("bounds", bounds)
    stays = F.filter("options", lambda o: F.exists("bounds", lambda b: (
        priced(o, b) - b["least"] + b["bound"]
        <= b["best"] + _tolerance(b["best"], b["price"], b["spendable"])
    )))
    return materialize(
        with_bounds.withColumn("options", stays).drop("_known", "corners"), "undecided"
    )


def with_rests(core: DataFrame, region: str, scenario: Sequence[str]) -> DataFrame:
    """``bounds`` with ``rest``: per budget the priced minimum of all later regions."""
    later = Window.partitionBy(*scenario, "_budget").orderBy(region).rowsBetween(
        1, Window.unboundedFollowing
    )
    rows = core.select(*scenario, region, F.posexplode("bounds").alias("_budget", "_b"))
    rest = F.coalesce(F.sum("_b.least").over(later), F.lit(0.0))
    found = rows.select(*scenario, region, "_budget", F.col("_b").withField("rest", rest).alias("_b"))
    back = found.groupBy(*scenario, region).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_budget", "_b"))), lambda x: x["_b"])
        .alias("bounds")
    )
    return core.drop("bounds").join(back, [*scenario, region], "left")


def may_be_best(cost: Column, late: Column, bounds: Column) -> Column:
    """Whether a partial plan can still lead to an optimal one for some budget."""
    return F.exists(bounds, lambda b: (
        late + b["price"] * (cost - b["spendable"]) + b["rest"]
        <= b["best"] + _tolerance(b["best"], b["price"], b["spendable"])
    ))
