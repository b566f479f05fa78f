import itertools
import random

import pytest

from punctual.plans import allocate as al
from punctual.plans import shrinkage as sh

COLUMNS = "order_region string, shipping_mode string, n_orders bigint, late_rate double"


def cells(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


def random_cells(regions, seed):
    rng = random.Random(seed)
    return [
        (f"R{r:02d}", mode, rng.randrange(1, 60), round(rng.random(), 3))
        for r in range(regions) for mode in al.COST_INDEX
    ]


def brute_force(rows, rate_of, budget):
    """Least expected late orders over all assignments, or None."""
    volume, options = {}, {}
    for region, mode, n, _ in rows:
        volume[region] = volume.get(region, 0) + n
    for region, mode, n, rate in rows:
        if mode in al.COST_INDEX:
            options.setdefault(region, []).append(
                (volume[region] * al.COST_INDEX[mode], volume[region] * rate_of(n, rate)))
    total = sum(volume.values())
    best = None
    for plan in itertools.product(*[options.get(r, []) for r in sorted(volume)]):
        cost, late = sum(p[0] for p in plan), sum(p[1] for p in plan)
        if cost <= budget * total and (best is None or late < best):
            best = late
    return best


def test_shrinkage_formula(spark):
    stats = cells(spark, ("a", "x", 12, 0.25), ("b", "x", 988, 0.551619433))
    got = {r["order_region"]: r for r in sh.shrink(stats).collect()}
    world = (12 * 0.25 + 988 * 0.551619433) / 1000
    assert got["a"]["global_rate"] == pytest.approx(world)
    assert got["a"]["late_rate_adjusted"] == pytest.approx((3 + 100 * world) / 112)
    assert got["a"]["late_rate_adjusted"] == pytest.approx(0.516071, abs=1e-5)


def test_adjusted_rate_lies_between_own_and_overall(spark):
    rows = sh.shrink(cells(spark, *random_cells(6, 1))).collect()
    for r in rows:
        low, high = sorted([r["late_rate"], r["global_rate"]])
        assert low - 1e-12 <= r["late_rate_adjusted"] <= high + 1e-12


def test_largest_shifts(spark):
    shrunk = sh.shrink(cells(spark, ("a", "x", 5, 0.0), ("b", "x", 5000, 0.5)))
    top = sh.largest_shifts(shrunk, ["order_region"], top=1).collect()
    assert [r["order_region"] for r in top] == ["a"]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("ranges", [1, 7, 1024])
def test_plans_equal_brute_force(spark, monkeypatch, seed, ranges):
    monkeypatch.setattr(al, "COST_RANGES", ranges)
    rows = random_cells(5, seed)
    budgets = [0.9, 1.0, 1.3, 2.0, 2.7, 4.0]
    got = al.allocate(cells(spark, *rows), budgets, rate="late_rate").collect()
    volume = {r[0]: sum(x[2] for x in rows if x[0] == r[0]) for r in rows}
    for r in got:
        best = brute_force(rows, lambda n, rate: rate, r["budget"])
        assert r["feasible"] == (best is not None)
        if best is None:
            assert r["expected_late"] is None and r["plan"] is None
            continue
        assert r["expected_late"] == pytest.approx(best)
        assert r["total_cost"] <= r["budget"] * r["n_orders"]
        rate = {(x[0], x[1]): x[3] for x in rows}
        plan = {p["order_region"]: p["recommended_mode"] for p in r["plan"]}
        assert set(plan) == set(volume)
        assert sum(volume[p] * rate[p, m] for p, m in plan.items()) == pytest.approx(best)
        assert sum(volume[p] * al.COST_INDEX[m] for p, m in plan.items()) == r["total_cost"]
    late = [r["expected_late"] for r in sorted(got, key=lambda r: r["budget"]) if r["feasible"]]
    assert late == sorted(late, reverse=True)


def test_a_null_scenario_equals_its_named_twin(spark):
    rows = random_cells(3, 21)
    both = spark.createDataFrame(
        [(None, *r) for r in rows] + [("x", *r) for r in rows], "month string, " + COLUMNS)
    got = al.allocate(both, [1.5, 3.0], rate="late_rate", scenario=["month"]).collect()
    by_month = {m: sorted(tuple(r)[1:] for r in got if r["month"] == m) for m in (None, "x")}
    assert by_month[None] == by_month["x"] and all(r["feasible"] for r in got)


def test_orders_without_a_region_stay_in_the_baseline(spark):
    stats = sh.shrink(cells(spark, ("a", "Same Day", 20, 0.5), (None, "Same Day", 100, 0.9)))
    got = al.allocate(stats, [4.0]).first()
    whole = sh.baseline(stats).first()
    assert got["baseline_late"] == pytest.approx(whole["baseline_late"]) == pytest.approx(100)
    assert got["n_orders"] == 120 and len(got["plan"]) == 1


def test_budget_below_the_cheapest_plan(spark):
    stats = cells(spark, ("a", "First Class", 10, 0.5), ("a", "Same Day", 10, 0.1),
                  ("b", "First Class", 10, 0.5), ("b", "Same Day", 10, 0.2))
    got = al.allocate(stats, [2.0], rate="late_rate").first()
    assert got["feasible"] is False and got["total_cost"] is None
    assert got["n_orders"] == 40 and got["baseline_late"] == pytest.approx(13.0)
    assert al.assignment(al.allocate(stats, [2.0], rate="late_rate")).count() == 0


def test_mode_without_history_is_not_free(spark):
    stats = cells(spark, ("a", "Standard Class", 90, 0.4), ("b", "Standard Class", 50, 0.4),
                  ("b", "Same Day", 60, 0.1))
    rows = al.assignment(al.allocate(stats, [4.0], rate="late_rate")).collect()
    assert {r["order_region"]: r["recommended_mode"] for r in rows} == {
        "a": "Standard Class", "b": "Same Day"}


def test_mode_without_history_at_the_overall_rate(spark):
    stats = sh.shrink(cells(spark, ("a", "Standard Class", 100, 0.9),
                            ("b", "Standard Class", 900, 0.1)))
    got = al.allocate(stats, [4.0], unobserved="global").first()
    plan = {p["order_region"]: p["recommended_mode"] for p in got["plan"]}
    # Region a does better at the overall rate 0.18, region b better on its own.
    assert plan["b"] == "Standard Class" and plan["a"] != "Standard Class"


def test_modes_without_a_cost_count_as_volume_only(spark):
    stats = cells(spark, ("a", "Drone", 30, 0.0), ("a", "Standard Class", 10, 0.5))
    got = al.allocate(stats, [1.0], rate="late_rate").first()
    assert got["total_cost"] == 40.0 and got["expected_late"] == 20.0
    assert got["plan"][0]["recommended_mode"] == "Standard Class"


def test_region_without_any_candidate_makes_the_plan_infeasible(spark):
    stats = cells(spark, ("a", "Drone", 30, 0.0), ("b", "Standard Class", 10, 0.5))
    assert al.allocate(stats, [4.0], rate="late_rate").first()["feasible"] is False


def test_scenarios_equal_separate_runs(spark):
    first, second = random_cells(4, 11), random_cells(2, 12)
    both = spark.createDataFrame(
        [("x", *r) for r in first] + [("y", *r) for r in second], "month string, " + COLUMNS)
    budgets = [1.2, 2.5]
    got = {(r["month"], r["budget"]): r["expected_late"] for r in
           al.allocate(both, budgets, rate="late_rate", scenario=["month"]).collect()}
    for month, rows in [("x", first), ("y", second)]:
        for budget in budgets:
            best = brute_force(rows, lambda n, rate: rate, budget)
            assert got[month, budget] == pytest.approx(best)


def test_unknown_option_is_refused(spark):
    with pytest.raises(ValueError, match="unobserved"):
        al.allocate(cells(spark, ("a", "Same Day", 1, 0.1)), rate="late_rate",
                    unobserved="free")


def efficient(options):
    """Corners of the lower hull, one after the other by the largest saving per cost."""
    cost, late, _ = here = min(options, key=lambda o: (o[0], o[1], o[2]))
    corners = [here]
    while True:
        better = [o for o in options if o[0] > cost and o[1] < late]
        if not better:
            return corners
        here = max(better, key=lambda o: ((late - o[1]) / (o[0] - cost), o[0]))
        cost, late, _ = here
        corners.append(here)


def by_region(rows):
    volume = {}
    for region, _, n, _ in rows:
        volume[region] = volume.get(region, 0) + n
    options = {}
    for region, mode, _, rate in rows:
        options.setdefault(region, []).append(
            (volume[region] * al.COST_INDEX[mode], volume[region] * rate, mode))
    return volume, options


def many_cells(regions, seed):
    """Rates with few digits, so that ties, dominated and collinear modes occur."""
    rng = random.Random(seed)
    return [(f"R{r:05d}", mode, rng.randrange(1, 60), rng.randrange(0, 21) / 20)
            for r in range(regions) for mode in al.COST_INDEX if rng.random() < 0.9 or mode == "Same Day"]


@pytest.mark.parametrize("seed", [5, 6])
def test_large_plans_and_their_gap(spark, seed):
    rows = many_cells(300, seed)
    volume, options = by_region(rows)
    budgets = [0.3, 1.2, 1.5, 2.2, 3.0, 4.0]
    summary, plan = al.allocate_large(cells(spark, *rows), budgets, rate="late_rate")
    got = {r["budget"]: r for r in summary.collect()}
    chosen = {}
    for r in plan.collect():
        chosen.setdefault(r["budget"], {})[r["order_region"]] = r["recommended_mode"]
    total = sum(volume.values())
    steps = sorted(
        (-round((a[1] - b[1]) / (b[0] - a[0]), 9), region, k, b[0] - a[0], a[1] - b[1])
        for region, some in options.items()
        for k, (a, b) in enumerate(itertools.pairwise(efficient(some)), 1)
    )
    for budget in budgets:
        cost = sum(min(o)[0] for o in options.values())
        late = sum(min(o)[1] for o in options.values())
        r = got[budget]
        assert r["feasible"] == (cost <= budget * total)
        if not r["feasible"]:
            assert budget not in chosen and r["late"] is None
            continue
        bound = late
        for _, _, _, more, saved in steps:
            if cost + more > budget * total:
                bound = late - saved / more * (budget * total - cost)
                assert r["next_saved"] == pytest.approx(saved)
                break
            cost, late, bound = cost + more, late - saved, late - saved
        assert (r["cost"], r["late"]) == (pytest.approx(cost), pytest.approx(late))
        assert r["bound"] == pytest.approx(bound) and 0 <= r["gap"] + 1e-9 <= r["next_saved"] + 2e-9
        assert set(chosen[budget]) == set(volume)
        value = [next(o for o in options[k] if o[2] == m) for k, m in chosen[budget].items()]
        assert sum(v[0] for v in value) == pytest.approx(cost) and cost <= budget * total
        assert sum(v[1] for v in value) == pytest.approx(late)


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_bounds_enclose_the_best_plan(spark, seed):
    rows, budgets = random_cells(6, seed), [0.9, 1.1, 1.6, 2.4, 3.3, 4.0]
    summary, _ = al.allocate_large(cells(spark, *rows), budgets, rate="late_rate")
    for r in summary.collect():
        best = brute_force(rows, lambda n, rate: rate, r["budget"])
        assert r["feasible"] == (best is not None)
        if best is not None:
            assert r["bound"] - 1e-6 <= best <= r["late"] + 1e-6


@pytest.mark.parametrize("make", [random_cells, many_cells])
def test_bounds_do_not_change_the_table_of_25_regions(spark, monkeypatch, make):
    rows, budgets = make(25, 8), [0.9, 1.05, 1.5, 2.0, 3.0, 4.0]
    found = []
    for least in (10, 1000):
        monkeypatch.setattr(al, "REGIONS_FOR_BOUNDS", least)
        out = al.allocate(cells(spark, *rows), budgets, rate="late_rate").collect()
        found.append({r["budget"]: r for r in out})
    volume, options = by_region(rows)
    for budget, r in found[0].items():
        other = found[1][budget]
        assert r["feasible"] == other["feasible"] and r["total_cost"] == other["total_cost"]
        if not r["feasible"]:
            continue
        assert r["expected_late"] == pytest.approx(other["expected_late"])
        plan = {p["order_region"]: p["recommended_mode"] for p in r["plan"]}
        value = [next(o for o in options[k] if o[2] == m) for k, m in plan.items()]
        assert len(plan) == 25 and sum(v[0] for v in value) == r["total_cost"]
        assert sum(v[1] for v in value) == pytest.approx(r["expected_late"])


def test_bounds_of_scenarios_of_different_size(spark, monkeypatch):
    monkeypatch.setattr(al, "REGIONS_FOR_BOUNDS", 10)
    first, second = random_cells(13, 31), random_cells(4, 32)
    both = spark.createDataFrame(
        [("x", *r) for r in first] + [(None, *r) for r in second], "month string, " + COLUMNS)
    budgets = [0.5, 1.2, 2.5]
    got = {(r["month"], r["budget"]): r for r in
           al.allocate(both, budgets, rate="late_rate", scenario=["month"]).collect()}
    alone = {(m, r["budget"]): r for m, rows in (("x", first), (None, second)) for r in
             al.allocate(cells(spark, *rows), budgets, rate="late_rate").collect()}
    assert set(got) == set(alone)
    for key, r in got.items():
        assert (r["feasible"], r["total_cost"]) == (alone[key]["feasible"], alone[key]["total_cost"])
        if r["feasible"]:
            assert r["expected_late"] == pytest.approx(alone[key]["expected_late"])


def test_large_without_rows_or_candidates(spark):
    summary, plan = al.allocate_large(cells(spark), [1.0], rate="late_rate")
    assert plan.count() == 0 and not any(r["feasible"] for r in summary.collect())
    some = cells(spark, ("a", "Drone", 30, 0.0), ("b", "Standard Class", 10, 0.5), (None, "Same Day", 5, 0.1))
    summary, plan = al.allocate_large(some, [4.0], rate="late_rate")
    assert [r["feasible"] for r in summary.collect()] == [False] and plan.count() == 0
