
from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from punctual import oracle, schema
from punctual.operators.insert import insert_if_absent
from punctual.operators.split import stratified_split
from punctual.plans import allocate as al
from punctual.plans import diagnose as dg
from punctual.plans import estimability as es
from punctual.plans import evaluate as ev
from punctual.plans import model as ml
from punctual.plans import quality as dq
from punctual.plans import shrinkage as sh
from punctual.plans import star, stats
from punctual.session import CODEC, materialize, scratch_path
from punctual.sources import csv_files, date_formats, retail
from punctual.sources.given import warehouse_for
from punctual.sources.warehouse import Warehouse
from punctual.streaming import incremental, scoring

# Order totals of the given tables are about a thousand times those of the reference
# data, so the value limits are scaled.
VALUE_LIMITS = [100_000, 200_000, 300_000]
BUDGETS = [0.5, 1.0, 1.5, 2.0, 2.5, 3.0]
LARGE_BUDGETS = [0.5, 1.0, 1.05, 1.25, 1.5, 2.0, 3.0]
SWEEP = [tenths / 10 for tenths in range(10, 41)]
REGIONS = ["NATION_0", "NATION_7", "NATION_13"]
LOADED_BEFORE = "1996-01-01"
WORST_ITEMS = 2400

Query = Callable[[SparkSession, str], DataFrame]

# Queries of the training-data operators and of their pipeline, where these are present.
EXTRA_QUERIES: dict[str, Query] = {}
EXTRA_SQL: dict[str, str] = {}


try:
    from punctual.llm import registry as _llm
except ImportError:
    pass
else:
    EXTRA_QUERIES |= _llm.QUERIES
    EXTRA_SQL |= _llm.SQL
    try:
        import corpus_pipeline as _pipeline
    except ImportError:
        pass
    else:
        EXTRA_QUERIES["pipeline"] = _pipeline.run


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _shrunk(house: Warehouse) -> DataFrame:
    return sh.shrink(dg.region_mode_stats(house))


def _cell_scores(house: Warehouse) -> DataFrame:
    """Orders counted by a score that SQL can compute: the adjusted rate of their cell."""
    late = F.round(F.col("n_orders") * F.col("late_rate")).cast("bigint")
    cells = _shrunk(house).select(
        F.round("late_rate_adjusted", 9).alias("score"), late.alias("n_pos"),
        (F.col("n_orders") - late).alias("n_neg"),
    )
    return cells.groupBy("score").agg(
        F.sum("n_pos").alias("n_pos"), F.sum("n_neg").alias("n_neg")
    )


def _allocated(house: Warehouse, region: str, budgets: Sequence[float]) -> DataFrame:
    cells = sh.what_if_cells(house, "loose", region)
    return al.allocate(sh.shrink(cells), budgets, region=region)


def _headline(allocated: DataFrame) -> DataFrame:
    return _rounded(
        allocated.drop("plan"), 6, "expected_late", "baseline_late",
        "baseline_late_adjusted", "pct_of_baseline", "delta_pct",
    )


def _by_budget(region: str, budgets: Sequence[float]) -> Callable[[Warehouse], DataFrame]:
    return lambda house: _headline(_allocated(house, region, budgets))


def _by_market_and_region(house: Warehouse) -> DataFrame:
    """Every market decides for its own regions, all markets side by side."""
    cells = sh.what_if_cells(house, "loose", "order_region")
    markets = house.table("dim_geography").select("order_region", "market").distinct()
    shrunk = sh.shrink(cells).join(markets, "order_region")
    return _headline(al.allocate(shrunk, BUDGETS, scenario=["market"]))


def _allocation_large(house: Warehouse) -> DataFrame:
    """One instance of all regions by order month, under one budget for all of them."""
    cells = sh.shrink(sh.monthly_cells(house, "loose"))
    summary, _ = al.allocate_large(cells, LARGE_BUDGETS)
    return _rounded(summary.select(
        "budget", "feasible", "n_regions", "n_upgrades", F.col("cost").alias("total_cost"),
        F.col("late").alias("expected_late"), "gap", "next_saved",
    ), 6, "expected_late", "gap", "next_saved")


def _grown_customers(house: Warehouse) -> DataFrame:
    """Customers of an earlier load, completed by those of all orders.

    The earlier load knew other segments, so a row that is replaced shows.
    """
    staged = house.table("stg_orders")
    earlier = star.dim_customer(staged.filter(F.col("order_date") < LOADED_BEFORE))
    before = materialize(earlier.withColumn(
        "customer_segment", F.concat(F.lit("formerly "), F.col("customer_segment"))
    ), "customers")
    return insert_if_absent(star.dim_customer(staged), before, ["customer_id"])


def _streamed_house(house: Warehouse) -> Warehouse:
    """A warehouse that streams filled in two parts, with a refresh and a restart between.

    Half of the items of every order come in either part.
    """
    spark = house.spark
    layouts = schema.table_schemas(schema.TEXT, retail.MONEY)
    root, files, progress = (scratch_path(spark, n) for n in ("streamed", "files", "progress"))
    incremental.empty_warehouse(spark, root, layouts)
    staged = house.table("stg_orders")
    half = F.pmod(F.xxhash64("order_item_id"), F.lit(2))
    for part in range(2):
        staged.filter(half == part).write.mode("append").parquet(files, compression=CODEC)
        target = Warehouse.open(spark, root)
        incremental.stream_into(
            target, files, layouts["stg_orders"], progress
        ).awaitTermination()
        target = incremental.refresh_orders(Warehouse.open(spark, root))
    return target


def _summary(house: Warehouse) -> DataFrame:
    """The summary of orders, added up over the buckets of the order table."""
    kept = house.table(schema.SUMMARY)
    return kept.groupBy(
        "part", "has_order", "geography_id", "shipping_mode_id", "shipping_date_id",
        F.col("value_bin").cast("bigint").alias("value_bin"), "late_delivery_risk",
    ).agg(*[F.sum(c).alias(c) for c in ["n", "sum_real", "n_real", "sum_sched", "n_sched"]])


def _written_csv(house: Warehouse) -> str:
    """Staging rows as the raw CSV; some names hold quotes, commas and line breaks."""
    path = scratch_path(house.spark, "csv")
    odd = F.concat(F.col("product_name"), F.lit('\n"odd", name'))
    csv_files.write_csv(house.table("stg_orders").withColumn(
        "product_name", F.when(F.col("order_id") % 10 == 0, odd).otherwise(F.col("product_name"))
    ), path)
    return path


def _from_csv(house: Warehouse) -> DataFrame:
    """Staging rows written as the raw CSV and loaded again."""
    layout = schema.staging_schema(schema.TEXT, retail.MONEY)
    return csv_files.load_csv(house.spark, _written_csv(house), schema=layout)


def _csv_report(house: Warehouse) -> DataFrame:
    """What typing loses in a file with texts, long decimals and bad dates."""
    raw = csv_files.read_csv(house.spark, _written_csv(house))
    sales, day = (csv_files.HEADERS[c] for c in ("sales", "order_date"))
    number = F.col(csv_files.HEADERS["order_id"]).cast("long")
    spoiled = raw.withColumn(
        sales, F.when(number % 7 == 0, "n/a").when(number % 7 == 1, "1.005").otherwise(F.col(sales))
    ).withColumn(day, F.when(number % 5 == 0, "2018-01-31").otherwise(F.col(day)))
    return csv_files.load_report(
        spoiled, schema=schema.staging_schema(schema.TEXT, retail.MONEY)
    )


def _date_formats(house: Warehouse) -> DataFrame:
    """What the values of two date columns tell about their patterns: one mixes ISO days
    with times of day, the other is day-first."""
    raw = csv_files.read_csv(house.spark, _written_csv(house))
    ordered, shipped = (csv_files.HEADERS[c] for c in ("order_date", "shipping_date"))
    number = F.col(csv_files.HEADERS["order_id"]).cast("long")

    def rewritten(column: str, pattern: str):
        return F.date_format(csv_files.parse_day(F.col(column), csv_files.DATE_PATTERN), pattern)

    mixed = raw.withColumn(ordered, F.when(
        number % 5 == 0, rewritten(ordered, "yyyy-MM-dd")).otherwise(F.col(ordered))
    ).withColumn(shipped, rewritten(shipped, "d/M/yyyy"))
    return date_formats.format_report(mixed, [ordered, shipped])


def _redelivered(house: Warehouse) -> DataFrame:
    """Items without a key, in a batch that is delivered twice: counted by order."""
    spark = house.spark
    layouts = schema.table_schemas(schema.TEXT, retail.MONEY)
    root = scratch_path(spark, "redelivered")
    incremental.empty_warehouse(spark, root, layouts)
    keyless = house.table("stg_orders").withColumn("order_item_id", F.lit(None).cast("string"))
    for _ in range(2):
        incremental.load_batch(Warehouse.open(spark, root), keyless, "delivery", 0)
    loaded = Warehouse.open(spark, root).table("fact_order_items")
    return loaded.groupBy("order_id").agg(F.count("*").alias("n_items"))


def _score_stream(house: Warehouse) -> DataFrame:
    """Orders scored by a stream in two parts with a restart, beside their batch scores."""
    spark = house.spark
    features = materialize(ml.training_features(house), "features")
    path, files, progress = (scratch_path(spark, n) for n in ("model", "orders", "progress"))
    ml.fit(features, ml.logistic(features.count()), ml.VERSIONS["A"]).write().save(path)
    model = ml.load_model(path)
    root = scratch_path(spark, "scores")
    target = Warehouse(spark, root)
    target.write(scoring.SCORED, ml.with_band(ml.score(model, features.limit(0))))
    target.publish()
    half = F.pmod(F.xxhash64("order_id"), F.lit(2))
    for part in (0, 1):
        features.filter(half == part).write.mode("append").parquet(files)
        for _ in range(2):  # the second start finds nothing new
            scoring.stream_scores(
                Warehouse.open(spark, root), model, files, features.schema, progress
            ).awaitTermination()
    streamed = Warehouse.open(spark, root).table(scoring.SCORED)
    batch = ml.with_band(ml.score(model, features)).select(
        F.col("order_id"), F.col("score").alias("_score"), F.col("risk_band").alias("_band")
    )
    return streamed.join(batch, "order_id").select(
        "order_id", (F.abs(F.col("score") - F.col("_score")) < 1e-12).alias("same_score"),
        (F.col("risk_band") == F.col("_band")).alias("same_band"),
    )


def _score_equations(house: Warehouse) -> DataFrame:
    """Late orders by level, observed and as the fitted logit expects them."""
    factors = ["shipping_mode", "order_region"]
    orders = materialize(stats.order_features(house), "orders")
    fitted = stats.logit(orders, factors, [])
    equations = es.score_equations(orders, fitted, factors, [], stats.LABEL)
    return _rounded(equations, 2, "observed", "expected")


def _positions(sorted_rows: DataFrame) -> DataFrame:
    """Number the rows of a sorted result as they come."""
    placed = sorted_rows.withColumn("_at", F.monotonically_increasing_id())
    return placed.withColumn(
        "position", F.row_number().over(Window.orderBy("_at")).cast("bigint")
    ).drop("_at")


def _logit_mode(house: Warehouse) -> DataFrame:
    fitted = stats.logit(stats.order_features(house), ["shipping_mode"], [])
    return _rounded(fitted.select(
        "term", "coefficient", "std_error", "log_likelihood", "null_log_likelihood", "pseudo_r2"
    ), 4, "coefficient", "std_error", "log_likelihood", "null_log_likelihood", "pseudo_r2")


def _split_counts(house: Warehouse) -> DataFrame:
    parts = stratified_split(stats.order_features(house), stats.LABEL, ["order_id"])
    return parts.groupBy(stats.LABEL, "part").agg(
        F.count("*").alias("n_orders"), F.sum("order_id").alias("sum_order_id")
    )


def _welch(house: Warehouse) -> DataFrame:
    tested = stats.welch(stats.order_features(house)).drop("p_value")
    return _rounded(_rounded(tested, 4, "mean_late", "mean_on_time", "dof"), 6, "t")


def _chi_square(variable: str) -> Callable[[Warehouse], DataFrame]:
    def query(house: Warehouse) -> DataFrame:
        tested = stats.chi_square_of_orders(house, variable)
        return _rounded(tested.drop("p_value"), 6, "chi2")

    return query


def _test_p_values(house: Warehouse) -> DataFrame:
    """The p-values of all three tests."""
    tests = [
        stats.chi_square_of_orders(house, v).select("variable", "p_value")
        for v in ["shipping_mode", "order_region"]
    ]
    value = stats.welch(stats.order_features(house)).select(F.lit("total_sales").alias("variable"), "p_value")
    return _rounded(tests[0].unionByName(tests[1]).unionByName(value), 6, "p_value")


def _scored(house: Warehouse) -> DataFrame:
    """Orders scored by a model that was fitted, saved and loaded again."""
    path = scratch_path(house.spark, "model")
    features = materialize(ml.training_features(house), "features")
    ml.train_final(features, path)
    model = ml.load_model(path)
    return ml.with_band(ml.score(model, features)).select("order_id", "score", "risk_band")


def _held_out(model: str) -> Callable[[Warehouse], DataFrame]:
    return lambda house: ml.held_out_quality(
        ml.training_features(house), versions=["A"], models=[model]
    )


def _logistic_balance(house: Warehouse) -> DataFrame:
    """Orders, late ones and the mean score of the training part.

    The intercept is not penalized, so its score equation makes the mean score the
    late rate.
    """
    parts = stratified_split(ml.training_features(house), stats.LABEL, ["order_id"])
    train = materialize(parts.filter("part = 'train'"), "train")
    model = ml.fit(train, ml.logistic(train.count()), ml.VERSIONS["A"])
    return _rounded(ml.score(model, train).agg(
        F.count("*").alias("n_orders"), F.sum(stats.LABEL).alias("n_late"),
        F.avg("score").alias("mean_score"),
    ), 3, "mean_score")


def _line_keys(spark: SparkSession, folder: str) -> DataFrame:
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return dq.key_report(lines, ["l_orderkey", "l_linenumber"], "lineitem")


def _orders_without_lines(spark: SparkSession, folder: str) -> DataFrame:
    orders, lines = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("orders", "lineitem"))
    return dq.reference_report(orders, "o_orderkey", lines, "l_orderkey", "o_orderkey")


def _line_constancy(spark: SparkSession, folder: str) -> DataFrame:
    """The constancy check on columns that do vary within orders."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    flags = dq.varying_fields(lines, "l_orderkey", ["l_returnflag", "l_linestatus"])
    return flags.agg(
        F.count("*").alias("n_orders"),
        F.count_if("l_returnflag").alias("n_varying_returnflag"),
        F.count_if("l_linestatus").alias("n_varying_linestatus"),
    )


# Queries over the warehouse of the given tables.
MODEL_QUERIES: dict[str, Callable[[Warehouse], DataFrame]] = {
    "stg_orders": lambda w: w.table("stg_orders"),
    "dim_customer": lambda w: w.table("dim_customer"),
    "dim_product": lambda w: w.table("dim_product"),
    "dim_geography": lambda w: w.table("dim_geography"),
    "dim_shipping_mode": lambda w: w.table("dim_shipping_mode"),
    "dim_date": lambda w: w.table("dim_date"),
    "fact_order_items": lambda w: w.table("fact_order_items"),
    "v_orders": lambda w: star.v_orders(w.table("order_grain")),
    "csv_ingest": _from_csv,
    "csv_load_report": _csv_report,
    "date_format_report": _date_formats,
    "late_rate_by_region": dg.late_rate_by_region,
    "late_rate_by_region_in_order": lambda w: _positions(dg.late_rate_by_region(w)),
    "late_rate_by_order_value_in_order": lambda w: _positions(
        dg.late_rate_by_order_value(w, VALUE_LIMITS)
    ),
    "distinct_regions_in_order": lambda w: _positions(dg.distinct_regions(w)),
    "worst_departments": lambda w: dg.worst_categories(
        w, WORST_ITEMS, level="department_name"
    ),
    "late_rate_by_mode": dg.late_rate_by_mode,
    "late_rate_region_mode": dg.late_rate_region_mode,
    "avg_order_value_region_mode": dg.avg_order_value_region_mode,
    "late_rate_by_order_value": lambda w: dg.late_rate_by_order_value(w, VALUE_LIMITS),
    "worst_categories": dg.worst_categories,
    "late_rate_by_ship_weekday": dg.late_rate_by_ship_weekday,
    "actual_vs_scheduled_by_mode": dg.actual_vs_scheduled_by_mode,
    "late_rate_selected_regions": lambda w: dg.late_rate_selected_regions(w, REGIONS),
    "region_mode_stats": dg.region_mode_stats,
    "region_mode_table": lambda w: dg.region_mode_table(w, REGIONS),
    "late_rate_pivot": dg.late_rate_pivot,
    "overall_late_rate": dg.overall_late_rate,
    "distinct_regions": dg.distinct_regions,
    "distinct_modes": dg.distinct_modes,
    "dq_fact_pk": dq.primary_keys,
    "dq_dim_unique": dq.natural_keys,
    "dq_foreign_keys": dq.foreign_keys,
    "dq_order_constancy": dq.order_constancy,
    "insert_if_absent_customer": _grown_customers,
    "incremental_load": lambda w: ml.training_features(_streamed_house(w)),
    "late_rates_after_load": lambda w: dg.late_rate_region_mode(_streamed_house(w)),
    "order_summary": _summary,
    "redelivered_batch": _redelivered,
    "order_features": stats.order_features,
    "training_features": ml.training_features,
    "chi_square_mode": _chi_square("shipping_mode"),
    "chi_square_region": _chi_square("order_region"),
    "welch_order_value": _welch,
    "test_p_values": _test_p_values,
    "logit_mode": _logit_mode,
    "logit_coefficients": lambda w: stats.logit(stats.order_features(w)),
    "stratified_split_counts": _split_counts,
    "late_rate_shrunk": lambda w: _rounded(
        _shrunk(w), 9, "global_rate", "late_rate_adjusted"
    ),
    "shrinkage_shift_top": lambda w: _rounded(
        sh.largest_shifts(_shrunk(w), ["order_region", "shipping_mode"]), 9,
        "late_rate_adjusted", "shift",
    ),
    "baseline_expected_late": lambda w: _rounded(
        sh.baseline(_shrunk(w)), 6, "baseline_late", "baseline_late_adjusted"
    ),
    "score_counts": _cell_scores,
    "roc_auc": lambda w: _rounded(ev.roc_auc(_cell_scores(w)), 9, "roc_auc"),
    "pr_auc": lambda w: _rounded(ev.pr_auc(_cell_scores(w)), 9, "pr_auc"),
    "pr_curve": lambda w: ev.pr_curve(_cell_scores(w)),
    "classification_report": lambda w: _rounded(
        ev.classification_report(_cell_scores(w)), 9, "precision", "recall", "f1_score"
    ),
    "risk_bands": lambda w: ev.risk_bands(_cell_scores(w)),
    "allocation_by_budget": _by_budget("market", BUDGETS),
    "allocation_plan": lambda w: al.assignment(_allocated(w, "market", BUDGETS)),
    "allocation_sweep": _by_budget("market", SWEEP),
    "allocation_by_region": _by_budget("order_region", BUDGETS),
    "allocation_per_market": _by_market_and_region,
    "allocation_large": _allocation_large,
    "logistic_balance": _logistic_balance,
    "logistic_metrics": _held_out("logistic"),
    "gbt_metrics": _held_out("gbt"),
    "model_comparison": lambda w: ml.held_out_quality(ml.training_features(w)),
    "score_orders": _scored,
    "score_stream": _score_stream,
    "logit_score_equations": _score_equations,
}

# Queries over single given tables.
TABLE_QUERIES: dict[str, Query] = {
    "profile_orders": lambda spark, folder: dq.profile(
        spark.read.parquet(f"{folder}/orders.parquet")
    ),
    "dq_line_keys": _line_keys,
    "dq_orders_without_lines": _orders_without_lines,
    "dq_line_constancy": _line_constancy,
}


def entry(spark: SparkSession) -> DataFrame:
    """Late-delivery rate by region and shipping mode, at order grain."""
    return dg.late_rate_region_mode(warehouse_for(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Query]:
    """Every registered query by name."""
    def over_model(query: Callable[[Warehouse], DataFrame]) -> Query:
        return lambda spark, folder: query(warehouse_for(spark, folder))

    return {
        **{k: over_model(q) for k, q in MODEL_QUERIES.items()}, **TABLE_QUERIES,
        **EXTRA_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    """SQL for every query whose result SQL can state."""
    return {**oracle.STATEMENTS, **EXTRA_SQL}
