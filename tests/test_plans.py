"""Physical plans: what reaches the scan, and what must not appear."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from punctual.plans import diagnose as dg
from punctual.plans import quality, star
from punctual.sources import retail

FOLDER = "/root/testdata/sf0.001"
# Iterative fits and streams have run before their result is planned.
EAGER = {
    "incremental_load", "logistic_metrics", "gbt_metrics", "model_comparison",
    "score_orders", "logit_coefficients", "logit_mode", "logistic_balance",
}


NAMES = {**registry.MODEL_QUERIES, **registry.TABLE_QUERIES}


def plan(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def read_schemas(df):
    return re.findall(r"ReadSchema: struct<([^\n]*)>", plan(df))


@pytest.mark.parametrize("name", sorted(set(NAMES) - EAGER))
def test_no_crossed_tables_and_no_row_functions(spark, name):
    text = plan(registry.queries()[name](spark, FOLDER), "simple")
    for bad in ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"]:
        assert bad not in text


def test_questions_read_only_their_columns(given):
    (orders, modes) = sorted(read_schemas(dg.late_rate_by_mode(given)), key=len, reverse=True)[:2]
    assert {c.split(":")[0] for c in orders.split(",")} == {
        "shipping_mode_id", "late_delivery_risk"}
    assert {c.split(":")[0] for c in modes.split(",")} == {"shipping_mode_id", "shipping_mode"}


def test_region_filter_reaches_the_scan(given):
    text = plan(dg.late_rate_selected_regions(given, ["NATION_0", "NATION_7"]))
    assert re.search(r"PushedFilters: \[.*In\(order_region, \[NATION_0,NATION_7\]\)", text)


def test_orders_are_shuffled_once_as_partial_rows(given):
    fields = ["geography_id", "order_status", "payment_type"]
    text = plan(star.order_versions(given.table("fact_order_items"), fields), "simple")
    assert text.count("Exchange hashpartitioning(order_id") == 1
    assert text.count("Exchange") == 1
    assert "partial_sum" in text and "SortAggregate" not in text


def test_the_constancy_check_does_not_sort_the_fact(given):
    text = plan(quality.varying_fields(given.table("fact_order_items")), "simple")
    assert text.count("Exchange") == 1 and "SortAggregate" not in text


def test_counting_comes_before_the_dimension_joins(given):
    text = plan(dg.late_rate_region_mode(given), "simple")
    # Read bottom-up: the partial count lies below the joins.
    assert text.rindex("partial_count") > text.rindex("HashJoin")


def test_top_list_needs_no_full_sort(given):
    assert "TakeOrderedAndProject" in plan(dg.worst_categories(given), "simple")


def test_lines_are_shuffled_as_raw_columns(spark):
    text = plan(retail.staging_from_tables(retail.read_tables(spark, FOLDER)), "simple")
    # The text key is made after the last exchange.
    assert text.index("concat_ws") < text.index("Exchange")
    assert text.count("concat_ws(-") == 1


def test_nothing_is_read_for_listing_dimensions_but_the_dimension(given):
    assert len(read_schemas(dg.distinct_regions(given))) == 1


def test_a_key_is_one_row_of_its_filter(spark):
    from punctual.operators import key_filter

    keys = spark.range(500).select(F.col("id").cast("string").alias("k"))
    filters = key_filter.filter_rows(keys, "k", "here", 2)
    assert "Generate" not in plan(filters, "simple")
    # All bits of a key are in one word.
    words = keys.select(key_filter._positions("k", F.lit(94)).alias("p")).select(
        F.size("p").alias("n"), F.size(F.array_distinct("p")).alias("bits"),
        F.size(F.array_distinct(F.transform("p", lambda x: F.shiftright(x, 6)))).alias("words"),
    ).distinct().collect()
    assert [tuple(r) for r in words] == [(key_filter.HASHES, key_filter.HASHES, 1)]
