"""What loads and batches leave on disk."""

import os
import time
from concurrent.futures import ThreadPoolExecutor

from punctual.plans import star
from punctual.session import (
    DROPS, dropped_shuffles, dropped_tables, materialize, scratch_path, scratch_root,
)
from punctual.sources.warehouse import Warehouse
from punctual.streaming import incremental


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = disk.getAllFiles().mkString("\n").split("\n")
    return {n for n in names if "shuffle_" in n}


def left(spark, before):
    """Shuffle files that stay; they are removed in the background."""
    for _ in range(50):
        found = shuffle_files(spark) - before
        if not found:
            break
        time.sleep(0.2)
    return found


def scratch_tables(spark):
    return set(os.listdir(scratch_root(spark)))


def mixed_orders(staging):
    """Orders of several items, some of which disagree on a field."""
    return staging(*[
        {"order_id": i // 3, "customer_id": i // 3, "payment_type": "CASH" if i == 5 else "DEBIT"}
        for i in range(30)
    ])


def test_a_build_leaves_no_shuffle_and_no_scratch_table(spark, staging):
    rows = mixed_orders(staging)
    root = scratch_path(spark, "house")
    shuffles, tables = shuffle_files(spark), scratch_tables(spark)
    house = star.build(spark, rows, root)
    assert not left(spark, shuffles)
    assert scratch_tables(spark) - tables == {os.path.basename(root)}
    assert house.table("order_grain").count() == 10
    assert house.table("fact_order_items").count() == 30


def test_a_batch_and_a_refresh_leave_no_shuffle_and_no_scratch_table(spark, staging, house):
    loaded = house({"order_id": 100})
    batch = mixed_orders(staging).filter("order_item_id > 1")  # the house has the first key
    shuffles, tables = shuffle_files(spark), scratch_tables(spark)
    incremental.load_batch(loaded, batch)
    fresh = incremental.refresh_orders(Warehouse.open(spark, loaded.root))
    assert not left(spark, shuffles)
    assert scratch_tables(spark) == tables
    assert fresh.table("order_grain").count() == 11


def test_the_setting_returns_after_the_last_of_several_blocks(spark):
    before = spark.conf.get(DROPS, None)

    def block(seconds):
        with dropped_shuffles(spark, spark):
            time.sleep(seconds)
            return spark.conf.get(DROPS)

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(block, [0.1, 0.5])) == ["true", "true"]
    assert spark.conf.get(DROPS, None) == before


def test_a_block_removes_its_own_tables_only(spark):
    kept = materialize(spark.range(3), "kept")
    with dropped_tables(spark):
        outer = materialize(spark.range(4), "outer")
        with dropped_tables(spark):
            assert materialize(spark.range(5), "inner").count() == 5
        assert not any(n.startswith("inner-") for n in scratch_tables(spark))
        assert outer.count() == 4
    assert kept.count() == 3
    assert not any(n.startswith("outer-") for n in scratch_tables(spark))

