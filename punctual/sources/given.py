"""The warehouse of a folder of given tables, built once per session and content."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from punctual.plans.star import build
from punctual.session import dropped_shuffles, dropped_tables, scratch_path, sized_shuffles
from punctual.sources.retail import TABLES, read_tables, staging_from_tables
from punctual.sources.warehouse import Warehouse

# A byte of the given tables becomes so many in the joins, whose rows are wide: with fewer
# partitions their sorts spill.
WIDENING = 16

_built: dict[tuple, Warehouse] = {}


def _content(spark: SparkSession, folder: str) -> tuple:
    """Path, size and last change of every input file; lists them, reads nothing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(
        [f"{folder}/{t}.parquet" for t in TABLES]
    )
    listed = F.struct("path", "length", "modificationTime").cast("string")
    seen = files.agg(
        F.sum("length"), F.sum(F.xxhash64(listed).cast("decimal(38,0)")),
        F.sum(F.xxhash64(F.lit(1), listed).cast("decimal(38,0)")), F.count("*"),
    )
    return tuple(seen.first())


def warehouse_for(spark: SparkSession, folder: str) -> Warehouse:
    """Load the tables of ``folder`` into a warehouse below the shared scratch folder.

    The order-grain shuffle is then paid once and not by every question.
    """
    content = _content(spark, folder)
    key = (spark.sparkContext.applicationId, folder, content)
    if key not in _built:
        sized = sized_shuffles(spark, WIDENING * (content[0] or 0))
        with sized, dropped_shuffles(spark), dropped_tables(spark):
            staging = staging_from_tables(read_tables(spark, folder))
            _built[key] = build(spark, staging, scratch_path(spark, "warehouse"))
    return _built[key]
