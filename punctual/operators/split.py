"""Exact stratified split in parallel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctual.session import materialize

# Four hexadecimal digits: at most 65,536 counts per label meet in one task, and about
# one row in 65,536 is ranked.
PREFIX_DIGITS = 4


def stratified_split(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    train: float = 0.8,
    seed: int = 42,
) -> DataFrame:
    """Add ``part``: 'train' for the first ``train`` share of each label, else 'test'.

    Rows are ordered within a label by a digest of the key and the seed, which does
    not depend on partitions or engine. ``keys`` must identify a row.

    No label is sorted and no row is shuffled. Counts by digest prefix tell in which
    prefix the cut of a label falls; only the rows of that prefix are ranked, which
    gives the last training row. Every row is then compared with it.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys],
                               F.lit(str(seed))))
    marked = df.withColumns({
        "_stratum": F.coalesce(F.col(label).cast("string"), F.lit("")),
        "_place": F.struct(digest.alias("digest"), *keys),
    })
    prefixed = marked.withColumn("_prefix", F.substring("_place.digest", 1, PREFIX_DIGITS))
    counts = prefixed.groupBy("_stratum", "_prefix").agg(F.count("*").alias("_n"))
    running = (
        Window.partitionBy("_stratum").orderBy("_prefix")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    total = F.sum("_n").over(Window.partitionBy("_stratum"))
    # The small addend keeps a product such as 0.7 * 10 from ending below its integer.
    cuts = counts.select(
        "_stratum", "_prefix",
        (F.sum("_n").over(running) - F.col("_n")).alias("_before"),
        F.sum("_n").over(running).alias("_through"),
        F.floor(total * train + 1e-9).alias("_wanted"),
    ).filter("_before < _wanted and _wanted <= _through")
    cuts = materialize(cuts, "cuts")
    rank = F.row_number().over(Window.partitionBy("_stratum").orderBy("_place"))
    ranked = (
        prefixed.select("_stratum", "_prefix", "_place").join(cuts, ["_stratum", "_prefix"])
        .withColumn("_rank", F.col("_before") + rank)
    )
    last = materialize(
        ranked.filter("_rank = _wanted").select("_stratum", F.col("_place").alias("_last")),
        "last",
    )
    # One row per label, small enough to be broadcast by its size.
    part = F.when(F.col("_place") <= F.col("_last"), "train").otherwise("test")
    return marked.join(last, "_stratum", "left").select(*df.columns, part.alias("part"))
