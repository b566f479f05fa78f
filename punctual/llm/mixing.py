"""Mixing sources to target weights by capped water-filling.

A source's share of the mix is proportional to its weight, but stops at a largest number
of epochs; what is above is shared again among the others, by weight, until none is
above. A source whose share is r times its size then repeats all its documents as often
as the whole part of r says, and a seeded sample of them once more for the fraction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.llm.cuts import cuts
from punctual.operators.ordered import running_totals
from punctual.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
PLACE_BITS = 48
# Documents per source that may change sides to bring its sum nearer to the target.
CORRECTIONS = 4


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place_of(seed: int, doc_id: Column, text: Column) -> Column:
    """Position of a document in the seeded order, from its id and text alone."""
    digest = F.xxhash64(F.lit(seed), doc_id, F.xxhash64(text))
    return F.shiftrightunsigned(digest, 64 - PLACE_BITS)


def cycled_weights(sizes: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``sizes(source, source_size)`` with ``weights`` in turn, by code point, null last."""
    order = F.struct(F.col("source").isNull(), F.col("source"))
    ranked = running_totals(sizes.withColumn("one", F.lit(1)), order, ["one"])
    which = (F.col("one_before") % len(weights)).cast("int")
    listed = F.array(*[F.lit(float(w)) for w in weights])
    return ranked.select(
        "source", "source_size", F.element_at(listed, which + 1).alias("weight")
    )


def fill(sources: DataFrame, total_share: float, epochs: float) -> DataFrame:
    """Add ``target`` to ``sources(source, source_size, weight)``.

    The targets add up to ``total_share`` times all sizes, unless every source is at
    its limit of ``epochs`` times its size. The common level rises round by round; only
    the sums of a round come to the driver. A weight that is null or not positive
    gives no share.
    """
    sources = sources.withColumn(
        "weight", F.when(F.col("weight") > 0, F.col("weight")).otherwise(F.lit(0.0))
    )
    limit = F.col("source_size") * F.lit(float(epochs))
    level, total = 0.0, None
    while True:
        above = F.col("weight") * F.lit(level) > limit
        everything, clamped, weight = sources.agg(
            F.sum("source_size"), F.sum(F.when(above, limit)),
            F.sum(F.when(~above, F.col("weight"))),
        ).first()
        total = total_share * (everything or 0)
        if not weight:
            break
        higher = (total - (clamped or 0.0)) / weight
        if higher <= level:
            break
        level = higher
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), limit))


def _choices(units: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole repetitions, the last place sampled once more, and exceptions.

    The documents in seeded order are taken as long as the sum stays below the
    fraction's amount; then single documents change sides, each the one that brings the
    sum nearest to it.
    """
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    rated = targets.withColumn("whole", F.floor(F.coalesce(rate, F.lit(0.0))))
    rated = rated.withColumn(
        "wanted", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))
    )
    at = cuts(units, rated.select("grp", "wanted"), PLACE_BITS)
    none = F.array().cast("array<long>")
    plan = materialize(rated.join(at.select(
        "grp",
        (F.col("place") - 1).alias("cut"), F.col("before").alias("sampled"),
    ), "grp", "left").withColumns({
        "cut": F.coalesce("cut", F.lit(-1)), "sampled": F.coalesce("sampled", F.lit(0.0)),
        "changed": none,
    }), "plan")
    for _ in range(CORRECTIONS):
        missing = F.col("wanted") - F.col("sampled")
        chosen = _chosen()
        change = F.when(chosen, -F.col("amount")).otherwise(F.col("amount"))
        best = units.join(plan.filter("wanted > 0"), "grp").filter(
            ~F.array_contains("changed", F.col("place"))
        ).select(
            "grp", "place", change.cast("double").alias("change"),
            F.abs(missing - change).alias("off"), F.abs(missing).alias("was"),
        ).filter("off < was").groupBy("grp").agg(
            F.min(F.struct("off", "place", "change")).alias("best")
        )
        plan = materialize(plan.join(best, "grp", "left").select(
            *[c for c in plan.columns if c not in ("sampled", "changed")],
            (F.col("sampled") + F.coalesce("best.change", F.lit(0.0))).alias("sampled"),
            F.when(F.col("best").isNull(), F.col("changed")).otherwise(
                F.concat("changed", F.array("best.place"))
            ).alias("changed"),
        ), "plan")
    return plan


def _chosen() -> Column:
    """Whether the document at ``place`` is repeated once more than ``whole`` says."""
    return (F.col("place") <= F.col("cut")) != F.array_contains("changed", F.col("place"))


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    total_share: float = 1.5,
    epochs: float = 2.0,
    seed: int = 11,
) -> tuple[DataFrame, DataFrame]:
    """Sizes of the documents and the plan per source, both written once.

    Sizes: ``doc_id``, ``size``, ``place``, ``grp``. Plan: ``grp``, ``source``,
    ``source_size``, ``target``, ``whole``, ``cut``, ``changed`` and more.
    """
    measured = materialize(docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"),
        n_words(F.col("text").cast("string")).alias("size"),
        place_of(seed, F.col("doc_id"), F.col("text").cast("string")).alias("place"),
    ), "sizes")
    # A null and a text are told apart by the prefix.
    grp = F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("source")))
    measured = measured.withColumn("grp", grp)
    sizes = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(
        fill(cycled_weights(sizes, weights), total_share, epochs).withColumn("grp", grp), "targets"
    )
    # Rows that are the same in id and text are one unit.
    units = materialize(
        measured.groupBy("grp", "place").agg(F.sum("size").alias("amount")), "units"
    )
    return measured, _choices(units, targets)


def mix(docs: DataFrame, **options) -> DataFrame:
    """How often the mix takes each row of ``docs(doc_id, text, source)``.

    Columns: ``doc_id``, ``size`` (words of the text), ``source_size``, ``target`` (of
    its source) and ``taken`` (words the mix takes, repetitions counted).

    A null text has size 0 and is taken 0 times its size; a null source is a source of
    its own, the last one. Rows that are the same in id and text are sampled together.
    An empty table gives an empty result; further columns are ignored. The same rows
    give the same result in every run and partitioning.
    """
    measured, plan = plan_mix(docs, **options)
    joined = measured.drop("source").join(plan, "grp")
    times = F.col("whole") + _chosen().cast("long")
    return joined.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken")
    )


def mixed_documents(docs: DataFrame, seed: int = 11, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, all columns kept.

    A row without words is kept once when its source has a share. Texts are not
    shuffled: a row finds its repetitions by its source, id and text.
    """
    _, plan = plan_mix(docs, seed=seed, **options)
    held = docs.select(
        F.struct("*").alias("row"),
        F.when(F.col("source").isNull(), "-").otherwise(
            F.concat(F.lit("+"), F.col("source").cast("string"))
        ).alias("grp"),
        place_of(seed, F.col("doc_id"), F.col("text").cast("string")).alias("place"),
    )
    times = (F.col("whole") + _chosen().cast("long")).cast("int")
    return held.join(plan, "grp").withColumn("times", times).filter("times > 0").select(
        "row", F.explode(F.sequence(F.lit(1), F.col("times")))
    ).select("row.*")
