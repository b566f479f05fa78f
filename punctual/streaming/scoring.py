"""Scores of a stream of orders, into the warehouse."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from punctual.plans import model as ml
from punctual.sources.warehouse import Conflict, Warehouse

SCORED = "scored_orders"
TRIES = 5


def score_batch(
    house: Warehouse, model: PipelineModel, rows: DataFrame, source: str, number: int
) -> None:
    """Append the scores and bands of a batch, and publish them with its number.

    A batch whose number is published already adds nothing.
    """
    for _ in range(TRIES):
        if house.ledger.get(source, -1) >= number:
            return
        house.append(SCORED, ml.with_band(ml.score(model, rows)))
        house.note_batch(source, number)
        try:
            house.publish()
            return
        except Conflict:
            house.reload()
    raise Conflict(f"others published to {house.root} during {TRIES} batches of scores")


def stream_scores(
    house: Warehouse,
    model: PipelineModel,
    folder: str,
    layout: T.StructType,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Score the files of ``folder`` in micro-batches until none is left.

    Started again with the same checkpoint, it goes on with the files that came since.
    """
    source = (
        house.spark.readStream.schema(layout)
        .option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    )
    return (
        source.writeStream.foreachBatch(
            lambda rows, number: score_batch(house, model, rows, checkpoint, number)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
