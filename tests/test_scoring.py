from pyspark.sql import functions as F

from punctual.plans import model as ml
from punctual.session import scratch_path
from punctual.sources.warehouse import Warehouse
from punctual.streaming import scoring


def test_streamed_scores_equal_batch_scores(spark, given):
    features = ml.training_features(given).filter("order_id < 1500")
    model = ml.fit(features, ml.logistic(300), ml.VERSIONS["A"])
    files, progress, root = (scratch_path(spark, n) for n in ("files", "progress", "scores"))
    target = Warehouse(spark, root)
    target.write(scoring.SCORED, ml.with_band(ml.score(model, features.limit(0))))
    target.publish()
    features.filter("order_id % 2 = 0").write.parquet(files)
    for _ in range(2):  # nothing is scored twice
        scoring.stream_scores(
            Warehouse.open(spark, root), model, files, features.schema, progress).awaitTermination()
    half = Warehouse.open(spark, root)
    assert half.table(scoring.SCORED).count() == features.filter("order_id % 2 = 0").count()
    # The same batch again, as after a failure behind the publishing.
    scoring.score_batch(half, model, features.filter("order_id % 2 = 0"), progress, 0)
    features.filter("order_id % 2 = 1").write.mode("append").parquet(files)
    scoring.stream_scores(
        Warehouse.open(spark, root), model, files, features.schema, progress).awaitTermination()
    got = Warehouse.open(spark, root).table(scoring.SCORED)
    wanted = ml.with_band(ml.score(model, features))
    columns = ["order_id", F.round("score", 9), "risk_band"]
    assert got.select(*columns).exceptAll(wanted.select(*columns)).count() == 0
    assert got.count() == wanted.count()


def test_a_batch_that_breaks_off_publishes_no_score(spark, given, monkeypatch):
    features = ml.training_features(given).filter("order_id < 400")
    model = ml.fit(features, ml.logistic(300), ml.VERSIONS["A"])
    target = Warehouse(spark, scratch_path(spark, "scores"))
    target.write(scoring.SCORED, ml.with_band(ml.score(model, features.limit(0))))
    target.publish()
    publish = Warehouse.publish
    monkeypatch.setattr(Warehouse, "publish", lambda self: 1 / 0)
    try:
        scoring.score_batch(Warehouse.open(spark, target.root), model, features, "s", 0)
    except ZeroDivisionError:
        pass
    monkeypatch.setattr(Warehouse, "publish", publish)
    again = Warehouse.open(spark, target.root)
    assert again.table(scoring.SCORED).count() == 0
    scoring.score_batch(again, model, features, "s", 0)
    assert Warehouse.open(spark, target.root).table(scoring.SCORED).count() == features.count()
