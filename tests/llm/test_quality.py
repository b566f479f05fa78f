import random

from punctual.llm import quality

from tests.llm.conftest import SMALL

LABELS = "doc_id long, quality int, toxic int"


def test_good_documents_stay_and_bad_ones_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = labels.filter("doc_id % 2 = 0")  # the other half is held out
    unseen = {r.doc_id: r.quality for r in labels.filter("doc_id % 2 = 1").collect()}
    out = {r.doc_id: r.selected for r in quality.selection(docs, seen).collect()}
    good = [out[d] for d, q in unseen.items() if q == 1]
    bad = [out[d] for d, q in unseen.items() if q == 0]
    assert sum(good) / len(good) >= 0.97
    assert sum(bad) / len(bad) <= 0.5


def test_held_out_toxic_rows(spark):
    """The weight puts toxic good rows below clean ones but, as README says, k keeps them."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = quality.selection(docs, labels.filter("doc_id % 2 = 0"))
    unseen = out.join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    clean, toxic, bad = (
        [r for r in unseen if (r.quality, r.toxic) == kind] for kind in ((1, 0), (1, 1), (0, 1))
    )
    stay = [sum(r.selected for r in rows) for rows in (clean, toxic, bad)]
    assert (len(clean), len(toxic), len(bad)) == (1546, 195, 36)
    assert stay == [1546, 195, 1]
    above = sum(c.log_weight > t.log_weight for c in clean for t in toxic)
    assert above >= 0.75 * len(clean) * len(toxic)


def test_k_rows_with_the_largest_keys(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    out = sorted(quality.selection(docs, labels, share=0.4).collect(), key=lambda r: -r.key)
    # Equal rows tie; none other does here.
    assert [r.selected for r in out] == [i < 80 for i in range(200)]
    kept = quality.selected_documents(docs, labels, share=0.4)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in out if r.selected}
    again = quality.selection(docs.repartition(5), labels, share=0.4).collect()
    assert {r.doc_id for r in again if r.selected} == {r.doc_id for r in out if r.selected}


def test_noise_is_gumbel(spark, documents):
    """Texts without n-grams have weight 0, so their keys are the noise."""
    rows = [(i, "") for i in range(4000)]
    out = quality.selection(documents(rows), spark.createDataFrame([], LABELS)).collect()
    mean = sum(r.key for r in out) / len(out)
    assert abs(mean - 0.5772) < 0.06
    assert all(r.log_weight == 0 for r in out)


def test_odd_rows(spark, documents, odd_rows):
    labels = spark.createDataFrame(
        [(0, 1, 0), (1, 1, None), (2, 0, 0), (None, 1, 0), (3, None, 1), (0, 1, 0)], LABELS
    )
    docs = documents(odd_rows)
    out = quality.selection(docs, labels).collect()
    assert len(out) == len(odd_rows)
    kept = quality.selected_documents(docs, labels).collect()
    assert len(kept) == sum(r.selected for r in out)
    everything = quality.selection(docs, labels, share=1.0).collect()
    assert all(r.selected for r in everything)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], LABELS)
    assert quality.selection(documents([]), none).count() == 0
    assert quality.selected_documents(documents([]), none).count() == 0


def test_target_sample_is_bounded(spark):
    rng = random.Random(0)
    labels = spark.createDataFrame([(i, rng.randint(0, 1), 0) for i in range(500)], LABELS)
    assert quality.target_sample(labels, 50).count() == 50
