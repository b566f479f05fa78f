import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctual.llm import toxicity

from tests.llm.conftest import SMALL

LABELS = "doc_id long, quality int, toxic int"
CALM = [f"word{i}" for i in range(300)]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def corpus(n=600, seed=2):
    """Half of the documents hold one or two sentences with an insult, or a form of one."""
    rng = random.Random(seed)
    rows, labels, bad = [], [], {}
    for i in range(n):
        sentences = [" ".join(rng.choices(CALM, k=rng.randint(3, 12))) for _ in range(rng.randint(2, 12))]
        toxic = i % 2
        if toxic:
            own = sorted(rng.sample(range(len(sentences)), rng.randint(1, 2)))
            for s in own:
                word = rng.choice(["nastyfool", "VILE", "grimlot" + rng.choice(CALM)])
                sentences[s] += " " + word
            bad[i] = own
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, 1, toxic))
    return rows, labels, bad


def test_held_out_documents_and_their_sentences(spark, documents):
    rows, labels, bad = corpus()
    docs, known = documents(rows), spark.createDataFrame(labels, LABELS)
    out = {r.doc_id: r for r in toxicity.toxicity(docs, known).collect()}
    unseen = [r for r in out.values() if r.held_out]
    assert len(unseen) > 100 and all(held(r.doc_id) == r.held_out for r in out.values())
    right = [r.predicted == r.doc_id % 2 for r in unseen]
    assert sum(right) / len(right) >= 0.97
    model = toxicity.train(docs.filter(~toxicity.held_out(F.col("doc_id"))), known)
    found = toxicity.offending_sentences(docs, model).collect()
    named = {(r.row.doc_id, r.sentence) for r in found if held(r.row.doc_id)}
    true = {(d, s) for d, own in bad.items() if held(d) for s in own}
    assert len(named & true) >= 0.95 * len(true) and len(named - true) <= 0.05 * len(true)
    for r in found:
        assert r.excerpt == r.row.text[r.start : r.stop]


def test_given_documents(spark):
    """Held-out labels of the given tables; the few positives leave wide limits."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.toxicity(docs, labels)
    rows = out.join(labels, "doc_id").filter("held_out").collect()
    toxic = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert sum(toxic) / len(toxic) >= 0.8 and sum(clean) / len(clean) <= 0.03


def test_only_the_text_counts(spark):
    """Neither labels of held-out rows nor other columns change a score."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    first = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    turned = labels.withColumn("toxic", F.when(
        toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.withColumn("source", F.lit("x")).withColumn("lang", F.lit("y")).repartition(5)
    second = {r.doc_id: r.score for r in toxicity.toxicity(other, turned).collect()}
    assert first.keys() == second.keys()
    assert all(abs(first[d] - second[d]) < 1e-9 for d in first)


def test_gradient_is_that_of_the_noisy_or():
    rng = np.random.default_rng(4)
    toxic, plain = np.array([True, False, True, False]), np.array([3, 2, 0, 5])
    bag = np.array([0, 0, 1, 2, 2, 2])
    of, place = np.array([0, 0, 1, 2, 2, 3, 4, 5, 5]), np.array([0, 1, 1, 0, 2, 2, 1, 0, 2])
    weights, bias = rng.normal(size=3), -1.3

    def loss(weights, bias):
        total = 0.0
        for i in range(4):
            clean = (1 - 1 / (1 + np.exp(-bias))) ** plain[i]
            for s in np.flatnonzero(bag == i):
                clean *= 1 - 1 / (1 + np.exp(-bias - weights[place[of == s]].sum()))
            total -= np.log(1 - clean if toxic[i] else clean)
        return total

    gradient, of_bias = toxicity.bag_gradient(toxic, plain, bag, of, place, weights, bias)
    step = 1e-6
    for k in range(3):
        move = step * (np.arange(3) == k)
        slope = (loss(weights + move, bias) - loss(weights - move, bias)) / (2 * step)
        assert gradient[k] == pytest.approx(slope, rel=1e-5, abs=1e-8)
    slope = (loss(weights, bias + step) - loss(weights, bias - step)) / (2 * step)
    assert of_bias == pytest.approx(slope, rel=1e-5)


def plain_score(model, text):
    """Noisy-or over sentences, with features looked up one by one."""
    import re

    import pyarrow as pa

    clean = 1.0
    for sentence in re.split(r"[.!?\n]", text or ""):
        if not re.search(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", sentence):
            continue
        chunk = next(toxicity.text_chunks(pa.array([sentence])))
        found = toxicity._Sentences(toxicity.Terms(), chunk[2], chunk[3])
        value = model.bias + sum(
            model.weights[list(model.features).index(f)] for f in set(found.features.tolist())
            if f in model.features
        )
        clean *= 1 - 1 / (1 + np.exp(-value))
    return 1 - clean


def test_scores_equal_a_plain_version(spark, documents, odd_rows):
    rows, labels, _ = corpus(200)
    model = toxicity.train(documents(rows), spark.createDataFrame(labels, LABELS))
    assert len(model.features)
    few = [(r[0], r[1]) for r in odd_rows if len(r[1] or "") < 5000] + rows[:30]
    for r in toxicity.scored(documents(few), model).collect():
        assert r.score == pytest.approx(plain_score(model, r.row.text), abs=1e-9)


def test_odd_rows(spark, documents, odd_rows):
    labels = spark.createDataFrame(
        [(0, 1, 1), (0, 1, 0), (None, 1, 1), (1, 1, 0), (2, 0, None), (22, 1, 1), (99, 1, 1)], LABELS
    )
    docs = documents(odd_rows)
    out = toxicity.toxicity(docs, labels).collect()
    assert sorted(repr(r.doc_id) for r in out) == sorted(repr(r[0]) for r in odd_rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    assert all(r.score == 0 for r in out if r.doc_id in (20, 21, 22))
    assert all(r.held_out == held(r.doc_id) for r in out)
    none = spark.createDataFrame([], LABELS)
    assert len(toxicity.toxicity(docs, none).collect()) == len(odd_rows)
    assert toxicity.toxicity(documents([]), labels).count() == 0
    model = toxicity.train(docs, labels)
    assert set(toxicity.scored(docs, model).select("row.*").columns) == set(docs.columns)
