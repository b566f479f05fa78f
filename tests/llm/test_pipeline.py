import importlib.util
import sys
from collections import Counter
from pathlib import Path

import pytest

from tests.llm.conftest import words
from tests.llm.test_lines import expected as plain_lines
from tests.llm.test_minhash import brute_force

TOP = Path(__file__).resolve().parents[2]
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pipeline():
    spec = importlib.util.spec_from_file_location("corpus_pipeline", TOP / "corpus_pipeline.py")
    module = importlib.util.module_from_spec(spec)
    sys.modules["corpus_pipeline"] = module
    spec.loader.exec_module(module)
    return module


@pytest.fixture(scope="module")
def steps(spark, pipeline):
    from punctual.session import materialize

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], FOLDER), name))
    return out


def test_stages_return_documents(steps):
    for step in steps[1:-1]:
        assert step.dtypes == steps[0].dtypes


def test_quality_keeps_good_documents(spark, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in steps[1].collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in good) >= 0.97 * len(good)
    assert len(kept) < steps[0].count()


def test_lines_equal_a_plain_pass(steps):
    rows = sorted((r.doc_id, r.text) for r in steps[1].collect())
    want = {d: text for d, (_, n, text) in plain_lines(rows).items() if not n or text.strip()}
    assert {r.doc_id: r.text for r in steps[2].collect()} == want
    assert all(r.n_chars == len(r.text) for r in steps[2].collect())


def test_one_of_each_group_stays(steps):
    rows = sorted((r.doc_id, r.text) for r in steps[2].collect())
    _, root = brute_force(rows, 5, 80)
    assert {r.doc_id for r in steps[3].collect()} == {rows[i][0] for i in root if root[i] == i}


def test_mix_takes_whole_documents(steps):
    before = {r.doc_id: len(words(r.text)) for r in steps[3].collect()}
    times = Counter(r.doc_id for r in steps[4].collect())
    assert set(times) <= set(before) and max(times.values()) <= 2
    total = sum(n * before[d] for d, n in times.items())
    assert total == pytest.approx(1.5 * sum(before.values()), rel=0.05)


def test_packing_holds_all_documents(steps):
    times = Counter(r.doc_id for r in steps[4].collect())
    ends = Counter(r.doc_id for r in steps[5].collect() if r.start + r.length == r.doc_tokens)
    assert ends == times


def test_run_gives_the_last_stage(spark, pipeline, steps):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    out = pipeline.run(spark, FOLDER).select(columns).collect()
    assert Counter(out) == Counter(steps[-1].select(columns).collect())


def test_odd_rows(spark, pipeline, documents, odd_rows):
    docs = documents(odd_rows)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() > 0


def test_empty_documents(spark, pipeline, documents):
    docs = documents([])
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() == 0
