import math
import random

import numpy as np
import pytest
from punctual.llm import binary_codes, projections
from pyspark.sql import functions as F

from tests.llm.conftest import SMALL
from tests.llm.test_minhash import groups

LAYOUT = "vec_id long, embedding array<double>, label int, row string, grp string, n_links string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], LAYOUT)


def sound(vector):
    return (vector is not None and len(vector) and any(vector)
            and all(x is not None and math.isfinite(x) for x in vector))


@pytest.fixture(scope="module")
def odd_vectors():
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(16).tolist(), i % 2) for i in range(60)]
    centre = rng.standard_normal(16)
    for i in range(100, 420):  # a large group of near copies around one vector
        rows.append((i, (centre + rng.normal(0, 0.12, 16)).tolist(), 1))
    rows += [(500, None, 1), (501, [0.0] * 16, 1), (502, [], 1), (503, [float("nan")] * 16, 1),
             (504, [float("inf")] + [1.0] * 15, 1), (505, [None] + [1.0] * 15, 1),
             (506, centre.tolist(), None), (None, centre.tolist(), 1), (None, centre.tolist(), 1),
             (507, (centre * 7).tolist(), 0), (100, rows[60][1], 1), (100, rows[60][1], 1)]
    random.Random(1).shuffle(rows)
    return rows


def link_brute_force(rows, similarity=0.98):
    links = []
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][2] is not None and rows[a][2] == rows[b][2]:
                x, y = rows[a][1], rows[b][1]
                if sound(x) and sound(y) and len(x) == len(y):
                    x, y = np.array(x), np.array(y)
                    if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= similarity:
                        links.append((a, b))
    root = groups(links, range(len(rows)))
    out = []
    for i, (vec_id, *_) in enumerate(rows):
        ids = [rows[j][0] for j in root if root[j] == root[i] and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((vec_id, sum(i in x for x in links), least, vec_id == least))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x) for x in r))


def test_links_equal_those_of_all_pairs(spark, odd_vectors):
    out = binary_codes.near_vectors(table(spark, odd_vectors)).collect()
    assert order(out) == order(link_brute_force(odd_vectors))


def test_large_buckets_are_compared_in_blocks(spark, odd_vectors, monkeypatch):
    monkeypatch.setattr(binary_codes, "BLOCK_ROWS", 16)
    monkeypatch.setattr(binary_codes, "PAIRS", 50)
    out = binary_codes.near_vectors(table(spark, odd_vectors)).collect()
    assert order(out) == order(link_brute_force(odd_vectors))


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = x + rng.normal(0, 0.05, x.shape)
    y /= np.linalg.norm(y, axis=1)[:, None]
    turn = binary_codes.rotations(64, 1, binary_codes.SEED)
    a, b = x @ turn.T, y @ turn.T
    signs = np.where(a > 0, 1, -1) / 8
    factor = (signs * a).sum(axis=1)
    estimate, exact = (signs * b).sum(axis=1) / factor, (x * y).sum(axis=1)
    assert abs((estimate - exact).mean()) < 0.01
    bound = binary_codes.SIGMAS * np.sqrt((1 - factor**2) / 63) / factor
    assert (np.abs(estimate - exact) <= bound).all()


@pytest.mark.parametrize("most", [2, 1000, 10**9])
def test_tables_meet_the_recall(most):
    bits, tables = binary_codes.plan_tables(0.98, most)
    assert 2**bits >= min(most, 2**28)
    agree = (1 - math.acos(0.98) / math.pi) ** bits
    assert (1 - agree) ** tables <= binary_codes.MISSED


def test_no_vectors(spark):
    assert binary_codes.near_vectors(table(spark, [])).count() == 0
    assert projections.nearest(table(spark, []), F.col("vec_id") % 2 == 0).count() == 0


def nearest_brute_force(rows, k, step):
    stored = [(i, v, np.array(x)) for i, (v, x, _) in enumerate(rows) if sound(x)]
    out = {}
    for i, vec_id, x in stored:
        if vec_id is not None and vec_id % step == 0:
            scored = sorted(
                ((-float(x @ y), w is None, w) for j, w, y in stored if j != i),
            )
            out.setdefault(vec_id, []).append([(w, -s) for s, _, w in scored[:k]])
    return out


def recall(out, rows, k, step):
    expected, got = nearest_brute_force(rows, k, step), {}
    for r in sorted(out, key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(expected)
    hits = total = 0
    for query, lists in expected.items():
        if len(lists) == 1:
            own = got[query]
            assert [r for r, *_ in own] == list(range(1, len(lists[0]) + 1))
            assert own == sorted(own, key=lambda r: (-r[2], r[1] is None, r[1] or 0))
            found = [(v, round(s, 9)) for _, v, s in own]
            hits += sum((v, round(s, 9)) in found for v, s in lists[0])
            total += len(lists[0])
    return hits / total


def test_recall_on_the_given_vectors(spark):
    given = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in given.collect()]
    out = projections.nearest(given, F.col("vec_id") % 20 == 0).collect()
    assert recall(out, rows, 20, 20) >= 0.95


def test_recall_over_many_cells(spark, monkeypatch):
    monkeypatch.setattr(projections, "CELL_ROWS", 64)
    monkeypatch.setattr(projections, "LEAF_ROWS", 8)
    monkeypatch.setattr(projections, "QUERY_ROWS", 16)
    rng = np.random.default_rng(6)
    rows = [(i, (rng.standard_normal(12) * (1 + i % 3)).tolist(), 0) for i in range(700)]
    out = projections.nearest(table(spark, rows), F.col("vec_id") % 7 == 0, k=10).collect()
    assert recall(out, rows, 10, 7) >= 0.9


def test_odd_vectors(spark, odd_vectors):
    out = projections.nearest(table(spark, odd_vectors), F.col("vec_id") % 20 == 0).collect()
    assert recall(out, odd_vectors, 20, 20) >= 0.9


def test_few_candidates_are_all_returned(spark):
    rows = [(i, [1.0, float(i)], 0) for i in range(5)]
    out = projections.nearest(table(spark, rows), F.col("vec_id") == 0).collect()
    assert [r.vec_id for r in sorted(out, key=lambda r: r["rank"])] == [1, 2, 3, 4]


def test_lengths_are_searched_each_for_itself(spark, monkeypatch):
    monkeypatch.setattr(projections, "CELL_ROWS", 64)
    monkeypatch.setattr(projections, "MOST_GAPS", 16)  # a few queries at a time
    rng = np.random.default_rng(9)
    rows = [(i, rng.standard_normal([3, 8, 8, 8, 8][i % 5]).tolist(), 0) for i in range(500)]
    rows += [(1000, [1.0] * 5, 0)]  # alone: no candidates
    out = projections.nearest(table(spark, rows), F.col("vec_id") % 4 == 0, k=6).collect()
    by_length = {r[0]: len(r[1]) for r in rows}
    assert all(by_length[r.query_id] == by_length[r.vec_id] for r in out)
    for width in (3, 8):
        own = [r for r in rows if len(r[1]) == width]
        assert recall([r for r in out if by_length[r.query_id] == width], own, 6, 4) >= 0.9
    assert {by_length[r.query_id] for r in out} == {3, 8}


def test_chi_square():
    # Known values: medians and a tail of the law with eight dimensions.
    assert projections.chi_square(np.array([7.344121]), 8)[0] == pytest.approx(0.5, abs=1e-6)
    assert projections.chi_square(np.array([20.09024]), 8)[0] == pytest.approx(0.99, abs=1e-6)
