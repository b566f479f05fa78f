import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from punctual.llm import registry, search

from tests.llm.conftest import SMALL, lower

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(lower(text or ""))


def brute(docs, items, k=10):
    held = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    n_docs = sum(1 for _, c in held if c)
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in items:
        asked = Counter(terms(text))
        found = []
        for doc_id, counts in held:
            if not counts:
                continue
            m = 100 - 75 + 75 * sum(counts.values()) * n_docs // total
            score = 0
            for term, times in asked.items():
                tf = counts.get(term, 0)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += times * w * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        found.sort(key=lambda f: f[:3])
        out += [(item_id, rank, f[3], -f[0]) for rank, f in enumerate(found[:k], 1)]
    return sorted(out, key=repr)


def asked(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, rank string, item string")


def collected(out):
    return sorted((tuple(r) for r in out.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_equals_sql(spark):
    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    wanted = duck.execute(
        f"SELECT item_id, rank, doc_id, score FROM ({registry.SQL['op12_search']})"
    ).fetchall()
    out = registry.QUERIES["op12_search"](spark, SMALL)
    assert collected(out) == sorted(wanted, key=repr)
    assert len(wanted) > 100
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint", "int", "bigint", "bigint"]


def test_odd_rows_and_items(spark, documents, odd_rows):
    items = [(1, "w1 w2 w3 W4"), (2, None), (3, ""), (4, "?! .."), (None, "w7 naïve 漢字"), (1, "w1 w2 w3 W4"),
             (5, "absent"), (6, "w9 " * 3000), (7, "x" * 300_000), (8, "ünï Ünï ü")]
    out = search.search(documents(odd_rows), asked(spark, [(*i, "x", "x") for i in items]))
    assert collected(out) == brute([r[:2] for r in odd_rows], items)
    assert search.search(documents([]), asked(spark, [(1, "a", "x", "x")])).count() == 0
    none = search.search(documents(odd_rows), asked(spark, []))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]


def test_ties_go_to_smaller_ids(spark, documents):
    rows = [(i, "same words here") for i in range(200, 0, -1)] + [(1000, "other")] * 3
    items = [(1, "same"), (2, "other words")]
    out = search.search(documents(rows).repartition(7), asked(spark, [(*i, "x", "x") for i in items]))
    got = collected(out)
    assert got == brute(rows, items)
    assert [d for i, _, d, _ in sorted(got) if i == 1] == list(range(1, 11))


@pytest.mark.parametrize("sizes", [(1, 1, 1, 1), (2, 3, 5, 3), (4096, 256, 4096, 512)])
def test_tiles_and_blocks_of_any_size(spark, documents, monkeypatch, sizes):
    for name, size in zip(("BLOCK_ITEMS", "TILE_ITEMS", "TILE_TERMS", "TILE_DOCS"), sizes):
        monkeypatch.setattr(search, name, size)
    rng = random.Random(1)
    words = [f"t{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(40)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(5)]
    out = search.search(documents(rows), asked(spark, [(*i, "x", "x") for i in items]), k=4)
    assert collected(out) == brute(rows, items, 4)


def test_products_stay_exact():
    """Sums over 2^53 are split; a single entry beyond it is multiplied as integers."""
    block = search.Block([1, 2], ["a b c d", "a " * 5 + "b"])
    weights = np.array([2**40, 3, 2**33, 2**32], np.int64)
    tiles = block.tiles(weights)
    assert {t[2].dtype for t in tiles} == {np.dtype(np.int64), np.dtype(np.float64)}
    for first, own, matrix in tiles:
        if matrix.dtype == np.float64:
            assert matrix.sum(axis=1).max() * search.MOST_IMPACT < search.EXACT
    whole = np.zeros((2, 4), np.int64)
    for first, own, matrix in tiles:
        whole[first : first + len(matrix), own] += matrix.astype(np.int64)
    counts = np.zeros((2, 4), np.int64)
    counts[block.item, block.term] = block.times
    assert (whole == counts * weights).all()
