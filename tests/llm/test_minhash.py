import random
from itertools import combinations

import pytest
from punctual.llm import graph, minhash

from tests.llm.conftest import SMALL, words


def shingle_set(text, size):
    own = words(text)
    if len(own) < size:
        return frozenset([tuple(own)] if own else [])
    return frozenset(tuple(own[i : i + size]) for i in range(len(own) - size + 1))


def groups(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_force(rows, size, percent):
    """Row number -> (set size, rows of its component)."""
    sets = [shingle_set(t, size) for _, t, *_ in rows]
    links = []
    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b]:
            shared = len(sets[a] & sets[b])
            if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                links.append((a, b))
    return [len(s) for s in sets], groups(links, range(len(rows)))


def check(spark_rows, rows, size, percent):
    sizes, root = brute_force(rows, size, percent)
    expected = []
    for i, (doc_id, *_) in enumerate(rows):
        ids = [rows[j][0] for j in root if root[j] == root[i] and rows[j][0] is not None]
        least = min(ids, default=None)
        expected.append((doc_id, sizes[i], least, doc_id == least))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, spark_rows), key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_components_equal_those_of_all_pairs(spark, documents, odd_rows, size, percent):
    given = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id + 100, r.text) for r in given] + odd_rows
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    for k in range(60):  # copies of one text with 0 to 9 changed words each
        copy = list(base)
        for at in rng.sample(range(150), k % 10):
            copy[at] = f"new{rng.random()}"
        rows.append((1000 + k, " ".join(copy)))
    out = minhash.near_duplicates(documents(rows), size, percent).collect()
    check(out, rows, size, percent)


def test_bridges_between_groups_are_found(documents):
    """A chain, whose ends have little in common, is one component."""
    rows = [(k, " ".join(f"t{i}" for i in range(8 * k, 8 * k + 200))) for k in range(12)]
    out = minhash.near_duplicates(documents(rows), 3, 85).collect()
    assert {r.component_id for r in out} == {0}


def test_one_row_of_each_group_stays(documents, odd_rows):
    kept = minhash.deduplicated(documents(odd_rows)).collect()
    _, root = brute_force(odd_rows, 5, 80)
    worded = {root[i] for i, (_, t, *_) in enumerate(odd_rows) if words(t)}
    blank = sum(not words(t) for _, t, *_ in odd_rows)
    assert len(kept) == len(worded) + blank
    assert kept[0].__fields__ == documents(odd_rows).columns


def test_empty_table(documents):
    assert minhash.near_duplicates(documents([])).count() == 0
    assert minhash.deduplicated(documents([])).count() == 0


def test_components_of_random_graphs(spark):
    rng = random.Random(9)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    links += [(400, k) for k in range(401, 450)] + [(k, k + 1) for k in range(500, 560)]
    table = spark.createDataFrame([*links, (None, 3), (7, None)], "a long, b long")
    got = {r.node: r.root for r in graph.components(table).collect()}
    nodes = {x for link in links for x in link}
    expected = groups([x for x in links if x[0] != x[1]], nodes)
    assert {n: got.get(n, n) for n in nodes} == expected
    assert graph.components(table.limit(0)).count() == 0


def test_no_task_meets_all_pairs_of_a_bucket(documents):
    """Copies with changes of their own give about one edge per copy."""
    rng = random.Random(4)
    rows = []
    for k in range(400):
        copy = [f"b{i}" for i in range(200)]
        for at in rng.sample(range(200), 9):
            copy[at] = f"own{k}-{at}"
        rows.append((k, " ".join(copy)))
    seen = {}
    real = minhash.materialize

    def counted(df, label):
        out = real(df, label)
        seen[label] = seen.get(label, 0) + out.count()
        return out

    minhash.materialize = counted
    try:
        minhash.near_duplicates(documents(rows), 3, 85).collect()
    finally:
        minhash.materialize = real
    assert seen["stars"] + seen["more"] < 40 * len(rows)
