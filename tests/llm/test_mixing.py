import random
from collections import defaultdict

import pytest
from punctual.llm import mixing
from punctual.llm.cuts import cuts

from tests.llm.conftest import SMALL, words


def targets(sizes, weights=(3, 1, 2), share=1.5, epochs=2.0):
    """Water-filling source by source, as it is described."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        left = total - sum(fixed.values())
        free = [s for s in names if s not in fixed]
        every = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / every > epochs * sizes[s]]
        if not above:
            return fixed | {s: left * weight[s] / every for s in free}
        fixed |= {s: epochs * sizes[s] for s in above}


def check(out, rows, nearness):
    source_of, sizes = defaultdict(set), defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(words(text))
    for doc_id, text, source in rows:
        source_of[doc_id, len(words(text)), sizes[source]].add(source)
    expected, taken = targets(sizes), defaultdict(int)
    for r in out:
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        sources = source_of[r.doc_id, r.size, r.source_size]
        assert any(r.target == pytest.approx(expected[s]) for s in sources)
        taken[min(sources, key=lambda s: (s is None, s or ""))] += r.taken
    largest = defaultdict(int)
    for _, text, source in rows:
        largest[source] = max(largest[source], len(words(text)))
    for source, target in expected.items():
        assert abs(taken[source] - target) <= max(nearness * target, largest[source])


def test_targets_and_sums_on_the_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    check(out, rows, 0.05)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def test_odd_rows(documents, odd_rows):
    out = mixing.mix(documents(odd_rows)).collect()
    assert len(out) == len(odd_rows)
    check(out, odd_rows, 0.05)


def test_the_mix_repeats_rows(documents, odd_rows):
    docs = documents(odd_rows)
    taken = sum(r.taken for r in mixing.mix(docs).collect())
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(words(r.text)) for r in mixed.collect()) == taken


def test_empty_table(documents):
    assert mixing.mix(documents([])).count() == 0
    assert mixing.mixed_documents(documents([])).count() == 0


def test_cuts_equal_a_running_sum(spark):
    rng = random.Random(8)
    units = [(g, rng.randrange(1 << 24), rng.randint(0, 9)) for g in "ab" for _ in range(300)]
    units += [("c", 5, 3), ("c", 5, 4), ("c", (1 << 24) - 1, 1)]
    wanted = {"a": 400.0, "b": 1.0, "c": 8.0, "d": 3.0, "e": 0.0}
    out = cuts(
        spark.createDataFrame(units, "grp string, place long, amount long"),
        spark.createDataFrame(list(wanted.items()), "grp string, wanted double"), 24,
    )
    got = {r.grp: (r.place, r.before, r["at"]) for r in out.collect()}
    expected = {}
    for g, need in wanted.items():
        total = 0.0
        for place in sorted({p for h, p, _ in units if h == g}):
            at = sum(n for h, p, n in units if h == g and p == place)
            if total < need <= total + at:
                expected[g] = (place, total, at)
            total += at
    assert got == expected
