"""Random inputs against plain Python."""

import bisect
from decimal import ROUND_HALF_UP, Decimal, localcontext

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from punctual.functions import scalar
from punctual.operators.insert import absent_rows
from punctual.operators.keys import drop_repeats, first_by
from punctual.plans import evaluate as ev

few = settings(
    max_examples=6, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
counts = st.integers(min_value=0, max_value=10**12)


@few
@given(pairs=st.lists(st.tuples(counts, st.integers(1, 10**12)), min_size=30, max_size=60))
def test_rounding(spark, pairs):
    pairs = [(min(a, b), b) for a, b in pairs] + [(1, 2000), (3, 2000), (1999, 2000)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a bigint, b bigint")
    got = df.orderBy("i").select(scalar.rounded_rate(F.col("a"), F.col("b"))).collect()
    with localcontext() as context:
        context.prec = 60
        expected = [
            float((Decimal(a) / b).quantize(Decimal("0.001"), ROUND_HALF_UP)) for a, b in pairs
        ]
    assert [r[0] for r in got] == expected


@few
@given(
    values=st.lists(st.integers(-5, 1000), min_size=20, max_size=50),
    limits=st.lists(st.integers(0, 900), min_size=1, max_size=5, unique=True).map(sorted),
)
def test_buckets(spark, values, limits):
    labels = [f"<{limits[0]}", *[f"{a}-{b}" for a, b in zip(limits, limits[1:])],
              f"{limits[-1]}+"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, x int")
    got = df.orderBy("i").select(scalar.value_bucket(F.col("x"), limits)).collect()
    assert [r[0] for r in got] == [labels[bisect.bisect_right(limits, v)] for v in values]


keyed = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.integers(0, 100)),
    min_size=1, max_size=40,
)


@few
@given(rows=keyed)
def test_first_rows_and_repeats(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int").repartition(3)
    least = {}
    for k, v in rows:
        least[k] = min(v, least.get(k, v))
    assert dict(map(tuple, first_by(df, ["k"], []).collect())) == least
    nulls = sorted(v for k, v in rows if k is None)
    kept = [tuple(r) for r in drop_repeats(df, ["k"]).collect()]
    assert sorted(v for k, v in kept if k is None) == nulls
    assert {k: v for k, v in kept if k is not None} == {
        k: v for k, v in least.items() if k is not None}
    assert len(kept) == len(nulls) + sum(k is not None for k in least)


@few
@given(batch=keyed, existing=keyed)
def test_insert_is_idempotent_and_complete(spark, batch, existing):
    new = spark.createDataFrame(batch, "k int, v int")
    old = spark.createDataFrame(existing, "k int, v int")
    added = absent_rows(new, old, ["k"]).collect()
    assert {r["k"] for r in added} == {k for k, _ in batch} - {k for k, _ in existing}
    assert len(added) == len({r["k"] for r in added})
    grown = old.unionByName(spark.createDataFrame(added, "k int, v int"))
    assert absent_rows(new, grown, ["k"]).count() == 0


@few
@given(scored=st.lists(
    st.tuples(st.integers(0, 8).map(lambda x: x / 8), st.booleans()), min_size=4, max_size=40))
def test_areas(spark, scored):
    pos = [s for s, y in scored if y]
    neg = [s for s, y in scored if not y]
    df = spark.createDataFrame([(s, int(y)) for s, y in scored], "score double, y int")
    got = ev.areas(ev.score_counts(df, "y")).first()
    if not pos or not neg:
        assert got["roc_auc"] is None
        return
    pairs = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert abs(got["roc_auc"] - pairs / (len(pos) * len(neg))) < 1e-12
    assert 0 <= got["pr_auc"] <= 1
