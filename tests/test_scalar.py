import datetime

import math

import pytest
from pyspark.sql import functions as F

from punctual.functions import scalar, tails


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_value_buckets_are_half_open_and_null_is_last(spark):
    got = column(spark, [99.99, 100.0, 300.0, 600.0, None], "double",
                 lambda x: scalar.value_bucket(x, [100, 300, 600]))
    assert got == ["<100", "100-300", "300-600", "600+", "600+"]


def test_risk_bands_have_strict_limits(spark):
    got = column(spark, [0.61, 0.60, 0.41, 0.40], "double", scalar.risk_band)
    assert got == ["high", "moderate", "moderate", "low"]


def test_date_text_and_weekday(spark):
    assert column(spark, ["1/31/2018 22:56", "31 Jan", None], "string", scalar.parse_day) == [
        datetime.date(2018, 1, 31), None, None,
    ]
    day = column(spark, ["1/31/2018 22:56"], "string",
                 lambda x: scalar.weekday_name(scalar.parse_day(x)))
    assert day == ["Wednesday"]


def test_rounding_is_half_up_on_exact_quotients(spark):
    df = spark.createDataFrame([(1, 16), (569, 2000), (0, 0), (1, 3)], "a bigint, b bigint")
    rate = scalar.rounded_rate(F.col("a"), F.col("b"))
    assert [r[0] for r in df.select(rate).collect()] == [0.063, 0.285, None, 0.333]


def test_empty_list_selects_everything(spark):
    values = ["a", "b"]
    assert column(spark, values, "string", lambda x: scalar.in_list(x, [])) == [True, True]
    assert column(spark, values, "string", lambda x: scalar.in_list(x, ["b"])) == [False, True]


def test_lookup_of_unknown_key_is_null(spark):
    got = column(spark, ["a", "z", None], "string", lambda x: scalar.lookup({"a": 1.5}, x))
    assert got == [1.5, None, None]


@pytest.mark.parametrize("statistic, dof, p", [
    (3.841458820694124, 1, 0.05), (0.0, 3, 1.0), (18.307038053275146, 10, 0.05),
    (24.2824112281, 24, 0.445547), (9.21034037197618, 2, 0.01),
])
def test_chi_square_tail(statistic, dof, p):
    assert tails.chi_square_tail(statistic, dof) == pytest.approx(p, abs=1e-6)


@pytest.mark.parametrize("t, dof, p", [
    (2.2281388519649385, 10, 0.05), (-2.2281388519649385, 10, 0.05), (0.0, 5, 1.0),
    (12.706204736432095, 1, 0.05), (1.9602012636, 1e4, 0.05),
])
def test_student_tail(t, dof, p):
    assert tails.student_two_sided(t, dof) == pytest.approx(p, abs=1e-6)


@pytest.mark.parametrize("dof", [2, 20, 1000, 19_998, 20_002, 60_000])
@pytest.mark.parametrize("shift", [-3, -0.5, 0, 0.01, 1, 4])
def test_chi_square_tail_equals_the_closed_sum_of_even_dof(dof, shift):
    x = dof + shift * math.sqrt(2 * dof)
    if x <= 0:
        return
    logs = [-x / 2 + k * math.log(x / 2) - math.lgamma(k + 1) for k in range(dof // 2)]
    assert tails.chi_square_tail(x, dof) == pytest.approx(
        math.fsum(map(math.exp, logs)), rel=1e-9)


@pytest.mark.parametrize("dof", [1e6, 1e8, 1e10, 1e12, 1e15])
def test_chi_square_tail_at_its_mean(dof):
    # Half plus the skewness term of the limit law.
    expected = 0.5 - 1 / (3 * math.sqrt(math.pi * dof))
    assert tails.chi_square_tail(dof, dof) == pytest.approx(expected, rel=1e-9)


def student_by_parts(t, dof, steps=200_000):
    """Simpson's rule over the angle whose tangent is t over the root of the dof."""
    start, end = math.atan(t / math.sqrt(dof)), math.pi / 2
    end = min(end, start + 60 / math.sqrt(dof))
    width = (end - start) / steps
    log_front = math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2) - 0.5 * math.log(math.pi)
    weights = (1 if k in (0, steps) else 4 if k % 2 else 2 for k in range(steps + 1))
    total = math.fsum(
        w * math.exp((dof - 1) * math.log(math.cos(start + k * width)))
        for k, w in enumerate(weights) if math.cos(start + k * width) > 0)
    return 2 * math.exp(log_front) * total * width / 3


@pytest.mark.parametrize("dof", [3.5, 300, 9_999, 10_001, 50_000])
@pytest.mark.parametrize("t", [0.3, 1.96, 6.0])
def test_student_tail_equals_the_integral(dof, t):
    assert tails.student_two_sided(t, dof) == pytest.approx(student_by_parts(t, dof), rel=2e-8)


@pytest.mark.parametrize("t", [0.5, 1.96, 5, 9])
def test_student_tail_has_no_seam_and_becomes_normal(t):
    below, above = (tails.student_two_sided(t, tails._LARGE * f) for f in (1 - 1e-12, 1))
    assert below == pytest.approx(above, rel=1e-9)
    for dof in (1e12, 1e14, 1e15):
        normal = math.erfc(t / math.sqrt(2))
        assert tails.student_two_sided(t, dof) == pytest.approx(normal, rel=1e-8)


def test_a_fraction_that_does_not_settle_is_an_error():
    with pytest.raises(ArithmeticError):
        tails._continued_fraction(lambda n: n * n * 1e6, lambda n: 1.0 if n % 2 else -1.0)


def test_tails_travel_to_workers_without_the_package(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    payload = tmp_path / "function"
    payload.write_bytes(cloudpickle.dumps(tails.student_two_sided))
    code = (
        "import pickle, sys; sys.modules['punctual'] = None; "
        f"print(pickle.load(open({str(payload)!r}, 'rb'))(0.0, 5))"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.stdout.strip() == "1.0", done.stderr
