"""Column expressions shared by the plans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE = "decimal(20,0)"


def ratio(part: Column, whole: Column) -> Column:
    """Unrounded ``part / whole`` as a double; null when ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def rounded_ratio(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole`` rounded half up on the exact decimal quotient."""
    exact = F.try_divide(part, whole.cast(WHOLE))
    return F.round(exact, digits).cast("double")


def rounded_rate(part: Column, whole: Column, digits: int = 3) -> Column:
    """Rounded ratio of two counts."""
    return rounded_ratio(part.cast(WHOLE), whole, digits)


def value_bucket(value: Column, limits: Sequence[int]) -> Column:
    """Label of the half-open bucket that holds ``value``.

    ``limits`` 100, 300 gives '<100', '100-300' and '300+'. A null value matches
    no comparison and falls into the last bucket.
    """
    label = F.when(value < limits[0], f"<{limits[0]}")
    for low, high in zip(limits, limits[1:]):
        label = label.when(value < high, f"{low}-{high}")
    return label.otherwise(f"{limits[-1]}+")


def leading_digits(value: Column) -> Column:
    """The number with the first two digits of the whole part of ``value``, then zeros.

    1234.5 gives 1200; values below 1 give 0. It never exceeds the value, and compares
    with ``whole_bound`` numbers as the value itself does.
    """
    whole = F.floor(value).cast("string")
    cut = F.rpad(F.substr(whole, F.lit(1), F.lit(2)), F.length(whole), F.lit("0"))
    return F.when(value < 1, F.lit(0).cast("decimal(38,0)")).when(
        value.isNotNull(), cut.cast("decimal(38,0)"))


def whole_bound(limit: float) -> bool:
    """Whether ``leading_digits`` keeps values below and above ``limit`` apart."""
    digits = str(limit)
    return digits.isdigit() and limit > 0 and not digits[2:].strip("0")


def risk_band(score: Column, high: float = 0.6, moderate: float = 0.4) -> Column:
    """Three bands with strict lower limits."""
    return (
        F.when(score > high, "high").when(score > moderate, "moderate").otherwise("low")
    )


def weekday_name(day: Column) -> Column:
    """Full English weekday name without padding."""
    return F.date_format(day, "EEEE")


def parse_day(text: Column, pattern: str | Sequence[str] = "M/d/yyyy H:mm") -> Column:
    """Date part of a timestamp text; text that does not parse becomes null.

    Of several patterns the first that fits reads the text.
    """
    patterns = [pattern] if isinstance(pattern, str) else list(pattern)
    read = [F.try_to_timestamp(text, F.lit(p)) for p in patterns]
    return F.to_date(F.coalesce(*read)) if read else F.lit(None).cast("date")


def in_list(column: Column, values: Sequence[str]) -> Column:
    """Membership filter; an empty list selects everything."""
    return column.isin(list(values)) if values else F.lit(True)


def same_key(left: Sequence[Column], right: Sequence[Column], null_safe: bool) -> Column:
    """Equality of two composite keys, with nulls equal to each other or not."""
    pairs = zip(left, right)
    terms = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    return reduce(lambda a, b: a & b, terms)


def lookup(mapping: dict[str, float], key: Column) -> Column:
    """Constant lookup; a key outside the mapping gives null."""
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)
