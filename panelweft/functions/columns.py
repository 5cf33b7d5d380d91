"""Column helpers shared by the operators. Everything here stays JVM-side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# US GDP deflator, 2017 = 100 (2005 = 81.556, 2021 = 110.186).
DEFLATE_2021_TO_2005 = 81.556 / 110.186
DEFLATE_2017_TO_2005 = 81.556 / 100


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_nan(c) -> Column:
    """NaN -> NULL, so that every later aggregate skips it."""
    c = as_col(c).cast("double")
    return F.when(~F.isnan(c), c)


def number(c) -> Column:
    """Text to double; anything that is not a number becomes NULL."""
    return null_if_nan(as_col(c).try_cast("double"))


def deflate(c, factor: float) -> Column:
    return as_col(c) * F.lit(factor)


def geomean(c) -> Column:
    """Aggregate: geometric mean of the positive values."""
    c = as_col(c)
    return F.exp(F.avg(F.when(c > 0, F.ln(c))))


def distinct_years(time: str, first: int, last: int) -> Column:
    """Aggregate: number of distinct years within first..last, exact. The
    years are collected as bits, so no distinct aggregation is planned."""
    counts = []
    for low in range(first, last + 1, 63):
        high = min(low + 62, last)
        bit = F.expr(f"shiftleft(1L, `{time}` - {low})")
        bits = F.bit_or(F.when(F.col(time).between(low, high), bit))
        counts.append(F.coalesce(F.bit_count(bits), F.lit(0)))
    return reduce(lambda a, b: a + b, counts)


def country_of(region) -> Column:
    """Country code of a region id: the text before the first dot."""
    return F.substring_index(as_col(region), ".", 1)


def ascii_fold(c) -> Column:
    """Each non-ASCII character becomes one question mark."""
    return F.regexp_replace(as_col(c), r"[^\x00-\x7F]", "?")


def band_year(c) -> Column:
    """First run of four digits in a band name."""
    return F.regexp_extract(as_col(c), "[0-9]{4}", 0).try_cast("int")


def rel_diff(a, b) -> Column:
    """|a-b| / max(|a|,|b|); 0 when both are 0; NULL when either is NULL."""
    a, b = as_col(a), as_col(b)
    scale = F.greatest(F.abs(a), F.abs(b))
    gap = F.when(scale == 0, F.lit(0.0)).otherwise(F.try_divide(F.abs(a - b), scale))
    return F.when(a.isNotNull() & b.isNotNull(), gap)


def pct_diff(a, b) -> Column:
    """|a-b| in percent of |b|; 0 when equal; NULL when only b is 0."""
    a, b = as_col(a), as_col(b)
    return F.when(a == b, F.lit(0.0)).otherwise(F.try_divide(F.abs(a - b), F.abs(b)) * 100)


def pct_diff_or_inf(a, b) -> Column:
    """Like pct_diff, but infinite when only b is 0 (for gates on a maximum)."""
    a, b = as_col(a), as_col(b)
    return F.when((b == 0) & (a != 0), F.lit(float("inf"))).otherwise(pct_diff(a, b))


def one_side_null(a, b) -> Column:
    """True where exactly one of the two values is missing."""
    return as_col(a).isNull() != as_col(b).isNull()


def laid_out(entries: str, size: int, value: str) -> Column:
    """An array of `size` from an array of structs sorted by their `place` (from
    0): each value at its place, NULL elsewhere. A place given twice is an error."""
    none = F.get(F.col(entries), F.lit(size))[value]  # NULL of the right type

    def with_gap(x, i):
        before = F.when(i == 0, -1).otherwise(F.get(F.col(entries), i - 1)["place"])
        gap = x["place"] - before - 1
        right = F.when(gap < 0, F.raise_error(F.lit("a cell is given twice")).cast("int")).otherwise(gap)
        return F.concat(F.array_repeat(none, right), F.array(x[value]))

    rest = F.lit(size - 1) - F.element_at(F.col(entries), -1)["place"]
    return F.concat(F.flatten(F.transform(F.col(entries), with_gap)), F.array_repeat(none, rest))
