"""Queries on allocation, freezing, reconciliation and shares."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweft.catalog import inputs as src
from panelweft.catalog.inputs import knots_sql, sql
from panelweft.operators import allocate, cohorts, series
from panelweft.scale import materialise

KEY = ["country"]
PARTS = {"a": "share_a", "n": "share_n", "r": "share_r"}


def _weights(spark, d):
    return src.regions(spark, d).select("region", "country", "nationkey", "weight")


def _annual_control(spark, d):
    knots = src.control(spark, d).where("year in (1995, 1998, 2001) and nationkey % 4 <> 0")
    return series.interpolate(knots, KEY, value="total")


def _rounded(df, digits=4):
    return df.select("region", "country", "year", F.round(F.col("value") / 100, digits).alias("value"))


def allocate_fixed(spark, d):
    return _rounded(allocate.allocate_fixed(_weights(spark, d), _annual_control(spark, d), KEY))


def freeze_uncontrolled(spark, d):
    out = allocate.freeze_uncontrolled(_weights(spark, d), _annual_control(spark, d), KEY)
    return _rounded(out)


def allocate_and_freeze(spark, d):
    """Interpolate national knots, allocate them to regions by weight, keep
    the rest at their weight, and compare national sums with the control."""
    weights = _weights(spark, d)
    control = materialise(_annual_control(spark, d), "control")
    rows = allocate.allocate_or_freeze(weights, control, KEY)
    sums = rows.groupBy("country", "year").agg(
        F.count(F.lit(1)).alias("n_regions"), F.sum("value").alias("allotted")
    )
    joined = sums.join(control.select("country", "year", "total"), ["country", "year"], "left")
    gap = F.abs(F.col("allotted") - F.col("total")) > 1e-6 * F.col("total")
    return joined.select(
        "country",
        "year",
        "n_regions",
        F.round(F.col("allotted") / 1e6, 7).alias("allotted"),
        F.coalesce(~gap, F.lit(True)).alias("ok"),
    )


def _yearly_weights(spark, d):
    return src.raw_values(spark, d).select(
        "region", "country", "nationkey", "year", (F.col("raw") * (F.col("year") % 3)).alias("weight")
    )


def allocate_yearly(spark, d):
    control = src.revenue(spark, d).where("nationkey % 4 <> 0 and year <> 1997")
    return _rounded(allocate.allocate_yearly(_yearly_weights(spark, d), control, KEY))


def allocate_or_keep(spark, d):
    """Yearly allocation and kept rows in one pass."""
    control = src.revenue(spark, d).where("nationkey % 4 <> 0 and year <> 1997")
    control = materialise(control, "control")
    return _rounded(allocate.allocate_or_keep(_yearly_weights(spark, d), control, KEY))


def keep_uncontrolled(spark, d):
    control = src.revenue(spark, d).where("nationkey % 4 <> 0")
    return _rounded(allocate.keep_uncontrolled(_yearly_weights(spark, d), control, KEY))


def backfill_constant(spark, d):
    rows = src.raw_values(spark, d).select("region", "year", "raw")
    return allocate.backfill_constant(rows, 1995, 1990, 1994)


def reconcile_to_target(spark, d):
    raw = src.raw_values(spark, d).withColumnRenamed("raw", "value")
    weights = _weights(spark, d).select("region", "weight")
    target = src.revenue(spark, d).where("nationkey % 4 <> 0").select(
        "country", "year", (F.col("total") / 100).alias("target")
    )
    out = allocate.reconcile_weighted_mean(
        raw.join(weights, "region", "left"), target, KEY, since=1998
    )
    return _rounded(out, 3)


def _flag_totals(spark, d):
    """country, year, a, n, r, total: quantity by return flag."""
    per_order = (
        src.table(spark, d, "lineitem")
        .groupBy("l_orderkey", F.year("l_shipdate").alias("year"))
        .pivot("l_returnflag", ["A", "N", "R"])
        .agg(F.sum("l_quantity"))
    )
    orders = src.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    per_customer = (
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", "year")
        .agg(*(F.sum(x).alias(x.lower()) for x in "ANR"))
    )
    return (
        src.located(spark, d, per_customer)
        .groupBy("country", "nationkey", "year")
        .agg(*(F.coalesce(F.sum(x), F.lit(0.0)).alias(x) for x in "anr"))
    )


def _knot_shares(spark, d):
    # parts and total are both read from one staged table
    parts = materialise(_flag_totals(spark, d), "flag-totals").where("nationkey % 6 <> 5")
    parts = parts.where("year in (1996, 1998, 2000) and not (nationkey = 7 and year = 1998)")
    total = parts.select("country", "year", F.expr("a + n + r").alias("total"))
    return materialise(cohorts.shares(parts, total, ["country", "year"], PARTS), "knot-shares")


def shares(spark, d):
    out = _knot_shares(spark, d)
    return out.select("country", "year", *(F.round(c, 10).alias(c) for c in PARTS.values()))


def mean_shares(spark, d):
    out = cohorts.mean_over_members(_knot_shares(spark, d), ["year"], list(PARTS.values()))
    return out.select("year", *(F.round(c, 10).alias(c) for c in PARTS.values()))


def apply_or_fallback(spark, d):
    """A nation without shares takes the mean; a nation lacking one knot
    loses the years until its next one."""
    knots = _knot_shares(spark, d)
    own = series.step_lookup(knots, 1995, 2001)
    typical = series.step_lookup(
        cohorts.mean_over_members(knots, ["year"], list(PARTS.values())), 1995, 2001
    )
    raw = src.raw_values(spark, d).select("region", "country", "year", "raw")
    out = cohorts.apply_or_fallback(
        raw,
        own,
        typical,
        "country",
        columns={"share_a": "part_a", "share_n": "part_n", "share_r": "part_r"},
        value="raw",
    )
    return out.select(
        "region", "year", *(F.round(F.col(f"part_{x}") / 100, 4).alias(f"part_{x}") for x in "anr")
    )


_KNOTS = "SELECT country, year, total FROM control WHERE year IN (1995, 1998, 2001) AND nationkey % 4 <> 0"
_PATH = knots_sql("sparse", "country", "total")
_SUMS = "SELECT country, sum(weight) AS s FROM regions GROUP BY 1"
_ALLOTTED = """SELECT region, country, year, weight * total / nullif(s, 0) AS value
  FROM regions JOIN sums USING (country) JOIN path USING (country)"""
_FROZEN = """SELECT region, country, CAST(y AS INTEGER) AS year, weight AS value
  FROM regions, unnest(generate_series((SELECT min(year) FROM path), (SELECT max(year) FROM path))) u(y)
  WHERE country NOT IN (SELECT country FROM path)"""
_SHOW = "SELECT region, country, year, round(value / 100, 4) AS value FROM "
_FLAGS = """SELECT country, nationkey, CAST(year(l_shipdate) AS INTEGER) AS year,
    coalesce(sum(l_quantity) FILTER (l_returnflag = 'A'), 0) AS a,
    coalesce(sum(l_quantity) FILTER (l_returnflag = 'N'), 0) AS n,
    coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0) AS r
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN regions ON o_custkey = c_custkey
  GROUP BY 1, 2, 3"""
_SHARES = """SELECT country, year, a / (a + n + r) AS share_a, n / (a + n + r) AS share_n,
    r / (a + n + r) AS share_r FROM flags
  WHERE a + n + r > 0 AND nationkey % 6 <> 5 AND year IN (1996, 1998, 2000)
    AND NOT (nationkey = 7 AND year = 1998)"""
_MEANS = """SELECT year, avg(share_a) AS share_a, avg(share_n) AS share_n, avg(share_r) AS share_r
  FROM shares GROUP BY year"""
_ROUND = "round(share_a, 10) AS share_a, round(share_n, 10) AS share_n, round(share_r, 10) AS share_r"

QUERIES = {
    "allocate_fixed": (
        allocate_fixed,
        sql("regions", "control", sparse=_KNOTS, path=_PATH, sums=_SUMS, a=_ALLOTTED, tail=_SHOW + "a"),
    ),
    "freeze_uncontrolled": (
        freeze_uncontrolled,
        sql("regions", "control", sparse=_KNOTS, path=_PATH, f=_FROZEN, tail=_SHOW + "f"),
    ),
    "allocate_and_freeze": (
        allocate_and_freeze,
        sql(
            "regions",
            "control",
            sparse=_KNOTS,
            path=_PATH,
            sums=_SUMS,
            a=_ALLOTTED,
            f=_FROZEN,
            tail="""
SELECT country, year, count(*) AS n_regions, round(sum(value) / 1e6, 7) AS allotted,
  coalesce(abs(sum(value) - any_value(total)) <= 1e-6 * any_value(total), true) AS ok
FROM (SELECT * FROM a UNION ALL SELECT * FROM f) LEFT JOIN path USING (country, year)
GROUP BY 1, 2""",
        ),
    ),
    "allocate_yearly": (
        allocate_yearly,
        sql(
            "raw_values",
            "revenue",
            w="SELECT region, country, year, raw * (year % 3) AS weight FROM raw_values",
            sums="SELECT country, year, sum(weight) AS s FROM w GROUP BY 1, 2",
            a="""SELECT region, w.country, w.year, CASE WHEN s > 0 THEN weight / s ELSE 0 END * total AS value
  FROM w JOIN sums USING (country, year)
  JOIN (SELECT * FROM revenue WHERE nationkey % 4 <> 0 AND year <> 1997) USING (country, year)""",
            tail=_SHOW + "a",
        ),
    ),
    "freeze_uncontrolled_history": (
        keep_uncontrolled,
        sql(
            "raw_values",
            k="SELECT region, country, year, raw * (year % 3) AS value FROM raw_values WHERE nationkey % 4 = 0",
            tail=_SHOW + "k",
        ),
    ),
    "allocate_or_keep": (
        allocate_or_keep,
        sql(
            "raw_values",
            "revenue",
            w="SELECT region, country, nationkey, year, raw * (year % 3) AS weight FROM raw_values",
            sums="SELECT country, year, sum(weight) AS s FROM w GROUP BY 1, 2",
            a="""SELECT region, w.country, w.year, CASE WHEN s > 0 THEN weight / s ELSE 0 END * total AS value
  FROM w JOIN sums USING (country, year)
  JOIN (SELECT * FROM revenue WHERE nationkey % 4 <> 0 AND year <> 1997) USING (country, year)
  UNION ALL SELECT region, country, year, weight FROM w WHERE nationkey % 4 = 0""",
            tail=_SHOW + "a",
        ),
    ),
    "backfill_constant": (
        backfill_constant,
        sql(
            "raw_values",
            tail="""
SELECT region, year, raw FROM raw_values
UNION ALL SELECT region, CAST(y AS INTEGER), raw FROM raw_values, unnest(generate_series(1990, 1994)) u(y)
WHERE year = 1995""",
        ),
    ),
    "reconcile_to_target": (
        reconcile_to_target,
        sql(
            "raw_values",
            "regions",
            "revenue",
            x="""SELECT v.region, v.country, v.year, raw AS value, weight
  FROM raw_values v JOIN regions r USING (region)""",
            f="""SELECT country, year, any_value(total) / 100 / (sum(value * weight) / sum(weight)) AS factor
  FROM x JOIN revenue USING (country, year)
  WHERE nationkey % 4 <> 0 AND year >= 1998 AND weight > 0 GROUP BY 1, 2
  HAVING sum(value * weight) / sum(weight) > 0""",
            tail="""
SELECT region, country, year, round(value * coalesce(factor, 1) / 100, 3) AS value
FROM x LEFT JOIN f USING (country, year)""",
        ),
    ),
    "shares": (
        shares,
        sql(
            "regions", flags=_FLAGS, shares=_SHARES, tail=f"SELECT country, year, {_ROUND} FROM shares"
        ),
    ),
    "mean_shares": (
        mean_shares,
        sql(
            "regions",
            flags=_FLAGS,
            shares=_SHARES,
            means=_MEANS,
            tail=f"SELECT year, {_ROUND} FROM means",
        ),
    ),
    "apply_or_fallback": (
        apply_or_fallback,
        sql(
            "raw_values",
            flags=_FLAGS,
            shares=_SHARES,
            means=_MEANS,
            steps="""SELECT CAST(range AS INTEGER) AS year, knot FROM range(1995, 2002)
  ASOF JOIN (SELECT DISTINCT year AS knot FROM shares) ON range >= knot""",
            used="""SELECT v.region, v.year, raw, coalesce(s.share_a, m.share_a) AS share_a,
    coalesce(s.share_n, m.share_n) AS share_n, coalesce(s.share_r, m.share_r) AS share_r
  FROM raw_values v JOIN steps USING (year)
  LEFT JOIN shares s ON s.country = v.country AND s.year = knot
  LEFT JOIN means m ON m.year = knot AND v.country NOT IN (SELECT country FROM shares)""",
            tail="""
SELECT region, year, round(raw * share_a / 100, 4) AS part_a, round(raw * share_n / 100, 4) AS part_n,
  round(raw * share_r / 100, 4) AS part_r FROM used WHERE share_a IS NOT NULL""",
        ),
    ),
}
