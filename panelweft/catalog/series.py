"""Queries on interpolation, growth chains, splices and step lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweft.catalog import inputs as src
from panelweft.catalog.inputs import knots_sql, sql
from panelweft.operators import fill, series
from panelweft.operators.cohorts import splice_eras
from panelweft.scale import materialise

KEY = ["country"]


def _sparse_control(spark, d):
    rows = src.control(spark, d).where("year in (1995, 1998, 2001)")
    return rows.select("country", "year", F.col("total").alias("value"))


def interp_linear(spark, d):
    path = series.interpolate(_sparse_control(spark, d), KEY)
    return path.select("country", "year", F.round(F.col("value") / 1e6, 7).alias("value"))


def interp_loglinear(spark, d):
    path = series.interpolate(_sparse_control(spark, d), KEY, log=True)
    return path.select("country", "year", F.round(F.col("value") / 1e6, 7).alias("value"))


def interp_regions(spark, d):
    """Every customer's own sparse series, many short series at once."""
    raw = src.raw_values(spark, d).withColumnRenamed("raw", "value")
    path = series.interpolate(raw, ["region"], log=True)
    return path.select("region", "year", F.round(F.col("value") / 1e6, 7).alias("value"))


def _annual(spark, d):
    """Both sources, every year. Each chain below reads them several times,
    so the sums over the fact tables are written once."""
    a = series.interpolate(src.model_a(spark, d), KEY, log=True)
    b = series.interpolate(src.model_b(spark, d), KEY, log=True)
    return materialise(a, "annual_a"), materialise(b, "annual_b")


def _growths(spark, d):
    a, b = _annual(spark, d)
    lead = materialise(series.growth_since(a, KEY, 1996), "lead")
    return lead, materialise(series.late_growth(lead, b, KEY, 1998, 2001), "late")


def _shown(df, digits=9):
    return df.select("country", "year", F.round("growth", digits).alias("growth"))


def growth_to_base(spark, d):
    return _shown(series.growth_since(_annual(spark, d)[0], KEY, 1996))


def bridge_chain(spark, d):
    a, b = _annual(spark, d)
    return _shown(series.bridge_and_chain(series.growth_since(a, KEY, 1996), b, KEY, 1998))


def annualised_bridge(spark, d):
    a, b = _annual(spark, d)
    return _shown(series.bridge_alone(series.growth_since(a, KEY, 1996), b, KEY, 1998, 2001))


def _crossed(spark, d):
    lead, late = _growths(spark, d)
    return series.cross_fill(late, lead, KEY)


def cross_fill(spark, d):
    return _shown(_crossed(spark, d))


def _covered(spark, d):
    crossed = materialise(_crossed(spark, d), "crossed")
    return series.fill_uncovered(crossed, src.homes(spark, d), "country")


def fill_uncovered(spark, d):
    return _shown(_covered(spark, d))


def project(spark, d):
    base = src.raw_values(spark, d).where("year = 1996").select("region", "country", "raw")
    ahead = series.project(base, _covered(spark, d), KEY, "raw")
    return ahead.select("region", "year", F.round(F.col("raw") / 1e6, 7).alias("value"))


def year_ratio(spark, d):
    rows = src.control(spark, d)
    out = series.ratio_between(rows, KEY, 1999, 2000, value="total")
    return out.select("country", F.round("ratio", 10).alias("ratio"))


def geomean_by_year(spark, d):
    out = series.geomean_by(src.raw_values(spark, d), ["year"], "raw", "mean")
    return out.select("year", F.round(F.col("mean") / 1e6, 7).alias("mean"))


def roll_forward(spark, d):
    rows = src.raw_values(spark, d).select("region", "country", "year", F.col("raw").alias("value"))
    control = src.control(spark, d)
    first = series.ratio_between(
        control.where("nationkey % 3 <> 0"), KEY, 1999, 2000, value="total", out="g1"
    )
    second = series.ratio_between(
        src.revenue(spark, d).where("nationkey % 2 = 0"), KEY, 1999, 2000, value="total", out="g2"
    )
    default = series.geomean_by(second, [], "g2", "g").scalar()
    ahead = fill.roll_forward(rows, KEY, 2000, [(first, "g1"), (second, "g2")], default)
    return ahead.select("region", "year", F.round(F.col("value") / 1e6, 7).alias("value"))


def splice_rebase(spark, d):
    a = src.control(spark, d).where("nationkey % 4 <> 0")
    b = src.revenue(spark, d).where("nationkey % 3 <> 0")
    spliced = series.splice_rebase(
        a.select("country", "year", F.col("total").alias("value")),
        b.select("country", "year", F.col("total").alias("value")),
        KEY,
        handoff=1998,
        since=1996,
    )
    return spliced.select("country", "year", F.round(F.col("value") / 1e6, 7).alias("value"))


def step_lookup(spark, d):
    """Every fifth day is a knot: daily values held until the next knot day;
    knots are shared by all users."""
    events = src.table(spark, d, "events")
    daily = (
        events.groupBy("user_id", F.dayofmonth("ts").alias("year"))
        .agg(F.sum(F.round(F.col("value") * 100)).alias("value"))
        .where("year in (3, 8, 13, 18, 23, 28)")
    )
    return series.step_lookup(daily, 1, 31).select("user_id", "year", "value")


def eras(spark, d):
    """History shared by all scenarios, then each scenario's own rows."""
    rows = src.by_scenario(spark, d)
    tagged = rows.where("(year < 1998) = (scenario = 'SSP1')").select(
        F.when(F.col("year") < 1998, "historical").otherwise("projection").alias("era"),
        "scenario",
        "country",
        "year",
        "total",
    )
    return splice_eras(tagged, ["SSP2", "SSP3"], (1995, 1997), 1999)


def override_path(spark, d):
    """One nation's 1997-2001 values replaced by a path between anchors."""
    raw = src.raw_values(spark, d)
    control = src.control(spark, d)
    one = F.col("country") == "NATION_3"
    start = control.where(one & (F.col("year") == 1996)).select(
        "country", F.col("total").alias("start")
    )
    end = (
        src.revenue(spark, d)
        .where(one & (F.col("year") == 2001))
        .select("country", F.col("total").alias("end"))
    )
    path = fill.log_path(start.join(end, "country"), KEY, 1996, 2001, 1997, 2000)
    shape = control.select("country", "year", F.col("total").alias("shape"))
    shaped = raw.where(one).join(shape, ["country", "year"])
    rows = raw.select("region", "country", "year", F.col("raw").alias("value"))
    out = fill.override_path(rows, shaped, path, KEY, ["region"], 1997, 2000)
    return out.select("region", "country", "year", F.round(F.col("value") / 1e6, 7).alias("value"))


_SPARSE = "SELECT country, year, total AS value FROM control WHERE year IN (1995, 1998, 2001)"
_GROWTH = "SELECT country, year, round(growth, 9) AS growth FROM "

QUERIES = {
    "interp_linear": (
        interp_linear,
        sql(
            "control",
            sparse=_SPARSE,
            path=knots_sql("sparse", "country"),
            tail="SELECT country, year, round(value / 1e6, 7) AS value FROM path",
        ),
    ),
    "interp_loglinear": (
        interp_loglinear,
        sql(
            "control",
            sparse=_SPARSE,
            path=knots_sql("sparse", "country", log=True),
            tail="SELECT country, year, round(value / 1e6, 7) AS value FROM path",
        ),
    ),
    "interp_regions": (
        interp_regions,
        sql(
            "raw_values",
            path=knots_sql("raw_values", "region", "raw", log=True),
            tail="SELECT region, year, round(raw / 1e6, 7) AS value FROM path",
        ),
    ),
    "growth_to_base": (growth_to_base, sql("growth_a", tail=_GROWTH + "growth_a")),
    "bridge_chain": (bridge_chain, sql("bridged", tail=_GROWTH + "bridged")),
    "annualised_bridge": (annualised_bridge, sql("bridged_alone", tail=_GROWTH + "bridged_alone")),
    "cross_fill": (cross_fill, sql("crossed", tail=_GROWTH + "crossed")),
    "fill_uncovered": (fill_uncovered, sql("covered", tail=_GROWTH + "covered")),
    "project": (
        project,
        sql(
            "raw_values",
            "covered",
            tail="""
SELECT region, c.year, round(raw * growth / 1e6, 7) AS value
FROM raw_values r JOIN covered c ON r.country = c.country WHERE r.year = 1996""",
        ),
    ),
    "year_ratio": (
        year_ratio,
        sql(
            "control",
            tail="""
SELECT country, round(b.total / a.total, 10) AS ratio
FROM control a JOIN control b USING (country)
WHERE a.year = 1999 AND b.year = 2000 AND a.total > 0""",
        ),
    ),
    "geomean_by_year": (
        geomean_by_year,
        sql(
            "raw_values",
            tail="""
SELECT year, round(exp(avg(ln(raw))) / 1e6, 7) AS mean
FROM raw_values WHERE raw > 0 GROUP BY year""",
        ),
    ),
    "roll_forward": (
        roll_forward,
        sql(
            "raw_values",
            "control",
            "revenue",
            g1="""SELECT country, b.total / a.total AS g FROM control a JOIN control b USING (country)
  WHERE a.year = 1999 AND b.year = 2000 AND a.nationkey % 3 <> 0""",
            g2="""SELECT country, b.total / a.total AS g FROM revenue a JOIN revenue b USING (country)
  WHERE a.year = 1999 AND b.year = 2000 AND a.nationkey % 2 = 0""",
            tail="""
SELECT region, CAST(2001 AS INTEGER) AS year,
  round(raw * coalesce(g1.g, g2.g, (SELECT exp(avg(ln(g))) FROM g2)) / 1e6, 7) AS value
FROM raw_values r LEFT JOIN g1 ON r.country = g1.country LEFT JOIN g2 ON r.country = g2.country
WHERE r.year = 2000""",
        ),
    ),
    "splice_rebase": (
        splice_rebase,
        sql(
            "control",
            "revenue",
            a="SELECT country, year, total FROM control WHERE nationkey % 4 <> 0",
            b="SELECT country, year, total FROM revenue WHERE nationkey % 3 <> 0",
            anchors="""SELECT a.country, a.total AS wa, b.total AS wb FROM a JOIN b USING (country, year)
  WHERE year = 1998""",
            knots="""SELECT country, year, total AS value FROM a
  WHERE year >= 1996 AND (year <= 1998 OR country NOT IN (SELECT country FROM anchors))
  UNION ALL SELECT country, year, wa * total / wb FROM b JOIN anchors USING (country) WHERE year > 1998""",
            path=knots_sql("knots", "country"),
            tail="SELECT country, year, round(value / 1e6, 7) AS value FROM path",
        ),
    ),
    "step_lookup": (
        step_lookup,
        """
WITH daily AS (
  SELECT user_id, CAST(day(ts) AS INTEGER) AS knot, sum(round(value * 100)) AS value
  FROM events WHERE day(ts) IN (3, 8, 13, 18, 23, 28) GROUP BY 1, 2),
spine AS (SELECT CAST(range AS INTEGER) AS year FROM range(1, 32)),
knots AS (SELECT DISTINCT knot FROM daily)
SELECT user_id, year, value
FROM spine ASOF JOIN knots ON year >= knot JOIN daily USING (knot)""",
    ),
    "splice_eras": (
        eras,
        sql(
            "by_scenario",
            tail="""
SELECT s.scenario, country, year, total FROM by_scenario b,
  (VALUES ('SSP2'), ('SSP3')) s(scenario)
WHERE year < 1998 AND b.scenario = 'SSP1'
UNION ALL
SELECT scenario, country, year, total FROM by_scenario
WHERE year >= 1999 AND scenario IN ('SSP2', 'SSP3')""",
        ),
    ),
    "override_path": (
        override_path,
        sql(
            "raw_values",
            "control",
            "revenue",
            anchors="""SELECT c.total AS v0, r.total AS v1 FROM control c JOIN revenue r USING (country)
  WHERE country = 'NATION_3' AND c.year = 1996 AND r.year = 2001""",
            path="""SELECT CAST(y AS INTEGER) AS year, v0 * exp(ln(v1 / v0) * (y - 1996) / 5.0) AS path
  FROM anchors, unnest(generate_series(1997, 2000)) u(y)""",
            shaped="""SELECT region, r.country, year, raw / total * path AS value
  FROM raw_values r JOIN control c USING (country, year) JOIN path USING (year)
  WHERE r.country = 'NATION_3' AND year <= 1999""",
            tail="""
SELECT region, country, year, round(raw / 1e6, 7) AS value FROM raw_values
WHERE country <> 'NATION_3' OR year < 1997
UNION ALL SELECT region, country, year, round(value / 1e6, 7) FROM shaped
UNION ALL SELECT region, country, CAST(2000 AS INTEGER),
  round(value / (SELECT path FROM path WHERE year = 1999)
        * (SELECT path FROM path WHERE year = 2000) / 1e6, 7)
FROM shaped WHERE year = 1999""",
        ),
    ),
}
