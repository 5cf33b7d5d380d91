"""Queries on calibration, fallbacks, imputation and smoothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweft.catalog import inputs as src
from panelweft.catalog.inputs import sql
from panelweft.operators import fill, smooth
from panelweft.scale import bounded, materialise

KEY = ["country"]


def _calibrated(spark, d):
    raw = src.raw_values(spark, d)
    shape = src.revenue(spark, d).where("nationkey % 4 <> 1").select(
        "country", "year", F.col("total").alias("shape")
    )
    level = src.control(spark, d).where("nationkey % 3 <> 1 and not (nationkey = 5 and year < 1998)")
    level = level.select("country", "year", (F.col("total") / 2).alias("level"))
    national = bounded(shape.join(level, ["country", "year"], "full"))
    joined = raw.join(national, ["country", "year"], "left")
    return joined.withColumn("value", fill.calibrate_share("raw", "shape", "level"))


def _show(df):
    return df.select("region", "country", "year", F.round(F.col("value") / 100, 6).alias("value"))


def calibrate_share(spark, d):
    return _show(_calibrated(spark, d))


def group_fallback(spark, d):
    return _show(
        fill.fallback_whole_group(_calibrated(spark, d), KEY, "value", F.col("raw") * 0.81556)
    )


def row_fallback(spark, d):
    """Customers without orders in a year take a national level, a scaled
    shape or the all-nation mean, if their weight is large enough."""
    regions = src.regions(spark, d).select("region", "country", "weight")
    spine = regions.withColumn("year", F.explode(F.sequence(F.lit(1995), F.lit(2001))))
    raw = src.raw_values(spark, d).select("region", "year", "raw")
    level = materialise(
        src.control(spark, d).where("nationkey % 3 <> 1").select(
            "country", "year", F.col("total").alias("level")
        ),
        "level",
    )
    shape = src.revenue(spark, d).where("nationkey % 2 = 0").select(
        "country", "year", F.col("total").alias("shape")
    )
    typical = level.groupBy("year").agg(F.avg("level").alias("typical"))
    rows = (
        spine.join(raw, ["region", "year"], "left")
        .join(bounded(shape.join(level, ["country", "year"], "full")), ["country", "year"], "left")
        .join(bounded(typical), "year", "left")
        .withColumn("value", F.col("raw"))
    )
    empty = F.col("raw").isNull() & (F.col("weight") > 50000)
    return _show(
        fill.fallback_chain(rows, "value", empty, "level", F.col("shape") * 0.81556, "typical")
    )


def update_join(spark, d):
    rows = src.raw_values(spark, d).select("region", "country", "year", F.col("raw").alias("value"))
    patch = src.regions(spark, d).where("c_custkey % 7 = 0").select(
        "region", F.lit(1999).alias("year"), F.when(F.col("weight") > 0, F.col("weight")).alias("value")
    )
    return _show(fill.update_join(rows, patch, ["region", "year"], "value"))


def extend_spine(spark, d):
    rows = src.raw_values(spark, d).select("region", "year", "raw")
    return fill.extend_spine(rows, rows.select("region").distinct(), 1990, 1994)


def _daily(spark, d):
    """user_id, day, value: one row per user and day of January, gaps null."""
    events = src.table(spark, d, "events")
    daily = events.groupBy("user_id", F.dayofmonth("ts").alias("day")).agg(
        F.sum(F.round(F.col("value") * 100)).alias("value")
    )
    days = daily.select("user_id").distinct().withColumn(
        "day", F.explode(F.sequence(F.lit(1), F.lit(30)))
    )
    return days.join(daily, ["user_id", "day"], "left")


def kernel_smooth(spark, d):
    out = smooth.kernel_smooth(_daily(spark, d), ["user_id"], "value", "smooth", 13, "day")
    return out.select("user_id", "day", F.round("smooth", 6).alias("smooth"))


def period_mean(spark, d):
    mean = fill.period_mean(["user_id"], 5, 15, "day", "value")
    out = _daily(spark, d).withColumn("mean", mean)
    return out.select("user_id", "day", F.round("mean", 6).alias("mean"))


def regime_smooth(spark, d):
    out = smooth.regime_smooth(_daily(spark, d), ["user_id"], "value", "smooth", 5, 15, 13, "day")
    zero = smooth.zero_from("value", 10, "day")
    return out.select("user_id", "day", F.round("smooth", 6).alias("smooth"), zero.alias("value0"))


_CALIBRATED = """SELECT v.region, v.country, year, raw,
    CASE WHEN s.total > 0 THEN raw / s.total * (c.total / 2) END AS value
  FROM raw_values v
  LEFT JOIN (SELECT * FROM revenue WHERE nationkey % 4 <> 1) s USING (country, year)
  LEFT JOIN (SELECT * FROM control WHERE nationkey % 3 <> 1 AND NOT (nationkey = 5 AND year < 1998)) c
    USING (country, year)"""
_SHOW = "SELECT region, country, year, round(value / 100, 6) AS value FROM "
_DAILY = """SELECT u.user_id, CAST(dd.range AS INTEGER) AS day, value
  FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN range(1, 31) dd
  LEFT JOIN (SELECT user_id, CAST(day(ts) AS INTEGER) AS day, sum(round(value * 100)) AS value
             FROM events GROUP BY 1, 2) e ON e.user_id = u.user_id AND e.day = dd.range"""
# the kernel spelled out: a weight per row pair, oldest row of the frame heaviest
_KERNEL = """SELECT a.user_id, a.day, sum(b.{v} * (13 - (b.day - greatest(1, a.day - 12))))
      / sum(CASE WHEN b.{v} IS NOT NULL THEN 13 - (b.day - greatest(1, a.day - 12)) END) AS smooth
  FROM {t} a JOIN {t} b ON a.user_id = b.user_id AND b.day BETWEEN a.day - 12 AND a.day
  GROUP BY 1, 2"""

QUERIES = {
    "calibrate_share": (
        calibrate_share,
        sql("raw_values", "revenue", "control", c=_CALIBRATED, tail=_SHOW + "c"),
    ),
    "group_fallback": (
        group_fallback,
        sql(
            "raw_values",
            "revenue",
            "control",
            c=_CALIBRATED,
            f="""SELECT region, country, year, CASE WHEN max(value) OVER (PARTITION BY country) IS NULL
    THEN raw * 0.81556 ELSE value END AS value FROM c""",
            tail=_SHOW + "f",
        ),
    ),
    "row_fallback": (
        row_fallback,
        sql(
            "regions",
            "raw_values",
            "control",
            "revenue",
            level="SELECT country, year, total AS level FROM control WHERE nationkey % 3 <> 1",
            f="""SELECT r.region, r.country, CAST(y.range AS INTEGER) AS year,
    CASE WHEN raw IS NULL AND weight > 50000 THEN coalesce(level, s.total * 0.81556,
      (SELECT avg(level) FROM level t WHERE t.year = y.range)) ELSE raw END AS value
  FROM regions r CROSS JOIN range(1995, 2002) y
  LEFT JOIN raw_values v ON v.region = r.region AND v.year = y.range
  LEFT JOIN level l ON l.country = r.country AND l.year = y.range
  LEFT JOIN (SELECT * FROM revenue WHERE nationkey % 2 = 0) s ON s.country = r.country AND s.year = y.range""",
            tail=_SHOW + "f",
        ),
    ),
    "update_join": (
        update_join,
        sql(
            "raw_values",
            "regions",
            u="""SELECT v.region, v.country, year, CASE WHEN year = 1999 AND c_custkey % 7 = 0
    THEN CASE WHEN weight > 0 THEN weight END ELSE raw END AS value
  FROM raw_values v JOIN regions USING (region)""",
            tail=_SHOW + "u",
        ),
    ),
    "extend_spine": (
        extend_spine,
        sql(
            "raw_values",
            tail="""
SELECT region, year, raw FROM raw_values
UNION ALL SELECT region, CAST(y AS INTEGER), NULL
FROM (SELECT DISTINCT region FROM raw_values), unnest(generate_series(1990, 1994)) u(y)""",
        ),
    ),
    "kernel_smooth": (
        kernel_smooth,
        sql(
            daily=_DAILY,
            k=_KERNEL.format(v="value", t="daily"),
            tail="SELECT user_id, day, round(smooth, 6) AS smooth FROM k",
        ),
    ),
    "period_mean": (
        period_mean,
        sql(
            daily=_DAILY,
            tail="""
SELECT user_id, day, round(avg(value) FILTER (day BETWEEN 5 AND 15) OVER (PARTITION BY user_id), 6) AS mean
FROM daily""",
        ),
    ),
    "regime_smooth": (
        regime_smooth,
        sql(
            daily=_DAILY,
            base="""SELECT user_id, day, value, CASE WHEN day <= 15
    THEN avg(value) FILTER (day BETWEEN 5 AND 15) OVER (PARTITION BY user_id) ELSE value END AS b
  FROM daily""",
            k=_KERNEL.format(v="b", t="base"),
            tail="""
SELECT user_id, day, round(coalesce(CASE WHEN day > 15 THEN smooth ELSE b END, 0), 6) AS smooth,
  CASE WHEN day >= 10 THEN coalesce(value, 0) ELSE value END AS value0
FROM base JOIN k USING (user_id, day)""",
        ),
    ),
}
