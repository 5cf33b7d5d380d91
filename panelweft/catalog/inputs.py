"""Input frames of the registered queries, built from the given tables.

Each input exists twice: as a function on Spark and, in SQL, as the common
table expression of the same name for the side-by-side check. Money is
counted in whole cents, so sums come out the same in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelweft.operators.zonal import Grid

GRID = Grid(x0=-150.0, y_top=60.0, res_x=2.5, res_y=2.5, n_rows=48, n_cols=120)
WEIGHT_YEAR = 1998


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Its schema is read from the files once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def cents(col) -> F.Column:
    return F.round(F.col(col) * 100)


def regions(spark, d):
    """region, country, c_custkey, nationkey, weight: one row per customer."""
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    customer = table(spark, d, "customer")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.concat_ws(".", "n_name", F.col("c_custkey").cast("string")).alias("region"),
        F.col("n_name").alias("country"),
        "c_custkey",
        F.col("n_nationkey").alias("nationkey"),
        F.greatest(cents("c_acctbal"), F.lit(0.0)).alias("weight"),
    )


def order_sums(spark, d, *by):
    """Order value per customer and year (and further order columns), summed
    before anything is joined so that a busy customer is one row."""
    orders = table(spark, d, "orders")
    return orders.groupBy(
        "o_custkey", F.year("o_orderdate").alias("year"), *by
    ).agg(F.sum(cents("o_totalprice")).alias("total"), F.count(F.lit(1)).alias("n_orders"))


def homes(spark, d):
    """c_custkey to country and nationkey."""
    return regions(spark, d).select("region", "c_custkey", "country", "nationkey")


def located(spark, d, sums):
    return sums.join(homes(spark, d), F.col("o_custkey") == F.col("c_custkey"))


def control(spark, d):
    """country, nationkey, year, total: order value per nation and year."""
    rows = located(spark, d, order_sums(spark, d))
    return rows.groupBy("country", "nationkey", "year").agg(F.sum("total").alias("total"))


def by_scenario(spark, d):
    """scenario, country, nationkey, year, total, n_orders."""
    rows = located(spark, d, order_sums(spark, d, "o_orderpriority"))
    return rows.groupBy(
        F.concat(F.lit("SSP"), F.substring("o_orderpriority", 1, 1)).alias("scenario"),
        "country",
        "nationkey",
        "year",
    ).agg(F.sum("total").alias("total"), F.sum("n_orders").alias("n_orders"))


def raw_values(spark, d):
    """region, country, nationkey, year, raw: order value per customer and
    year."""
    return located(spark, d, order_sums(spark, d)).select(
        "region", "country", "nationkey", "year", F.col("total").alias("raw")
    )


def revenue(spark, d):
    """country, nationkey, year, total: lineitem value per nation and ship
    year."""
    per_order = (
        table(spark, d, "lineitem")
        .groupBy("l_orderkey", F.year("l_shipdate").alias("year"))
        .agg(F.sum(cents("l_extendedprice")).alias("total"))
    )
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    per_customer = (
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", "year")
        .agg(F.sum("total").alias("total"))
    )
    rows = located(spark, d, per_customer)
    return rows.groupBy("country", "nationkey", "year").agg(F.sum("total").alias("total"))


def model_a(spark, d):
    """The leading source: alternate years, without every fifth nation."""
    rows = control(spark, d).where("nationkey % 5 <> 0 and year % 2 = 1")
    return rows.select("country", "year", F.col("total").alias("value"))


def model_b(spark, d):
    """The late source: from 1998, without 1999 and every third nation."""
    rows = revenue(spark, d).where("nationkey % 3 <> 0 and year >= 1998 and year <> 1999")
    return rows.select("country", "year", F.col("total").alias("value"))


def boxes(spark, d):
    """region, country, lon0, lat0, lon1, lat1: one box per supplier."""
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    return s.selectExpr(
        "concat('S', s_nationkey, '.', s_suppkey) as region",
        "concat('S', s_nationkey) as country",
        "s_suppkey",
        "(s_suppkey * 7919 % 3200) / 10.0D - 160 - (1 + s_suppkey % 9) as lon0",
        "(s_suppkey * 104729 % 1400) / 10.0D - 70 - (0.5D + s_suppkey % 5) as lat0",
        "(s_suppkey * 7919 % 3200) / 10.0D - 160 + (1 + s_suppkey % 9) as lon1",
        "(s_suppkey * 104729 % 1400) / 10.0D - 70 + (0.5D + s_suppkey % 5) as lat1",
    )


def cell_orders(spark, d):
    """cell_row, cell_col, year, total, n_orders: orders dropped on the grid
    by customer key."""
    sums = order_sums(spark, d)
    return sums.groupBy(
        (F.col("o_custkey") * 31 % GRID.n_rows).cast("int").alias("cell_row"),
        (F.col("o_custkey") * 17 % GRID.n_cols).cast("int").alias("cell_col"),
        "year",
    ).agg(F.sum("total").alias("total"), F.sum("n_orders").alias("n_orders"))


def cell_values(spark, d):
    gap = "(cell_row + cell_col + year) % 11 = 0"
    return cell_orders(spark, d).select(
        "cell_row", "cell_col", "year", F.expr(f"case when not ({gap}) then total end").alias("value")
    )


def cell_people(spark, d):
    gap = "(cell_row * cell_col + year) % 13 = 0"
    return cell_orders(spark, d).select(
        "cell_row",
        "cell_col",
        "year",
        F.expr(f"case when not ({gap}) then cast(n_orders % 4 as double) end").alias("value"),
    )


# --- the same inputs in SQL ------------------------------------------------

_SQL = {
    "regions": """
  SELECT n_name || '.' || c_custkey AS region, n_name AS country, c_custkey,
         n_nationkey AS nationkey, greatest(round(c_acctbal * 100), 0) AS weight
  FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "control": """
  SELECT country, nationkey, CAST(year(o_orderdate) AS INTEGER) AS year,
         sum(round(o_totalprice * 100)) AS total
  FROM orders JOIN regions ON o_custkey = c_custkey GROUP BY 1, 2, 3""",
    "by_scenario": """
  SELECT 'SSP' || substr(o_orderpriority, 1, 1) AS scenario, country, nationkey,
         CAST(year(o_orderdate) AS INTEGER) AS year,
         sum(round(o_totalprice * 100)) AS total, count(*) AS n_orders
  FROM orders JOIN regions ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4""",
    "raw_values": """
  SELECT region, country, nationkey, CAST(year(o_orderdate) AS INTEGER) AS year,
         sum(round(o_totalprice * 100)) AS raw
  FROM orders JOIN regions ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4""",
    "revenue": """
  SELECT country, nationkey, CAST(year(l_shipdate) AS INTEGER) AS year,
         sum(round(l_extendedprice * 100)) AS total
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN regions ON o_custkey = c_custkey GROUP BY 1, 2, 3""",
    "model_a": """
  SELECT country, year, total AS value FROM control
  WHERE nationkey % 5 <> 0 AND year % 2 = 1""",
    "model_b": """
  SELECT country, year, total AS value FROM revenue
  WHERE nationkey % 3 <> 0 AND year >= 1998 AND year <> 1999""",
    "annual_a": "{log_path:model_a}",
    "annual_b": "{log_path:model_b}",
    "growth_a": """
  SELECT a.country, a.year, a.value / b.value AS growth
  FROM annual_a a JOIN annual_a b ON a.country = b.country AND b.year = 1996
  WHERE a.year > 1996""",
    "growth_b98": """
  SELECT a.country, a.year, a.value / b.value AS growth
  FROM annual_b a JOIN annual_b b ON a.country = b.country AND b.year = 1998
  WHERE a.year > 1998""",
    "bridged": """
  SELECT country, year, growth FROM growth_a
  WHERE year <= 1998 AND country IN (SELECT country FROM annual_b)
  UNION ALL
  SELECT b.country, b.year, a.growth * b.growth FROM growth_b98 b
  JOIN growth_a a ON a.country = b.country AND a.year = 1998""",
    "alone": """
  SELECT country, pow(max(value) FILTER (year = 2001) / max(value) FILTER (year = 1998),
         1.0 / 3) AS rate
  FROM annual_b WHERE country NOT IN (SELECT country FROM growth_a) GROUP BY 1""",
    "bridged_alone": """
  SELECT country, CAST(1996 + k AS INTEGER) AS year, pow(rate, k) AS growth
  FROM alone, (VALUES (1), (2)) steps(k)
  UNION ALL
  SELECT b.country, b.year, pow(rate, 2) * b.growth FROM growth_b98 b JOIN alone USING (country)""",
    "late_growth": "SELECT * FROM bridged UNION ALL SELECT * FROM bridged_alone",
    "crossed": """
  SELECT * FROM late_growth UNION ALL
  SELECT * FROM growth_a WHERE country NOT IN (SELECT country FROM late_growth)""",
    "covered": """
  SELECT * FROM crossed UNION ALL
  SELECT n.country, g.year, g.growth
  FROM (SELECT DISTINCT country FROM control
        WHERE country NOT IN (SELECT country FROM crossed)) n,
       (SELECT year, exp(avg(ln(growth))) AS growth FROM crossed GROUP BY year) g""",
    "boxes": """
  SELECT 'S' || s_nationkey || '.' || s_suppkey AS region, 'S' || s_nationkey AS country, s_suppkey,
    (s_suppkey * 7919 % 3200) / 10.0::DOUBLE - 160 - (1 + s_suppkey % 9) AS lon0,
    (s_suppkey * 104729 % 1400) / 10.0::DOUBLE - 70 - (0.5::DOUBLE + s_suppkey % 5) AS lat0,
    (s_suppkey * 7919 % 3200) / 10.0::DOUBLE - 160 + (1 + s_suppkey % 9) AS lon1,
    (s_suppkey * 104729 % 1400) / 10.0::DOUBLE - 70 + (0.5::DOUBLE + s_suppkey % 5) AS lat1
  FROM supplier""",
    "box_cells": """
  SELECT region, country, CAST(r.range AS INTEGER) AS cell_row, CAST(c.range AS INTEGER) AS cell_col,
    (least((60 - lat0) / 2.5, r.range + 1) - greatest((60 - lat1) / 2.5, r.range))
    * (least((lon1 + 150) / 2.5, c.range + 1) - greatest((lon0 + 150) / 2.5, c.range)) AS frac
  FROM boxes, range(48) r, range(120) c
  WHERE (60 - lat0) / 2.5 > r.range AND (60 - lat1) / 2.5 < r.range + 1
    AND (lon1 + 150) / 2.5 > c.range AND (lon0 + 150) / 2.5 < c.range + 1""",
    "cell_orders": """
  SELECT CAST(o_custkey * 31 % 48 AS INTEGER) AS cell_row, CAST(o_custkey * 17 % 120 AS INTEGER) AS cell_col,
    CAST(year(o_orderdate) AS INTEGER) AS year, sum(round(o_totalprice * 100)) AS total,
    count(*) AS n_orders
  FROM orders GROUP BY 1, 2, 3""",
    "cells": """
  SELECT cell_row, cell_col, year,
    CASE WHEN (cell_row + cell_col + year) % 11 <> 0 THEN total END AS value,
    CASE WHEN (cell_row * cell_col + year) % 13 <> 0 THEN CAST(n_orders % 4 AS DOUBLE) END AS people,
    coalesce(max(CASE WHEN year = 1998 AND (cell_row * cell_col + year) % 13 <> 0
      THEN CAST(n_orders % 4 AS DOUBLE) END) OVER (PARTITION BY cell_row, cell_col), 0) AS weight
  FROM cell_orders""",
    "measured": """
  SELECT region, year,
    sum(value * weight * frac) / nullif(sum(CASE WHEN value IS NOT NULL THEN weight * frac END), 0) AS by_people,
    sum(value * frac) / nullif(sum(CASE WHEN value IS NOT NULL THEN frac END), 0) AS by_area,
    sum(people * frac) AS pop,
    sum(people / area * people * frac) / nullif(sum(people * frac), 0) AS pop_wtd_density
  FROM box_cells JOIN cells USING (cell_row, cell_col) JOIN cell_area USING (cell_row)
  GROUP BY 1, 2""",
    "zonal": """
  SELECT region, country, year, by_people IS NULL AS zero_pop,
    coalesce(by_people, by_area) AS gdppc, coalesce(pop, 0) AS pop,
    coalesce(pop_wtd_density, 0) AS pop_wtd_density
  FROM (SELECT region, country, year FROM boxes, (SELECT DISTINCT year FROM cells)) s
  LEFT JOIN measured USING (region, year)""",
}

_SQL["cell_area"] = ""

_NEEDS = {
    "control": ["regions"],
    "by_scenario": ["regions"],
    "raw_values": ["regions"],
    "revenue": ["regions"],
    "model_a": ["control"],
    "model_b": ["revenue"],
    "annual_a": ["model_a"],
    "annual_b": ["model_b"],
    "growth_a": ["annual_a"],
    "growth_b98": ["annual_b"],
    "bridged": ["growth_a", "growth_b98"],
    "alone": ["annual_b", "growth_a"],
    "bridged_alone": ["alone", "growth_b98"],
    "late_growth": ["bridged", "bridged_alone"],
    "crossed": ["late_growth", "growth_a"],
    "covered": ["crossed", "control"],
    "box_cells": ["boxes"],
    "cells": ["cell_orders"],
    "measured": ["box_cells", "cells", "cell_area"],
    "zonal": ["boxes", "measured"],
}


def knots_sql(source: str, key: str, value: str = "value", log: bool = False) -> str:
    """SQL of an annual path between the positive knots of a table."""
    part = "((y.y - t0) / CAST(t1 - t0 AS DOUBLE))"
    between = (
        f"exp(ln(v0) + (ln(v1) - ln(v0)) * {part})" if log else f"v0 + (v1 - v0) * {part}"
    )
    return f"""
  SELECT {key}, CAST(y.y AS INTEGER) AS year,
    CASE WHEN y.y = t0 THEN v0 ELSE {between} END AS {value}
  FROM (SELECT {key}, year AS t0, {value} AS v0,
          lead(year) OVER w AS t1, lead({value}) OVER w AS v1, lag(year) OVER w AS t_before
        FROM {source} WHERE {value} > 0 WINDOW w AS (PARTITION BY {key} ORDER BY year)) k,
    unnest(generate_series(t0, coalesce(t1 - 1, t0))) y(y)
  WHERE t1 IS NOT NULL OR t_before IS NOT NULL"""


def _under(arg: str) -> str:
    """SQL of the area between the equator and a latitude, per grid column."""
    a2, f = 6378.137**2, 1 / 298.257223563
    e2 = f * (2 - f)
    e, d = e2**0.5, 2.5 * 3.141592653589793 / 180
    s = f"sin({arg})"
    return (
        f"({a2 * (1 - e2) / 2 * d!r} * ({s} / (1 - {e2!r} * {s} * {s})"
        f" + ln((1 + {e!r} * {s}) / (1 - {e!r} * {s})) / {2 * e!r})"
        f" + {a2!r} / (1 - {e2!r} * {s} * {s}) * {s} * pow(cos({arg}), 2) * {d**3 / 12!r})"
    )


def _text(name: str) -> str:
    sql = _SQL[name]
    if sql.startswith("{log_path:"):
        return knots_sql(sql[10:-1], "country", log=True)
    if name == "cell_area":
        top, bottom = "radians(60 - range * 2.5::DOUBLE)", "radians(60 - (range + 1) * 2.5::DOUBLE)"
        return f"\n  SELECT CAST(range AS INTEGER) AS cell_row, {_under(top)} - {_under(bottom)} AS area FROM range(48)"
    return sql


def sql(*names: str, tail: str, **extra: str) -> str:
    """A query over the named inputs, further named expressions, and `tail`."""
    order: list[str] = []

    def add(name):
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({_text(n)})" for n in order] + [f"{n} AS ({q})" for n, q in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n" + tail if parts else tail
