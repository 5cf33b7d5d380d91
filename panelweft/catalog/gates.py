"""Queries on the data-quality gates, with contracts broken on purpose."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweft.catalog import inputs as src
from panelweft.catalog.inputs import sql
from panelweft.operators import checks
from panelweft.operators.assemble import (
    PANEL_COLUMNS,
    combos,
    derive,
    left_join_all,
    pick_base_year,
    project_and_order,
    zero_fill,
)
from panelweft.operators.checks import Expected
from panelweft.operators.smooth import zero_from

GROUP = ["scenario", "gdp_model"]


def _assembled(spark, d, scenarios=("SSP2", "SSP3"), models=("OECD", "IIASA")):
    """A small-span panel: customers by order year, population from weights,
    some customers without a weight, density or cohort."""
    regions = src.regions(spark, d)
    ids = regions.select(F.col("region").alias("hierid"), F.col("country").alias("iso3"), "c_custkey")
    spine = ids.withColumn("year", F.explode(F.sequence(F.lit(1995), F.lit(2001))))
    raw = src.raw_values(spark, d).select(
        F.col("region").alias("hierid"), "year", (F.col("raw") / 100).alias("gdppc_raw")
    )
    income = combos(
        spine.join(raw, ["hierid", "year"], "left"), scenario=scenarios, gdp_model=models
    )
    lift = F.when((F.col("scenario") == "SSP3") & (F.col("year") > 1998), 2.0).otherwise(1.0)
    income = income.withColumn("gdppc", F.coalesce("gdppc_raw", F.lit(0.0)))
    income = income.withColumn("gdppc_raw0", zero_from("gdppc_raw", 1990))

    years = combos(spine, scenario=scenarios).where("c_custkey % 23 <> 0")
    weight = regions.select(F.col("region").alias("hierid"), "weight")
    people = years.join(weight, "hierid").select(
        "scenario", "hierid", "iso3", "year", (F.col("weight") * lift).alias("pop")
    )
    parts = people.select(
        "scenario",
        "hierid",
        "year",
        (F.col("pop") / 4).alias("pop0to4"),
        (F.col("pop") / 2).alias("pop5to64"),
        (F.col("pop") / 4).alias("pop65plus"),
    )
    density = pick_base_year(
        spine.where("c_custkey % 19 <> 0").select(
            "hierid", "year", ((F.col("c_custkey") + F.col("year")) / 4).alias("pop_wtd_density")
        ),
        1998,
    )
    area = ids.select("hierid", (F.col("c_custkey") % 31).cast("double").alias("area_km2"))
    joined = left_join_all(
        income,
        (people, ["scenario", "hierid", "iso3", "year"]),
        (parts, ["scenario", "hierid", "year"]),
        (area, ["hierid"]),
        (density, ["hierid"]),
    )
    filled = zero_fill(joined, ["pop", "pop_wtd_density", "pop0to4", "pop5to64", "pop65plus"])
    return project_and_order(derive(filled), GROUP)


def assemble_panel(spark, d):
    return _assembled(spark, d)


def _custkey():
    return F.substring_index("hierid", ".", -1).cast("long")


def _broken(spark, d):
    """One defect per residue of the customer key, in one combination."""
    panel = _assembled(spark, d, ("SSP2",), ("OECD", "IIASA")).withColumn("k", _custkey() % 101)
    here = F.col("gdp_model") == "IIASA"

    def at(key, year=None):
        hit = here & (F.col("k") == key)
        return hit if year is None else hit & (F.col("year") == year)

    changed = {
        "pop0to4": F.when(at(3), F.col("pop0to4") * 3).otherwise(F.col("pop0to4")),
        "gdp": F.when(at(5), F.col("gdp") * 2 + 1).otherwise(F.col("gdp")),
        "gdppc": F.when(at(7, 1997), -5.0).otherwise(F.col("gdppc")),
        "gdppc_raw": F.when(at(11, 2001), None).otherwise(F.col("gdppc_raw")),
        "gdppc_raw0": F.when(at(13, 1996), None).otherwise(F.col("gdppc_raw0")),
        "pop_density": F.when(at(17), None).otherwise(F.col("pop_density")),
        "area_km2": F.when(at(29), -1.0).otherwise(F.col("area_km2")),
    }
    defective = panel.withColumns(changed).where(~at(23, 1995))
    twice = defective.where(at(19, 1999))
    return defective.unionByName(twice).drop("k").select(*GROUP, *PANEL_COLUMNS)


def quality_report(spark, d):
    n = src.table(spark, d, "customer").count()
    return checks.panel_checks(_broken(spark, d), Expected(n, 1995, 2001), GROUP).select(
        "gdp_model", "check", "ok", "n_bad", "detail"
    )


def missing_panel_report(spark, d):
    """One of four panels is not there, and one has lost a region."""
    n = src.table(spark, d, "customer").count()
    combos = tuple((s, m) for s in ("SSP2", "SSP3") for m in ("IIASA", "OECD"))
    gone = (F.col("scenario") == "SSP3") & (F.col("gdp_model") == "IIASA")
    short = (F.col("scenario") == "SSP2") & (F.col("gdp_model") == "OECD") & (_custkey() == 1)
    panel = _assembled(spark, d).where(~gone & ~short)
    report = checks.panel_checks(panel, Expected(n, 1995, 2001, combos), GROUP)
    return report.select(*GROUP, "check", "ok", "n_bad")


def cross_panel_report(spark, d):
    """Population that depends on the model, area that differs, and two
    scenarios that never part."""
    panel = _assembled(spark, d, ("SSP1", "SSP2", "SSP3"))
    k = _custkey()
    model_bound = (F.col("scenario") == "SSP1") & (F.col("gdp_model") == "OECD") & (k % 200 == 1)
    panel = panel.withColumns(
        {
            "pop": F.when(model_bound, F.col("pop") + 1).otherwise(F.col("pop")),
            "area_km2": F.when((k % 300 == 2) & (F.col("scenario") == "SSP3"), 0.5).otherwise(
                F.col("area_km2")
            ),
        }
    )
    out = checks.cross_panel_checks(panel, ["SSP1", "SSP2", "SSP3"], ["IIASA", "OECD"], 1998)
    return out.select("check", "ok", "n_bad", "detail")


def control_report(spark, d):
    """National sums against a history and rebased trajectories. Some
    nations are off before, after, or only at the seam."""
    control = src.control(spark, d)
    history = control.where("nationkey % 6 <> 5").select(
        F.col("country").alias("iso3"), "year", (F.col("total") / 1e6).alias("pop")
    )
    path = combos(src.revenue(spark, d).where("nationkey % 4 <> 3"), scenario=("SSP2", "SSP3"))
    lift = F.when(F.col("scenario") == "SSP3", F.col("year") - 1990).otherwise(1)
    trajectory = path.select(
        "scenario", F.col("country").alias("iso3"), "year", (F.col("total") * lift).alias("pop")
    )
    spliced = checks.expected_controls(
        combos(history, scenario=("SSP2", "SSP3")), trajectory, 1998, 1995, ["scenario", "iso3"]
    )
    key = F.substring_index("iso3", "_", -1).cast("int")
    off = F.when((key == 1) & (F.col("year") == 1996), 1.1).when(
        (key == 2) & (F.col("year") > 1998), 1.01
    )
    panel = spliced.select(
        "scenario",
        F.lit("OECD").alias("gdp_model"),
        "iso3",
        "year",
        (F.col("pop") * 1e6 * F.coalesce(off, F.lit(1.0))).alias("pop"),
    )
    return checks.control_checks(panel, history, trajectory, 1998, GROUP)


def target_report(spark, d):
    """Raw income times population against a national target."""
    panel = _assembled(spark, d, ("SSP2",), ("OECD",))
    people = F.col("pop")
    target = (
        panel.groupBy("iso3", "year")
        .agg(F.try_divide(F.sum(F.col("gdppc_raw0") * people), F.sum(people)).alias("target"))
        .withColumn(
            "target",
            F.col("target")
            * F.when(F.substring_index("iso3", "_", -1).cast("int") % 8 == 3, 1.01).otherwise(1.0005),
        )
    )
    return checks.target_check(panel, target, 0.1, 1998, GROUP)


_PANEL = """SELECT scenario, gdp_model, region AS hierid, country AS iso3, c_custkey AS k,
    CAST(y.range AS INTEGER) AS year, coalesce(raw / 100, 0) AS gdppc, raw / 100 AS gdppc_raw,
    coalesce(raw / 100, 0) AS gdppc_raw0,
    CASE WHEN c_custkey % 23 <> 0 THEN weight * CASE WHEN scenario = 'SSP3' AND y.range > 1998 THEN 2.0::DOUBLE
      ELSE 1.0::DOUBLE END ELSE 0 END AS pop,
    CAST(c_custkey % 31 AS DOUBLE) AS area_km2,
    CASE WHEN c_custkey % 19 <> 0 THEN (c_custkey + 1998) / 4.0::DOUBLE ELSE 0 END AS pop_wtd_density
  FROM (SELECT region, country, c_custkey, weight FROM regions) r CROSS JOIN range(1995, 2002) y
  CROSS JOIN (VALUES ('SSP1'), ('SSP2'), ('SSP3')) s(scenario)
  CROSS JOIN (VALUES ('OECD'), ('IIASA')) m(gdp_model)
  LEFT JOIN (SELECT region AS rr, year AS yy, raw FROM raw_values) v ON rr = region AND yy = y.range"""
_FULL = """SELECT *, gdppc * pop AS gdp, CASE WHEN area_km2 > 0 THEN pop / area_km2 ELSE 0 END AS pop_density,
    pop / 4 AS pop0to4, pop / 2 AS pop5to64, pop / 4 AS pop65plus FROM p0"""
_DEFECTS = """SELECT * REPLACE (
    CASE WHEN h AND k % 101 = 3 THEN pop0to4 * 3 ELSE pop0to4 END AS pop0to4,
    CASE WHEN h AND k % 101 = 5 THEN gdp * 2 + 1 ELSE gdp END AS gdp,
    CASE WHEN h AND k % 101 = 7 AND year = 1997 THEN -5 ELSE gdppc END AS gdppc,
    CASE WHEN h AND k % 101 = 11 AND year = 2001 THEN NULL ELSE gdppc_raw END AS gdppc_raw,
    CASE WHEN h AND k % 101 = 13 AND year = 1996 THEN NULL ELSE gdppc_raw0 END AS gdppc_raw0,
    CASE WHEN h AND k % 101 = 17 THEN NULL ELSE pop_density END AS pop_density,
    CASE WHEN h AND k % 101 = 29 THEN -1 ELSE area_km2 END AS area_km2)
  FROM (SELECT *, gdp_model = 'IIASA' AS h FROM panel WHERE scenario = 'SSP2')
  WHERE NOT (h AND k % 101 = 23 AND year = 1995)"""
_TWICE = """SELECT * FROM defects UNION ALL
  SELECT * FROM defects WHERE h AND k % 101 = 19 AND year = 1999"""
_BAD = {
    "no_duplicates": None,
    "no_unexpected_na": "pop_density IS NULL",
    "raw0_na_iff_pre1990": "gdppc_raw0 IS NULL",
    "gdppc_band": "gdppc < 0 OR gdppc >= 1e7",
    "non_negative": "area_km2 < 0",
    "cohorts_sum_to_pop": "pop > 0 AND NOT ((pop0to4 + pop5to64 + pop65plus) / pop BETWEEN 0.97 AND 1.03)",
    "gdp_is_gdppc_times_pop": "abs(gdp - gdppc * pop) > greatest(1e-9 * abs(gdp), 1e-9)",
}
_COUNTS = " UNION ALL ".join(
    [
        f"SELECT gdp_model, hierid, '{n}' AS name, count(*) FILTER ({c}) AS n FROM b GROUP BY 1, 2"
        for n, c in _BAD.items()
        if c
    ]
    + [
        "SELECT gdp_model, hierid, 'no_duplicates', count(*) - count(DISTINCT year) FROM b GROUP BY 1, 2",
        """SELECT gdp_model, hierid, 'raw_na_only_deliberate', CAST(coalesce(max(CASE WHEN gdppc_raw IS NULL AND
    gdppc <> 0 THEN year END) >= min(CASE WHEN gdppc_raw IS NOT NULL THEN year END), max(CASE WHEN gdppc_raw IS NULL
    AND gdppc <> 0 THEN year END) IS NOT NULL) AS BIGINT) FROM b GROUP BY 1, 2""",
    ]
)
_STRUCTURE = """SELECT gdp_model, 'columns' AS name, 0 AS n, '' AS detail FROM b GROUP BY 1
  UNION ALL SELECT gdp_model, 'grid_size', abs(count(*) - 7 * (SELECT count(*) FROM customer)),
    CASE WHEN count(*) = 7 * (SELECT count(*) FROM customer) THEN '' ELSE count(*) || ' rows, expected '
      || 7 * (SELECT count(*) FROM customer) END FROM b GROUP BY 1
  UNION ALL SELECT gdp_model, 'ir_count', abs(count(DISTINCT hierid) - (SELECT count(*) FROM customer)), '' FROM b GROUP BY 1
  UNION ALL SELECT gdp_model, 'year_span', 7 - count(DISTINCT year), '' FROM b GROUP BY 1"""
_CONTROL = {
    "history": "SELECT country AS iso3, nationkey AS k, year, total FROM control WHERE nationkey % 6 <> 5",
    "path": """SELECT scenario, country AS iso3, year, total * CASE WHEN scenario = 'SSP3' THEN year - 1990 ELSE 1 END AS v
  FROM revenue, (VALUES ('SSP2'), ('SSP3')) s(scenario) WHERE nationkey % 4 <> 3""",
    "anchors": """SELECT scenario, h.iso3, total / v AS f FROM history h JOIN path p ON h.iso3 = p.iso3
  AND h.year = p.year WHERE h.year = 1998""",
    "late": """SELECT scenario, iso3, year, f * v AS want FROM path JOIN anchors USING (scenario, iso3) WHERE year > 1998
  UNION ALL SELECT scenario, iso3, year, total FROM history, (VALUES ('SSP2'), ('SSP3')) s(scenario)
    WHERE year > 1998 AND iso3 NOT IN (SELECT iso3 FROM anchors)""",
}

QUERIES = {
    "assemble_panel": (
        assemble_panel,
        sql(
            "regions",
            "raw_values",
            p0=_PANEL,
            panel=_FULL,
            tail="""
SELECT * EXCLUDE (k)
FROM panel WHERE scenario <> 'SSP1'""",
        ),
    ),
    "quality_report": (
        quality_report,
        sql(
            "regions",
            "raw_values",
            p0=_PANEL,
            panel=_FULL,
            defects=_DEFECTS,
            b=_TWICE,
            counts=_COUNTS,
            structure=_STRUCTURE,
            summed="""SELECT gdp_model, name, sum(n) AS n, coalesce(array_to_string(list_sort(list(hierid)
    FILTER (n > 0))[1:3], ', '), '') AS detail FROM counts GROUP BY 1, 2
  UNION ALL SELECT * FROM structure""",
            tail="""
SELECT gdp_model, name AS "check", n = 0 AS ok, CAST(n AS BIGINT) AS n_bad, detail FROM summed""",
        ),
    ),
    "missing_panel_report": (
        missing_panel_report,
        sql(
            n="SELECT count(*) AS n FROM customer",
            c=f"""SELECT s AS scenario, m AS gdp_model, "check" FROM (VALUES ('SSP2'), ('SSP3')) s(s),
    (VALUES ('IIASA'), ('OECD')) m(m), (VALUES {", ".join(f"('{x}')" for x in checks.PANEL_CHECKS)}) t("check")""",
            tail="""
SELECT scenario, gdp_model, "check", n_bad = 0 AS ok, n_bad FROM (SELECT scenario, gdp_model, "check",
  CAST(CASE WHEN scenario = 'SSP3' AND gdp_model = 'IIASA' THEN
      CASE "check" WHEN 'grid_size' THEN 7 * n WHEN 'ir_count' THEN n WHEN 'year_span' THEN 7 ELSE 0 END
    WHEN scenario = 'SSP2' AND gdp_model = 'OECD' THEN CASE "check" WHEN 'grid_size' THEN 7 WHEN 'ir_count' THEN 1 ELSE 0 END
    ELSE 0 END AS BIGINT) AS n_bad FROM c, n)""",
        ),
    ),
    "cross_panel_report": (
        cross_panel_report,
        sql(
            "regions",
            tail="""
SELECT 'pop_model_independent_' || s AS "check", s <> 'SSP1' AS ok, CASE WHEN s = 'SSP1' THEN n ELSE 0 END AS n_bad,
  CASE WHEN s = 'SSP1' THEN who ELSE '' END AS detail
FROM (VALUES ('SSP1'), ('SSP2'), ('SSP3')) t(s),
  (SELECT count(*) * 7 AS n, min(region) AS who FROM regions WHERE c_custkey % 200 = 1)
UNION ALL SELECT 'area_identical', false, count(*) * 7, min(region) FROM regions WHERE c_custkey % 300 = 2
UNION ALL SELECT 'pop_differs_across_scenarios_OECD', true, 0, ''
UNION ALL SELECT 'pop_differs_across_scenarios_IIASA', false, 1, 'SSP1-SSP2'""",
        ),
    ),
    "control_report": (
        control_report,
        sql(
            "control",
            "revenue",
            **_CONTROL,
            tail="""
SELECT s AS scenario, 'OECD' AS gdp_model, c AS "check", n = 0 AS ok, CAST(n AS BIGINT) AS n_bad, detail
FROM (VALUES ('SSP2'), ('SSP3')) t(s), (
  SELECT 'pop_sums_to_wpp' AS c, count(*) AS n, coalesce(min(iso3), '') AS detail FROM history WHERE k = 1 AND year = 1996
  UNION ALL SELECT 'pop_rebased_ssp_after_handoff', count(*), coalesce(min(iso3), '') FROM late
    WHERE iso3 = 'NATION_2' AND scenario = 'SSP2'
  UNION ALL SELECT 'pop_no_jump_at_handoff', count(*), coalesce(min(iso3), '') FROM late
    WHERE iso3 = 'NATION_2' AND scenario = 'SSP2' AND year = 1999)""",
        ),
    ),
    "target_report": (
        target_report,
        sql(
            "regions",
            "raw_values",
            p0=_PANEL,
            t="""SELECT iso3, year FROM p0 WHERE scenario = 'SSP2' AND gdp_model = 'OECD' AND year >= 1998
  GROUP BY 1, 2 HAVING sum(gdppc * pop) > 0""",
            bad="SELECT * FROM t WHERE CAST(split_part(iso3, '_', 2) AS INTEGER) % 8 = 3",
            tail="""
SELECT 'SSP2' AS scenario, 'OECD' AS gdp_model, 'gdp_sums_to_national' AS "check", count(*) = 0 AS ok,
  count(*) AS n_bad, coalesce(array_to_string(list_sort(list(DISTINCT iso3))[1:3], ', '), '') AS detail FROM bad""",
        ),
    ),
}
