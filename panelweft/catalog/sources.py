"""Queries on readers and source normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweft.catalog import inputs as src
from panelweft.catalog.inputs import sql
from panelweft.functions.columns import ascii_fold, country_of, rel_diff
from panelweft.scale import staging_path
from panelweft.sources import grids, manifest, national, snapshot, wide

YEARS = list(range(1995, 2002))


def _long(spark, d):
    """model, scenario, region, variable, unit, year, value: order value as
    long snapshot rows."""
    return src.by_scenario(spark, d).select(
        F.when(F.col("nationkey") % 2 == 0, "M0").otherwise("M1").alias("model"),
        "scenario",
        F.col("country").alias("region"),
        F.lit("Total").alias("variable"),
        F.lit("cents").alias("unit"),
        "year",
        F.col("total").alias("value"),
    )


def _wide_text(df):
    """Year columns as text, gaps spelled n/a, plus a footer row."""
    ids = ["model", "scenario", "region", "variable", "unit"]
    table = df.groupBy(*ids).pivot("year", YEARS).agg(F.max("value"))
    text = table.select(
        *ids, *(F.coalesce(F.col(f"`{y}`").cast("string"), F.lit("n/a")).alias(str(y)) for y in YEARS)
    )
    footer = text.groupBy("variable").agg(F.count(F.lit(1)).alias("n")).select(
        F.concat(F.lit("© "), F.col("variable")).alias("model"),
        *(F.lit("x").alias(c) for c in ids[1:]),
        *(F.lit("1").alias(str(y)) for y in YEARS),
    )
    return text.unionByName(footer).toDF("Model", "Scenario", "Region", "Variable", "Unit", *map(str, YEARS))


def wide_to_long(spark, d):
    return wide.wide_to_long(_wide_text(_long(spark, d)))


def wide_csv(spark, d):
    """The wide table written as CSV, read back by its reader."""
    path = staging_path(spark, "wide")
    _wide_text(_long(spark, d)).write.csv(path, header=True)
    return wide.wide_to_long(wide.read_wide_csv(spark, path))


def stack_unique(spark, d):
    long = _long(spark, d)
    late = long.where("scenario in ('SSP1', 'SSP4', 'SSP5')")
    return wide.stack_unique([long.where("scenario in ('SSP2', 'SSP3')"), late])


def union_prefer_first(spark, d):
    first = src.control(spark, d).where("year <= 1998").select("country", "year", "total")
    second = src.revenue(spark, d).where("year >= 1997").select("country", "year", "total")
    return wide.union_prefer_first(first, second, ["country", "year"])


def _accounts(spark, d):
    rows = src.by_scenario(spark, d)
    return rows.groupBy(F.col("country").alias("countrycode"), "year").agg(
        F.sum(F.when(F.col("scenario") != "SSP4", F.col("total"))).alias("rgdpe"),
        F.sum(
            F.when(F.col("scenario") == "SSP5", F.col("n_orders") * (F.col("nationkey") % 3))
        ).alias("pop"),
    )


def income_accounts(spark, d):
    out = wide.read_income_accounts(_accounts(spark, d))
    return out.select("iso3", "year", F.round("gdppc", 3).alias("gdppc"))


def _sheet(spark, d, first, last, header_at):
    """National order value as an exported sheet: preamble, header, body."""
    body = src.control(spark, d).where(F.col("year").between(first, last)).select(
        (1000 + F.col("nationkey") * 100 + F.col("year") % 100).alias("row_no"),
        F.col("year").cast("string").alias("c0"),
        F.when(F.col("nationkey") % 5 == 4, "Region").otherwise("Country/Area").alias("c1"),
        F.when(F.col("nationkey") != 6, F.col("country")).alias("c2"),
        F.col("total").cast("decimal(20,0)").cast("string").alias("c3"),
    )
    region = src.table(spark, d, "region")
    preamble = region.select(
        F.col("r_regionkey").alias("row_no"), F.col("r_name").alias("c0"),
        *(F.lit(None).cast("string").alias(c) for c in ("c1", "c2", "c3")),
    )
    labels = ["Year", "Type", wide.HEADER_LABEL, wide.POPULATION_LABEL]
    header = region.where("r_regionkey = 0").select(
        F.lit(header_at).alias("row_no"), *(F.lit(x).alias(f"c{i}") for i, x in enumerate(labels))
    )
    return preamble.unionByName(header).unionByName(body)


def population_sheets(spark, d):
    return wide.read_population(_sheet(spark, d, 1995, 1999, 20), _sheet(spark, d, 1998, 2001, 31))


def national_income(spark, d):
    table = (
        src.control(spark, d)
        .withColumn("iso3", F.when(F.col("nationkey") != 9, F.col("country")).otherwise(" "))
        .where("not (nationkey = 4 and year = 1997)")
        .groupBy("iso3")
        .pivot("year", YEARS)
        .agg(F.max("total"))
    )
    return wide.read_national_income(table)


def _named(spark, d):
    key = F.col("nationkey")
    name = (
        F.when(key == 0, "World")
        .when(key == 1, "Somewhere (R5)")
        .when(key == 2, "Kosovo")
        .when(key == 3, "Curaçao")
        .when(key == 4, "R?union")
        .when(key == 5, "Micronesia")
        .otherwise(F.col("country"))
    )
    return src.control(spark, d).select(name.alias("region"), "year", "total")


def _dictionary(spark, d):
    nation = src.table(spark, d, "nation").where("n_nationkey < 20")
    return nation.select(F.col("n_name").alias("name"), F.concat(F.lit("C"), "n_nationkey").alias("iso3"))


def map_names(spark, d):
    out = national.map_names_to_codes(_named(spark, d), _dictionary(spark, d))
    return out.select("iso3", "year", "total")


def unmapped_names(spark, d):
    return national.unmapped_names(_named(spark, d), _dictionary(spark, d))


def age_bins(spark, d):
    part = src.table(spark, d, "part")
    rows = part.selectExpr(
        """concat('Population|', if(p_partkey % 2 = 0, 'Male', 'Female'), '|Age ', p_size * 2, '-',
           p_size * 2 + 4, if(p_partkey % 7 = 0, '|Secondary', '')) as variable""",
        "p_type as scenario",
        "p_brand as iso3",
        "cast(2000 + p_partkey % 3 as int) as year",
        "round(p_retailprice * 100) as value",
    )
    return national.age_bins(rows, "projection")


def _snapshot(spark, d):
    """Orders and lineitems as the rows of a projection snapshot."""
    rows = src.by_scenario(spark, d)

    def part(model, variable, value, where):
        return rows.where(where).select(
            F.lit(model).alias("model"),
            "scenario",
            F.col("country").alias("iso3"),
            F.lit(variable).alias("variable"),
            "year",
            value.cast("double").alias("value"),
        )

    people = F.col("n_orders") * (F.col("nationkey") % 4)
    return (
        part(national.OECD_MODEL, national.PER_CAPITA, F.col("total") / 100, "nationkey % 3 <> 0")
        .unionByName(part(national.IIASA_MODEL, national.GDP, F.col("total") / 100, "year >= 1997"))
        .unionByName(part(national.PEOPLE_MODEL, national.POPULATION, people, "year <> 1999"))
    )


def ratio_of_sources(spark, d):
    out = national.national_gdppc(_snapshot(spark, d))
    return out.withColumn("gdppc", F.round("gdppc", 2))


def national_pop(spark, d):
    rows = _snapshot(spark, d)
    return national.national_pop(rows.where("year < 1998"), rows.where("year >= 1998"))


def national_cohorts(spark, d):
    """Customer counts by sex and age variable in both eras."""
    rows = src.by_scenario(spark, d).select(
        F.lit(national.PEOPLE_MODEL).alias("model"),
        "scenario",
        F.col("country").alias("iso3"),
        F.format_string(
            "Population|%s|Age %d+", F.when(F.col("nationkey") > 9, "Male").otherwise("Female"),
            (F.col("n_orders") * 9 % 100).cast("int"),
        ).alias("variable"),
        "year",
        F.col("total").alias("value"),
    )
    return national.national_cohorts(rows.where("year < 1998"), rows.where("year >= 1998"))


def cube_to_long(spark, d):
    """One chunk per nation, scenario and year nested as arrays; a year that a
    line lacks is a gap in it."""
    at = F.struct("year", "total", "n_orders")
    lines = (
        src.by_scenario(spark, d)
        .groupBy("country", "scenario")
        .agg(F.collect_list(at).alias("found"))
        .withColumn(
            "line",
            F.transform(
                F.sequence(F.lit(1995), F.lit(2001)),
                lambda y: F.get(F.filter("found", lambda x: x["year"] == y), 0),
            ),
        )
    )
    row = F.struct(
        "scenario",
        F.col("line.total").alias("total"),
        F.transform("line.n_orders", lambda n: n.cast("double")).alias("n"),
    )
    chunks = lines.groupBy("country").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    cube = chunks.select(
        F.array("country").alias("country"),
        F.col("rows.scenario").alias("scenario"),
        F.sequence(F.lit(1995), F.lit(2001)).alias("year"),
        F.array("rows.total").alias("total"),
        F.array("rows.n").alias("n"),
    )
    return grids.cube_to_long(cube, ["country", "scenario", "year"], ["total", "n"])


def panel_csv(spark, d):
    """A region table written as CSV with empty gaps, read with its schema;
    one nation is called NA."""
    rows = src.raw_values(spark, d).select(
        F.when(F.col("nationkey") == 5, F.concat(F.lit("NA."), F.substring_index("region", ".", -1)))
        .when(F.col("region") == "NATION_7.6", "NA")
        .otherwise(F.col("region"))
        .alias("hierid"),
        "year",
        F.when(F.col("year") != 1999, F.col("raw")).alias("gdppc"),
    )
    path = staging_path(spark, "panel_csv")
    rows.write.csv(path, header=True, nullValue="")
    back = wide.read_panel_csv(spark, path, "hierid string, year int, gdppc double")
    return back.withColumn("iso3", country_of("hierid"))


def verify_inputs(spark, d):
    """Every document as a file, checked against a manifest with some wrong
    checksums and some entries without a file."""
    docs = src.table(spark, d, "documents").select("doc_id", "text")
    listed = docs.selectExpr(
        "concat('doc/', doc_id) as path",
        "md5(cast(if(doc_id % 10 = 3, concat(text, 'x'), text) as binary)) as md5",
        "case doc_id % 3 when 0 then 'manual' when 1 then 'script' end as fetch",
    )
    files = docs.where("doc_id % 10 <> 7").selectExpr(
        "concat('doc/', doc_id) as path", "md5(cast(text as binary)) as md5"
    )
    return manifest.verify_inputs(files, listed)


def fold_text(spark, d):
    docs = src.table(spark, d, "documents")
    folded = ascii_fold("text")
    return docs.select("doc_id", F.md5(folded.cast("binary")).alias("digest"), F.length(folded).alias("n"))


def _release(spark, d):
    """All scenarios, some names accented."""
    rows = _long(spark, d)
    accented = F.when(F.col("region").endswith("3"), F.regexp_replace("region", "A", "Á"))
    return rows.withColumn("region", F.coalesce(accented, F.col("region")))


def _given(spark, d):
    """Two scenarios of the release as an older export, accents lost, the
    values a little shorter, some nations never listed."""
    rows = _release(spark, d).where("scenario in ('SSP2', 'SSP3')")
    rows = rows.where("not (model = 'M1' and region like '%7')")
    return rows.withColumn("region", ascii_fold("region")).withColumn(
        "value", F.col("value") * (1 + 1e-14)
    )


def gated_snapshot(spark, d):
    out = snapshot.derive_gated_snapshot(
        _release(spark, d), _given(spark, d), ["SSP1", "SSP4", "SSP5"], YEARS
    )
    return out.toDF(*out.columns[:5], *(f"y{y}" for y in YEARS))


def gate_report(spark, d):
    """A release in which one nation is off and one scenario is short."""
    off = F.when(F.col("region") == "NATION_8", F.col("value") * 1.25).otherwise(F.col("value"))
    release = _release(spark, d).where("not (scenario = 'SSP3' and year = 2000)")
    release = release.withColumn("value", off)
    given = _given(spark, d)
    report = snapshot.gate_report(snapshot.within_snapshot(release, given), given)
    return report.withColumn("max_rel", F.round("max_rel", 9))


def rows_per_scenario(spark, d):
    eligible = snapshot.within_snapshot(_release(spark, d), _given(spark, d))
    return snapshot.rows_per_scenario(snapshot.new_rows(eligible, ["SSP1", "SSP4", "SSP5"], YEARS))


def relative_difference(spark, d):
    """Relative difference of ordered quantity value and list price."""
    items = src.table(spark, d, "lineitem")
    gap = rel_diff(F.col("l_discount"), F.col("l_tax"))
    return items.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.avg(gap), 9).alias("mean_rel"),
        F.count_if(gap == 0).alias("n_equal"),
        F.max(gap).alias("max_rel"),
    )


_LONG = """SELECT CASE WHEN nationkey % 2 = 0 THEN 'M0' ELSE 'M1' END AS model, scenario, country AS region,
    'Total' AS variable, 'cents' AS unit, year, total AS value FROM by_scenario"""
_RELEASE = """SELECT model, scenario, CASE WHEN region LIKE '%3' THEN replace(region, 'A', 'Á') ELSE region END
    AS region, variable, unit, year, value FROM long"""
_ELIGIBLE = """SELECT * FROM release r WHERE EXISTS (SELECT 1 FROM release g
    WHERE g.scenario IN ('SSP2', 'SSP3') AND NOT (g.model = 'M1' AND g.region LIKE '%7')
      AND g.model = r.model AND g.region = r.region)"""
_PIVOT = ", ".join(f"max(value) FILTER (year = {y}) AS y{y}" for y in YEARS)
_SNAPSHOT = f"""SELECT '{national.OECD_MODEL}' AS model, scenario, country AS iso3,
    '{national.PER_CAPITA}' AS variable, year, total / 100 AS value FROM by_scenario WHERE nationkey % 3 <> 0
  UNION ALL SELECT '{national.IIASA_MODEL}', scenario, country, '{national.GDP}', year, total / 100
  FROM by_scenario WHERE year >= 1997
  UNION ALL SELECT '{national.PEOPLE_MODEL}', scenario, country, '{national.POPULATION}', year,
    CAST(n_orders * (nationkey % 4) AS DOUBLE) FROM by_scenario WHERE year <> 1999"""
_NAMED = """SELECT CASE nationkey WHEN 0 THEN 'World' WHEN 1 THEN 'Somewhere (R5)' WHEN 2 THEN 'Kosovo'
    WHEN 3 THEN 'Curaçao' WHEN 4 THEN 'R?union' WHEN 5 THEN 'Micronesia' ELSE country END AS region,
    nationkey, country, year, total FROM control"""

QUERIES = {
    "wide_to_long": (wide_to_long, sql("by_scenario", long=_LONG, tail="SELECT * FROM long")),
    "wide_csv": (wide_csv, sql("by_scenario", long=_LONG, tail="SELECT * FROM long")),
    "stack_unique": (stack_unique, sql("by_scenario", long=_LONG, tail="SELECT * FROM long")),
    "union_prefer_first": (
        union_prefer_first,
        sql(
            "control",
            "revenue",
            stacked="""SELECT country, year, total, 0 AS rank FROM control WHERE year <= 1998
  UNION ALL SELECT country, year, total, 1 FROM revenue WHERE year >= 1997""",
            tail="""
SELECT country, year, total FROM stacked
QUALIFY row_number() OVER (PARTITION BY country, year ORDER BY rank) = 1""",
        ),
    ),
    "income_accounts": (
        income_accounts,
        sql(
            "by_scenario",
            a="""SELECT country, year, sum(total) FILTER (scenario <> 'SSP4') AS gdp,
    sum(n_orders * (nationkey % 3)) FILTER (scenario = 'SSP5') AS pop FROM by_scenario GROUP BY 1, 2""",
            tail="""
SELECT country AS iso3, year, round(gdp / pop, 3) AS gdppc FROM a WHERE gdp IS NOT NULL AND pop > 0""",
        ),
    ),
    "population_sheets": (
        population_sheets,
        sql(
            "control",
            tail="""
SELECT country AS iso3, year, total / 1e3 AS pop FROM control
WHERE nationkey % 5 <> 4 AND nationkey <> 6""",
        ),
    ),
    "national_income": (
        national_income,
        sql(
            "control",
            tail="""
SELECT country AS iso3, year, total AS gdppc FROM control
WHERE nationkey <> 9 AND NOT (nationkey = 4 AND year = 1997)""",
        ),
    ),
    "map_names": (
        map_names,
        sql(
            "control",
            named=_NAMED,
            tail="""
SELECT CASE nationkey WHEN 2 THEN 'XKX' WHEN 3 THEN 'CUW' WHEN 4 THEN 'REU' WHEN 5 THEN 'FSM'
  ELSE 'C' || nationkey END AS iso3, year, total FROM named WHERE nationkey BETWEEN 2 AND 19""",
        ),
    ),
    "unmapped_names": (
        unmapped_names,
        sql("control", tail="SELECT DISTINCT country AS region FROM control WHERE nationkey >= 20"),
    ),
    "age_bins": (
        age_bins,
        """
SELECT 'projection' AS era, p_type AS scenario, p_brand AS iso3,
  CAST(2000 + p_partkey % 3 AS INTEGER) AS year,
  coalesce(sum(round(p_retailprice * 100)) FILTER (p_size * 2 < 5), 0) AS age0to4,
  coalesce(sum(round(p_retailprice * 100)) FILTER (p_size * 2 >= 5 AND p_size * 2 < 65), 0) AS age5to64,
  coalesce(sum(round(p_retailprice * 100)) FILTER (p_size * 2 >= 65), 0) AS age65plus
FROM part WHERE p_partkey % 7 <> 0 GROUP BY ALL""",
    ),
    "ratio_of_sources": (
        ratio_of_sources,
        sql(
            "by_scenario",
            s=_SNAPSHOT,
            tail=f"""
SELECT 'OECD' AS model, scenario, iso3, year, round(value, 2) AS gdppc FROM s
WHERE model = '{national.OECD_MODEL}'
UNION ALL SELECT 'IIASA', g.scenario, g.iso3, g.year, round(g.value / p.value * 1e3, 2)
FROM s g JOIN s p USING (scenario, iso3, year)
WHERE g.model = '{national.IIASA_MODEL}' AND p.model = '{national.PEOPLE_MODEL}' AND p.value > 0""",
        ),
    ),
    "national_pop": (
        national_pop,
        sql(
            "by_scenario",
            s=_SNAPSHOT,
            tail=f"""
SELECT CASE WHEN year < 1998 THEN 'historical' ELSE 'projection' END AS era, scenario, iso3, year,
  value AS pop FROM s WHERE variable = '{national.POPULATION}'""",
        ),
    ),
    "national_cohorts": (
        national_cohorts,
        sql(
            "by_scenario",
            tail="""
SELECT CASE WHEN year < 1998 THEN 'historical' ELSE 'projection' END AS era, scenario, country AS iso3,
  year, CASE WHEN n_orders * 9 % 100 < 5 THEN total ELSE 0 END AS age0to4,
  CASE WHEN n_orders * 9 % 100 BETWEEN 5 AND 64 THEN total ELSE 0 END AS age5to64,
  CASE WHEN n_orders * 9 % 100 >= 65 THEN total ELSE 0 END AS age65plus FROM by_scenario""",
        ),
    ),
    "cube_to_long": (
        cube_to_long,
        sql(
            "by_scenario",
            tail="""
SELECT l.country, l.scenario, CAST(y.range AS INTEGER) AS year, total, CAST(n_orders AS DOUBLE) AS n
FROM (SELECT DISTINCT country, scenario FROM by_scenario) l CROSS JOIN range(1995, 2002) y
LEFT JOIN by_scenario b ON b.country = l.country AND b.scenario = l.scenario AND b.year = y.range""",
        ),
    ),
    "panel_csv": (
        panel_csv,
        sql(
            "raw_values",
            named="""SELECT CASE WHEN nationkey = 5 THEN 'NA.' || split_part(region, '.', 2)
    WHEN region = 'NATION_7.6' THEN 'NA' ELSE region END AS hierid, year,
    CASE WHEN year <> 1999 THEN raw END AS gdppc FROM raw_values""",
            tail="SELECT hierid, year, gdppc, split_part(hierid, '.', 1) AS iso3 FROM named",
        ),
    ),
    "verify_inputs": (
        verify_inputs,
        """
SELECT 'doc/' || doc_id AS path,
  CASE WHEN doc_id % 10 = 7 THEN 'missing (' || (CASE doc_id % 3 WHEN 0 THEN 'manual' WHEN 1 THEN 'script'
    ELSE 'auto' END) || ')' WHEN doc_id % 10 = 3 THEN 'mismatch' ELSE 'ok' END AS status
FROM documents""",
    ),
    "ascii_fold": (
        fold_text,
        """
SELECT doc_id, md5(regexp_replace(text, '[^\\x00-\\x7F]', '?', 'g')) AS digest,
  CAST(length(regexp_replace(text, '[^\\x00-\\x7F]', '?', 'g')) AS INTEGER) AS n FROM documents""",
    ),
    "gated_snapshot": (
        gated_snapshot,
        sql(
            "by_scenario",
            long=_LONG,
            release=_RELEASE,
            eligible=_ELIGIBLE,
            tail=f"""
SELECT model, scenario, region, variable, unit, {_PIVOT}
FROM eligible WHERE scenario IN ('SSP1', 'SSP4', 'SSP5') GROUP BY ALL""",
        ),
    ),
    "gate_report": (
        gate_report,
        sql(
            "by_scenario",
            long=_LONG,
            given="""SELECT * FROM long WHERE scenario IN ('SSP2', 'SSP3')
    AND NOT (model = 'M1' AND region LIKE '%7')""",
            tail="""
SELECT count(*) AS n_cells, count(*) FILTER (scenario = 'SSP3' AND year = 2000) AS n_missing,
  round(max(CASE WHEN region = 'NATION_8' AND NOT (scenario = 'SSP3' AND year = 2000)
    THEN 0.2::DOUBLE ELSE 0 END), 9) AS max_rel FROM given""",
        ),
    ),
    "rows_per_scenario": (
        rows_per_scenario,
        sql(
            "by_scenario",
            long=_LONG,
            release=_RELEASE,
            eligible=_ELIGIBLE,
            tail="""
SELECT model, scenario, count(DISTINCT region) AS n_rows FROM eligible
WHERE scenario IN ('SSP1', 'SSP4', 'SSP5') GROUP BY 1, 2""",
        ),
    ),
    "relative_difference": (
        relative_difference,
        """
WITH x AS (SELECT l_returnflag, l_linestatus, CASE WHEN greatest(l_discount, l_tax) = 0 THEN 0
  ELSE abs(l_discount - l_tax) / greatest(l_discount, l_tax) END AS gap FROM lineitem)
SELECT l_returnflag, l_linestatus, round(avg(gap), 9) AS mean_rel, count(*) FILTER (gap = 0) AS n_equal,
  max(gap) AS max_rel FROM x GROUP BY 1, 2""",
    ),
}
