"""Queries that compare two versions of a dataset."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweft.catalog import inputs as src
from panelweft.catalog.inputs import sql
from panelweft.operators import compare

KEYS = ["region", "year"]
COLUMNS = ["value", "extra"]
SCENARIOS = ["SSP1", "SSP2", "SSP3", "SSP4", "SSP5"]


def _result(spark, d):
    """Order value per customer and year, without some keys; some gaps."""
    rows = src.raw_values(spark, d).withColumn("k", _key())
    return rows.where("k % 37 <> 5").select(
        "region",
        "country",
        "year",
        F.when(F.col("k") % 41 != 7, F.col("raw")).alias("value"),
        (F.col("raw") * 2).alias("extra"),
    )


def _reference(spark, d):
    """The same, some values moved by a known factor, some zero or absent."""
    rows = src.raw_values(spark, d).withColumn("k", _key())
    moved = (
        F.when(F.col("k") % 29 == 1, F.col("raw") * 1.25)
        .when(F.col("k") % 31 == 2, F.col("raw") + F.col("k"))
        .when(F.col("k") % 97 == 3, 0.0)
        .otherwise(F.col("raw"))
    )
    extra = F.when(F.col("k") % 53 != 9, F.col("raw") * 2)
    return rows.where("k % 43 <> 6").select(
        "region", "country", "year", moved.alias("value"), extra.alias("extra")
    )


def _key():
    return F.substring_index("region", ".", -1).cast("long")


def pct_diff_stats(spark, d):
    out = compare.pct_diff_stats(_result(spark, d), _reference(spark, d), KEYS, "value")
    return _rounded(out, "mean_abs_pct", "max_abs_pct", "median_abs_pct")


def _rounded(df, *cols, digits=7):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def worst_offenders(spark, d):
    out = compare.worst_offenders(_result(spark, d), _reference(spark, d), KEYS, "value", 5)
    return _rounded(out, "pct")


def compare_all_columns(spark, d):
    out = compare.compare_all_columns(_result(spark, d), _reference(spark, d), KEYS, COLUMNS)
    return out.withColumn("max_pct", F.least(F.round("max_pct", 7), F.lit(1e9)))


def _flagged(spark, d):
    return src.regions(spark, d).where("c_custkey % 29 = 1 and nationkey % 2 = 0").select("region")


def tiered_compare(spark, d):
    out = compare.tiered_compare(
        _result(spark, d), _tier_reference(spark, d), _flagged(spark, d), [*KEYS, "country"], COLUMNS
    )
    return _rounded(out, "max_pct")


def _tier_reference(spark, d):
    """Values moved in flagged customers, a little in their countries, not
    elsewhere; tier A has one gap that does not match."""
    rows = src.raw_values(spark, d).withColumn("k", _key())
    even = F.col("nationkey") % 2 == 0
    moved = (
        F.when(even & (F.col("k") % 29 == 1), F.col("raw") * 1.25)
        .when(even, F.col("raw") * 1.0001)
        .otherwise(F.col("raw"))
    )
    return rows.select(
        "region",
        "country",
        "year",
        F.when(F.col("k") % 41 != 7, moved).alias("value"),
        F.when(F.col("k") % 53 != 9, F.col("raw") * 2).alias("extra"),
    )


def national_agreement(spark, d):
    out = compare.national_agreement(
        _result(spark, d), _reference(spark, d), ["country"], COLUMNS, [1996, 1998, 2000]
    )
    return out.select("country", "year", "column", "a", "b", "one_sided", F.round("pct", 9).alias("pct"))


def envelope_compare(spark, d):
    a = _result(spark, d).withColumn("area", F.col("extra"))
    b = _reference(spark, d).withColumn("area", F.coalesce("extra", F.lit(1.0)))
    out = compare.envelope_compare(a, b, KEYS, strict="area", main="value", raw="extra")
    return _rounded(
        out, "strict_max", "main_share", "main_mean", "main_max", "raw_share", "raw_max", digits=9
    )


def _by_scenario(spark, d):
    rows = src.by_scenario(spark, d)
    same = F.when(F.col("scenario").isin("SSP1", "SSP2") & (F.col("year") <= 1998), F.col("nationkey") + 1)
    return rows.withColumn("value", F.coalesce(same.cast("double"), F.col("total")))


def scenario_pairs(spark, d):
    out = compare.scenario_pairs(
        _by_scenario(spark, d), SCENARIOS, "country", "value", 1998, [1999, 2001]
    )
    return _rounded(out, "max_rel", digits=9)


def national_report(spark, d):
    return compare.national_report(
        src.by_scenario(spark, d), SCENARIOS, "country", "total", [1996, 2000]
    )


def source_summary(spark, d):
    control = src.control(spark, d)
    raw = src.raw_values(spark, d)
    return compare.source_summary(control, "control", "country").unionByName(
        compare.source_summary(raw, "customers", "region")
    )


def rank_flagged(spark, d):
    sizes = src.regions(spark, d).select("region", F.col("weight").alias("size"))
    out = compare.rank_flagged(
        _result(spark, d), _reference(spark, d), KEYS, ["value"], sizes
    )
    return out.withColumn("max_pct", F.least(F.round("max_pct", 7), F.lit(1e9)))


def compare_benchmark(spark, d):
    out = compare.compare_benchmark(_result(spark, d), _reference(spark, d), KEYS, COLUMNS)
    return _rounded(out, "mean_abs_pct", "max_abs_pct", "median_abs_pct")


_RESULT = """SELECT region, country, year, CASE WHEN k % 41 <> 7 THEN raw END AS value, raw * 2 AS extra
  FROM keyed WHERE k % 37 <> 5"""
_REFERENCE = """SELECT region, country, year, CASE WHEN k % 29 = 1 THEN raw * 1.25::DOUBLE WHEN k % 31 = 2 THEN raw + k
    WHEN k % 97 = 3 THEN 0 ELSE raw END AS value, CASE WHEN k % 53 <> 9 THEN raw * 2 END AS extra
  FROM keyed WHERE k % 43 <> 6"""
_KEYED = "SELECT *, CAST(split_part(region, '.', 2) AS BIGINT) AS k FROM raw_values"
_BOTH = """SELECT a.region IS NOT NULL AS in_a, b.region IS NOT NULL AS in_b, a.value AS av, b.value AS bv,
    a.extra AS ae, b.extra AS be, coalesce(a.region, b.region) AS region, coalesce(a.year, b.year) AS year
  FROM a FULL JOIN b ON a.region = b.region AND a.year = b.year"""
_PCT = "abs({a} - {b}) / abs({b}) * 100"


def _stats(a, b, extra=""):
    off = f"CASE WHEN in_a AND in_b AND {b} <> 0 THEN {_PCT.format(a=a, b=b)} END"
    return f"""
SELECT count(*) FILTER (in_a AND in_b) AS n_matched, count(*) FILTER (NOT in_b) AS n_result_only,
  count(*) FILTER (NOT in_a) AS n_reference_only, round(avg({off}), 7) AS mean_abs_pct,
  round(max({off}), 7) AS max_abs_pct, count(*) FILTER ({off} > 1) AS n_over_threshold,
  round(median({off}), 7) AS median_abs_pct{extra} FROM j"""


def _gap(a, b):
    """SQL of a percent difference, infinite where only b is 0."""
    return f"""CASE WHEN {a} = {b} THEN 0 WHEN {a} IS NOT NULL AND {b} = 0 THEN 'inf'::DOUBLE ELSE {_PCT.format(a=a, b=b)} END"""


def _rel(a, b):
    return f"CASE WHEN greatest(abs({a}), abs({b})) = 0 THEN 0 ELSE abs({a} - {b}) / greatest(abs({a}), abs({b})) END"


_PARTS = {"keyed": _KEYED, "a": _RESULT, "b": _REFERENCE, "j": _BOTH}
_TIER = {
    "keyed": _KEYED,
    "flagged": """SELECT region, country FROM regions WHERE c_custkey % 29 = 1 AND nationkey % 2 = 0""",
    "t": f"""SELECT region, country, k % 37 <> 5 AS in_a, CASE WHEN k % 41 <> 7 THEN raw END AS av, raw * 2 AS ae,
    CASE WHEN k % 41 <> 7 THEN CASE WHEN nationkey % 2 = 0 AND k % 29 = 1 THEN raw * 1.25::DOUBLE
      WHEN nationkey % 2 = 0 THEN raw * 1.0001::DOUBLE ELSE raw END END AS bv,
    CASE WHEN k % 53 <> 9 THEN raw * 2 END AS be
  FROM keyed""",
    "tiers": """SELECT *, CASE WHEN region IN (SELECT region FROM flagged) THEN 'C'
    WHEN country IN (SELECT country FROM t WHERE region IN (SELECT region FROM flagged)) THEN 'B' ELSE 'A' END AS tier FROM t""",
    "s": """SELECT tier, in_a, 'value' AS "column", av AS a, bv AS b FROM tiers
  UNION ALL SELECT tier, in_a, 'extra', ae, be FROM tiers""",
}

QUERIES = {
    "pct_diff_stats": (pct_diff_stats, sql("raw_values", **_PARTS, tail=_stats("av", "bv"))),
    "compare_benchmark": (
        compare_benchmark,
        sql(
            "raw_values",
            **_PARTS,
            tail=_stats("av", "bv", ", 'value' AS \"column\"")
            + " UNION ALL "
            + _stats("ae", "be", ", 'extra' AS \"column\""),
        ),
    ),
    "worst_offenders": (
        worst_offenders,
        sql(
            "raw_values",
            **_PARTS,
            tail=f"""
SELECT region, year, av AS value, bv AS reference, round({_PCT.format(a='av', b='bv')}, 7) AS pct
FROM j WHERE in_a AND in_b AND av IS NOT NULL AND bv <> 0
ORDER BY {_PCT.format(a='av', b='bv')} DESC, region, year LIMIT 5""",
        ),
    ),
    "compare_all_columns": (
        compare_all_columns,
        sql(
            "raw_values",
            **_PARTS,
            tail=" UNION ALL ".join(
                f"""SELECT '{n}' AS "column", count(*) FILTER (NOT (in_a AND in_b)) AS n_unmatched,
  least(round(max({_gap(x, y)}), 7), 1e9) AS max_pct, count(*) FILTER (({x} IS NULL) <> ({y} IS NULL)) AS n_null_mismatch
FROM j"""
                for n, x, y in (("value", "av", "bv"), ("extra", "ae", "be"))
            ),
        ),
    ),
    "tiered_compare": (
        tiered_compare,
        sql(
            "regions",
            "raw_values",
            **_TIER,
            tail=f"""
SELECT tier, "column", count(*) FILTER (in_a) AS n_rows, count(*) FILTER (NOT in_a) AS n_one_sided,
  round(coalesce(max({_gap('a', 'b')}) FILTER (in_a), 0), 7) AS max_pct,
  count(*) FILTER (in_a AND (a IS NULL) <> (b IS NULL)) AS n_null_mismatch,
  count(*) FILTER (in_a AND {_gap('a', 'b')} > 1e-2) AS n_over,
  tier <> 'A' OR (bool_and(in_a) AND count(*) FILTER ((a IS NULL) <> (b IS NULL)) = 0
    AND count(*) FILTER ({_gap('a', 'b')} > 1e-2) = 0) AS ok
FROM s GROUP BY 1, 2""",
        ),
    ),
    "national_agreement": (
        national_agreement,
        sql(
            "raw_values",
            **_PARTS,
            x="""SELECT country, year, a.value AS a, b.value AS b, a.extra AS c, b.extra AS d, ia IS NULL OR ib IS NULL AS alone
  FROM (SELECT country, year, 1 AS ia, sum(value) AS value, sum(extra) AS extra FROM a GROUP BY 1, 2) a
  FULL JOIN (SELECT country, year, 1 AS ib, sum(value) AS value, sum(extra) AS extra FROM b GROUP BY 1, 2) b USING (country, year)
  WHERE year IN (1996, 1998, 2000)""",
            tail=f"""
SELECT country, year, 'value' AS "column", a, b, alone AS one_sided,
  CASE WHEN alone THEN 'inf'::DOUBLE ELSE round({_gap('a', 'b')}, 9) END AS pct FROM x
UNION ALL SELECT country, year, 'extra', c, d, alone, CASE WHEN alone THEN 'inf'::DOUBLE ELSE round({_gap('c', 'd')}, 9) END FROM x""",
        ),
    ),
    "envelope_compare": (
        envelope_compare,
        sql(
            "raw_values",
            **_PARTS,
            e=f"""SELECT *, CASE WHEN in_a AND in_b THEN {_rel('ae', 'coalesce(be, 1)')} END AS s,
    CASE WHEN in_a AND in_b THEN CASE WHEN av IS NULL OR bv IS NULL THEN 1 ELSE {_rel('av', 'bv')} END END AS m,
    CASE WHEN ae IS NOT NULL AND be IS NOT NULL THEN {_rel('ae', 'be')} END AS r FROM j""",
            g="""SELECT count(*) FILTER (in_a AND in_b) AS n_matched, count(*) FILTER (NOT in_a) AS n_missing,
    count(*) FILTER (NOT in_b) AS n_extra, max(s) AS strict_max, avg(CASE WHEN m <= 1e-6 THEN 1.0 WHEN m IS NOT NULL THEN 0.0 END) AS main_share,
    avg(m) AS main_mean, max(m) AS main_max,
    avg(CASE WHEN r <= 1e-6 THEN 1.0 WHEN r IS NOT NULL THEN 0.0 END) AS raw_share, max(r) AS raw_max FROM e""",
            tail="""
SELECT n_matched, n_missing, n_extra, round(strict_max, 9) AS strict_max, round(main_share, 9) AS main_share,
  round(main_mean, 9) AS main_mean, round(main_max, 9) AS main_max, round(raw_share, 9) AS raw_share,
  round(raw_max, 9) AS raw_max, n_missing = 0 AND n_extra = 0 AS rows_ok, strict_max <= 1e-6 AS strict_ok,
  main_share >= 0.97 AND main_mean <= 1e-3 AS main_ok, raw_share >= 0.99 AS raw_ok FROM g""",
        ),
    ),
    "scenario_pairs": (
        scenario_pairs,
        sql(
            "by_scenario",
            v="""SELECT scenario, country, year, CASE WHEN scenario IN ('SSP1', 'SSP2') AND year <= 1998
    THEN CAST(nationkey + 1 AS DOUBLE) ELSE total END AS v FROM by_scenario WHERE year IN (1998, 1999, 2001)""",
            p=f"""SELECT x.year, x.scenario || '-' || y.scenario AS pair,
    count(*) FILTER ({_rel('x.v', 'y.v')} > 1e-9) AS n, max({_rel('x.v', 'y.v')}) AS m
  FROM v x JOIN v y ON x.country = y.country AND x.year = y.year AND x.scenario < y.scenario GROUP BY 1, 2""",
            tail="""
SELECT year, arg_min(pair, (n, pair)) AS weakest_pair, min(n) AS n_diff, round(max(m), 9) AS max_rel,
  CASE WHEN year = 1998 THEN max(m) <= 1e-9 ELSE min(n) > 0 END AS ok FROM p GROUP BY year""",
        ),
    ),
    "national_report": (
        national_report,
        sql(
            "by_scenario",
            tail="""
SELECT coalesce(country, 'GLOBAL') AS country, year, sum(total) FILTER (scenario = 'SSP1') AS "SSP1",
  sum(total) FILTER (scenario = 'SSP2') AS "SSP2", sum(total) FILTER (scenario = 'SSP3') AS "SSP3",
  sum(total) FILTER (scenario = 'SSP4') AS "SSP4", sum(total) FILTER (scenario = 'SSP5') AS "SSP5"
FROM by_scenario WHERE year IN (1996, 2000) GROUP BY GROUPING SETS ((country, year), (year))""",
        ),
    ),
    "source_summary": (
        source_summary,
        sql(
            "control",
            "raw_values",
            tail="""
SELECT 'control' AS source, count(*) AS n_rows, count(DISTINCT country) AS n_members,
  min(year) AS first_year, max(year) AS last_year FROM control
UNION ALL SELECT 'customers', count(*), count(DISTINCT region), min(year), max(year) FROM raw_values""",
        ),
    ),
    "rank_flagged": (
        rank_flagged,
        sql(
            "raw_values",
            "regions",
            **_PARTS,
            tail=f"""
SELECT j.region, least(round(max({_gap('av', 'bv')}), 7), 1e9) AS max_pct, any_value(weight) AS size
FROM j JOIN regions r ON r.region = j.region WHERE in_a AND in_b
GROUP BY 1 HAVING max({_gap('av', 'bv')}) > 1e-2""",
        ),
    ),
}
