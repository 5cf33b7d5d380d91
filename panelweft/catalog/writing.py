"""Queries on the sinks: what was written, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweft.catalog import inputs as src
from panelweft.catalog.inputs import sql
from panelweft.operators import hashtree
from panelweft.operators.assemble import combos
from panelweft.operators.checks import Expected, panel_checks
from panelweft.operators.quantiles import exact_quantiles
from panelweft.plans.config import handoff_year
from panelweft.scale import exact_median, staging_path
from panelweft.sinks import writers
from panelweft.sinks.chunks import ChunkedCube
from panelweft.sources import manifest


def _panel(spark, d):
    """A full grid: every customer in every year, two scenarios, two models."""
    regions = src.regions(spark, d).select(F.col("region").alias("hierid"), "weight")
    spine = regions.withColumn("year", F.explode(F.sequence(F.lit(1995), F.lit(2001))))
    raw = src.raw_values(spark, d).select(F.col("region").alias("hierid"), "year", "raw")
    rows = spine.join(raw, ["hierid", "year"], "left")
    return combos(rows, scenario=("SSP3", "SSP2"), gdp_model=("OECD", "IIASA")).select(
        "scenario",
        "gdp_model",
        "hierid",
        "year",
        F.col("raw").alias("gdppc"),
        F.col("weight").alias("pop"),
    )


def cube_codes(spark, d):
    """The cube written in dimension order and read back."""
    path = staging_path(spark, "cube")
    writers.write_cube(writers.to_cube(_panel(spark, d), ["gdppc", "pop"]), path)
    return spark.read.parquet(path)


def dense_codes(spark, d):
    """Codes of all distinct (source, language, length) labels of the
    documents."""
    docs = src.table(spark, d, "documents")
    label = docs.select(F.concat_ws("/", "source", "lang", F.col("n_chars").cast("string")).alias("label"))
    return writers.dense_codes(label, "label", "code")


def exact_medians(spark, d):
    """Median line price, exact, over all lineitems."""
    return exact_median(src.table(spark, d, "lineitem"), "l_extendedprice", "median_price")


def cube_chunks(spark, d):
    """A slice of the cube stored in chunks: some labels of three dimensions."""
    coded = writers.to_cube(_panel(spark, d), ["gdppc", "pop"])
    lengths = {"scenario": 1, "gdp_model": 1, "hierid": 64, "year": 4}
    cube = ChunkedCube(staging_path(spark, "chunks"), ("scenario", "hierid", "gdp_model", "year"), ("gdppc", "pop"), lengths)
    cube.write(coded)
    return cube.read(spark, scenario=["SSP3"], gdp_model=["IIASA GDP"], year=[1996, 1999, 2000])


def _checked_panel(spark, d):
    """A full grid with every column that the gates look at."""
    base = _panel(spark, d).withColumn("hierid", F.concat(F.lit("N"), F.col("hierid")))
    number = F.substring_index("hierid", ".", -1).cast("long")
    income = F.coalesce(F.col("gdppc") / 100, F.lit(0.0))
    return base.select(
        "scenario", "gdp_model", "hierid", F.substring_index("hierid", ".", 1).alias("iso3"), "year",
        F.least(income, F.lit(9e6)).alias("gdppc"), F.least(income, F.lit(9e6)).alias("gdppc_raw"),
        F.least(income, F.lit(9e6)).alias("gdppc_raw0"), (F.least(income, F.lit(9e6)) * F.col("pop")).alias("gdp"), "pop",
        (number % 97 + 1).cast("double").alias("area_km2"), (F.col("pop") / (number % 97 + 1)).alias("pop_density"),
        F.lit(1.0).alias("pop_wtd_density"), (F.col("pop") * 0.25).alias("pop0to4"), (F.col("pop") * 0.5).alias("pop5to64"),
        (F.col("pop") * 0.25).alias("pop65plus"),
    )


def written_panels(spark, d):
    """Panels written as CSV folders behind all gates on whole panels, read back."""
    path = staging_path(spark, "panels")
    panel = _checked_panel(spark, d)
    pairs = tuple((s, m) for s in ("SSP2", "SSP3") for m in ("IIASA", "OECD"))
    wanted = Expected(src.table(spark, d, "customer").count(), 1995, 2001, combinations=pairs)
    writers.write_panels(panel, f"{path}/1.0.0", panel_checks(panel, wanted, ["scenario", "gdp_model"]), version="1.0.0")
    kinds = ", ".join(f"{c} double" for c in panel.columns[5:])
    return spark.read.csv(
        f"{path}/1.0.0", header=True, schema=f"hierid string, iso3 string, year int, {kinds}, scenario string, gdp_model string"
    )


def stage_file(spark, d):
    """A stage table as text, with its spelling of gaps."""
    path = staging_path(spark, "stage")
    writers.write_stage(_panel(spark, d).where("gdp_model = 'OECD'"), path, ["scenario", "hierid", "year"])
    back = spark.read.csv(path, header=True)
    return back.groupBy("scenario", F.col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("gdppc") == "NA").alias("n_gaps"),
        F.round(F.sum(F.col("pop").cast("double")), 2).alias("pop"),
    )


def handoff_years(spark, d):
    """The last year of estimates that a run takes, for every setting that order
    years suggest: years before 2020 and behind 2099 are refused."""
    years = src.table(spark, d, "orders").select((F.year("o_orderdate") * 40 - F.lit(77881)).alias("setting")).distinct()
    rows = []
    for r in years.orderBy("setting").collect():  # one per order year
        try:
            rows.append((r["setting"], handoff_year(r["setting"])))
        except ValueError:
            rows.append((r["setting"], None))
    return spark.createDataFrame(rows, "setting int, handoff int")


def cached_tables(spark, d):
    """Two tables built once, then served from the folder."""
    path = staging_path(spark, "cache")
    names = ["control", "revenue"]

    def build():
        return {n: getattr(src, n)(spark, d) for n in names}

    def refuse():
        raise RuntimeError("the tables are there already")

    writers.cached(spark, path, names, build)
    tables = writers.cached(spark, path, names, refuse)
    return tables["control"].join(
        tables["revenue"].withColumnRenamed("total", "revenue"), ["country", "nationkey", "year"]
    )


def quantiles(spark, d):
    """Quartiles and median of three columns of the lineitems, per ship year and
    return flag, exact."""
    lines = src.table(spark, d, "lineitem").withColumn("year", F.year("l_shipdate"))
    moved = lines.withColumn("signed", F.when(F.col("l_linenumber") % 3 != 0, F.col("l_extendedprice") * (F.col("l_discount") - 0.05)))
    out = exact_quantiles(moved, ["l_extendedprice", "l_quantity", "signed"], ["year", "l_returnflag"], [0.25, 0.5, 0.75])
    return out.withColumn("value", F.round("value", 9))


def _versions(spark, d):
    """A regional table, and a version of it with values changed, rows dropped
    and rows added, two equal ones among them."""
    old = src.raw_values(spark, d).select("country", "region", "year", "raw")
    key = F.substring_index("region", ".", -1).cast("long")
    nation = src.table(spark, d, "nation").select(F.col("n_name").alias("country"), "n_nationkey")
    both = old.join(nation, "country").withColumn("k", key).where("not (n_nationkey % 5 = 1 and k % 7 = 2 and year = 1997)")
    raw = F.when((F.col("n_nationkey") % 5 == 2) & (F.col("k") % 11 == 3), F.col("raw") + 1).otherwise(F.col("raw"))
    new = both.select("country", "region", "year", raw.alias("raw"), "n_nationkey", "k")
    added = new.where("n_nationkey % 5 = 3 and k % 13 = 4").select("country", "region", "year", (F.col("raw") * 0 + 7).alias("raw"))
    new = new.select("country", "region", "year", "raw").unionByName(added).unionByName(added)
    root = staging_path(spark, "versions")
    for name, table in (("a", old), ("b", new)):
        hashtree.write_version(table, f"{root}/{name}", ["country", "region"])
    return hashtree.compare_versions(spark, f"{root}/a", f"{root}/b", ["country", "region"])


def version_diff(spark, d):
    """The rows in which two written versions differ."""
    return _versions(spark, d)[1]


def version_steps(spark, d):
    """How many nodes of the trees were compared on the way to the differences."""
    found, _ = _versions(spark, d)
    return spark.createDataFrame(found.steps, "depth int, compared long, differing long")


def provenance(spark, d):
    """What provenance says of a panel, and whether it says the same of a written
    copy, of a copy with every row of a year twice more, and of one in which the
    values of two measures are exchanged where they differ."""
    panel = _panel(spark, d)
    path = staging_path(spark, "copy")
    writers.write_cube(panel.withColumns({f"{c}_code": F.col(c) for c in ("scenario", "hierid", "gdp_model", "year")}), path)
    copy = spark.read.parquet(path).select(*panel.columns)
    some = copy.where("year = 1998 and scenario = 'SSP2'")
    doubled = copy.unionByName(some).unionByName(some)
    turn = F.col("gdp_model") == "OECD"
    swapped = copy.withColumns({
        "gdppc": F.when(turn, F.col("pop")).otherwise(F.col("gdppc")), "pop": F.when(turn, F.col("gdppc")).otherwise(F.col("pop"))
    })
    said = lambda df, name: writers.provenance(spark, {"version": "1.0.0"}, df).select("item", F.col("value").alias(name))
    out = said(panel, "value")
    for name, df in (("copy", copy), ("doubled", doubled), ("swapped", swapped)):
        out = out.join(said(df, name), "item")
    return out.select(
        "item", F.substring_index("value", " ", 1).alias("first"),
        *[(F.col(n) == F.col("value")).alias(f"same_{n}") for n in ("copy", "doubled", "swapped")],
    )


def file_manifest(spark, d):
    """Customers written as text files, one for each five hundred keys; their sizes
    and checksums, and what a manifest says that holds wrong and missing entries."""
    lines = src.table(spark, d, "customer").select(
        F.floor(F.col("c_custkey") / 500).alias("part"), "c_custkey",
        F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", F.col("c_nationkey").cast("string"), "c_mktsegment").alias("value"),
    )
    path = staging_path(spark, "files")
    dealt = lines.repartition("part").sortWithinPartitions("part", "c_custkey")
    dealt.select("part", "value").write.partitionBy("part").option("lineSep", "\n").text(path)
    part = F.regexp_extract("path", "part=([0-9]+)/", 1)
    whole = 20_000  # larger files are read in ranges
    files = manifest.file_digests(spark, path, whole=whole, part=4096).where("bytes > 0").withColumn("path", part)
    number = F.col("path").cast("long")
    listed = files.select("path", F.when(number % 3 == 1, F.md5("md5")).otherwise(F.col("md5")).alias("md5"), F.lit(None).cast("string").alias("fetch"))
    absent = files.select(F.concat("path", F.lit("-lost")).alias("path"), "md5", F.when(number % 2 == 0, "manual").alias("fetch"))
    status = manifest.verify_inputs(files, listed.unionByName(absent))
    return status.join(files, "path", "left").select("path", "status", "bytes", "md5", "tree")


_FULL = """SELECT scenario, gdp_model, region AS hierid, CAST(y.range AS INTEGER) AS year, raw AS gdppc, weight AS pop
  FROM regions r CROSS JOIN range(1995, 2002) y
  CROSS JOIN (VALUES ('SSP2'), ('SSP3')) s(scenario) CROSS JOIN (VALUES ('OECD'), ('IIASA')) m(gdp_model)
  LEFT JOIN (SELECT region AS rr, year AS yy, raw FROM raw_values) v ON rr = region AND yy = y.range"""

_VERSIONS = {
    "old": "SELECT country, region, nationkey, year, raw, CAST(split_part(region, '.', -1) AS BIGINT) AS k FROM raw_values",
    "changed": """SELECT country, region, year, raw + CASE WHEN nationkey % 5 = 2 AND k % 11 = 3 THEN 1 ELSE 0 END AS raw, nationkey, k
  FROM old WHERE NOT (nationkey % 5 = 1 AND k % 7 = 2 AND year = 1997)""",
    "new": """SELECT country, region, year, raw FROM changed UNION ALL
  SELECT country, region, year, 7 FROM changed, range(2) WHERE nationkey % 5 = 3 AND k % 13 = 4""",
    "diff": """SELECT * FROM (SELECT country, region, year, raw, count(*) FILTER (side = 0) AS n_a, count(*) FILTER (side = 1) AS n_b
  FROM (SELECT country, region, year, raw, 0 AS side FROM old UNION ALL SELECT country, region, year, raw, 1 FROM new)
  GROUP BY 1, 2, 3, 4) WHERE n_a <> n_b""",
}

QUERIES = {
    "cube_codes": (
        cube_codes,
        sql(
            "regions",
            "raw_values",
            p=_FULL,
            named="""SELECT * REPLACE (CASE gdp_model WHEN 'OECD' THEN 'OECD Env-Growth' ELSE 'IIASA GDP' END AS gdp_model) FROM p""",
            tail="""
SELECT scenario, hierid, gdp_model, year, dense_rank() OVER (ORDER BY scenario) - 1 AS scenario_code,
  dense_rank() OVER (ORDER BY hierid) - 1 AS hierid_code, dense_rank() OVER (ORDER BY gdp_model) - 1 AS gdp_model_code,
  CAST(year - 1995 AS BIGINT) AS year_code, CAST(gdppc AS FLOAT) AS gdppc, CAST(pop AS FLOAT) AS pop FROM named""",
        ),
    ),
    "dense_codes": (
        dense_codes,
        """
SELECT label, row_number() OVER (ORDER BY label) - 1 AS code
FROM (SELECT DISTINCT source || '/' || lang || '/' || n_chars AS label FROM documents)""",
    ),
    "exact_median": (exact_medians, "SELECT median(l_extendedprice) AS median_price FROM lineitem"),
    "cube_chunks": (
        cube_chunks,
        sql(
            "regions",
            "raw_values",
            p=_FULL,
            tail="""
SELECT * FROM (SELECT scenario, hierid, CASE gdp_model WHEN 'OECD' THEN 'OECD Env-Growth' ELSE 'IIASA GDP' END AS gdp_model, year,
    dense_rank() OVER (ORDER BY scenario) - 1 AS scenario_code, dense_rank() OVER (ORDER BY hierid) - 1 AS hierid_code,
    dense_rank() OVER (ORDER BY gdp_model) - 1 AS gdp_model_code, CAST(year - 1995 AS BIGINT) AS year_code,
    CAST(gdppc AS FLOAT) AS gdppc, CAST(pop AS FLOAT) AS pop FROM p)
WHERE scenario = 'SSP3' AND gdp_model = 'IIASA GDP' AND year IN (1996, 1999, 2000)""",
        ),
    ),
    "written_panels": (
        written_panels,
        sql(
            "regions",
            "raw_values",
            p=_FULL,
            q="""SELECT scenario, gdp_model, 'N' || hierid AS hierid, 'N' || split_part(hierid, '.', 1) AS iso3, year,
    least(coalesce(gdppc / 100, 0), 9e6::DOUBLE) AS gdppc, pop, (CAST(split_part(hierid, '.', -1) AS BIGINT) % 97 + 1)::DOUBLE AS area_km2 FROM p""",
            tail="""
SELECT scenario, gdp_model, hierid, iso3, year, gdppc, gdppc AS gdppc_raw, gdppc AS gdppc_raw0, gdppc * pop AS gdp, pop, area_km2,
  pop / area_km2 AS pop_density, 1.0::DOUBLE AS pop_wtd_density, pop * 0.25::DOUBLE AS pop0to4, pop * 0.5::DOUBLE AS pop5to64, pop * 0.25::DOUBLE AS pop65plus FROM q""",
        ),
    ),
    "stage_file": (
        stage_file,
        sql(
            "regions",
            "raw_values",
            p=_FULL,
            tail="""
SELECT scenario, year, count(*) AS n_rows, count(*) - count(gdppc) AS n_gaps, round(sum(pop), 2) AS pop
FROM p WHERE gdp_model = 'OECD' GROUP BY 1, 2""",
        ),
    ),
    "handoff_years": (
        handoff_years,
        """
SELECT DISTINCT CAST(year(o_orderdate) * 40 - 77881 AS INTEGER) AS setting,
  CAST(CASE WHEN year(o_orderdate) * 40 - 77881 BETWEEN 2020 AND 2099 THEN year(o_orderdate) * 40 - 77881 END AS INTEGER) AS handoff FROM orders""",
    ),
    "cached_tables": (
        cached_tables,
        sql(
            "control",
            "revenue",
            tail="""
SELECT country, nationkey, year, c.total, r.total AS revenue
FROM control c JOIN revenue r USING (country, nationkey, year)""",
        ),
    ),
    "provenance": (
        provenance,
        sql(
            "regions",
            "raw_values",
            p=_FULL,
            q="""SELECT * REPLACE (CASE gdp_model WHEN 'OECD' THEN pop ELSE gdppc END AS gdppc, CASE gdp_model WHEN 'OECD' THEN gdppc ELSE pop END AS pop) FROM p""",
            moved="""SELECT scenario, gdp_model, count(*) AS n FROM (SELECT * FROM q EXCEPT ALL SELECT * FROM p) GROUP BY 1, 2""",
            tail="""
SELECT 'version' AS item, '1.0.0' AS "first", true AS same_copy, true AS same_doubled, true AS same_swapped
UNION ALL
SELECT 'content/' || scenario || '/' || gdp_model, count(*)::VARCHAR, true,
  count(*) FILTER (year = 1998 AND scenario = 'SSP2') = 0, coalesce(any_value(n), 0) = 0
FROM p LEFT JOIN moved USING (scenario, gdp_model) GROUP BY scenario, gdp_model""",
        ),
    ),
    "quantiles": (
        quantiles,
        """
WITH l AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag, l_extendedprice, l_quantity,
  CASE WHEN l_linenumber % 3 <> 0 THEN l_extendedprice * (l_discount - 0.05::DOUBLE) END AS signed FROM lineitem),
s AS (SELECT year, l_returnflag, 'l_extendedprice' AS "column", l_extendedprice AS v FROM l
  UNION ALL SELECT year, l_returnflag, 'l_quantity', l_quantity FROM l UNION ALL SELECT year, l_returnflag, 'signed', signed FROM l),
g AS (SELECT year, l_returnflag, "column", count(v) AS n, quantile_cont(v, [0.25, 0.5, 0.75]) AS q FROM s GROUP BY ALL HAVING count(v) > 0)
SELECT year, l_returnflag, "column", p.p::DOUBLE AS prob, n, round(q[p.i], 9) AS value
FROM g, (VALUES (1, 0.25), (2, 0.5), (3, 0.75)) p(i, p)""",
    ),
    "version_diff": (version_diff, sql("raw_values", **_VERSIONS, tail="SELECT * FROM diff")),
    "version_steps": (
        version_steps,
        sql(
            "raw_values",
            **_VERSIONS,
            tail="""
SELECT 0::INTEGER AS depth, 1::BIGINT AS compared, 1::BIGINT AS differing
UNION ALL SELECT 1, (SELECT count(DISTINCT country) FROM old), (SELECT count(DISTINCT country) FROM diff)
UNION ALL SELECT 2, (SELECT count(DISTINCT region) FROM old WHERE country IN (SELECT country FROM diff)),
  (SELECT count(DISTINCT region) FROM diff)""",
        ),
    ),
    "file_manifest": (
        file_manifest,
        """
WITH l AS (SELECT c_custkey // 500 AS part, string_agg(c_custkey || ',' || c_name || ',' || c_nationkey || ',' || c_mktsegment, chr(10) ORDER BY c_custkey) || chr(10) AS body
  FROM customer GROUP BY 1),
f AS (SELECT part, length(body) AS bytes, md5(body) AS md5,
  md5(array_to_string(list_transform(range(CAST(ceil(length(body) / 4096.0) AS BIGINT)), lambda i: md5(substr(body, i * 4096 + 1, 4096))), '')) AS tree FROM l)
SELECT part::VARCHAR AS path, CASE part % 3 WHEN 1 THEN 'mismatch' ELSE 'ok' END AS status, bytes, md5, tree FROM f
UNION ALL
SELECT part || '-lost', CASE part % 2 WHEN 0 THEN 'missing (manual)' ELSE 'missing (auto)' END, NULL, NULL, NULL FROM f""",
    ),
}
