"""Queries on coverage, zonal statistics and areas."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweft.catalog import inputs as src
from panelweft.catalog.inputs import GRID, WEIGHT_YEAR, sql
from panelweft.functions.columns import country_of
from panelweft.operators import outlines, zonal
from panelweft.operators.zonal import Grid
from panelweft.plans import zonal as zonal_plan
from panelweft.plans.zonal import ZonalInputs
from panelweft.scale import staging_path
from panelweft.sources import grids
from panelweft.sources.tiles import TiledGrid

GLOBE = Grid(x0=-180.0, y_top=90.0, res_x=2.5, res_y=2.5, n_rows=72, n_cols=144)


def _rings(spark, d, points):
    """Ring vertices from a box table: `points` is (ring_id, lon, lat) SQL."""
    entries = F.array(
        *(
            F.struct(
                F.lit(ring).alias("ring_id"),
                F.lit(seq).alias("seq"),
                F.expr(lon).alias("lon"),
                F.expr(lat).alias("lat"),
            )
            for seq, (ring, lon, lat) in _numbered(points)
        )
    )
    return src.boxes(spark, d).select("region", F.inline(entries))


def _numbered(points):
    seen = {}
    for p in points:
        seen[p[0]] = seen.get(p[0], -1) + 1
        yield seen[p[0]], p


# an outer box and a half-size hole running the other way round
_HOLE = {
    "lon0": "(3 * lon0 + lon1) / 4",
    "lon1": "(lon0 + 3 * lon1) / 4",
    "lat0": "(3 * lat0 + lat1) / 4",
    "lat1": "(lat0 + 3 * lat1) / 4",
}
DONUT = [
    (0, "lon0", "lat0"),
    (0, "lon0", "lat1"),
    (0, "lon1", "lat1"),
    (0, "lon1", "lat0"),
    (1, _HOLE["lon0"], _HOLE["lat0"]),
    (1, _HOLE["lon1"], _HOLE["lat0"]),
    (1, _HOLE["lon1"], _HOLE["lat1"]),
    (1, _HOLE["lon0"], _HOLE["lat1"]),
    (1, _HOLE["lon0"], _HOLE["lat0"]),
]
DIAMOND = [
    (0, "(lon0 + lon1) / 2", "lat0"),
    (0, "lon1", "(lat0 + lat1) / 2"),
    (0, "(lon0 + lon1) / 2", "lat1"),
    (0, "lon0", "(lat0 + lat1) / 2"),
]


def coverage_boxes(spark, d):
    out = zonal.box_coverage(src.boxes(spark, d), GRID)
    return out.select("region", "cell_row", "cell_col", F.round("frac", 9).alias("frac"))


def coverage_rings(spark, d):
    out = zonal.coverage_fraction(_rings(spark, d, DONUT), GRID)
    return out.select("region", "cell_row", "cell_col", F.round("frac", 8).alias("frac"))


def coverage_diamonds(spark, d):
    """Slanted edges: the covered shares add up to each region's own area,
    and their mean column is known in closed form (a third of it is shown, as
    thirds have no rounding ties)."""
    out = zonal.coverage_fraction(_rings(spark, d, DIAMOND), GLOBE)
    centre = F.sum(F.col("frac") * (F.col("cell_col") + 0.5)) / F.sum("frac")
    return out.groupBy("region").agg(
        F.round(F.sum("frac"), 7).alias("cells"),
        F.round(centre / 3, 7).alias("centre_third"),
        F.max(F.col("frac") > 1 + 1e-9).alias("over"),
    )


def bad_geometry(spark, d):
    """Rings broken on purpose, by supplier key, and the reason reported."""
    flat = F.col("s_suppkey") % 5 == 1
    shifted = F.col("s_suppkey") % 5 == 2
    two = F.col("s_suppkey") % 5 == 3
    b = src.boxes(spark, d)
    corners = [("lon0", "lat0"), ("lon1", "lat0"), ("lon1", "lat1"), ("lon0", "lat1")]
    points = F.array(
        *(
            F.struct(
                F.lit(0).alias("ring_id"),
                F.when(shifted & F.lit(i > 1), i + 1).otherwise(i).alias("seq"),
                F.expr("(lon0 + lon1) / 2" if i == 2 else lon).alias("lon"),
                F.when(flat, F.col("lat0")).otherwise(F.col(lat)).alias("lat"),
            )
            for i, (lon, lat) in enumerate(corners)
        )
    )
    points = F.when(two, F.slice(points, 1, 2)).otherwise(points)
    rings = b.select("region", F.inline(points))
    return zonal.bad_rings(rings).select("region", "ring_id", "reason")


def overlapping_regions(spark, d):
    """A region given twice the same box covers its cells twice."""
    rings = _rings(spark, d, [*DIAMOND, *((1, x, y) for _, x, y in DIAMOND)])
    some = rings.where("ring_id = 0 or substring_index(region, '.', -1) % 3 = 0")
    fine = Grid(x0=-180.0, y_top=90.0, res_x=0.25, res_y=0.25, n_rows=720, n_cols=1440)
    bad = zonal.bad_regions(zonal.coverage_fraction(some, fine))
    return bad.select("region", (F.col("max_frac") > 1).alias("over"))


def polygon_area(spark, d):
    rings = _rings(spark, d, DIAMOND)
    out = zonal.polygon_area_km2(rings)
    return out.select("region", F.round("area_km2", 4).alias("area_km2"))


def ring_table(spark, d):
    """Ring contract checked, regions listed with their country."""
    rings = _rings(spark, d, DIAMOND).withColumnRenamed("region", "hierid")
    return grids.regions_of(grids.rings_from_vertices(rings))


def region_country(spark, d):
    return src.regions(spark, d).select("region", country_of("region").alias("country"))


def cell_area(spark, d):
    """Area of the occupied cells per year."""
    cells = src.cell_orders(spark, d).withColumn("area", GRID.area_km2())
    return cells.groupBy("year", "cell_row").agg(
        F.round(F.sum("area"), 4).alias("area_km2"), F.count(F.lit(1)).alias("n_cells")
    )


def raster_to_cells(spark, d):
    part = src.table(spark, d, "part")
    bands = part.select(
        F.format_string("gdp_pc_%d", F.col("p_partkey") % 33 + 1990).alias("band"),
        (F.col("p_partkey") % 48).alias("cell_row"),
        (F.col("p_partkey") % 120).alias("cell_col"),
        F.when(F.col("p_size") < 5, F.lit(float("nan"))).otherwise(F.col("p_retailprice")).alias("value"),
    )
    return grids.raster_to_cells(bands)


def _cells(spark, d):
    return zonal.cell_table(src.cell_values(spark, d), src.cell_people(spark, d), GRID, WEIGHT_YEAR)


def cell_table(spark, d):
    out = _cells(spark, d)
    return out.select("cell_row", "cell_col", "year", "value", "people", "weight", F.round("density", 10).alias("density"))


def zonal_stats(spark, d):
    coverage = zonal.box_coverage(src.boxes(spark, d), GRID)
    out = zonal.zonal_stats(
        coverage,
        _cells(spark, d),
        by_people=zonal.weighted_mean("value", "weight"),
        by_area=zonal.area_mean("value"),
        people=zonal.zonal_sum("people"),
    )
    return out.select(
        "region",
        "year",
        F.round(F.col("by_people") / 100, 3).alias("by_people"),
        F.round(F.col("by_area") / 100, 3).alias("by_area"),
        F.round("people", 7).alias("people"),
    )


def _zonal(spark, d):
    boxes = src.boxes(spark, d)
    tables = zonal.zonal_tables(zonal.box_coverage(boxes, GRID), _cells(spark, d), boxes, range(1995, 2002))
    return tables.join(boxes.select("region", "country"), "region")


def zonal_fallback(spark, d):
    return _zonal(spark, d).select(
        "region",
        "year",
        F.round(F.col("gdppc") / 100, 3).alias("gdppc"),
        "zero_pop",
        F.round("pop", 7).alias("pop"),
    )


SQUARE = [(0, "lon0", "lat0"), (0, "lon0", "lat1"), (0, "lon1", "lat1"), (0, "lon1", "lat0")]


#: Two rings on a coarse lattice: they cross, touch and lie on each other.
LATTICE = [
    (
        ring,
        f"(s_suppkey * 7919 % 3200) / 10.0D - 160 + (s_suppkey * {i + 2} * {31 + 7 * ring} + {i * i * 17}) % 13 * 0.25D",
        f"(s_suppkey * 104729 % 1400) / 10.0D - 70 + (s_suppkey * {i + 3} * {17 + 5 * ring} + {i * 29}) % 11 * 0.25D",
    )
    for ring in (0, 1)
    for i in range(6)
]


def ring_contacts(spark, d):
    """Every pair of edges of a region that meets, with the point."""
    out = outlines.ring_contacts(_rings(spark, d, LATTICE))
    return out.withColumns({c: F.round(c, 11) for c in ("lon", "lat")})


def _second_ring(corner):
    """A corner of the second ring: a hole, a ring that turns like the first, one
    that overlaps it, or one beside it, by supplier."""
    x, y = corner
    same = _HOLE["lon1" if x else "lon0"], _HOLE["lat1" if y else "lat0"]
    hole = _HOLE["lon1" if y else "lon0"], _HOLE["lat1" if x else "lat0"]
    over = f"(lon0 + lon1) / 2 + {x} * (lon1 - lon0)", f"(lat0 + lat1) / 2 + {y} * (lat1 - lat0)"
    beside = f"lon1 + 1 + {x}", f"lat1 + 1 + {y}"
    kinds = (hole, same, over, beside)
    return tuple(
        "case s_suppkey % 4 " + " ".join(f"when {k} then {v[c]}" for k, v in enumerate(kinds)) + " end" for c in (0, 1)
    )


PAIRS = [
    *((0, ("lon0", "lon1")[x], ("lat0", "lat1")[y]) for x, y in ((0, 0), (1, 0), (1, 1), (0, 1))),
    *((1, *_second_ring(c)) for c in ((0, 0), (1, 0), (1, 1), (0, 1))),
]


def outline_faults(spark, d):
    """Holes and rings side by side are fine; what overlaps is named."""
    out = outlines.outline_faults(_rings(spark, d, PAIRS))
    return out.withColumns({c: F.round(c, 9) for c in ("lon", "lat")})


def _tiled(spark, cells, size):
    """A grid written as tiles."""
    out = TiledGrid(staging_path(spark, "tiles"), GRID, size)
    out.write(cells)
    return out


def raster_tiles(spark, d):
    """Cells written as tiles: what the tiles say of themselves, and the cells
    that they give again."""
    tiled = _tiled(spark, src.cell_values(spark, d), 16)
    tiles = tiled.stored(spark)
    again = tiled.cells(tiles).withColumn("tile", tiled.tile_of("cell_row", "cell_col"))
    return again.join(tiles.select("tile", "year", "n", "low", "high", F.size("cells").alias("size")), ["tile", "year"])


def _staged(spark, d, tiled=False):
    vertices = _rings(spark, d, SQUARE).withColumnRenamed("region", "hierid")
    values, people = src.cell_values(spark, d), src.cell_people(spark, d)
    if tiled:
        values, people = _tiled(spark, values, 16), _tiled(spark, people, 16)
    inputs = ZonalInputs(vertices, values, people, GRID, WEIGHT_YEAR, range(1995, 2002))
    return zonal_plan.zonal_stage(spark, staging_path(spark, "zonal_stage"), inputs)


def zonal_validation(spark, d):
    """Regional income of the stage, averaged over people, next to the mean
    value of an order of the year."""
    published = src.cell_orders(spark, d).groupBy("year").agg((F.sum("total") / F.sum("n_orders")).alias("published"))
    years = F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("year")
    countries = src.boxes(spark, d).select(F.col("country").alias("iso3")).distinct().select("iso3", years)
    out = zonal_plan.validation_report(_staged(spark, d), countries.join(published, "year"))
    return out.select(
        "iso3", "year", F.round(F.col("natavg") / 100, 3).alias("natavg"), F.round("ratio", 9).alias("ratio"),
        F.round("pct_diff", 7).alias("pct_diff"),
    )


def zonal_stage(spark, d):
    """The whole stage, from outlines and cells to the cached tables."""
    return _zonal_rows(_staged(spark, d))


def zonal_tiles(spark, d):
    """The stage from tiles, of which those that outlines meet are read."""
    return _zonal_rows(_staged(spark, d, tiled=True))


def _zonal_rows(tables):
    people = tables["region_pop"].select("hierid", "year", F.round("pop", 7).alias("pop"))
    density = tables["region_density"].select(
        "hierid", "year", F.round(F.col("pop_wtd_density") * 1e6, 5).alias("density")
    )
    income = tables["region_gdppc"].select(
        "hierid", "year", F.round(F.col("gdppc") / 100, 3).alias("gdppc"), "zero_pop"
    )
    return income.join(people, ["hierid", "year"]).join(density, ["hierid", "year"])


def flagged_regions(spark, d):
    return zonal.flagged_count(_zonal(spark, d), "region", "zero_pop")


def weighted_density(spark, d):
    out = _zonal(spark, d)
    return out.select("region", "year", F.round(F.col("pop_wtd_density") * 1e6, 5).alias("density"))


def _validation(spark, d):
    published = (
        src.cell_orders(spark, d)
        .groupBy("year")
        .agg((F.sum("total") / F.sum("n_orders")).alias("published"))
    )
    years = F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("year")
    nations = src.boxes(spark, d).select("country").distinct().select("country", years)
    table = nations.join(published, "year")
    return zonal.validate_national(
        _zonal(spark, d), table, value="gdppc", weight="pop"
    )


def validate_national(spark, d):
    out = _validation(spark, d)
    return out.select(
        "country",
        "year",
        F.round(F.col("natavg") / 100, 3).alias("natavg"),
        F.round("ratio", 9).alias("ratio"),
        F.round("pct_diff", 7).alias("pct_diff"),
    )


def validation_by_year(spark, d):
    out = zonal.validation_by_year(_validation(spark, d), 5.0)
    return out.withColumn("median_ratio", F.round("median_ratio", 9))


def validation_summary(spark, d):
    out = zonal.validation_summary(_validation(spark, d), WEIGHT_YEAR, 5.0)
    return out.select(F.round("median_ratio", 9).alias("median_ratio"), "n_over")


_HOLES = f"""SELECT region, country, {_HOLE['lon0']} AS lon0, {_HOLE['lon1']} AS lon1,
    {_HOLE['lat0']} AS lat0, {_HOLE['lat1']} AS lat1 FROM boxes"""
_HOLE_CELLS = src._SQL["box_cells"].replace("FROM boxes,", "FROM holes,")
_EDGES = """SELECT region, unnest([(lon0 + lon1) / 2, lon1, (lon0 + lon1) / 2, lon0]) AS x0,
    unnest([lat0, (lat0 + lat1) / 2, lat1, (lat0 + lat1) / 2]) AS y0,
    unnest([lon1, (lon0 + lon1) / 2, lon0, (lon0 + lon1) / 2]) AS x1,
    unnest([(lat0 + lat1) / 2, lat1, (lat0 + lat1) / 2, lat0]) AS y1 FROM boxes"""
_VALIDATION = """SELECT country, year, natavg, natavg / published AS ratio,
    (natavg - published) / published * 100 AS pct_diff
  FROM (SELECT country, year, sum(gdppc * pop) / sum(pop) AS natavg FROM zonal
        WHERE gdppc IS NOT NULL AND pop > 0 GROUP BY 1, 2)
  JOIN (SELECT year, sum(total) / sum(n_orders) AS published FROM cell_orders GROUP BY 1) USING (year)"""



def _lattice_sql():
    """Every pair of edges of a region, judged in whole numbers."""
    double = lambda e: e.replace("0.0D", "0.0::DOUBLE").replace("0.25D", "0.25::DOUBLE")
    points = ", ".join(
        f"{{'ring': {ring}, 'seq': {seq}, 'lon': {double(lon)}, 'lat': {double(lat)}}}"
        for seq, (ring, lon, lat) in _numbered(LATTICE)
    )
    side = lambda a, b, c: (
        f"sign(({b[0]} - {a[0]}) * ({c[1]} - {a[1]}) - ({b[1]} - {a[1]}) * ({c[0]} - {a[0]}))"
    )
    p = {f"{e}{n}": (f"{e}.x{n}", f"{e}.y{n}") for e in "ab" for n in (0, 1)}
    s = [side(p["a0"], p["a1"], p["b0"]), side(p["a0"], p["a1"], p["b1"]), side(p["b0"], p["b1"], p["a0"]), side(p["b0"], p["b1"], p["a1"])]

    def inside(c, a, b, s):
        at = " AND ".join(f"{c[i]} BETWEEN least({a[i]}, {b[i]}) AND greatest({a[i]}, {b[i]})" for i in (0, 1))
        return f"{s} = 0 AND {at} AND ({c[0]}, {c[1]}) <> ({a[0]}, {a[1]}) AND ({c[0]}, {c[1]}) <> ({b[0]}, {b[1]})"

    touch = [(p["b0"], p["a0"], p["a1"], "s0"), (p["b1"], p["a0"], p["a1"], "s1"), (p["a0"], p["b0"], p["b1"], "s2"), (p["a1"], p["b0"], p["b1"], "s3")]
    lies = "s0 = 0 AND s1 = 0 AND s2 = 0 AND s3 = 0"
    along = (
        "((b.x0 - a.x0)::DOUBLE * (b.y1 - b.y0)::DOUBLE - (b.y0 - a.y0)::DOUBLE * (b.x1 - b.x0)::DOUBLE)"
        " / ((a.x1 - a.x0)::DOUBLE * (b.y1 - b.y0)::DOUBLE - (a.y1 - a.y0)::DOUBLE * (b.x1 - b.x0)::DOUBLE)"
    )
    found = " ".join(f"WHEN {inside(c, a, b, s)} THEN {{'r': 'touches', 'x': {c[0]}::DOUBLE, 'y': {c[1]}::DOUBLE}}" for c, a, b, s in touch)
    box = src._SQL["boxes"].strip()
    return f"""
WITH boxes AS ({box}),
v AS (SELECT region, u.p.ring AS ring, u.p.seq AS seq, floor(u.p.lon * 1099511627776 + 0.5)::HUGEINT AS x, floor(u.p.lat * 1099511627776 + 0.5)::HUGEINT AS y
  FROM (SELECT region, unnest([{points}]) AS p FROM boxes) u),
e0 AS (SELECT region, ring, seq, x AS x0, y AS y0, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x1,
    coalesce(lead(y) OVER w, first_value(y) OVER w) AS y1 FROM v WINDOW w AS (PARTITION BY region, ring ORDER BY seq)),
e AS (SELECT * FROM e0 WHERE (x0, y0) <> (x1, y1)),
g AS (SELECT region, least(row(x0, y0), row(x1, y1)) AS p, greatest(row(x0, y0), row(x1, y1)) AS q, min(row(ring, seq)) AS one,
    max(row(ring, seq)) AS other, count(*) AS n FROM e GROUP BY 1, 2, 3),
d AS (SELECT region, one, p[1] AS x0, p[2] AS y0, q[1] AS x1, q[2] AS y1 FROM g),
m AS (SELECT a.region, a.one, b.one AS other, {s[0]} AS s0, {s[1]} AS s1, {s[2]} AS s2, {s[3]} AS s3, a, b
  FROM d a JOIN d b ON a.region = b.region AND a.one < b.one),
c AS (SELECT region, one, other, CASE
  WHEN {lies} THEN CASE WHEN greatest(row(a.x0, a.y0), row(b.x0, b.y0)) < least(row(a.x1, a.y1), row(b.x1, b.y1))
    THEN {{'r': 'overlaps', 'x': greatest(row(a.x0, a.y0), row(b.x0, b.y0))[1]::DOUBLE, 'y': greatest(row(a.x0, a.y0), row(b.x0, b.y0))[2]::DOUBLE}} END
  WHEN s0 * s1 < 0 AND s2 * s3 < 0 THEN {{'r': 'crosses', 'x': a.x0 + {along} * (a.x1 - a.x0), 'y': a.y0 + {along} * (a.y1 - a.y0)}}
  {found} END AS met FROM m),
k AS (SELECT region, one, other, met.r AS reason, met.x AS x, met.y AS y FROM c WHERE met IS NOT NULL
  UNION ALL SELECT region, one, other, 'overlaps', p[1], p[2] FROM g WHERE n > 1
  UNION ALL SELECT region, w[1], w[2], 'touches', x0, y0
    FROM (SELECT region, x0, y0, list_sort(list(row(ring, seq))) AS w FROM e GROUP BY 1, 2, 3) WHERE len(w) > 1)
SELECT region, one[1] AS ring_id, one[2] AS seq, other[1] AS other_ring, other[2] AS other_seq, reason,
  round(x / 1099511627776, 11) AS lon, round(y / 1099511627776, 11) AS lat FROM k
"""


QUERIES = {
    "ring_contacts": (ring_contacts, _lattice_sql()),
    "outline_faults": (
        outline_faults,
        sql(
            "boxes",
            tail="""
SELECT region, 1::INTEGER AS ring_id, 1::INTEGER AS other_ring, 'covered twice' AS reason,
  round(CASE s_suppkey % 4 WHEN 1 THEN (3 * lon0 + lon1) / 4 ELSE (lon0 + lon1) / 2 END, 9) AS lon,
  round(CASE s_suppkey % 4 WHEN 1 THEN (3 * lat0 + lat1) / 4 ELSE (lat0 + lat1) / 2 END, 9) AS lat
FROM boxes WHERE s_suppkey % 4 IN (1, 2)
UNION ALL
SELECT region, 0, 1, 'crosses', round((lon0 + lon1) / 2, 9), round(lat1, 9) FROM boxes WHERE s_suppkey % 4 = 2""",
        ),
    ),
    "zonal_validation": (
        zonal_validation,
        sql(
            "zonal",
            v=_VALIDATION,
            tail="""
SELECT country AS iso3, year, round(natavg / 100, 3) AS natavg, round(ratio, 9) AS ratio,
  round(pct_diff, 7) AS pct_diff FROM v""",
        ),
    ),
    "coverage_boxes": (
        coverage_boxes,
        sql(
            "box_cells",
            tail="SELECT region, cell_row, cell_col, round(frac, 9) AS frac FROM box_cells",
        ),
    ),
    "coverage_rings": (
        coverage_rings,
        sql(
            "box_cells",
            holes=_HOLES,
            hole_cells=_HOLE_CELLS,
            tail="""
SELECT region, cell_row, cell_col, round(b.frac - coalesce(h.frac, 0), 8) AS frac
FROM box_cells b LEFT JOIN hole_cells h USING (region, cell_row, cell_col)
WHERE b.frac - coalesce(h.frac, 0) > 1e-9""",
        ),
    ),
    "coverage_diamonds": (
        coverage_diamonds,
        sql(
            "boxes",
            tail="""
SELECT region, round((lon1 - lon0) * (lat1 - lat0) / 2 / 6.25, 7) AS cells,
  cen AS centre_third, false AS over
FROM (SELECT *, (SELECT round(sum(a * (c + 0.5)) / sum(a) / 3, 7) FROM (
    SELECT c.range AS c,
      -- share of the diamond's width in each grid column, by its closed form
      ((CASE WHEN least(greatest((c.range + 1 - m) / h, -1), 1) < 0 THEN (least(greatest((c.range + 1 - m) / h, -1), 1) + 1) * (least(greatest((c.range + 1 - m) / h, -1), 1) + 1) ELSE 2 - (1 - least(greatest((c.range + 1 - m) / h, -1), 1)) * (1 - least(greatest((c.range + 1 - m) / h, -1), 1)) END) / 2) - ((CASE WHEN least(greatest((c.range - m) / h, -1), 1) < 0 THEN (least(greatest((c.range - m) / h, -1), 1) + 1) * (least(greatest((c.range - m) / h, -1), 1) + 1) ELSE 2 - (1 - least(greatest((c.range - m) / h, -1), 1)) * (1 - least(greatest((c.range - m) / h, -1), 1)) END) / 2) AS a
    FROM range(144) c)) AS cen
  FROM (SELECT *, ((lon0 + lon1) / 2 + 180) / 2.5 AS m, (lon1 - lon0) / 5 AS h FROM boxes))""",
        ),
    ),
    "bad_geometry": (
        bad_geometry,
        sql(
            "boxes",
            tail="""
SELECT region, CAST(0 AS INTEGER) AS ring_id, CASE s_suppkey % 5 WHEN 1 THEN 'zero area'
  WHEN 2 THEN 'gaps in vertex numbers' ELSE 'fewer than three vertices' END AS reason
FROM boxes WHERE s_suppkey % 5 IN (1, 2, 3)""",
        ),
    ),
    "overlapping_regions": (
        overlapping_regions,
        sql("boxes", tail="SELECT region, true AS over FROM boxes WHERE s_suppkey % 3 = 0"),
    ),
    "polygon_area": (
        polygon_area,
        sql(
            "boxes",
            edges=_EDGES,
            t="""SELECT region, radians(x1 - x0) / 2 AS h, tan(radians(y0) / 2) AS a,
    tan(radians(y1) / 2) AS b FROM edges""",
            tail="""
SELECT region, round(abs(sum(2 * atan2(tan(h) * (a + b), 1 + a * b))) * 6371.010 * 6371.010, 4) AS area_km2
FROM t GROUP BY 1""",
        ),
    ),
    "ring_table": (
        ring_table,
        sql(
            "boxes",
            tail="SELECT DISTINCT region AS hierid, country AS iso3 FROM boxes",
        ),
    ),
    "region_country": (region_country, sql("regions", tail="SELECT region, country FROM regions")),
    "cell_area": (
        cell_area,
        sql(
            "cell_orders",
            "cell_area",
            tail="""
SELECT year, cell_row, round(sum(area), 4) AS area_km2, count(*) AS n_cells
FROM cell_orders JOIN cell_area USING (cell_row) GROUP BY 1, 2""",
        ),
    ),
    "raster_to_cells": (
        raster_to_cells,
        """
SELECT CAST(p_partkey % 48 AS INTEGER) AS cell_row, CAST(p_partkey % 120 AS INTEGER) AS cell_col,
  CAST(p_partkey % 33 + 1990 AS INTEGER) AS year, CASE WHEN p_size >= 5 THEN p_retailprice END AS value
FROM part""",
    ),
    "cell_table": (
        cell_table,
        sql(
            "cells",
            "cell_area",
            tail="""
SELECT cell_row, cell_col, year, value, people, weight, round(people / area, 10) AS density
FROM cells JOIN cell_area USING (cell_row)""",
        ),
    ),
    "zonal_stats": (
        zonal_stats,
        sql(
            "measured",
            tail="""
SELECT region, year, round(by_people / 100, 3) AS by_people, round(by_area / 100, 3) AS by_area,
  round(pop, 7) AS people FROM measured""",
        ),
    ),
    "zonal_fallback": (
        zonal_fallback,
        sql(
            "zonal",
            tail="""
SELECT region, year, round(gdppc / 100, 3) AS gdppc, zero_pop, round(pop, 7) AS pop FROM zonal""",
        ),
    ),
    "zonal_stage": (
        zonal_stage,
        sql(
            "zonal",
            tail="""
SELECT region AS hierid, year, round(gdppc / 100, 3) AS gdppc, zero_pop, round(pop, 7) AS pop,
  round(pop_wtd_density * 1e6, 5) AS density FROM zonal""",
        ),
    ),
    "zonal_tiles": (
        zonal_tiles,
        sql(
            "zonal",
            tail="""
SELECT region AS hierid, year, round(gdppc / 100, 3) AS gdppc, zero_pop, round(pop, 7) AS pop,
  round(pop_wtd_density * 1e6, 5) AS density FROM zonal""",
        ),
    ),
    "raster_tiles": (
        raster_tiles,
        sql(
            "cells",
            t="SELECT cell_row, cell_col, year, value, CAST(cell_row // 16 * 8 + cell_col // 16 AS BIGINT) AS tile FROM cells WHERE value IS NOT NULL",
            tail="""
SELECT tile, year, cell_row, cell_col, value, count(*) OVER w AS n, min(value) OVER w AS low, max(value) OVER w AS high,
  256::INTEGER AS size FROM t WINDOW w AS (PARTITION BY tile, year)""",
        ),
    ),
    "validation_by_year": (
        validation_by_year,
        sql(
            "zonal",
            v=_VALIDATION,
            tail="""
SELECT year, round(median(ratio), 9) AS median_ratio, count(*) FILTER (abs(pct_diff) > 5) AS n_over FROM v GROUP BY year""",
        ),
    ),
    "flagged_regions": (
        flagged_regions,
        sql("zonal", tail="SELECT count(DISTINCT region) AS n_flagged FROM zonal WHERE zero_pop"),
    ),
    "weighted_density": (
        weighted_density,
        sql(
            "zonal",
            tail="SELECT region, year, round(pop_wtd_density * 1e6, 5) AS density FROM zonal",
        ),
    ),
    "validate_national": (
        validate_national,
        sql(
            "zonal",
            v=_VALIDATION,
            tail="""
SELECT country, year, round(natavg / 100, 3) AS natavg, round(ratio, 9) AS ratio,
  round(pct_diff, 7) AS pct_diff FROM v""",
        ),
    ),
    "validation_summary": (
        validation_summary,
        sql(
            "zonal",
            v=_VALIDATION,
            tail="""
SELECT round(median(ratio), 9) AS median_ratio, count(*) FILTER (abs(pct_diff) > 5) AS n_over
FROM v WHERE year = 1998""",
        ),
    ),
}
