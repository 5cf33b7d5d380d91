"""Grid cells to regions: exact coverage, zonal statistics, areas.

Coverage never needs a whole polygon in one place. Each edge is cut at the
grid lines; a piece inside a cell adds its height to every cell on its right
and a partial share to its own cell. Summed over a region's pieces and
accumulated along each row, that is the exact covered share of every cell that
an edge crosses. Cells between them are inside or outside as a whole: there the
edges that cross the middle of the row are counted, in whole numbers, so that
nothing has to be rounded away. Holes run against their outer ring and so
subtract themselves.

Edges are spread over tasks by the number of their pieces, and dealt by region and
row before they are cut into columns: what a task holds does not grow with the input.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweft.functions.columns import as_col
from panelweft.functions.geo import SPHERE_RADIUS_KM, cell_area_km2, lune_excess, snapped, twice_area
from panelweft.operators.quantiles import exact_quantiles
from panelweft.scale import Observed, materialise, tasks_of

CELL = ["cell_row", "cell_col"]
PIECES_PER_TASK = 1 << 18  # of edges, cut at rows and columns
TWICE = 1e-9  # by how much a share must exceed 1 to mean covered twice


@dataclass(frozen=True)
class Grid:
    """Regular lon-lat grid: left edge, top edge, resolution, shape."""

    x0: float
    y_top: float
    res_x: float
    res_y: float
    n_rows: int
    n_cols: int

    def require_same(self, other: Grid) -> None:
        if self != other:
            raise ValueError(f"grids do not align: {self} vs {other}")

    def x(self, lon) -> Column:
        return (as_col(lon) - self.x0) / self.res_x

    def y(self, lat) -> Column:
        return (F.lit(self.y_top) - as_col(lat)) / self.res_y

    def area_km2(self, row="cell_row") -> Column:
        return cell_area_km2(row, self.y_top, self.res_y, self.res_x)


def _clamp(value: Column, low, high) -> Column:
    return F.greatest(F.least(value, as_col(high)), as_col(low))


def ring_edges(rings: DataFrame, region: str = "region", strict: bool = True) -> DataFrame:
    """(region, ring_id, seq, lon0, lat0, lon1, lat1): one row per ring edge,
    numbered by its first vertex.

    Vertices meet their successors in an equi-join on the full vertex key,
    so a ring of any length spreads over all tasks. Every ring gets one
    closing edge from its last vertex to its first; it has no length when
    the ring was closed already. Vertex numbers must be consecutive; a ring
    with a gap or a number twice is an error, unless `strict` is off.
    """
    ring = [region, "ring_id"]
    here = rings.select(*ring, "seq", F.col("lon").alias("lon0"), F.col("lat").alias("lat0"))
    there = rings.select(
        *ring, (F.col("seq") - 1).alias("seq"), F.col("lon").alias("lon1"), F.col("lat").alias("lat1")
    )
    point = F.struct("lon", "lat")
    ends = rings.groupBy(*ring).agg(
        F.max("seq").alias("seq"), F.max_by(point, "seq").alias("tail"), F.min_by(point, "seq").alias("head"),
        (F.count(F.lit(1)) != F.max("seq") - F.min("seq") + 1).alias("broken"),
    )
    if strict:
        named = F.concat(F.lit("vertex numbers of ring "), F.concat_ws("/", *ring), F.lit(" have gaps"))
        tail = F.when(F.col("broken"), F.raise_error(named)).otherwise(F.col("tail.lon"))
        ends = ends.withColumn("tail", F.struct(tail.alias("lon"), F.col("tail.lat").alias("lat")))
    closing = ends.select(
        *ring,
        "seq",
        F.col("tail.lon").alias("lon0"),
        F.col("tail.lat").alias("lat0"),
        F.col("head.lon").alias("lon1"),
        F.col("head.lat").alias("lat1"),
    )
    return here.join(there, [*ring, "seq"]).unionByName(closing)


def coverage_runs(rings: DataFrame, grid: Grid, region: str = "region") -> DataFrame:
    """(region, cell_row, first_col, last_col, frac, whole): the covered share of
    each cell that an edge runs through (first = last), and runs of cells between
    them that are covered as a whole."""
    edges = ring_edges(rings, region).select(
        region,
        grid.x("lon0").alias("x0"),
        grid.y("lat0").alias("y0"),
        grid.x("lon1").alias("x1"),
        grid.y("lat1").alias("y1"),
    )
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    # an edge has at most as many pieces as it touches rows and columns
    rows, cols = (F.abs(F.floor(b) - F.floor(a)) + 1 for a, b in ((y0, y1), (x0, x1)))
    pieces = F.sum(F.least(rows, F.lit(grid.n_rows)) + F.least(cols, F.lit(grid.n_cols)))
    seen = Observed(pieces=pieces)
    edges = materialise(edges, "edges", seen)
    n = tasks_of(rings.sparkSession, seen.values["pieces"] or 0, PIECES_PER_TASK)
    edges = edges.repartition(n, *edges.columns)

    # cut at the row lines
    top = F.greatest(F.floor(F.least(y0, y1)), F.lit(0)).cast("int")
    last = F.least(F.ceil(F.greatest(y0, y1)) - 1, F.lit(grid.n_rows - 1)).cast("int")
    strips = (
        # a level edge adds no height, but marks the cells that it runs through
        edges.where((y0 != y1) | (y0 != F.floor(y0)))
        .where(top <= last)
        .withColumn("cell_row", F.explode(F.sequence(top, last)))
    )
    row = F.col("cell_row")
    slope = F.try_divide(x1 - x0, y1 - y0)
    ya, yb = _clamp(y0, row, row + 1), _clamp(y1, row, row + 1)
    # an edge crosses the middle of the row downwards, upwards or not at all
    middle = row + 0.5
    wind = F.when((y0 <= middle) & (middle < y1), 1).when((y1 <= middle) & (middle < y0), -1)
    strips = strips.select(
        region,
        "cell_row",
        F.when(ya == y0, x0).otherwise(x0 + (ya - y0) * slope).alias("xa"),
        F.when(yb == y1, x1).otherwise(x0 + (yb - y0) * slope).alias("xb"),
        (yb - ya).alias("dy"),
        F.coalesce(wind, F.lit(0)).alias("wind"),
        F.floor(x0 + (middle - y0) * slope).alias("at_middle"),
    ).repartition(n, region, "cell_row")

    # cut at the column lines; column -1 stands for everything left of the grid
    xa, xb = F.col("xa"), F.col("xb")
    left, right = F.least(xa, xb), F.greatest(xa, xb)
    first = F.greatest(F.floor(left), F.lit(-1)).cast("int")
    final = F.least(F.greatest(F.ceil(right) - 1, first), F.lit(grid.n_cols - 1)).cast("int")
    pieces = strips.where(first <= final).withColumn(
        "col", F.explode(F.sequence(first, final))
    )
    col = F.col("col")
    low = F.when(col < 0, F.least(left, F.lit(0.0))).otherwise(col)
    xs, xe = _clamp(xa, low, col + 1), _clamp(xb, low, col + 1)
    height = F.when(xa == xb, F.col("dy")).otherwise(F.col("dy") * (xe - xs) / (xb - xa))
    share = F.when(col < 0, F.lit(1.0)).otherwise(col + 1 - (xs + xe) / 2)
    turns = F.when(_clamp(F.col("at_middle"), first, final) == col, F.col("wind")).otherwise(0)
    crossed = (
        pieces.select(
            region,
            "cell_row",
            col.alias("cell_col"),
            height.alias("height"),
            (height * share).alias("own"),
            turns.alias("turns"),
        )
        .groupBy(region, *CELL)
        .agg(F.sum("height").alias("height"), F.sum("own").alias("own"), F.sum("turns").alias("turns"))
    )

    # accumulate along each row (at most one entry per grid column)
    along = Window.partitionBy(region, "cell_row").orderBy("cell_col")
    until_here = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    entries = crossed.withColumns({
        "inside": F.sum("turns").over(until_here),
        "left": F.coalesce(F.sum("height").over(before), F.lit(0.0)),
        "next_col": F.lead("cell_col", 1, grid.n_cols).over(along),
    })
    at = F.col("cell_col")
    own = F.struct(
        at.alias("first_col"), at.alias("last_col"), F.abs(F.col("own") + F.col("left")).alias("frac"), F.lit(False).alias("whole")
    )
    between = F.struct(
        (at + 1).alias("first_col"), (F.col("next_col") - 1).alias("last_col"),
        F.abs("inside").cast("double").alias("frac"), F.lit(True).alias("whole"),
    )
    return (
        entries.select(region, "cell_row", F.inline(F.array(own, between)))
        .where((F.col("frac") > 0) & (F.col("first_col") >= 0) & (F.col("first_col") <= F.col("last_col")))
    )


def coverage_fraction(rings: DataFrame, grid: Grid, region: str = "region") -> DataFrame:
    """(region, cell_row, cell_col, frac): share of each cell covered."""
    cells = F.explode(F.sequence("first_col", "last_col")).alias("cell_col")
    return coverage_runs(rings, grid, region).select(region, "cell_row", cells, "frac")


def box_coverage(boxes: DataFrame, grid: Grid, region: str = "region") -> DataFrame:
    """Coverage of lon/lat boxes (lon0, lat0, lon1, lat1): interval overlaps."""
    b = boxes.select(
        region,
        grid.x("lon0").alias("xa"),
        grid.x("lon1").alias("xb"),
        grid.y("lat1").alias("ya"),
        grid.y("lat0").alias("yb"),
    )

    def cells(lo, hi, n):
        first = F.greatest(F.floor(lo), F.lit(0)).cast("int")
        final = F.least(F.ceil(hi) - 1, F.lit(n - 1)).cast("int")
        return F.when(first <= final, F.sequence(first, final))

    def overlap(lo, hi, at):
        return F.least(F.col(hi), F.col(at) + 1) - F.greatest(F.col(lo), F.col(at))

    return (
        b.withColumn("cell_row", F.explode(cells("ya", "yb", grid.n_rows)))
        .withColumn("cell_col", F.explode(cells("xa", "xb", grid.n_cols)))
        .select(
            region,
            *CELL,
            (overlap("ya", "yb", "cell_row") * overlap("xa", "xb", "cell_col")).alias("frac"),
        )
        .where(F.col("frac") > 0)
    )


def bad_regions(coverage: DataFrame, region: str = "region") -> DataFrame:
    """Regions that cover some cell more than once: overlapping or
    self-crossing rings. Reported, not repaired."""
    return (
        coverage.where(F.col("frac") > 1 + TWICE)
        .groupBy(region)
        .agg(F.count(F.lit(1)).alias("n_cells"), F.max("frac").alias("max_frac"))
    )


def bad_rings(rings: DataFrame, region: str = "region") -> DataFrame:
    """Rings with gaps in their vertex numbers, fewer than three distinct
    vertices (counted over consecutive repeats) or no area, which is summed in
    whole numbers. What rings do to each other is in `outlines`."""
    ring = [region, "ring_id"]
    whole = {f"__{c}": snapped(F.col(c)) for c in ("lon0", "lat0", "lon1", "lat1")}
    shape = (
        ring_edges(rings, region, strict=False)
        .withColumns(whole)
        .groupBy(*ring)
        .agg(
            F.count_if((F.col("lon0") != F.col("lon1")) | (F.col("lat0") != F.col("lat1"))).alias(
                "n_edges"
            ),
            twice_area(*whole).alias("twice_area"),
        )
    )
    numbering = rings.groupBy(*ring).agg(
        (F.count(F.lit(1)) != F.max("seq") - F.min("seq") + 1).alias("gaps")
    )
    reason = (
        F.when(F.col("gaps"), "gaps in vertex numbers")
        .when(F.col("n_edges") < 3, "fewer than three vertices")
        .when(F.col("twice_area") == 0, "zero area")
    )
    return (
        shape.join(numbering, ring)
        .withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .select(*ring, "reason")
    )


def polygon_area_km2(rings: DataFrame, region: str = "region", out: str = "area_km2") -> DataFrame:
    """Area of each region on the sphere; holes subtract by orientation."""
    excess = F.sum(lune_excess("lon0", "lat0", "lon1", "lat1"))
    return (
        ring_edges(rings, region)
        .groupBy(region)
        .agg((F.abs(excess) * SPHERE_RADIUS_KM**2).alias(out))
    )


def cell_table(
    values: DataFrame, people: DataFrame, grid: Grid, weight_year: int, time: str = "year"
) -> DataFrame:
    """One row per cell and year: value, people, density, and the weight
    (people in the weight year, missing as 0). `values` and `people` are
    (cell_row, cell_col, year, value) tables on the same grid."""
    v = values.select(*CELL, time, F.col("value"))
    p = people.select(*CELL, time, F.col("value").alias("people"))
    base = F.max(F.when(F.col(time) == weight_year, F.col("people")))
    return (
        v.join(p, [*CELL, time], "full")
        .withColumn("weight", null_weight_to_zero(base.over(Window.partitionBy(*CELL))))
        .withColumn("density", F.col("people") / grid.area_km2())
    )


def null_weight_to_zero(weight) -> Column:
    return F.coalesce(as_col(weight), F.lit(0.0))


def weighted_mean(value, weight, frac="frac") -> Column:
    """Aggregate: coverage-weighted mean with weights; NULL at zero weight."""
    v, w, f = as_col(value), as_col(weight), as_col(frac)
    return F.try_divide(F.sum(v * w * f), F.sum(F.when(v.isNotNull(), w * f)))


def area_mean(value, frac="frac") -> Column:
    """Aggregate: coverage-weighted mean, missing cells skipped."""
    v, f = as_col(value), as_col(frac)
    return F.try_divide(F.sum(v * f), F.sum(F.when(v.isNotNull(), f)))


def zonal_sum(value, frac="frac") -> Column:
    """Aggregate: sum of value times covered share."""
    return F.sum(as_col(value) * as_col(frac))


def zonal_stats(
    coverage: DataFrame,
    cells: DataFrame,
    region: str = "region",
    time: str = "year",
    **aggregates: Column,
) -> DataFrame:
    """All measures of every region and year from one join and one grouping."""
    return (
        coverage.join(cells, CELL)
        .groupBy(region, time)
        .agg(*(agg.alias(name) for name, agg in aggregates.items()))
    )


def with_all_regions(
    stats: DataFrame, regions: DataFrame, years: Sequence[int], region: str = "region", time: str = "year"
) -> DataFrame:
    """Every region in every one of the years, measured or not."""
    every = F.explode(F.array(*(F.lit(y) for y in years))).alias(time)
    spine = regions.select(region).distinct().select(region, every)
    return spine.join(stats, [region, time], "left")


def fallback_with_flag(df: DataFrame, first: str, second: str, out: str, flag: str) -> DataFrame:
    """First measure if there is one, else the second; the flag marks rows
    without the first."""
    return (
        df.withColumn(flag, F.col(first).isNull())
        .withColumn(out, F.coalesce(first, second))
        .drop(first, second)
    )


def flagged_count(df: DataFrame, region: str, flag: str) -> DataFrame:
    """How many distinct regions carry the flag."""
    return df.where(flag).select(region).distinct().agg(F.count(F.lit(1)).alias("n_flagged"))


def zonal_tables(
    coverage: DataFrame,
    cells: DataFrame,
    regions: DataFrame,
    years: Sequence[int],
    region: str = "region",
    time: str = "year",
) -> DataFrame:
    """Per region and year: gdppc with its zero_pop flag, pop and
    pop_wtd_density, from a `cell_table`."""
    stats = zonal_stats(
        coverage,
        cells,
        region,
        time,
        by_people=weighted_mean("value", "weight"),
        by_area=area_mean("value"),
        pop=zonal_sum("people"),
        pop_wtd_density=weighted_mean("density", "people"),
    )
    every = with_all_regions(stats, regions, years, region, time)
    filled = fallback_with_flag(every, "by_people", "by_area", "gdppc", "zero_pop")
    return filled.na.fill(0.0, ["pop", "pop_wtd_density"]).select(
        region, time, "gdppc", "zero_pop", "pop", "pop_wtd_density"
    )


def validate_national(
    df: DataFrame,
    published: DataFrame,
    country: str = "country",
    time: str = "year",
    value: str = "value",
    weight: str = "weight",
    published_value: str = "published",
) -> DataFrame:
    """Weighted national mean of the regions next to the published value."""
    v, w = F.col(value), F.col(weight)
    means = (
        df.where(v.isNotNull() & (w > 0))
        .groupBy(country, time)
        .agg((F.sum(v * w) / F.sum(w)).alias("natavg"))
    )
    ratio = F.try_divide(F.col("natavg"), F.col(published_value))
    return (
        means.join(published.select(country, time, published_value), [country, time])
        .withColumn("ratio", ratio)
        .withColumn(
            "pct_diff",
            F.try_divide(F.col("natavg") - F.col(published_value), F.col(published_value)) * 100,
        )
    )


def validation_by_year(validation: DataFrame, threshold: float, time: str = "year") -> DataFrame:
    """Per year: median ratio, and number of countries beyond the threshold."""
    over = validation.groupBy(time).agg(F.count_if(F.coalesce(F.abs("pct_diff") > threshold, F.lit(False))).alias("n_over"))
    medians = exact_quantiles(validation, ["ratio"], [time]).select(time, F.col("value").alias("median_ratio"))
    return over.join(medians, time, "left").select(time, "median_ratio", "n_over")


def validation_summary(validation: DataFrame, year: int, threshold: float, time: str = "year") -> DataFrame:
    """Base-year median ratio and number of countries beyond the threshold."""
    base = validation.where(F.col(time) == year)
    return validation_by_year(base, threshold, time).agg(
        F.max("median_ratio").alias("median_ratio"), F.coalesce(F.sum("n_over"), F.lit(0)).alias("n_over")
    )
