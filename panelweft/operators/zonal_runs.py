"""Zonal sums from runs of cells and prefix sums along grid rows.

A region is a thin outline of partly covered cells and, in each grid row, runs of
cells that it covers as a whole. The outline's cells are joined one by one; a run
takes its sums from two look-ups, the row's prefix sum at its last cell and the one
before its first. So the joins grow with the length of the outlines, not with
the area that they enclose.

Differences of prefix sums in floating point lose what a small run has beside a
large row. Here they are exact: every value is split into a multiple of a coarse
power of two, a multiple of a fine one, and a rest below that, chosen by the
largest value of its row and year so that whole rows of either kind add up without
rounding. What is dropped is below 1e-24 of the row's largest value for each cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweft.operators.zonal import Grid

SUMS = ("sum_vw", "sum_w", "sum_v", "n_v", "sum_p", "sum_dp")
MANTISSA = 52


def cell_sums(cells: DataFrame, grid: Grid, time: str = "year") -> DataFrame:
    """What a fully covered cell adds to each sum, from (cell_row, cell_col, year,
    value, people, weight): value x weight, weight, value and number of cells where
    there is a value; people; density x people."""
    has = F.col("value").isNotNull()
    at = lambda c: F.coalesce(F.when(has, c), F.lit(0.0))
    people = F.coalesce("people", F.lit(0.0))
    return cells.select(
        "cell_row", "cell_col", time,
        at(F.col("value") * F.col("weight")).alias("sum_vw"), at(F.col("weight")).alias("sum_w"),
        at(F.col("value")).alias("sum_v"), at(F.lit(1.0)).alias("n_v"),
        people.alias("sum_p"), (people / grid.area_km2() * people).alias("sum_dp"),
    )


def _quantum(largest: Column, n: int) -> Column:
    """A power of two of which sums of n values are exact multiples."""
    room = MANTISSA - (n - 1).bit_length()
    return F.pow(F.lit(2.0), F.ceil(F.log2(largest)) - room)


def prefix_sums(sums: DataFrame, wanted: DataFrame, grid: Grid, years: Sequence[int], time: str = "year") -> DataFrame:
    """(cell_row, cell_col, at): for each wanted place an entry per year, in order,
    with the sums of all cells of the row up to it, as pairs (coarse, fine)."""
    every = F.explode(F.array(*[F.lit(y) for y in years])).alias(time)
    asked = wanted.select("cell_row", "cell_col", every, *[F.lit(0.0).alias(c) for c in SUMS], F.lit(True).alias("asked"))
    rows = sums.where(F.col(time).isin(list(years))).withColumn("asked", F.lit(False)).unionByName(asked)
    row = Window.partitionBy("cell_row", time)
    upto = row.orderBy("cell_col").rangeBetween(Window.unboundedPreceding, 0)
    quanta = {f"q_{c}": F.max(F.abs(c)).over(row) for c in SUMS}
    split = rows.withColumns(quanta)
    for c in SUMS:
        # both steps are exact: scaling by a power of two, and rounding to whole numbers
        q = F.when(F.col(f"q_{c}") > 0, _quantum(F.col(f"q_{c}"), grid.n_cols)).otherwise(1.0)
        split = split.withColumn(f"q_{c}", q).withColumn(f"hi_{c}", F.rint(F.col(c) / F.col(f"q_{c}")) * F.col(f"q_{c}"))
        fine = F.col(f"q_{c}") * 2.0 ** -(MANTISSA - 1 - (grid.n_cols - 1).bit_length())
        split = split.withColumn(f"lo_{c}", F.rint((F.col(c) - F.col(f"hi_{c}")) / fine) * fine)
    parts = [f"{k}_{c}" for c in SUMS for k in ("hi", "lo")]
    summed = split.select("cell_row", "cell_col", time, "asked", *[F.sum(p).over(upto).alias(p) for p in parts])
    entry = F.struct(time, *parts)
    return summed.where("asked").groupBy("cell_row", "cell_col").agg(F.sort_array(F.collect_list(entry)).alias("at"))


def zonal_sums(
    runs: DataFrame, cells: DataFrame, grid: Grid, years: Sequence[int], region: str = "region", time: str = "year"
) -> DataFrame:
    """region, year and the sums over each region's cells, from `coverage_runs` and
    (cell_row, cell_col, year, value, people, weight)."""
    sums = cell_sums(cells, grid, time)
    edge = runs.where("not whole").select(region, "cell_row", F.col("first_col").alias("cell_col"), "frac")
    outline = edge.join(sums, ["cell_row", "cell_col"]).select(region, time, *[(F.col("frac") * F.col(c)).alias(c) for c in SUMS])
    whole = runs.where("whole").select(region, "cell_row", "last_col", (F.col("first_col") - 1).alias("before"), "frac")
    ends = F.explode(F.array(F.col("last_col"), F.col("before"))).alias("cell_col")
    wanted = whole.select("cell_row", ends).where("cell_col >= 0").distinct()
    prefix = prefix_sums(sums, wanted, grid, years, time)
    upto = lambda c, name: prefix.select("cell_row", F.col("cell_col").alias(c), F.col("at").alias(name))
    met = whole.join(upto("last_col", "upto"), ["cell_row", "last_col"]).join(upto("before", "less"), ["cell_row", "before"], "left")
    nothing = F.array().cast(prefix.schema["at"].dataType)  # before the first cell of a row
    met = met.withColumn("less", F.coalesce("less", nothing)).select(region, "frac", F.explode(F.arrays_zip("upto", "less")).alias("x"))

    def between(c):
        less = lambda k: F.coalesce(F.col(f"x.less.{k}_{c}"), F.lit(0.0))
        return (F.col(f"x.upto.hi_{c}") - less("hi")) + (F.col(f"x.upto.lo_{c}") - less("lo"))

    inner = met.select(region, F.col(f"x.upto.{time}").alias(time), *[(F.col("frac") * between(c)).alias(c) for c in SUMS])
    return outline.unionByName(inner).groupBy(region, time).agg(*[F.sum(c).alias(c) for c in SUMS])


def zonal_measures(sums: DataFrame, region: str = "region", time: str = "year") -> DataFrame:
    """Means by people and by area, people, and density weighted by people."""
    ratio = lambda a, b: F.try_divide(F.col(a), F.col(b))
    return sums.select(
        region, time, ratio("sum_vw", "sum_w").alias("by_people"), ratio("sum_v", "n_v").alias("by_area"),
        F.col("sum_p").alias("pop"), ratio("sum_dp", "sum_p").alias("pop_wtd_density"),
    )
