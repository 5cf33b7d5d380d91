"""Grids as tables of square tiles, read where outlines meet them.

A tile is one row per year with its cells as an array in row order, absent and
missing cells as NULL, and the number, least and greatest of those that are there.
Tiles are folders on disk, so a query names the tiles that it needs and the scan
opens no others; they are unpacked after that.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweft.functions.columns import laid_out
from panelweft.operators.zonal import Grid

SIZE = 128  # cells along a side: a tile's array has 16,384 of them


@dataclass(frozen=True)
class TiledGrid:
    """A grid stored as tiles below a path."""

    path: str
    grid: Grid
    size: int = SIZE

    @property
    def across(self) -> int:
        return -(-self.grid.n_cols // self.size)

    def tile_of(self, row, col) -> Column:
        """The number of the tile that holds a cell."""
        part = lambda c: F.floor(F.col(c) / self.size) if isinstance(c, str) else F.floor(c / self.size)
        return part(row) * self.across + part(col)

    def tiles(self, cells: DataFrame, time: str = "year") -> DataFrame:
        """(cell_row, cell_col, year, value) -> tile, year, n, low, high, cells. A
        cell outside of the grid or given twice in a year is an error."""
        size, grid = self.size, self.grid
        inside = F.col("cell_row").between(0, grid.n_rows - 1) & F.col("cell_col").between(0, grid.n_cols - 1)
        place = F.col("cell_row") % size * size + F.col("cell_col") % size
        place = F.when(inside, place).otherwise(F.raise_error(F.lit("a cell lies outside of the grid")))
        packed = (
            cells.where("value is not null")
            .select(self.tile_of("cell_row", "cell_col").alias("tile"), F.col(time), place.cast("int").alias("place"), "value")
            .groupBy("tile", time)
            .agg(
                F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"),
                F.sort_array(F.collect_list(F.struct("place", "value"))).alias("at"),  # one tile at most
            )
        )
        return packed.select("tile", time, "n", "low", "high", laid_out("at", size * size, "value").alias("cells"))

    def write(self, cells: DataFrame, time: str = "year") -> None:
        tiles = self.tiles(cells, time)
        tiles.repartition("tile").sortWithinPartitions("tile", time).write.partitionBy("tile").parquet(self.path)

    def meeting(self, runs: DataFrame) -> list[int]:
        """The tiles that the regions of `coverage_runs` cover something of; no more
        than the grid has."""
        cols = F.explode(F.sequence(F.floor(F.col("first_col") / self.size), F.floor(F.col("last_col") / self.size)))
        rows = F.floor(F.col("cell_row") / self.size).alias("row")
        found = runs.select(rows, cols.alias("col")).distinct().select((F.col("row") * self.across + F.col("col")).alias("tile"))
        return sorted(r["tile"] for r in found.collect())

    def stored(self, spark: SparkSession, only: Sequence[int] | None = None, years: Sequence[int] | None = None, time: str = "year") -> DataFrame:
        """The stored tiles, of all or of some numbers and years."""
        form = f"{time} int, n long, low double, high double, cells array<double>, tile long"
        tiles = spark.read.schema(form).parquet(self.path)
        if only is not None:
            tiles = tiles.where(F.col("tile").isin(list(only)) if only else F.lit(False))
        return tiles if years is None else tiles.where(F.col(time).isin(list(years)))

    def cells(self, tiles: DataFrame, time: str = "year") -> DataFrame:
        """Tiles unpacked to (cell_row, cell_col, year, value), NULL left out."""
        size = self.size
        rows = tiles.select("tile", time, F.posexplode("cells").alias("place", "value")).where("value is not null")
        top, left = F.floor(F.col("tile") / self.across) * size, F.col("tile") % self.across * size
        return rows.select(
            (top + F.floor(F.col("place") / size)).cast("int").alias("cell_row"),
            (left + F.col("place") % size).cast("int").alias("cell_col"), time, "value",
        )

    def under(self, runs: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
        """The cells of those tiles that the regions meet."""
        return self.cells(self.stored(runs.sparkSession, self.meeting(runs), years))
