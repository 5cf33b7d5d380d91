"""A cube in dense chunks: fixed positions, labels aside, slices that read their own.

A chunk holds a box of the cube, `length` labels along each dimension. It is one row:
its number along each dimension and, for each measure, an array with a place for every
cell of the box in dimension order. Places without a cell are marked. Chunks lie in
folders by the dimensions with few labels, sorted by the others, so a slice opens the
folders and row groups that it needs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweft.functions.columns import laid_out

LENGTHS = {"scenario": 1, "gdp_model": 1, "hierid": 512, "year": 32}


@dataclass(frozen=True)
class ChunkedCube:
    """A stored cube. `dims` in order, with the chunk length of each."""

    path: str
    dims: tuple[str, ...]
    measures: tuple[str, ...]
    lengths: Mapping[str, int]
    folders: tuple[str, ...] = ("scenario", "gdp_model")

    def _number(self, dim: str) -> str:
        return f"chunk_{dim}"

    @property
    def size(self) -> int:
        return reduce(lambda a, b: a * b, (self.lengths[d] for d in self.dims))

    def chunks(self, cube: DataFrame) -> DataFrame:
        """Rows with a code per dimension (`<dim>_code`, from 0) to chunks. A cell
        that is given twice is an error."""
        numbers = [F.floor(F.col(f"{d}_code") / self.lengths[d]).cast("long").alias(self._number(d)) for d in self.dims]
        place = reduce(
            lambda p, d: p * self.lengths[d] + F.col(f"{d}_code") % self.lengths[d], self.dims, F.lit(0).cast("long")
        )
        cells = cube.select(*numbers, place.cast("int").alias("place"), F.lit(True).alias("present"), *self.measures)
        keys = [self._number(d) for d in self.dims]
        held = cells.groupBy(*keys).agg(
            F.sort_array(F.collect_list(F.struct("place", "present", *self.measures))).alias("at")  # one chunk at most
        )
        return held.select(*keys, *(laid_out("at", self.size, c).alias(c) for c in ("present", *self.measures)))

    def write(self, cube: DataFrame) -> None:
        """Chunks, and the labels of each dimension with their codes."""
        keys = [self._number(d) for d in self.dims]
        folders = [self._number(d) for d in self.folders]
        chunks = self.chunks(cube).repartitionByRange(*keys).sortWithinPartitions(*keys)
        chunks.write.partitionBy(*folders).parquet(f"{self.path}/chunks")
        for dim in self.dims:
            cube.select(F.col(f"{dim}_code").cast("long").alias("code"), F.col(dim).alias("label")).distinct().write.parquet(f"{self.path}/labels/{dim}")

    def _codes(self, spark: SparkSession, dim: str, labels: Sequence) -> list[int]:
        """Codes of the labels asked for, no more than are named."""
        table = spark.read.parquet(f"{self.path}/labels/{dim}")
        return sorted(r["code"] for r in table.where(F.col("label").isin(list(labels))).collect())

    def read(self, spark: SparkSession, **slices: Sequence) -> DataFrame:
        """Rows (codes, labels, measures) of the whole cube or of the given labels
        along some dimensions. Only chunks that hold such labels are read."""
        unknown = set(slices) - set(self.dims)
        if unknown:
            raise ValueError(f"no dimension {', '.join(sorted(unknown))}")
        chunks, keep = spark.read.parquet(f"{self.path}/chunks"), []
        for dim, labels in slices.items():
            codes = self._codes(spark, dim, labels)
            numbers = sorted({c // self.lengths[dim] for c in codes})
            chunks = chunks.where(F.col(self._number(dim)).isin(numbers) if numbers else F.lit(False))
            keep.append(F.col(f"{dim}_code").isin(codes) if codes else F.lit(False))
        numbers = [self._number(d) for d in self.dims]
        # a place counts if it is present; the other arrays are looked up there
        opened = chunks.select(*numbers, *self.measures, F.posexplode("present").alias("place", "present")).where("present")
        codes, rest = {}, F.col("place")
        for dim in reversed(self.dims):
            length = self.lengths[dim]
            codes[dim] = F.col(self._number(dim)) * length + rest % length
            rest = F.floor(rest / length)
        rows = opened.select(
            *(codes[d].cast("long").alias(f"{d}_code") for d in self.dims), *(F.get(c, F.col("place")).alias(c) for c in self.measures)
        )
        for condition in keep:
            rows = rows.where(condition)
        for dim in self.dims:
            labels = spark.read.parquet(f"{self.path}/labels/{dim}")
            rows = rows.join(labels.select(F.col("code").alias(f"{dim}_code"), F.col("label").alias(dim)), f"{dim}_code")
        return rows.select(*self.dims, *(f"{d}_code" for d in self.dims), *self.measures)
