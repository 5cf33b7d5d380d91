"""Table contracts for grids, rings and cubes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweft.functions.columns import band_year, country_of, null_if_nan


def raster_to_cells(bands: DataFrame, band: str = "band", value: str = "value") -> DataFrame:
    """(band, cell_row, cell_col, value) rows to the cell table: the year
    comes from the band name, NaN becomes NULL. Align two rasters with
    `Grid.require_same` first."""
    return bands.select(
        F.col("cell_row").cast("int").alias("cell_row"),
        F.col("cell_col").cast("int").alias("cell_col"),
        band_year(band).alias("year"),
        null_if_nan(value).alias("value"),
    )


def rings_from_vertices(df: DataFrame, region: str = "hierid") -> DataFrame:
    """(region, ring_id, seq, lon, lat), in degrees on WGS84. Rows outside
    the valid range are an error of the source."""
    wanted = {region: "string", "ring_id": "int", "seq": "int", "lon": "double", "lat": "double"}
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError("ring table lacks columns: " + ", ".join(missing))
    rings = df.select(*(F.col(c).cast(t).alias(c) for c, t in wanted.items()))
    outside = ~(F.col("lon").between(-180, 180) & F.col("lat").between(-90, 90))
    gaps = F.greatest(*(F.col(c).isNull() for c in wanted))
    wrong = rings.where(gaps | outside).limit(1).collect()
    if wrong:
        raise ValueError(f"ring table has an unusable vertex: {wrong[0].asDict()}")
    return rings


def regions_of(rings: DataFrame, region: str = "hierid", country: str = "iso3") -> DataFrame:
    """Distinct regions with their country."""
    return rings.select(region).distinct().withColumn(country, country_of(region))


def cube_to_long(
    cube: DataFrame, dims: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Labelled arrays to rows. Each row of `cube` is one chunk: a coordinate
    array per dimension and, per measure, arrays nested in that order."""
    rows = cube.select(*dims, *measures)
    for dim in dims:
        others = [c for c in rows.columns if c != dim and c not in measures]
        rows = rows.select("*", F.posexplode(dim).alias("__at", "__label")).select(
            *others,
            F.col("__label").alias(dim),
            *(F.col(m)[F.col("__at")].alias(m) for m in measures),
        )
    return rows.select(*dims, *(null_if_nan(m).alias(m) for m in measures))
