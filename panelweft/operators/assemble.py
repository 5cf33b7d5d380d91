"""Join the region-level pieces into one panel frame for all combinations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the panel's columns, in order.
PANEL_COLUMNS = [
    "hierid",
    "iso3",
    "year",
    "gdppc",
    "gdppc_raw",
    "gdppc_raw0",
    "gdp",
    "pop",
    "area_km2",
    "pop_density",
    "pop_wtd_density",
    "pop0to4",
    "pop5to64",
    "pop65plus",
]


def combos(df: DataFrame, **axes: Sequence[str]) -> DataFrame:
    """Copy each row for every value of the given axes, as leading columns."""
    out = df
    for name, values in axes.items():
        out = out.withColumn(name, F.explode(F.array(*(F.lit(v) for v in values))))
    return out.select(*axes, *df.columns)


def pick_base_year(df: DataFrame, year: int, time: str = "year") -> DataFrame:
    """One year's rows as a static attribute."""
    return df.where(F.col(time) == year).drop(time)


def left_join_all(base: DataFrame, *sides: tuple[DataFrame, Sequence[str]]) -> DataFrame:
    """Left join several (frame, keys) sides onto the base."""
    for frame, keys in sides:
        base = base.join(frame, list(keys), "left")
    return base


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.fill(0.0, list(columns))


def derive(df: DataFrame) -> DataFrame:
    """gdp and population density; density is 0 without a positive area."""
    density = F.when(F.col("area_km2") > 0, F.col("pop") / F.col("area_km2"))
    return df.withColumn("gdp", F.col("gdppc") * F.col("pop")).withColumn(
        "pop_density",
        F.when(F.col("area_km2").isNotNull(), F.coalesce(density, F.lit(0.0))),
    )


def project_and_order(df: DataFrame, leading: Sequence[str] = ()) -> DataFrame:
    """The panel's columns in their fixed order, combination keys in front.
    Row order is left to the sinks."""
    return df.select(*leading, *PANEL_COLUMNS)
