"""Explicit gap-filling: calibration, fallbacks, overrides, imputation."""

from __future__ import annotations

from collections.abc import Sequence
from operator import mul

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweft.functions.columns import as_col
from panelweft.scale import bounded


def calibrate_share(raw, shape, level) -> Column:
    """raw / shape * level where all three exist and shape is positive."""
    raw, shape, level = as_col(raw), as_col(shape), as_col(level)
    return F.when(shape > 0, raw / shape * level)


def fallback_whole_group(
    df: DataFrame, group: Sequence[str], value: str, instead: Column, lookup=bounded
) -> DataFrame:
    """Fill from `instead` only in groups without a single value; a group
    that has some values is left with its gaps."""
    group = list(group)
    has = df.groupBy(*group).agg(F.count(value).alias("__n"))
    filled = F.when(F.col("__n") == 0, instead).otherwise(F.col(value))
    return df.join(lookup(has), group).withColumn(value, filled).drop("__n")


def fallback_chain(df: DataFrame, value: str, where: Column, *choices) -> DataFrame:
    """First available choice on the rows picked by `where`."""
    first = F.coalesce(*(as_col(c) for c in choices))
    return df.withColumn(value, F.when(where, first).otherwise(F.col(value)))


def update_join(target: DataFrame, patch: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Overwrite a column wherever the patch has the key."""
    news = patch.select(*keys, F.col(col).alias("__new"), F.lit(True).alias("__hit"))
    value = F.when(F.col("__hit"), F.col("__new")).otherwise(F.col(col))
    return target.join(news, list(keys), "left").withColumn(col, value).drop("__new", "__hit")


def roll_forward(
    df: DataFrame,
    keys: Sequence[str],
    last: int,
    growths: Sequence[tuple[DataFrame, str]],
    default: Column,
    time: str = "year",
    value: str = "value",
    lookup=bounded,
    times=mul,
) -> DataFrame:
    """The rows of year `last` moved one year ahead by the first growth that
    covers their key, else by the default. `times` multiplies a value by it."""
    ahead = df.where(F.col(time) == last)
    names = []
    for frame, name in growths:
        ahead = ahead.join(lookup(frame), [k for k in keys if k in frame.columns], "left")
        names.append(name)
    rate = F.coalesce(*names, default)
    return (
        ahead.withColumn(value, times(F.col(value), rate))
        .withColumn(time, F.lit(last + 1))
        .select(*df.columns)
    )


def log_path(
    anchors: DataFrame,
    keys: Sequence[str],
    from_year: int,
    to_year: int,
    first: int,
    last: int,
    start: str = "start",
    end: str = "end",
    time: str = "year",
    out: str = "path",
) -> DataFrame:
    """Log-linear path between two anchor levels. A key missing either anchor
    has no path."""
    pace = F.ln(F.col(end) / F.col(start)) / (to_year - from_year)
    return (
        anchors.where((F.col(start) > 0) & (F.col(end) > 0))
        .withColumn(time, F.explode(F.sequence(F.lit(first), F.lit(last))))
        .select(*keys, time, (F.col(start) * F.exp(pace * (F.col(time) - from_year))).alias(out))
    )


def override_path(
    df: DataFrame,
    raw: DataFrame,
    path: DataFrame,
    keys: Sequence[str],
    region: Sequence[str],
    first: int,
    last: int,
    time: str = "year",
    value: str = "value",
    raw_value: str = "raw",
    shape: str = "shape",
    path_value: str = "path",
    lookup=bounded,
) -> DataFrame:
    """Replace a group's rows from year `first` on: regional shape times the
    given national path, and in year `last` the previous year's value moved
    by the path. Groups without a path keep their rows.

    `raw` carries, per region and year, the raw value and the national shape.
    """
    keys = list(keys)
    path = lookup(path)
    following = path.select(
        *keys, (F.col(time) - 1).alias(time), F.col(path_value).alias("__next")
    )
    shaped = (
        raw.where((F.col(shape) > 0) & F.col(raw_value).isNotNull())
        .where(F.col(time).between(first, last - 1))
        .join(path, [*keys, time])
        .join(following, [*keys, time])
        .withColumn(value, F.col(raw_value) / F.col(shape) * F.col(path_value))
    )
    moved = F.col(value) / F.col(path_value) * F.col("__next")
    now = F.struct(F.col(time).alias(time), F.col(value).alias(value))
    then = F.struct((F.col(time) + 1).alias(time), moved.alias(value))
    both = F.when(F.col(time) == last - 1, F.array(now, then)).otherwise(F.array(now))
    spread = shaped.select(*keys, *region, F.explode(both).alias("__at")).select(
        *keys, *region, F.col(f"__at.{time}").alias(time), F.col(f"__at.{value}").alias(value)
    )
    replaced = lookup(path.select(*keys).distinct().withColumn("__replaced", F.lit(True)))
    kept = (
        df.join(replaced, keys, "left")
        .where(F.col("__replaced").isNull() | (F.col(time) < first))
        .select(*df.columns)
    )
    return kept.unionByName(spread.select(*df.columns))


def extend_spine(
    df: DataFrame, ids: DataFrame, first: int, last: int, time: str = "year"
) -> DataFrame:
    """Empty rows for first..last for every id, ahead of the frame. `ids`
    has one row per id."""
    empty = ids.withColumn(time, F.explode(F.sequence(F.lit(first), F.lit(last))))
    return empty.unionByName(df, allowMissingColumns=True).select(*df.columns)


def period_mean(
    region: Sequence[str], first: int, last: int, time: str = "year", value: str = "value"
) -> Column:
    """Window column: a region's own mean over a period, gaps skipped. The
    window is ordered by time so that it shares its sort with the smoothing
    windows; the frame is the whole series."""
    inside = F.when(F.col(time).between(first, last), F.col(value))
    whole = Window.partitionBy(*region).orderBy(time)
    return F.avg(inside).over(
        whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
