"""Spread national totals over regions, and scale regions to targets.

Country sums are plain grouped aggregates (partially summed before the
shuffle) joined back to the regions, not windows over a country: one country
may hold a large part of all regions. `lookup` prepares the national side of
each join; by default it is staged, measured, and broadcast if small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweft.operators.lanes import Lanes, per_lane
from panelweft.scale import bounded


def allocate_fixed(
    weights: DataFrame,
    control: DataFrame,
    keys: Sequence[str],
    time: str = "year",
    weight: str = "weight",
    total: str = "total",
    unit: float = 1.0,
    out: str = "value",
    lookup=bounded,
) -> DataFrame:
    """weight / country weight * total, for every year of the control.
    `weights` has one row per region; a zero weight sum gives NULL."""
    keys = list(keys)
    sums = weights.groupBy(*keys).agg(F.sum(weight).alias("__sum"))
    national = control.select(*keys, time, total).join(sums, keys)
    share = F.try_divide(F.col(weight) * (F.col(total) * unit), F.col("__sum"))
    return weights.join(lookup(national), keys).withColumn(out, share).drop(weight, total, "__sum")


def freeze_uncontrolled(
    weights: DataFrame,
    control: DataFrame,
    keys: Sequence[str],
    time: str = "year",
    weight: str = "weight",
    out: str = "value",
    within: Sequence[str] = (),
    lookup=bounded,
) -> DataFrame:
    """Regions of countries without any control keep their weight as value
    from the control's first to its last year."""
    keys, within = list(keys), list(within)
    idle = weights.join(lookup(control.select(*keys).distinct()), keys, "left_anti")
    span = [F.min(time).alias("__lo"), F.max(time).alias("__hi")]
    if within:
        idle = idle.join(lookup(control.groupBy(*within).agg(*span)), within)
    else:
        idle = idle.withColumn("__lo", control.agg(span[0]).scalar()).withColumn(
            "__hi", control.agg(span[1]).scalar()
        )
    return (
        idle.withColumn(time, F.explode(F.sequence("__lo", "__hi")))
        .withColumnRenamed(weight, out)
        .drop("__lo", "__hi")
    )


def backfill_constant(
    df: DataFrame, anchor: int, first: int, last: int, time: str = "year"
) -> DataFrame:
    """Repeat the anchor year's rows over first..last, ahead of the frame."""
    copies = df.where(F.col(time) == anchor).withColumn(
        time, F.explode(F.sequence(F.lit(first), F.lit(last)))
    )
    return copies.select(*df.columns).unionByName(df)


def allocate_yearly(
    weights: DataFrame,
    control: DataFrame,
    keys: Sequence[str],
    time: str = "year",
    weight: str = "weight",
    total: str = "total",
    unit: float = 1.0,
    out: str = "value",
    lookup=bounded,
) -> DataFrame:
    """Like allocate_fixed with each year's own weights; a zero weight sum
    gives 0, a year without control gives no row."""
    at = [*keys, time]
    sums = weights.groupBy(*at).agg(F.sum(weight).alias("__sum"))
    national = control.select(*at, total).join(sums, at)
    share = F.when(F.col("__sum") > 0, F.col(weight) / F.col("__sum")).otherwise(F.lit(0.0))
    return (
        weights.join(lookup(national), at)
        .withColumn(out, share * F.col(total) * unit)
        .drop(weight, total, "__sum")
    )


def keep_uncontrolled(
    weights: DataFrame,
    control: DataFrame,
    keys: Sequence[str],
    weight: str = "weight",
    out: str = "value",
    lookup=bounded,
) -> DataFrame:
    """Rows of countries that have no control in any year, weight as value."""
    idle = weights.join(lookup(control.select(*keys).distinct()), list(keys), "left_anti")
    return idle.withColumnRenamed(weight, out)


def allocate_or_freeze(
    weights: DataFrame,
    control: DataFrame,
    keys: Sequence[str],
    within: Sequence[str] = (),
    time: str = "year",
    weight: str = "weight",
    total: str = "total",
    unit: float = 1.0,
    out: str = "value",
    lookup=bounded,
    rows: DataFrame | None = None,
    lanes: Lanes | None = None,
) -> DataFrame:
    """`allocate_fixed` and `freeze_uncontrolled` in one pass over the
    regions: the national table also lists the countries without control,
    for every year of the control and with no total. `rows` are the weights
    in another layout, to sum up. With `lanes`, the weights lack their axes, which
    `rows` have, and the result has wide rows."""
    keys, within = list(keys), list(within)
    sums = (weights if rows is None else rows).groupBy(*keys).agg(F.sum(weight).alias("__sum"))
    spans = control.groupBy(*within).agg(F.sequence(F.min(time), F.max(time)).alias("__years"))
    idle = sums.join(control.select(*keys).distinct(), keys, "left_anti")
    if within:
        idle = idle.join(spans, within)
    else:
        idle = idle.withColumn("__years", spans.scalar())
    idle = idle.select(
        *keys, "__sum", F.explode("__years").alias(time), F.lit(None).cast("double").alias(total)
    )
    national = sums.join(control.select(*keys, time, total), keys).unionByName(idle)
    if lanes:
        keys = [k for k in keys if k not in lanes.names]
        national = lanes.pack(national, [*keys, time], [total, "__sum"]).drop("__n")
    return _spread(weights, lookup(national), keys, weight, total, unit, out, False, lanes and len(lanes))


def allocate_or_keep(
    weights: DataFrame,
    control: DataFrame,
    keys: Sequence[str],
    time: str = "year",
    weight: str = "weight",
    total: str = "total",
    unit: float = 1.0,
    out: str = "value",
    lookup=bounded,
    rows: DataFrame | None = None,
) -> DataFrame:
    """`allocate_yearly` and `keep_uncontrolled` in one pass over the
    regions. `rows` are the weights in another layout, to sum up."""
    at = [*keys, time]
    sums = (weights if rows is None else rows).groupBy(*at).agg(F.sum(weight).alias("__sum"))
    idle = sums.join(control.select(*keys).distinct(), list(keys), "left_anti")
    idle = idle.withColumn(total, F.lit(None).cast("double"))
    national = sums.join(control.select(*at, total), at).unionByName(idle.select(*at, "__sum", total))
    return _spread(weights, lookup(national), at, weight, total, unit, out, True)


def _spread(weights, national, on, weight, total, unit, out, guarded, lanes=None):
    """Region values from a national table; no total means the weight stays."""

    def kept(of):
        if guarded:
            share = F.when(of("__sum") > 0, F.col(weight) / of("__sum")).otherwise(F.lit(0.0))
            value = share * of(total) * unit
        else:
            value = F.try_divide(F.col(weight) * (of(total) * unit), of("__sum"))
        found = F.when(of(total).isNull(), F.col(weight)).otherwise(value)
        return found if lanes is None else F.when(of("has"), found)  # no row, no value

    return weights.join(national, list(on)).withColumn("__value", per_lane(lanes, kept)).drop(
        weight, total, "__sum"
    ).withColumnRenamed("__value", out)


def weighted_means(
    df: DataFrame, by: Sequence[str], value: str, weight: str, out: str = "mean"
) -> DataFrame:
    """Weighted mean per group over rows with a value and a positive weight."""
    usable = df.where(F.col(value).isNotNull() & (F.col(weight) > 0))
    mean = F.sum(F.col(value) * F.col(weight)) / F.sum(weight)
    return usable.groupBy(*by).agg(mean.alias(out))


def reconcile_weighted_mean(
    df: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    since: int,
    time: str = "year",
    value: str = "value",
    weight: str = "weight",
    target_value: str = "target",
    lookup=bounded,
) -> DataFrame:
    """Scale each country-year so that its weighted mean equals the target.
    Years before `since` and country-years without a target stay as they
    are; regions without weight are scaled along with their country."""
    at = [*keys, time]
    factors = (
        weighted_means(df.where(F.col(time) >= since), at, value, weight, "__mean")
        .where(F.col("__mean") > 0)
        .join(target.select(*at, target_value), at)
        .select(*at, (F.col(target_value) / F.col("__mean")).alias("__factor"))
    )
    scaled = F.col(value) * F.coalesce(F.col("__factor"), F.lit(1.0))
    return df.join(lookup(factors), at, "left").withColumn(value, scaled).drop("__factor")


def reconcile_growth(
    growth: DataFrame,
    start: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    within: Sequence[str] = (),
    time: str = "year",
    value: str = "value",
    weight: str = "weight",
    target_value: str = "target",
    growth_value: str = "growth",
    present: DataFrame | None = None,
) -> DataFrame:
    """The same scaling for regions that all move with one national growth
    path and keep their share of the weight: each country's weighted mean is
    then its starting mean times the growth, so the path itself can be set
    to target / starting mean and no region-year row is touched. `start` has
    one row per region. `present` (keys, time) lists the country-years that
    have weight at all; others keep their own path."""
    keys, full = list(keys), [*within, *keys]
    if present is not None:
        target = target.join(present.select(*keys, time).distinct(), [*keys, time], "left_semi")
    mean = weighted_means(start, keys, value, weight, "__mean")
    level = F.col("__mean") * F.col(growth_value)
    fitted = F.when(
        (level > 0) & F.col(target_value).isNotNull(), F.col(target_value) / F.col("__mean")
    ).otherwise(F.col(growth_value))
    return (
        growth.join(mean, keys, "left")
        .join(target.select(*full, time, target_value), [*full, time], "left")
        .select(*full, time, fitted.alias(growth_value))
    )
