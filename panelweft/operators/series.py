"""Irregular national series to annual paths, growth chains and splices.

All windows here are partitioned by a full series key and so hold at most one
row per calendar year; (key, year) must be unique. Steps that share a key
reuse one exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from operator import mul

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelweft.functions.columns import geomean, null_if_nan
from panelweft.scale import bounded


def interpolate(
    df: DataFrame,
    keys: Sequence[str],
    time: str = "year",
    value: str = "value",
    log: bool = False,
) -> DataFrame:
    """Every year between a key's first and last knot, linear in the value or
    in its logarithm. Knots must be positive; one knot alone yields nothing;
    nothing is extrapolated. Two knots of a key in one year are an error that
    names the key."""
    w = Window.partitionBy(*keys).orderBy(time)
    knots = (
        df.select(*keys, time, null_if_nan(value).alias("__v0"))
        .where(F.col("__v0") > 0)
        .withColumn("__t1", F.lead(time).over(w))
        .withColumn("__v1", F.lead("__v0").over(w))
        .withColumn("__alone", F.lag(time).over(w).isNull() & F.col("__t1").isNull())
        .where(~F.col("__alone"))
    )
    named = F.concat_ws(", ", *(F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in [*keys, time]))
    twice = F.raise_error(F.concat(F.lit("two knots for ("), named, F.lit(")")))
    until = F.when(F.col("__t1") == F.col(time), twice.cast("int")).otherwise(
        F.coalesce(F.col("__t1") - 1, F.col(time))
    )
    years = knots.withColumn("__t0", F.col(time)).withColumn(
        time, F.explode(F.sequence(F.col(time), until))
    )
    part = (F.col(time) - F.col("__t0")) / (F.col("__t1") - F.col("__t0"))
    v0, v1 = F.col("__v0"), F.col("__v1")
    between = F.exp(F.ln(v0) + (F.ln(v1) - F.ln(v0)) * part) if log else v0 + (v1 - v0) * part
    filled = F.when(F.col(time) == F.col("__t0"), v0).otherwise(between)
    return years.select(*keys, time, filled.alias(value))


def growth_since(
    df: DataFrame,
    keys: Sequence[str],
    base: int,
    time: str = "year",
    value: str = "value",
    out: str = "growth",
) -> DataFrame:
    """Value over the key's own value in the base year, for later years."""
    at_base = F.max(F.when(F.col(time) == base, F.col(value))).over(Window.partitionBy(*keys))
    return (
        df.withColumn("__base", at_base)
        .where((F.col(time) > base) & F.col("__base").isNotNull())
        .select(*keys, time, F.try_divide(F.col(value), F.col("__base")).alias(out))
    )


def ratio_between(
    df: DataFrame,
    keys: Sequence[str],
    first: int,
    last: int,
    time: str = "year",
    value: str = "value",
    out: str = "ratio",
) -> DataFrame:
    """value(last) / value(first) per key, where both exist and first is
    positive."""
    return (
        df.where(F.col(time).isin(first, last))
        .groupBy(*keys)
        .agg(
            F.max(F.when(F.col(time) == first, F.col(value))).alias("__a"),
            F.max(F.when(F.col(time) == last, F.col(value))).alias("__b"),
        )
        .where((F.col("__a") > 0) & F.col("__b").isNotNull())
        .select(*keys, (F.col("__b") / F.col("__a")).alias(out))
    )


def geomean_by(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """Geometric mean of a positive column, overall or per group."""
    return df.groupBy(*by).agg(geomean(value).alias(out))


def annualised_bridge(
    df: DataFrame,
    keys: Sequence[str],
    start: int,
    end: int,
    steps: int = 2,
    time: str = "year",
    value: str = "value",
    out: str = "growth",
) -> DataFrame:
    """Constant-rate growth for the `steps` years ending at `start`, taken
    from the average annual rate between `start` and `end`."""
    rates = ratio_between(df, keys, start, end, time, value, "__total")
    step = F.col("__step")
    rate = F.pow(F.col("__total"), F.lit(1.0 / (end - start)))
    return (
        rates.withColumn("__step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
        .select(
            *keys,
            (F.lit(start - steps) + step).cast("int").alias(time),
            F.pow(rate, step.cast("double")).alias(out),
        )
    )


def chain_growth(
    bridge: DataFrame,
    path: DataFrame,
    keys: Sequence[str],
    at: int,
    time: str = "year",
    growth: str = "growth",
) -> DataFrame:
    """Growth of one source up to year `at`, then another source's growth
    since `at` scaled by the first one's level there."""
    link = bridge.where(F.col(time) == at).select(*keys, F.col(growth).alias("__link"))
    later = path.join(link, list(keys)).select(
        *keys, time, (F.col("__link") * F.col(growth)).alias(growth)
    )
    return bridge.where(F.col(time) <= at).select(*keys, time, growth).unionByName(later)


def bridge_and_chain(
    lead_growth: DataFrame,
    late: DataFrame,
    keys: Sequence[str],
    start: int,
    time: str = "year",
    value: str = "value",
) -> DataFrame:
    """Growth of a source that begins in `start`, for keys the leading
    source covers: the leading growth up to `start`, then chained."""
    shared = late.select(*keys).distinct()
    bridge = lead_growth.where(F.col(time) <= start).join(shared, list(keys), "left_semi")
    return chain_growth(bridge, growth_since(late, keys, start, time, value), keys, start, time)


def bridge_alone(
    lead_growth: DataFrame,
    late: DataFrame,
    keys: Sequence[str],
    start: int,
    rate_until: int,
    steps: int = 2,
    time: str = "year",
    value: str = "value",
) -> DataFrame:
    """Growth for keys only the late source has: its own average rate stands
    in for the years before it begins."""
    alone = late.join(lead_growth.select(*keys).distinct(), list(keys), "left_anti")
    bridge = annualised_bridge(alone, keys, start, rate_until, steps, time, value)
    return chain_growth(bridge, growth_since(alone, keys, start, time, value), keys, start, time)


def late_growth(
    lead_growth: DataFrame,
    late: DataFrame,
    keys: Sequence[str],
    start: int,
    rate_until: int,
    steps: int = 2,
    time: str = "year",
    value: str = "value",
) -> DataFrame:
    """`bridge_and_chain` and `bridge_alone` together: each key of the late
    source is bridged by the leading growth where there is any, else by its
    own rate, and all are chained in one go."""
    keys = list(keys)
    shared = late.select(*keys).distinct()
    covered = lead_growth.select(*keys).distinct()
    bridge = (
        lead_growth.where(F.col(time) <= start)
        .join(shared, keys, "left_semi")
        .unionByName(
            annualised_bridge(
                late.join(covered, keys, "left_anti"), keys, start, rate_until, steps, time, value
            )
        )
    )
    return chain_growth(bridge, growth_since(late, keys, start, time, value), keys, start, time)


def cross_fill(chosen: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All of `chosen`, plus every row of `other` whose key it lacks."""
    missing = other.join(chosen.select(*keys).distinct(), list(keys), "left_anti")
    return chosen.unionByName(missing)


def fill_uncovered(
    growth: DataFrame,
    wanted: DataFrame,
    member: str,
    within: Sequence[str] = (),
    time: str = "year",
    value: str = "growth",
) -> DataFrame:
    """Give each wanted key without any growth the geometric mean path of all
    keys (of its group, when `within` names one).

    The mean path is packed into one array per group, at most one entry per
    year, and unpacked for the keys that need it.
    """
    within = list(within)
    key = [*within, member]
    lacking = wanted.select(*key).distinct().join(growth.select(*key).distinct(), key, "left_anti")
    path = F.array_sort(F.collect_list(F.struct(F.col(time), F.col(value))))
    means = geomean_by(growth, [*within, time], value, value)
    if within:
        packed = lacking.join(means.groupBy(*within).agg(path.alias("__path")), within)
    else:
        packed = lacking.withColumn("__path", means.agg(path).scalar())
    fill = packed.select(*key, F.inline("__path")).select(*key, time, value)
    return growth.select(*key, time, value).unionByName(fill)


def project(
    base: DataFrame,
    growth: DataFrame,
    keys: Sequence[str],
    value: str,
    growth_value: str = "growth",
    lookup=bounded,
    times=mul,
) -> DataFrame:
    """One row per base row and growth year of its key: value * growth, as `times`
    multiplies them."""
    moved = base.withColumnRenamed(value, "__level").join(lookup(growth), list(keys))
    return moved.withColumn(value, times(F.col("__level"), F.col(growth_value))).drop(
        "__level", growth_value
    )


def splice_rebase(
    first: DataFrame,
    second: DataFrame,
    keys: Sequence[str],
    handoff: int,
    since: int,
    time: str = "year",
    value: str = "value",
) -> DataFrame:
    """`first` through the handoff year, then `second` rebased to the level
    `first` has there. Keys without a positive anchor in both stay on
    `first` throughout; keys only in `second` get nothing. The result is
    interpolated to every year."""
    keys = list(keys)

    def anchor(df, name):
        at = df.where((F.col(time) == handoff) & (F.col(value) > 0))
        return at.select(*keys, F.col(value).alias(name))

    anchors = anchor(first, "__first").join(anchor(second, "__second"), keys)
    late = (
        second.where(F.col(time) > handoff)
        .join(anchors, keys)
        .select(
            *keys, time, (F.col("__first") * F.col(value) / F.col("__second")).alias(value)
        )
    )
    early = (
        first.where(F.col(time) >= since)
        .join(anchors.select(*keys, F.lit(True).alias("__anchored")), keys, "left")
        .where((F.col(time) <= handoff) | F.col("__anchored").isNull())
        .select(*keys, time, value)
    )
    return interpolate(early.unionByName(late), keys, time, value)


def step_years(
    knots: DataFrame, first: int, last: int, time: str = "year", within: Sequence[str] = ()
) -> DataFrame:
    """(within..., year, knot): the latest knot at or before each year; years
    before the first knot are absent. Knots are the distinct years of each
    `within` group, one entry per calendar year at most."""
    known = knots.groupBy(*within).agg(F.collect_set(time).alias("__knots"))
    years = known.withColumn(time, F.explode(F.sequence(F.lit(first), F.lit(last))))
    latest = F.array_max(F.filter("__knots", lambda k: k <= F.col(time)))
    return years.select(*within, time, latest.alias("knot")).where(F.col("knot").isNotNull())


def step_lookup(
    df: DataFrame, first: int, last: int, time: str = "year", within: Sequence[str] = ()
) -> DataFrame:
    """Hold values constant between knots, for every year of the span. The
    knot set is shared by all keys of a `within` group (a scenario), so a key
    lacking a knot has no rows until the next one. The year table has one row
    per group and year of the span and is sent to every task."""
    years = bounded(step_years(df.select(*within, time), first, last, time, within))
    return df.withColumnRenamed(time, "knot").join(years, [*within, "knot"]).drop("knot")
