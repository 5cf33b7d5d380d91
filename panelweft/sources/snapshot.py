"""Derive further scenarios from a full release, gated on a snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweft.functions.columns import ascii_fold, rel_diff
from panelweft.scale import bounded

MATCH_TOL = 1e-12
ROW_IDS = ["model", "scenario", "region", "variable"]


class GateFailed(Exception):
    """The release does not reproduce the snapshot; nothing may be written."""


def within_snapshot(release: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Release rows whose (model, variable) and (model, region) occur in the
    snapshot. Region names are compared with non-ASCII characters folded;
    the folded name is kept as `folded`."""
    # the release has few keys, each with very many rows: small lists are sent
    # to its rows instead of gathering them by key
    variables = bounded(snapshot.select("model", "variable").distinct())
    regions = bounded(snapshot.select("model", ascii_fold("region").alias("folded")).distinct())
    return (
        release.withColumn("folded", ascii_fold("region"))
        .join(variables, ["model", "variable"], "left_semi")
        .join(regions, ["model", "folded"], "left_semi")
    )


def gate_report(eligible: DataFrame, snapshot: DataFrame) -> DataFrame:
    """One row: snapshot cells, cells the release lacks, and the largest
    relative difference."""
    key = ["model", "scenario", "folded", "variable", "year"]
    cells = snapshot.select(
        "model", "scenario", ascii_fold("region").alias("folded"), "variable", "year", "value"
    )
    theirs = eligible.select(*key, F.col("value").alias("__value"))
    return cells.join(theirs, key, "left").agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.count_if(F.col("__value").isNull()).alias("n_missing"),
        F.coalesce(F.max(rel_diff("value", "__value")), F.lit(0.0)).alias("max_rel"),
    )


def new_rows(
    eligible: DataFrame, scenarios: Sequence[str], years: Sequence[int]
) -> DataFrame:
    """Wide rows of the new scenarios in the snapshot's layout."""
    ids = [*ROW_IDS, "unit"]
    return (
        eligible.where(F.col("scenario").isin(list(scenarios)))
        .groupBy(*ids)
        .pivot("year", list(years))
        .agg(F.max("value"))
    )


def derive_gated_snapshot(
    release: DataFrame,
    snapshot: DataFrame,
    scenarios: Sequence[str],
    years: Sequence[int],
) -> DataFrame:
    """New scenarios from the release, only if it reproduces every cell of
    the snapshot."""
    eligible = within_snapshot(release, snapshot)
    gate = gate_report(eligible, snapshot).collect()[0]
    if gate["n_missing"] or gate["max_rel"] > MATCH_TOL:
        raise GateFailed(
            f"{gate['n_missing']} of {gate['n_cells']} snapshot cells missing, "
            f"largest relative difference {gate['max_rel']:.3e}"
        )
    return new_rows(eligible, scenarios, years).orderBy(*ROW_IDS)


def rows_per_scenario(wide: DataFrame) -> DataFrame:
    return wide.groupBy("model", "scenario").agg(F.count(F.lit(1)).alias("n_rows"))
