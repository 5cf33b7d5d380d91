"""Gated writers. Files are range-partitioned, never one task per panel."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweft.functions.columns import distinct_years
from panelweft.operators.checks import enforce
from panelweft.operators.hashtree import SUMS, content_sums
from panelweft.scale import is_complete, mark_complete, materialise, move, remove, running_total

COMBO = ["scenario", "gdp_model"]
MODEL_LABELS = {"IIASA": "IIASA GDP", "OECD": "OECD Env-Growth"}  # fixed values


def require_version_folder(path: str, version: str | None) -> None:
    """A versioned output must go to a folder named after its version."""
    if version is not None and PurePosixPath(path.rstrip("/")).name != str(version):
        raise ValueError(f"version {version} does not match the output folder {path}")


def _in_order(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_panels(
    panel: DataFrame,
    path: str,
    report: DataFrame,
    version: str | None = None,
    null_text: str = "",
) -> None:
    """One CSV folder per combination, written only if every check passed.
    Rows are ordered by region and year across the files of a folder.
    `null_text` is how a gap is spelled: empty, or NA for stage files."""
    require_version_folder(path, version)
    enforce(report)
    _in_order(panel, [*COMBO, "hierid", "year"]).write.mode("errorifexists").partitionBy(
        *COMBO
    ).csv(path, header=True, nullValue=null_text)


def write_stage(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """A stage table as CSV with NA for gaps."""
    _in_order(df, keys).write.mode("overwrite").csv(path, header=True, nullValue="NA")


def write_whole(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let `write` fill a folder beside the path, then mark it and move it there:
    a write that fails or is killed leaves nothing at the path."""
    pending = f"{path}.pending-{uuid.uuid4().hex[:12]}"
    try:
        write(pending)
        mark_complete(spark, pending)
        move(spark, pending, path)
    except BaseException:
        remove(spark, pending)
        raise


def cached(
    spark: SparkSession, folder: str, names: Sequence[str], build: Callable[[], dict[str, DataFrame]]
) -> dict[str, DataFrame]:
    """Tables under a folder as Parquet; built if one of them is not there
    with its success mark, and only those without it are written."""
    root = folder.rstrip("/")
    lost = [n for n in names if not is_complete(spark, f"{root}/{n}")]
    if lost:
        tables = build()
        for name in lost:
            tables[name].write.mode("overwrite").parquet(f"{root}/{name}")
    return {n: spark.read.parquet(f"{root}/{n}") for n in names}


def dense_codes(df: DataFrame, column: str, code: str) -> DataFrame:
    """(column, code): position of each distinct label in sorted order, from
    0. Labels are ranked by a distributed running count."""
    labels = df.select(column).where(F.col(column).isNotNull()).distinct()
    ranked = running_total(labels.withColumn("__one", F.lit(1)), [column], "__one", code)
    return ranked.select(column, (F.col(code) - 1).cast("long").alias(code))


class CubeError(Exception):
    """The panel does not form a full cube."""


def to_cube(
    panel: DataFrame,
    measures: Sequence[str],
    dims: Sequence[str] = ("scenario", "hierid", "gdp_model", "year"),
    relabel: dict[str, str] = MODEL_LABELS,
) -> DataFrame:
    """Every row with its position along each dimension and float32 measures.

    Years must be contiguous and every combination must hold each region in
    each year exactly once.
    """
    scenario, region, model, year = dims
    label = F.col(model)
    for old, new in relabel.items():
        label = F.when(F.col(model) == old, new).otherwise(label)
    # span, codes, counts and cells are all read from one staged copy
    named = materialise(panel.select(*dims, *measures).withColumn(model, label), "cube-input")
    span = named.agg(F.min(year).alias("lo"), F.max(year).alias("hi")).collect()[0]
    n_years = span["hi"] - span["lo"] + 1
    regions = materialise(dense_codes(named, region, f"{region}_code"), "codes")
    n_regions = regions.count()
    per_region = named.groupBy(scenario, model, region).agg(
        F.count(F.lit(1)).alias("rows"),
        distinct_years(year, span["lo"], span["hi"]).alias("years"),
    )
    combos = per_region.groupBy(scenario, model).agg(
        F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("regions"),
        F.min("years").alias("fewest"),
        F.max("years").alias("most"),
    )
    found = combos.collect()  # one row per combination
    if all(r["most"] < n_years for r in found):
        raise CubeError("years are not contiguous")
    for r in found:
        full = r["regions"] == n_regions and r["rows"] == n_regions * n_years
        if not full or r["fewest"] != n_years:
            raise CubeError(f"not a full grid: {r.asDict()}, expected {n_regions} regions")
    coded = named.join(regions, region)
    for dim in (scenario, model):  # a handful of labels, known from the combinations
        labels = F.array(*(F.lit(x) for x in sorted({r[dim] for r in found})))
        coded = coded.withColumn(f"{dim}_code", F.array_position(labels, F.col(dim)) - 1)
    return coded.select(
        *dims,
        *(f"{d}_code" for d in (scenario, region, model)),
        (F.col(year) - span["lo"]).cast("long").alias(f"{year}_code"),
        *(F.col(m).cast("float").alias(m) for m in measures),
    )


def write_cube(cube: DataFrame, path: str, dims: Sequence[str] = ("scenario", "hierid", "gdp_model", "year")) -> None:
    """The cube as Parquet in dimension order."""
    _in_order(cube, [f"{d}_code" for d in dims]).write.mode("errorifexists").parquet(path)


def fingerprints(panel: DataFrame, by: Sequence[str] = tuple(COMBO)) -> DataFrame:
    """Row count and two order-free content sums of each combination; equal rows
    do not cancel in them."""
    return panel.groupBy(*by).agg(*content_sums(sorted(panel.columns)))


def provenance(
    spark: SparkSession, entries: dict[str, str], panel: DataFrame | None = None, files: DataFrame | None = None
) -> DataFrame:
    """(item, value) rows: version, date, settings, source versions, a fingerprint
    per combination, and size and checksum of each file (path, bytes, md5)."""
    rows = spark.createDataFrame(list(entries.items()), "item string, value string")
    if panel is not None:
        prints = fingerprints(panel).select(
            F.concat_ws("/", F.lit("content"), *COMBO).alias("item"),
            F.concat_ws(" ", *(F.col(c).cast("string") for c in SUMS)).alias("value"),
        )
        rows = rows.unionByName(prints)
    if files is not None:
        named = files.select(F.concat(F.lit("file/"), "path").alias("item"), F.concat_ws(" ", F.col("bytes").cast("string"), "md5").alias("value"))
        rows = rows.unionByName(named)
    return rows


def with_dictionary(df: DataFrame, dictionary: dict[str, dict]) -> DataFrame:
    """Attach description, unit, source and dims to the columns as metadata."""
    known = {c: dictionary[c] for c in df.columns if c in dictionary}
    return df.select(
        *(F.col(c).alias(c, metadata=known[c]) if c in known else F.col(c) for c in df.columns)
    )
