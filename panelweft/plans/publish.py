"""A whole run: build, check, and write everything or nothing."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweft.operators.checks import Expected, cross_panel_checks, enforce
from panelweft.operators.compare import source_summary
from panelweft.plans.config import PanelConfig, PanelSources
from panelweft.plans.dictionary import PANEL_DICTIONARY
from panelweft.plans.panel import build_panel, check_panel, expected_records
from panelweft.scale import Observed, is_complete, materialise
from panelweft.sinks.writers import (
    provenance,
    require_version_folder,
    to_cube,
    with_dictionary,
    write_cube,
    write_panels,
    write_whole,
)
from panelweft.sources.manifest import file_digests, require_inputs, verify_inputs

MEASURES = [c for c in PANEL_DICTIONARY if c not in ("scenario", "gdp_model", "hierid", "iso3", "year")]


def source_report(src: PanelSources) -> DataFrame:
    """Rows, members and years of every source with a time axis."""
    national = ("accounts", "gridded", "ssp_gdppc", "ssp_pop", "ssp_cohorts", "estimates")
    regional = ("region_gdppc", "region_pop", "region_density")
    parts = [source_summary(getattr(src, n), n, "iso3") for n in national]
    parts += [source_summary(getattr(src, n), n, "hierid") for n in regional]
    return reduce(DataFrame.unionByName, parts)


def run_entries(cfg: PanelConfig, versions: dict[str, str] | None = None) -> dict[str, str]:
    """Settings and source versions as provenance items."""
    items = {"title": "Region-by-year socioeconomic panel", "date": date.today().isoformat()}
    items |= {f"setting/{k}": str(v) for k, v in asdict(cfg).items() if k != "extra"}
    items |= {f"source/{k}": v for k, v in (versions or {}).items()}
    return items | cfg.extra


def panel_metrics() -> Observed:
    """Rows, and gaps and range of every measure, seen while the panel is staged."""
    each = {"rows": F.count(F.lit(1))}
    for c in MEASURES:
        each |= {f"gaps/{c}": F.count_if(F.col(c).isNull()), f"least/{c}": F.min(c), f"most/{c}": F.max(c)}
    return Observed(**each)


def _write_version(root: str, panel: DataFrame, report: DataFrame, notes: Callable[[DataFrame], DataFrame]) -> None:
    spark = panel.sparkSession
    write_panels(panel, f"{root}/csv", report)
    write_cube(with_dictionary(to_cube(panel, MEASURES), PANEL_DICTIONARY), f"{root}/cube")
    files = file_digests(spark, root).select(F.concat(F.lit("written/"), "path").alias("path"), "bytes", "md5")
    notes(files).write.parquet(f"{root}/provenance")


def publish(
    src: PanelSources,
    cfg: PanelConfig,
    expected: Expected,
    path: str,
    versions: dict[str, str] | None = None,
    inputs: tuple[str, DataFrame] | None = None,
) -> DataFrame:
    """Build all panels, run every gate, then write csv, cube and provenance
    below `path`. Returns the panel.

    `inputs` is the folder of the source files and its manifest: a file that is
    missing or differs ends the run at once, and the others are listed in
    provenance. So are row count, gaps and ranges, which are seen while the panel is
    staged. Everything is written
    beside the target and moved there in one step behind the last file; a run that
    fails or is killed leaves no version, and a finished one has its mark.
    """
    spark = src.region_gdppc.sparkSession
    require_version_folder(path, cfg.version)
    root = path.rstrip("/")
    if is_complete(spark, root):
        raise FileExistsError(f"{root} holds a finished version")
    files = None
    if inputs is not None:
        files = materialise(file_digests(spark, inputs[0]), "input-files")
        require_inputs(verify_inputs(files, inputs[1]))
    source_report(src).show(truncate=False)
    seen = panel_metrics()
    panel = build_panel(src, cfg, seen)
    metrics = seen.values
    report = check_panel(panel, src, cfg, expected)
    enforce(report, expected=expected_records(cfg))
    enforce(cross_panel_checks(panel, cfg.scenarios, cfg.gdp_models, cfg.handoff), "all panels")
    entries = run_entries(cfg, versions) | {f"seen/{k}": str(v) for k, v in metrics.items()}

    def notes(written: DataFrame) -> DataFrame:
        listed = written if files is None else written.unionByName(files.select("path", "bytes", "md5"))
        return provenance(spark, entries, panel, listed)

    write_whole(spark, root, lambda place: _write_version(place, panel, report, notes))
    return with_dictionary(panel, PANEL_DICTIONARY)
