"""A tiny complete world, from sources to written files."""

import dataclasses
import math
import os

import pytest
from pyspark.sql import functions as F

from panelweft.operators.checks import ChecksFailed, Expected
from panelweft.plans.config import PanelConfig, PanelSources
from panelweft.plans.publish import publish, source_report

SCENARIOS = {"SSP2": 1.0, "SSP3": 1.3}
CFG = PanelConfig(
    scenarios=tuple(SCENARIOS), gdp_models=("OECD", "IIASA"), pop_control="UN_WPP",
    force_gdp_sum=True, version="9.9",
)
KNOTS = range(2020, 2101, 5)


def make(spark):
    regions = {"AAA.1": 100.0, "AAA.2": 300.0, "BBB.1": 50.0, "BBB.2": 0.0}
    nations = ("AAA", "BBB")

    def frame(rows, schema):
        return spark.createDataFrame(list(rows), schema)

    def iso(r):
        return r.split(".")[0]

    def pop(c, s, y):
        return (2.0 if c == "AAA" else 1.0) * (1 + 0.01 * (y - 2020) * SCENARIOS.get(s, 1.0))

    ssp = [(s, c, y) for s in SCENARIOS for c in nations for y in KNOTS]
    past = [("Historical Reference", c, y) for c in nations for y in range(1950, 2021, 5)]
    eras = [("projection", *k) for k in ssp] + [("historical", *k) for k in past]
    grid = [(r, y) for r in regions for y in range(1990, 2023)]
    return PanelSources(
        accounts=frame(
            [("AAA", y, 10000.0 + 100 * (y - 1990)) for y in range(1990, 2024)], "iso3 string, year int, gdppc double"
        ),
        gridded=frame(
            [(c, y, 2000.0) for c in nations for y in range(1990, 2023)], "iso3 string, year int, gdppc double"
        ),
        ssp_gdppc=frame(
            [("OECD", s, c, y, 9000 * 1.02 ** (y - 2020)) for s, c, y in ssp]
            + [("IIASA", s, c, y, 9500 * 1.03 ** (y - 2020)) for s, c, y in ssp if y >= 2025],
            "model string, scenario string, iso3 string, year int, gdppc double",
        ),
        ssp_pop=frame(
            [(e, s, c, y, pop(c, s, y)) for e, s, c, y in eras],
            "era string, scenario string, iso3 string, year int, pop double",
        ),
        ssp_cohorts=frame(
            [(e, s, c, y, *(pop(c, s, y) * x for x in (0.1, 0.8, 0.1))) for e, s, c, y in eras],
            "era string, scenario string, iso3 string, year int, age0to4 double, age5to64 double, age65plus double",
        ),
        estimates=frame(
            [(c, y, 1.5 + 0.01 * (y - 1950)) for c in nations for y in range(1950, 2101)],
            "iso3 string, year int, pop double",
        ),
        region_gdppc=frame(
            [(r, iso(r), y, 1000.0 if r.endswith("1") else None if r == "BBB.2" else 3000.0) for r, y in grid],
            "hierid string, iso3 string, year int, gdppc double",
        ),
        region_pop=frame([(r, iso(r), y, regions[r]) for r, y in grid], "hierid string, iso3 string, year int, pop double"),
        region_density=frame([(r, y, 7.0) for r, y in grid], "hierid string, year int, pop_wtd_density double"),
        region_area=frame([(r, 4.0) for r in regions], "hierid string, area_km2 double"),
    )


def test_a_whole_run(spark, tmp_path):
    src = make(spark)
    path = str(tmp_path / "9.9")
    panel = publish(src, CFG, Expected(4, 1981, 2100), path, {"accounts": "11.0"}).cache()
    assert panel.count() == 4 * 4 * 120
    assert panel.schema["pop"].metadata["unit"] == "persons"
    one = {(r.hierid, r.year): r for r in panel.where("scenario = 'SSP3' and gdp_model = 'OECD'").collect()}

    # calibrated: shape 1000/2000 of the accounts' level, in 2005 money
    assert one["AAA.1", 1995].gdppc_raw == pytest.approx(0.5 * 10500 * 81.556 / 110.186)
    # no accounts: the grid value deflated; no grid value and nobody there: 0
    assert one["BBB.1", 1995].gdppc_raw == pytest.approx(1000 * 0.81556)
    assert one["BBB.2", 1995].gdppc_raw is None and one["BBB.2", 2050].gdppc == 0.0
    # estimates to 2023, then the scenario rebased to them
    want = 1e6 * (1.5 + 0.73) * (1 + 0.01 * 30 * 1.3) / (1 + 0.01 * 3 * 1.3)
    assert one["AAA.1", 2050].pop + one["AAA.2", 2050].pop == pytest.approx(want)
    assert one["AAA.2", 2050].pop == pytest.approx(3 * one["AAA.1", 2050].pop)
    # regional income meets the national target from 2024 on
    mean = (one["AAA.1", 2040].gdppc_raw + 3 * one["AAA.2", 2040].gdppc_raw) / 4
    assert mean == pytest.approx(9000 * 1.02**20 * 0.81556)
    assert one["AAA.1", 1985].gdppc == pytest.approx(
        sum(one["AAA.1", y].gdppc_raw for y in range(1990, 2016)) / 26
    )
    assert one["AAA.1", 2030].pop0to4 == pytest.approx(0.1 * one["AAA.1", 2030].pop)
    assert not math.isnan(one["BBB.2", 2100].gdp)

    back = spark.read.csv(f"{path}/csv", header=True, inferSchema=True)
    assert back.count() == 1920 and back.where("scenario = 'SSP2' and gdp_model = 'IIASA'").count() == 480
    cube = spark.read.parquet(f"{path}/cube")
    assert cube.agg(F.max("hierid_code"), F.max("year_code")).collect()[0][:] == (3, 119)
    notes = {r["item"]: r["value"] for r in spark.read.parquet(f"{path}/provenance").collect()}
    assert notes["source/accounts"] == "11.0" and notes["setting/version"] == "9.9"
    assert sum(k.startswith("content/") for k in notes) == 4


def test_nothing_is_written_behind_a_failed_gate(spark, tmp_path):
    src = make(spark)
    path = str(tmp_path / "9.9")
    with pytest.raises(ValueError, match="version"):
        publish(src, CFG, Expected(4, 1981, 2100), str(tmp_path / "9.8"))
    with pytest.raises(ChecksFailed, match="grid_size"):
        publish(src, CFG, Expected(5, 1981, 2100), path)
    same = dataclasses.replace(CFG, scenarios=("SSP2", "SSP3"))
    flat = dataclasses.replace(
        src, ssp_pop=src.ssp_pop.withColumn("pop", F.lit(1.0)),
        ssp_cohorts=src.ssp_cohorts.withColumns({c: F.lit(1 / 3) for c in ("age0to4", "age5to64", "age65plus")}),
    )
    with pytest.raises(ChecksFailed, match="pop_differs_across_scenarios_OECD"):
        publish(flat, same, Expected(4, 1981, 2100), path)
    assert not os.path.exists(path)


def test_source_report(spark):
    report = {r.source: r for r in source_report(make(spark)).collect()}
    assert report["estimates"][1:] == (302, 2, 1950, 2100) and report["region_pop"].n_members == 4


def test_a_version_appears_as_a_whole(spark, tmp_path):
    from panelweft.sources.manifest import InputsNotReady, file_digests

    src, path = make(spark), str(tmp_path / "9.9")
    small = dataclasses.replace(CFG, scenarios=("SSP2",), gdp_models=("OECD",), force_gdp_sum=False)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("x\n")
    known = file_digests(spark, str(tmp_path / "in")).select("path", "md5", F.lit("auto").alias("fetch"))
    with pytest.raises(InputsNotReady, match="b.csv: missing"):
        publish(src, small, Expected(4, 1981, 2100), path, inputs=(str(tmp_path / "in"), known.union(known.select(F.lit("b.csv"), "md5", "fetch"))))
    panel = publish(src, small, Expected(4, 1981, 2100), path, inputs=(str(tmp_path / "in"), known))
    notes = {r["item"]: r["value"] for r in spark.read.parquet(f"{path}/provenance").collect()}
    assert notes["seen/rows"] == str(4 * 120) and notes["seen/gaps/gdppc"] == "0"
    assert float(notes["seen/most/pop"]) == panel.agg(F.max("pop")).first()[0]
    assert notes["file/a.csv"].startswith("2 ") and any(k.startswith("file/written/csv/") for k in notes)
    assert os.path.exists(f"{path}/_SUCCESS") and sorted(os.listdir(tmp_path)) == ["9.9", "in"]
    with pytest.raises(FileExistsError):
        publish(src, small, Expected(4, 1981, 2100), path)


@pytest.mark.parametrize("step", ["first", "second", "mark_complete", "move"])
def test_a_killed_write_leaves_nothing(spark, tmp_path, monkeypatch, step):
    from panelweft.sinks import writers

    def write(place):
        spark.range(5).write.parquet(f"{place}/a")
        if step == "first":
            raise KeyboardInterrupt
        spark.range(5).write.parquet(f"{place}/b")
        if step == "second":
            raise KeyboardInterrupt

    def killed(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        if step in ("mark_complete", "move"):
            m.setattr(writers, step, killed)
        with pytest.raises(KeyboardInterrupt):
            writers.write_whole(spark, f"{tmp_path}/v", write)
    assert os.listdir(tmp_path) == []
    step = "none"
    writers.write_whole(spark, f"{tmp_path}/v", write)
    with pytest.raises(FileExistsError):
        writers.write_whole(spark, f"{tmp_path}/v", write)
    assert os.listdir(tmp_path) == ["v"] and sorted(os.listdir(f"{tmp_path}/v")) == ["._SUCCESS.crc", "_SUCCESS", "a", "b"]


def test_the_planner_setting_comes_back(spark):
    from panelweft.scale import shared_partitioning

    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    with pytest.raises(KeyError), shared_partitioning(spark):
        assert spark.conf.get(name) == "false"
        raise KeyError
    assert spark.conf.get(name) == before
