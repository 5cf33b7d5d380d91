import hashlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelweft.functions.columns import ascii_fold, band_year, country_of
from panelweft.sources import grids, manifest, national, snapshot, wide

LONG = "model string, scenario string, region string, variable string, year int, value double"


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


BODY = "M,SSP2,Kosovo,Population,million,1.5,,x\nM,SSP2,Taiwan,Population,million,2,3,4\n© 2024,,,,,,,\n"


@pytest.mark.parametrize("lead", ["Model", "﻿Model", "a,b,c,d,e,f,g,h\n﻿Model"])
def test_wide_csv_with_mark_and_late_header(spark, tmp_path, lead):
    path = write(tmp_path / "w.csv", f"{lead},Scenario,Region,Variable,Unit,2020,2025,2030\n{BODY}")
    long = wide.wide_to_long(wide.read_wide_csv(spark, path))
    got = {(r.region, r.year): r.value for r in long.collect()}
    assert got == {
        ("Kosovo", 2020): 1.5, ("Taiwan", 2020): 2.0, ("Taiwan", 2025): 3.0, ("Taiwan", 2030): 4.0,
    }
    assert dict(long.dtypes)["year"] == "int"


def test_overlapping_snapshots_are_an_error(spark):
    df = spark.createDataFrame([("M", "S", "R", "V", 2020, 1.0)], LONG)
    other = df.withColumn("scenario", F.lit("T"))
    assert wide.stack_unique([df, other]).count() == 2
    with pytest.raises(ValueError, match="duplicate"):
        wide.stack_unique([df, df])


def test_names_and_overrides(spark):
    names = ["World", "Africa (R10)", "Kosovo", "Taiwan", "Micronesia", "Curaçao", "Cura?ao", "R?union",
             "Réunion", "Congo (Kinshasa)", "Atlantis"]
    df = spark.createDataFrame([(n,) for n in names], "region string")
    listed = spark.createDataFrame([("Congo (Kinshasa)", "COD"), ("World", "WLD")], "name string, iso3 string")
    got = dict(rows(national.map_names_to_codes(df, listed)))
    assert got == {
        "Kosovo": "XKX", "Taiwan": "TWN", "Micronesia": "FSM", "Curaçao": "CUW", "Cura?ao": "CUW",
        "R?union": "REU", "Réunion": "REU", "Congo (Kinshasa)": "COD",
    }
    assert rows(national.unmapped_names(df, listed)) == [("Atlantis",)]


def test_age_bins_skip_education_splits(spark):
    names = ["Population|Male|Age 0-4", "Population|Female|Age 0-4", "Population|Male|Age 60-64",
             "Population|Female|Age 65-69", "Population|Male|Age 100+", "Population|Male|Age 0-4|No Education",
             "Mean Years of Education|Male|Age 0-4", "Population"]
    df = spark.createDataFrame([("S", "AAA", 2020, n, 1.0) for n in names],
                               "scenario string, iso3 string, year int, variable string, value double")
    assert rows(national.age_bins(df, "projection")) == [("projection", "S", "AAA", 2020, 2.0, 1.0, 2.0)]


def sheet(spark, body, at):
    head = [(1, "notes", None, None, None), (at, "Year", "Type", wide.HEADER_LABEL, wide.POPULATION_LABEL)]
    return spark.createDataFrame(head + body, "row_no int, c0 string, c1 string, c2 string, c3 string")


def test_population_sheets(spark):
    a = sheet(spark, [(9, "2022", "Country/Area", "AAA", "1500"), (10, "2023", "Country/Area", "AAA", "1600"),
                      (11, "2023", "Region", "BBB", "9"), (12, "note", "Country/Area", "CCC", "1")], 5)
    b = sheet(spark, [(8, "2023", "Country/Area", "AAA", "7777"), (9, "2024", "Country/Area", "AAA", "...")], 4)
    assert rows(wide.read_population(a, b)) == [("AAA", 2022, 1.5), ("AAA", 2023, 1.6), ("AAA", 2024, None)]
    with pytest.raises(ValueError, match="header"):
        wide.read_population_sheet(a.where("row_no > 5"))


def test_accounts_and_national_income(spark):
    df = spark.createDataFrame([("USA", 2019, "100", "2"), ("USA", 2020, "n/a", "2"), (None, 2019, "1", "1"),
                                ("ZZZ", 2019, "1", "0")], "countrycode string, year int, rgdpe string, pop string")
    assert rows(wide.read_income_accounts(df)) == [("USA", 2019, 50.0)]
    table = spark.createDataFrame([("AAA", 1.0, None), ("", 2.0, 3.0), (None, 2.0, 3.0)],
                                  "iso3 string, `1990` double, `1991` double")
    assert rows(wide.read_national_income(table)) == [("AAA", 1990, 1.0)]


def test_panel_csv_keeps_region_ids(spark, tmp_path):
    schema = "hierid string, year int, gdppc double"
    path = write(tmp_path / "p.csv", "hierid,year,gdppc\nNA,2000,1.5\nNaN.1,2000,\nNULL,2001,2\n")
    assert rows(wide.read_panel_csv(spark, path, schema)) == [("NA", 2000, 1.5), ("NULL", 2001, 2.0), ("NaN.1", 2000, None)]
    bad = write(tmp_path / "b.csv", "hierid,year,gdppc\n,2000,1.5\n")
    with pytest.raises(ValueError, match="empty region"):
        wide.read_panel_csv(spark, bad, schema)


def test_files_against_a_manifest(spark, tmp_path, capsys):
    folder = tmp_path / "in"
    (folder / "sub").mkdir(parents=True)
    write(folder / "a.csv", "one")
    write(folder / "sub" / "b.csv", "two")
    md5 = hashlib.md5(b"one").hexdigest()
    entries = spark.createDataFrame(
        [("a.csv", md5, "auto"), ("sub/b.csv", md5, None), ("c.csv", md5, "manual"), ("d.csv", md5, None)],
        "path string, md5 string, fetch string",
    )
    status = manifest.verify_inputs(manifest.file_digests(spark, str(folder)), entries)
    assert rows(status) == [("a.csv", "ok"), ("c.csv", "missing (manual)"), ("d.csv", "missing (auto)"), ("sub/b.csv", "mismatch")]
    with pytest.raises(manifest.InputsNotReady, match="sub/b.csv: mismatch"):
        manifest.require_inputs(status)
    assert "a.csv" in capsys.readouterr().out
    manifest.require_inputs(status.where("path = 'a.csv'"))


def test_gate_on_a_snapshot(spark):
    cols = "model string, scenario string, region string, variable string, unit string, year int, value double"
    release = spark.createDataFrame(
        [("M", s, r, "V", "u", y, float(y)) for s in ("SSP1", "SSP2") for r in ("Côte", "Elsewhere") for y in (1, 2)], cols
    )
    given = release.where("scenario = 'SSP2' and region = 'Côte'").withColumn("region", ascii_fold("region"))
    out = snapshot.derive_gated_snapshot(release, given, ["SSP1"], [1, 2])
    assert rows(out) == [("M", "SSP1", "Côte", "V", "u", 1.0, 2.0)]
    assert rows(snapshot.rows_per_scenario(out)) == [("M", "SSP1", 1)]
    with pytest.raises(snapshot.GateFailed, match="1 of 2"):
        snapshot.derive_gated_snapshot(release.where("not (scenario = 'SSP2' and year = 2)"), given, ["SSP1"], [1, 2])
    with pytest.raises(snapshot.GateFailed):
        snapshot.derive_gated_snapshot(release, given.withColumn("value", F.col("value") + 1e-6), ["SSP1"], [1, 2])


def test_small_helpers(spark):
    df = spark.createDataFrame([("AAA.1.Rx", "gdp_pc_2020", "é€😀a")], "r string, b string, t string")
    assert rows(df.select(country_of("r"), band_year("b"), ascii_fold("t"))) == [("AAA", 2020, "???a")]


def test_ring_contract(spark):
    cols = "hierid string, ring_id int, seq int, lon double, lat double"
    ok = spark.createDataFrame([("A.1", 0, 0, 1.0, 2.0)], cols)
    assert rows(grids.regions_of(grids.rings_from_vertices(ok))) == [("A.1", "A")]
    with pytest.raises(ValueError, match="lacks"):
        grids.rings_from_vertices(ok.drop("seq"))
    with pytest.raises(ValueError, match="unusable"):
        grids.rings_from_vertices(ok.withColumn("lat", F.lit(91.0)))


def test_cube_to_long(spark):
    cube = spark.createDataFrame(
        [(["a", "b"], [1, 2, 3], [[1.0, 2.0, 3.0], [4.0, float("nan"), 6.0]])],
        "region array<string>, year array<int>, v array<array<double>>",
    )
    assert rows(grids.cube_to_long(cube, ["region", "year"], ["v"])) == [
        ("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, 3.0), ("b", 1, 4.0), ("b", 2, None), ("b", 3, 6.0),
    ]


def test_ages_without_a_number_are_in_no_bin(spark):
    df = spark.createDataFrame([("A", "0", 1.0), ("A", "70", 2.0), ("A", "old", 4.0)], "k string, age string, value double")
    out = national.bin_and_pivot(df, ["k"], F.col("age").try_cast("int"), [5, 65], ["x", "y", "z"])
    assert rows(out) == [("A", 1.0, 0.0, 2.0)]
