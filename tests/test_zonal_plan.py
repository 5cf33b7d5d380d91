import dataclasses

import pytest

from panelweft.operators.zonal import Grid
from panelweft.plans.zonal import BadOutlines, ZonalInputs, build_zonal, validation_report, zonal_stage

GRID = Grid(0.0, 4.0, 1.0, 1.0, 4, 4)


def square(name, x, y, size=1.0, ring=0):
    corners = [(x, y), (x, y + size), (x + size, y + size), (x + size, y)]
    return [(name, ring, n, a, b) for n, (a, b) in enumerate(corners)]


def make(spark, outlines):
    vertices = spark.createDataFrame(outlines, "hierid string, ring_id int, seq int, lon double, lat double")
    cell = "cell_row int, cell_col int, year int, value double"
    values = spark.createDataFrame([(3, 0, y, 10.0 * y) for y in (1, 2)] + [(3, 1, 1, 7.0)], cell)
    people = spark.createDataFrame([(3, 0, 1, 5.0), (3, 0, 2, 6.0), (3, 1, 2, 4.0)], cell)
    return ZonalInputs(vertices, values, people, GRID, 2, (1, 2))


def test_tables_of_a_tiny_world(spark, tmp_path):
    inputs = make(spark, square("AAA.1", 0.0, 0.0, 2.0) + square("BBB.1", 1.0, 0.0) + square("CCC.1", 3.0, 3.0, 1e-5))
    tables = zonal_stage(spark, str(tmp_path), inputs)
    income = {(r.hierid, r.year): (r.gdppc, r.zero_pop) for r in tables["region_gdppc"].collect()}
    people = {(r.hierid, r.year): r["pop"] for r in tables["region_pop"].collect()}
    # weights are the people of year 2: 6 and 4
    assert income["AAA.1", 1] == (pytest.approx((10 * 6 + 7 * 4) / 10), False)
    assert income["BBB.1", 1] == (7.0, False) and income["BBB.1", 2] == (None, True)
    assert (people["AAA.1", 2], people["AAA.1", 1], people["BBB.1", 2]) == (10.0, 5.0, 4.0)
    assert income["CCC.1", 1] == (None, True) and people["CCC.1", 2] == 0.0 and len(income) == 6
    assert tables["region_area"].count() == 3
    report = validation_report(tables, spark.createDataFrame([("AAA", 1, 8.0)], "iso3 string, year int, published double"))
    assert report.first()["natavg"] == pytest.approx((10 * 6 + 7 * 4) / 10)
    # a finished folder is read, not built
    again = zonal_stage(spark, str(tmp_path), dataclasses.replace(inputs, vertices=None))
    assert again["region_pop"].count() == 6


def test_broken_outlines_are_refused(spark):
    gap = [r for r in square("AAA.1", 0.0, 0.0) if r[2] != 2] + square("BBB.1", 1.0, 0.0)
    with pytest.raises(BadOutlines, match="broken rings: AAA.1"):
        build_zonal(make(spark, gap))
    twice = square("AAA.1", 0.0, 0.0) + square("AAA.1", 0.0, 0.0, ring=1)
    with pytest.raises(BadOutlines, match="lie on each other: AAA.1|overlaps: AAA.1"):
        build_zonal(make(spark, twice))
