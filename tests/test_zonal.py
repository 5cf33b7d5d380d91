import math
import random

import pytest
from pyspark.sql import functions as F

from panelweft.operators import zonal
from panelweft.operators.zonal import Grid

MICRO = Grid(x0=0.0, y_top=2.0, res_x=1.0, res_y=1.0, n_rows=2, n_cols=2)


def micro(spark):
    cell = "cell_row int, cell_col int, year int, value double"
    gdp = spark.createDataFrame(
        [(0, 0, 2020, 100.0), (0, 1, 2020, 200.0), (1, 0, 2020, 300.0), (1, 1, 2020, None)], cell
    )
    pop = spark.createDataFrame(
        [(0, 0, 2020, 2.0), (0, 1, 2020, 0.0), (1, 0, 2020, 6.0), (1, 1, 2020, None)], cell
    )
    boxes = spark.createDataFrame(
        [("AAA.1", 0.0, 0.0, 1.0, 2.0), ("AAA.2", 1.0, 1.0, 2.0, 2.0), ("BBB.1", 5.0, 5.0, 6.0, 6.0)],
        "region string, lon0 double, lat0 double, lon1 double, lat1 double",
    )
    return gdp, pop, boxes


def test_micro_raster(spark):
    gdp, pop, boxes = micro(spark)
    cells = zonal.cell_table(gdp, pop, MICRO, 2020)
    out = zonal.zonal_tables(zonal.box_coverage(boxes, MICRO), cells, boxes, [2020])
    got = {r.region: r for r in out.collect()}
    assert got["AAA.1"].gdppc == 250.0 and not got["AAA.1"].zero_pop and got["AAA.1"].pop == 8.0
    assert got["AAA.2"].gdppc == 200.0 and got["AAA.2"].zero_pop
    assert got["AAA.2"].pop == 0.0 and got["AAA.2"].pop_wtd_density == 0.0
    assert got["BBB.1"].gdppc is None and got["BBB.1"].pop == 0.0 and got["BBB.1"].pop_wtd_density == 0.0
    areas = [r.a for r in spark.range(2).select(MICRO.area_km2(F.col("id")).alias("a")).orderBy("id").collect()]
    assert got["AAA.1"].pop_wtd_density == pytest.approx((2 / areas[0] * 2 + 6 / areas[1] * 6) / 8)
    assert zonal.flagged_count(out, "region", "zero_pop").collect()[0].n_flagged == 2

    published = spark.createDataFrame([("AAA", 2020, 250.0)], "country string, year int, published double")
    regions = out.withColumn("country", F.substring_index("region", ".", 1))
    v = zonal.validate_national(regions, published, value="gdppc", weight="pop")
    assert v.collect()[0].natavg == 250.0 and v.collect()[0].ratio == 1.0
    summary = zonal.validation_summary(v, 2020, 5.0).collect()[0]
    assert summary.median_ratio == 1.0 and summary.n_over == 0


def test_cell_area_against_known_geodesic_areas(spark):
    grid = Grid(x0=-180.0, y_top=90.0, res_x=1 / 12, res_y=1 / 12, n_rows=2160, n_cols=4320)
    area = [
        r.a for r in spark.range(2160).select("id", grid.area_km2(F.col("id")).alias("a")).orderBy("id").collect()
    ]
    assert area[1080] == pytest.approx(85.4796530573, rel=1e-9)
    assert area[0] == pytest.approx(0.0630032463, rel=1e-6)
    assert max(abs(a / b - 1) for a, b in zip(area, reversed(area))) < 1e-7


def rings_frame(spark, shapes):
    data = [
        (name, ring, i, float(x), float(y))
        for name, rings in shapes.items()
        for ring, points in enumerate(rings)
        for i, (x, y) in enumerate(points)
    ]
    return spark.createDataFrame(data, "region string, ring_id int, seq int, lon double, lat double")


def clip(points, inside, cross):
    out = []
    for a, b in zip(points, points[1:] + points[:1]):
        if inside(a):
            out.append(a)
        if inside(a) != inside(b):
            out.append(cross(a, b))
    return out


def clipped_area(points, x0, x1, y0, y1):
    """Signed area of a ring inside a box, by clipping at each side."""

    def at_x(x):
        return lambda a, b: (x, a[1] + (b[1] - a[1]) * (x - a[0]) / (b[0] - a[0]))

    def at_y(y):
        return lambda a, b: (a[0] + (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]), y)

    for inside, cross in (
        (lambda p: p[0] >= x0, at_x(x0)),
        (lambda p: p[0] <= x1, at_x(x1)),
        (lambda p: p[1] >= y0, at_y(y0)),
        (lambda p: p[1] <= y1, at_y(y1)),
    ):
        points = clip(points, inside, cross)
        if not points:
            return 0.0
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:] + points[:1])) / 2


def star(cx, cy, r, n, rnd, turn=1):
    return [
        (
            cx + r * rnd.uniform(0.4, 1) * math.cos(turn * 2 * math.pi * i / n),
            cy + r * rnd.uniform(0.4, 1) * math.sin(turn * 2 * math.pi * i / n),
        )
        for i in range(n)
    ]


def test_coverage_of_any_rings_against_clipping(spark):
    rnd = random.Random(11)
    grid = Grid(x0=-4.0, y_top=5.0, res_x=0.5, res_y=0.8, n_rows=11, n_cols=17)
    shapes = {}
    for i in range(12):
        cx, cy, r = rnd.uniform(-5, 5), rnd.uniform(-5, 5), rnd.uniform(0.2, 5)
        outer = star(cx, cy, r, rnd.randint(3, 14), rnd, turn=rnd.choice([1, -1]))
        shapes[f"s{i}"] = [outer]
    # a ring with a hole that runs the other way, and two separate parts
    shapes["hole"] = [star(0, 0, 4, 60, random.Random(1)), star(0, 0, 1.2, 9, rnd, turn=-1)]
    shapes["parts"] = [star(-2, 1, 1, 7, rnd), star(2, -1, 1, 5, rnd)]
    # vertices exactly on grid lines
    shapes["lines"] = [[(-4.0, 5.0), (-3.0, 5.0), (-3.0, 3.4), (-4.0, 3.4), (-4.0, 5.0)]]
    shapes["around"] = [[(-50, -50), (50, -50), (50, 50), (-50, 50)]]
    got = {
        (r.region, r.cell_row, r.cell_col): r.frac
        for r in zonal.coverage_fraction(rings_frame(spark, shapes), grid).collect()
    }
    size = grid.res_x * grid.res_y
    for name, rings in shapes.items():
        for row in range(grid.n_rows):
            for col in range(grid.n_cols):
                x, y = grid.x0 + col * grid.res_x, grid.y_top - row * grid.res_y
                want = abs(sum(clipped_area(list(r), x, x + grid.res_x, y - grid.res_y, y) for r in rings)) / size
                assert got.get((name, row, col), 0.0) == pytest.approx(want, abs=1e-8), (name, row, col)


def test_polygon_area_of_an_octant_and_a_hole(spark):
    octant = [(0, 0), (90, 0), (90, 90), (0, 90)]
    hole = [(10, 10), (10, 20), (20, 20), (20, 10)]
    out = {
        r.region: r.area_km2
        for r in zonal.polygon_area_km2(
            rings_frame(spark, {"o": [octant], "h": [octant, hole], "i": [hole]})
        ).collect()
    }
    assert out["o"] == pytest.approx(4 * math.pi * 6371.010**2 / 8)
    assert out["h"] == pytest.approx(out["o"] - out["i"])
    across = rings_frame(spark, {"a": [[(179, 0), (-179, 0), (-179, 2), (179, 2)]], "b": [[(0, 0), (2, 0), (2, 2), (0, 2)]]})
    a, b = (r.area_km2 for r in zonal.polygon_area_km2(across).orderBy("region").collect())
    assert a == pytest.approx(b)


def test_bad_rings_are_reported(spark):
    shapes = {
        "ok": [[(0, 0), (1, 0), (1, 1)]],
        "line": [[(0, 0), (1, 0)]],
        "flat": [[(0, 0), (1, 0), (3, 0)]],
    }
    rings = rings_frame(spark, shapes)
    gap = rings_frame(spark, {"gap": [[(0, 0), (1, 0), (1, 1)]]}).withColumn("seq", F.col("seq") * 2)
    out = {r.region: r.reason for r in zonal.bad_rings(rings.unionByName(gap)).collect()}
    assert out == {
        "line": "fewer than three vertices",
        "flat": "zero area",
        "gap": "gaps in vertex numbers",
    }


def test_grids_must_align():
    with pytest.raises(ValueError, match="align"):
        MICRO.require_same(Grid(0.0, 2.0, 1.0, 1.0, 2, 3))
    MICRO.require_same(Grid(0.0, 2.0, 1.0, 1.0, 2, 2))


def test_tiny_regions_keep_their_cells(spark):
    grid = zonal.Grid(0.0, 10.0, 1.0, 1.0, 10, 10)
    boxes = [("big", 1.0, 2.0, 4.0, 5.0), ("tiny", 3.25, 3.25, 3.25 + 1e-5, 3.25 + 1e-5), ("odd", 0.1, 0.7, 6.3, 8.9),
             ("over", -3.0, 4.5, 12.0, 5.5)]
    table = spark.createDataFrame(boxes, "region string, lon0 double, lat0 double, lon1 double, lat1 double")
    corners = [
        (n, 0, k, x, y)
        for n, a, b, c, d in boxes
        for k, (x, y) in enumerate([(a, b), (a, d), (c, d), (c, b)])
    ]
    rings = spark.createDataFrame(corners, "region string, ring_id int, seq int, lon double, lat double")
    key = lambda df: {(r.region, r.cell_row, r.cell_col): r.frac for r in df.collect()}
    want, got = key(zonal.box_coverage(table, grid)), key(zonal.coverage_fraction(rings, grid))
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(v, rel=1e-6, abs=1e-14) for k, v in want.items())
    assert 0 < got["tiny", 6, 3] < 1.1e-10


def test_rings_with_gaps_are_refused(spark):
    grid = zonal.Grid(0.0, 10.0, 1.0, 1.0, 10, 10)
    rows_ = [("r", 0, k, x, y) for k, (x, y) in zip((0, 1, 3), [(1.0, 1.0), (1.0, 4.0), (4.0, 4.0)])]
    rings = spark.createDataFrame(rows_, "region string, ring_id int, seq int, lon double, lat double")
    with pytest.raises(Exception, match="vertex numbers of ring r/0"):
        zonal.coverage_fraction(rings, grid).collect()
    assert zonal.bad_rings(rings).collect()[0].reason == "gaps in vertex numbers"


def test_sums_by_runs_equal_sums_by_cells(spark):
    from panelweft.operators.zonal_runs import zonal_measures, zonal_sums

    rnd = random.Random(4)
    grid = Grid(x0=-20.0, y_top=15.0, res_x=0.25, res_y=0.5, n_rows=60, n_cols=160)
    shapes = {f"s{i}": [star(rnd.uniform(-19, 19), rnd.uniform(-14, 14), rnd.uniform(0.1, 12), rnd.randint(3, 30), rnd)] for i in range(25)}
    shapes["hole"] = [star(0, 0, 9, 50, random.Random(1)), star(0, 0, 2, 9, rnd, turn=-1)]
    rings = rings_frame(spark, shapes)
    size = lambda: 10 ** rnd.uniform(-9, 14)  # noqa: E731  small runs beside a large row
    table = [
        (r, c, y, None if rnd.random() < 0.2 else size(), None if rnd.random() < 0.2 else size(), 0.0 if rnd.random() < 0.4 else size())
        for r in range(60) for c in range(160) for y in (1, 2) if rnd.random() < 0.7
    ]
    cells = spark.createDataFrame(table, "cell_row int, cell_col int, year int, value double, people double, weight double")
    runs = zonal.coverage_runs(rings, grid)
    got = {(r.region, r.year): r for r in zonal_measures(zonal_sums(runs, cells, grid, (1, 2))).collect()}
    want = zonal.zonal_stats(
        zonal.coverage_fraction(rings, grid), cells.withColumn("density", F.col("people") / grid.area_km2()),
        by_people=zonal.weighted_mean("value", "weight"), by_area=zonal.area_mean("value"), pop=zonal.zonal_sum("people"),
        pop_wtd_density=zonal.weighted_mean("density", "people"),
    ).collect()
    assert len(want) == len(got) > 40
    for w in want:
        for c in ("by_people", "by_area", "pop", "pop_wtd_density"):
            assert got[w.region, w.year][c] == (None if w[c] is None else pytest.approx(w[c], rel=1e-12)), (w, c)
    # joined rows follow the outline: boundary cells and runs, not all covered cells
    n_runs, n_cells = runs.count(), zonal.coverage_fraction(rings, grid).count()
    assert n_runs * 2 < n_cells


def test_pieces_of_edges_are_spread_by_their_number(spark, monkeypatch):
    # shuffle partitions are few, or few are left of them: the tasks are as many as the
    # pieces ask for, and no task has many more than its share
    monkeypatch.setattr(zonal, "PIECES_PER_TASK", 2000, raising=False)
    grid = Grid(0.0, 40.0, 0.5, 0.5, 80, 80)
    square = F.array(*[F.struct(F.lit(k).alias("seq"), (F.col("id") % 10 + x).alias("lon"), (F.col("id") % 7 + y).alias("lat"))
                       for k, (x, y) in enumerate([(0.3, 0.1), (0.1, 20.1), (20.3, 20.3), (20.1, 0.2)])])
    rings = spark.range(200).select(F.concat(F.lit("r"), "id").alias("region"), F.lit(0).alias("ring_id"), F.inline(square))
    sizes = [r["count"] for r in zonal.coverage_runs(rings, grid).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 8 and max(sizes) < 3 * sum(sizes) / len(sizes)
