"""Quantiles, hash trees, tiles and file digests."""

import hashlib
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweft.operators import hashtree
from panelweft.operators.quantiles import exact_quantiles, from_bits, ordered_bits
from panelweft.operators.zonal import Grid
from panelweft.sources import manifest
from panelweft.sources.tiles import TiledGrid
from tests.conftest import rows

ODD = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308,
       math.inf, -math.inf, 0.1, 1 / 3, 1023.9999999999999, 1024.0, 2.0**-1000, 3.0**300, 7e-310]


def test_bits_keep_the_order_and_every_value(spark):
    rnd = random.Random(1)
    values = ODD + [rnd.choice([1, -1]) * math.ldexp(rnd.random() + 0.5, rnd.randint(-1074, 1023)) for _ in range(3000)]
    values += [math.nextafter(2.0**e, s * math.inf) for e in range(-1022, 1023, 7) for s in (1, -1)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", ordered_bits("v").alias("b"))
    got = df.withColumn("again", from_bits("b")).collect()
    assert all(r["again"] == r["v"] for r in got)
    assert [r["v"] for r in sorted(got, key=lambda r: r["b"])] == sorted(values)
    none = spark.createDataFrame([(None,), (math.nan,)], "v double").select(ordered_bits("v").alias("b"))
    assert all(r["b"] is None for r in none.collect())


def test_quantiles_of_columns_and_groups(spark):
    rnd = random.Random(2)
    data = [
        (rnd.choice(["a", "b", None]), rnd.randrange(3), rnd.choice([None, math.nan, 5.0, 5.0, rnd.uniform(-1e9, 1e9), rnd.lognormvariate(0, 20)]), float(rnd.randrange(4)))
        for _ in range(3000)
    ]
    data += [("alone", 1, -3.5, None), ("empty", 0, None, None)]
    probs = [0.0, 0.1, 0.5, 0.99, 1.0]
    df = spark.createDataFrame(data, "g string, h int, x double, y double")
    got = {(r["g"], r["h"], r["column"], r["prob"]): (r["n"], r["value"]) for r in exact_quantiles(df, ["x", "y"], ["g", "h"], probs).collect()}
    want = {}
    for key in {(g, h) for g, h, _, _ in data}:
        for c, at in (("x", 2), ("y", 3)):
            v = [r[at] for r in data if r[:2] == key and r[at] is not None and not math.isnan(r[at])]
            want |= {(*key, c, p): (len(v), float(np.quantile(v, p))) for p in probs if v}
    assert set(got) == set(want)
    assert all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], rel=1e-12) for k in want)
    assert exact_quantiles(df.where("false"), ["x"]).count() == 0
    (median,) = exact_quantiles(df, ["y"]).collect()
    assert median["value"] == np.median([r[3] for r in data if r[3] is not None])


LEVELS = ["part", "key"]


def table(spark, data):
    return spark.createDataFrame(data, "part string, key string, year int, v double")


def test_versions_are_compared_from_the_root(spark, tmp_path):
    old = [(f"0{p}", f"k{k}", y, p + k / 7) for p in range(5) for k in range(8) for y in range(3)] + [(None, None, 1, None)]
    new = [r for r in old if r[:2] != ("02", "k3")] + [("03", "k9", 1, 1.0)] * 2 + [("04", "k1", 0, 9.0)] * 2 + [("07", "x", 1, None)]
    for name, data in (("a", old), ("b", new), ("c", old[::-1])):
        hashtree.write_version(table(spark, data), f"{tmp_path}/{name}", LEVELS)
    found, changed = hashtree.compare_versions(spark, f"{tmp_path}/a", f"{tmp_path}/b", LEVELS)
    assert rows(found.leaves) == rows(table(spark, old).where("false").select("part", "key", "year", "year")) + [
        ("02", "k3", 3, None), ("03", "k9", None, 2), ("04", "k1", 3, 5), ("07", "x", None, 1)
    ]
    # the root, 7 parts, and the keys of the four parts that differ
    assert found.steps == [(0, 1, 1), (1, 7, 4), (2, 8 + 9 + 8 + 1, 4)]
    assert rows(changed.select("part", "key", "year", "v", "n_a", "n_b")) == sorted(
        [("02", "k3", y, 2 + 3 / 7, 1, 0) for y in range(3)] + [("03", "k9", 1, 1.0, 0, 2), ("04", "k1", 0, 9.0, 0, 2), ("07", "x", 1, None, 0, 1)], key=str
    )
    plan = changed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "part" in plan.split("PartitionFilters: [")[1][:200]
    same, none = hashtree.compare_versions(spark, f"{tmp_path}/a", f"{tmp_path}/c", LEVELS)
    assert same.steps == [(0, 1, 0)] and same.leaves.count() == 0 and none.count() == 0


def test_equal_rows_and_exchanged_gaps_are_seen(spark):
    sums = lambda data: rows(table(spark, data).agg(*hashtree.content_sums(["part", "key", "year", "v"])))
    base = [("p", "k", 1, 1.0)]
    assert sums(base) != sums(base * 3)
    assert sums([("p", None, 1, 1.0)]) != sums([(None, "p", 1, 1.0)])
    assert rows(hashtree.hash_tree(table(spark, []), LEVELS).where("depth > 0")) == []


GRID = Grid(0.0, 10.0, 1.0, 1.0, 10, 13)
CELL = "cell_row int, cell_col int, year int, value double"


def test_tiles_give_their_cells_again(spark, tmp_path):
    rnd = random.Random(3)
    data = [(r, c, y, rnd.choice([None, rnd.random()])) for r in range(10) for c in range(13) for y in (1, 2) if rnd.random() < 0.6]
    tiled = TiledGrid(f"{tmp_path}/t", GRID, 4)
    tiled.write(spark.createDataFrame(data, CELL))
    stored = tiled.stored(spark)
    assert rows(tiled.cells(stored)) == sorted([r for r in data if r[3] is not None], key=str)
    for r in stored.collect():
        held = [v for v in r["cells"] if v is not None]
        assert (len(r["cells"]), r["n"], r["low"], r["high"]) == (16, len(held), min(held), max(held))
    runs = spark.createDataFrame([("a", 5, 3, 6)], "region string, cell_row int, first_col int, last_col int")
    assert tiled.meeting(runs) == [4, 5] and tiled.meeting(runs.where("false")) == []
    under = tiled.under(runs, [2])
    assert rows(under) == sorted([r for r in data if r[3] is not None and r[0] // 4 == 1 and r[1] < 8 and r[2] == 2], key=str)
    plan = under._jdf.queryExecution().executedPlan().toString()
    assert "tile" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_tiles_refuse_bad_cells(spark):
    tiled = TiledGrid("unused", GRID, 4)
    with pytest.raises(Exception, match="a cell is given twice"):
        tiled.tiles(spark.createDataFrame([(1, 1, 1, 1.0), (1, 1, 1, 2.0)], CELL)).collect()
    with pytest.raises(Exception, match="outside of the grid"):
        tiled.tiles(spark.createDataFrame([(1, 13, 1, 1.0)], CELL)).collect()


def test_digests_of_small_and_large_files(spark, tmp_path):
    rnd = random.Random(4)
    files = {"empty": b"", "a.bin": rnd.randbytes(1000), "sub/b.bin": rnd.randbytes(70_000), "c.bin": rnd.randbytes(4096 * 3)}
    for name, body in files.items():
        os.makedirs(os.path.dirname(f"{tmp_path}/{name}"), exist_ok=True)
        with open(f"{tmp_path}/{name}", "wb") as f:
            f.write(body)
    md5 = lambda b: hashlib.md5(b).hexdigest()
    want = sorted(
        (n, len(b), md5(b), md5("".join(md5(b[i : i + 4096]) for i in range(0, max(1, len(b)), 4096)).encode())) for n, b in files.items()
    )
    for whole in (0, 5000, 1 << 20):
        assert rows(manifest.file_digests(spark, str(tmp_path), whole=whole, part=4096)) == want


def test_a_file_larger_than_a_row(spark, tmp_path):
    size = (2 << 30) + 12345  # more than a row may hold; sparse on disk
    with open(f"{tmp_path}/large", "wb") as f:
        f.truncate(size)
    (r,) = manifest.file_digests(spark, str(tmp_path), part=256 << 20).collect()
    digest = hashlib.md5()
    for at in range(0, size, 1 << 26):
        digest.update(bytes(min(1 << 26, size - at)))
    assert (r["path"], r["bytes"], r["md5"]) == ("large", size, digest.hexdigest())


def test_cubes_in_chunks(spark, tmp_path):
    from panelweft.sinks.chunks import ChunkedCube

    rnd = random.Random(5)
    form = "s string, m string, r string, y int, s_code long, m_code long, r_code long, y_code long, v float, w float"
    every = [(s, m, f"r{r:02}", 2000 + y) for s in ("A", "B") for m in ("x", "y") for r in range(11) for y in range(7)]
    coded = [
        (s, m, r, y, "AB".index(s), "xy".index(m), int(r[1:]), y - 2000, rnd.choice([None, float(rnd.randrange(99))]), 1.5)
        for s, m, r, y in every if rnd.random() < 0.8
    ]
    df = spark.createDataFrame(coded, form)
    cube = ChunkedCube(f"{tmp_path}/c", ("s", "r", "m", "y"), ("v", "w"), {"s": 1, "m": 1, "r": 4, "y": 3}, ("s", "m"))
    cube.write(df)
    chunks = spark.read.parquet(f"{tmp_path}/c/chunks").collect()
    assert all(len(r["v"]) == len(r["present"]) == 12 for r in chunks)
    assert rows(cube.read(spark).select(df.columns)) == rows(df)
    part = cube.read(spark, s=["B"], y=[2001, 2004], r=["r03", "r10", "none"])
    assert rows(part.select(df.columns)) == rows(df.where("s = 'B' and y in (2001, 2004) and r in ('r03', 'r10')"))
    plan = part._jdf.queryExecution().executedPlan().toString()
    scan = plan.split("PartitionFilters: [")[1]
    assert "chunk_s" in scan.split("]")[0] and "chunk_r" in plan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert cube.read(spark, s=["none"]).count() == 0
    with pytest.raises(ValueError, match="no dimension"):
        cube.read(spark, z=[1])
    with pytest.raises(Exception, match="given twice"):
        cube.chunks(df.unionByName(df)).collect()
