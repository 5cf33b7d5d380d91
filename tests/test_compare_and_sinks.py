import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelweft import scale
from panelweft.operators import compare
from panelweft.operators.checks import ChecksFailed
from panelweft.plans.config import PanelConfig, handoff_year
from panelweft.sinks import writers


def frame(spark, values):
    return spark.createDataFrame(values, "region string, year int, v double")


def test_pct_diff_stats(spark):
    a = frame(spark, [("a", 1, 11.0), ("b", 1, 5.0), ("c", 1, None), ("d", 1, 2.0), ("x", 1, 1.0)])
    b = frame(spark, [("a", 1, 10.0), ("b", 1, 0.0), ("c", 1, 3.0), ("d", 1, 2.0), ("y", 1, 1.0), ("z", 1, 1.0)])
    r = compare.pct_diff_stats(a, b, ["region", "year"], "v").collect()[0]
    assert (r.n_matched, r.n_result_only, r.n_reference_only, r.n_over_threshold) == (4, 1, 2, 1)
    assert r.median_abs_pct == pytest.approx(5.0) and r.max_abs_pct == pytest.approx(10.0)
    assert r.mean_abs_pct == pytest.approx(5.0)


def test_worst_offenders_break_ties_by_key(spark):
    a = frame(spark, [(k, 1, 2.0) for k in "dcba"] + [("e", 1, 9.0)])
    b = frame(spark, [(k, 1, 1.0) for k in "abcde"])
    got = [r.region for r in compare.worst_offenders(a, b, ["region", "year"], "v", 3).collect()]
    assert got == ["e", "a", "b"]


def test_infinite_differences_fail_a_gate(spark):
    a, b = frame(spark, [("a", 1, 1.0), ("b", 1, 0.0)]), frame(spark, [("a", 1, 0.0), ("b", 1, 0.0)])
    r = compare.compare_all_columns(a, b, ["region", "year"], ["v"]).collect()[0]
    assert r.max_pct == float("inf") and r.n_unmatched == 0


def test_tiers(spark):
    cols = "region string, country string, year int, v double"
    a = spark.createDataFrame([("A.1", "A", 1, 1.0), ("A.2", "A", 1, 1.0), ("B.1", "B", 1, 1.0)], cols)
    b = spark.createDataFrame([("A.1", "A", 1, 2.0), ("A.2", "A", 1, 1.5), ("B.1", "B", 1, 1.0)], cols)
    flagged = spark.createDataFrame([("A.1",)], "region string")
    keys = ["region", "country", "year"]
    got = {r.tier: r for r in compare.tiered_compare(a, b, flagged, keys, ["v"]).collect()}
    assert {t: (r.n_rows, r.ok) for t, r in got.items()} == {"A": (1, True), "B": (1, True), "C": (1, True)}
    worse = b.withColumn("v", F.when(F.col("region") == "B.1", None).otherwise(F.col("v")))
    got = {r.tier: r for r in compare.tiered_compare(a, worse, flagged, keys, ["v"]).collect()}
    assert not got["A"].ok and got["A"].n_null_mismatch == 1


def test_median_with_a_hot_value(spark):
    values = [0.0] * 500 + [float(i) for i in range(1, 401)] + [7.5] * 3
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    assert scale.exact_median(df, "v").collect()[0][0] == statistics.median(values)
    odd = [3.0, 1.0, 2.0]
    assert scale.exact_median(spark.createDataFrame([(v,) for v in odd], "v double"), "v").collect()[0][0] == 2.0
    assert scale.exact_median(df.where("v < 0"), "v").collect()[0][0] is None


def test_running_total_over_many_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 3).alias("n"))
    got = scale.running_total(df.repartition(7), ["k"], "n", "total").orderBy("k").collect()
    total = 0
    for r in got:
        total += r.n
        assert r.total == total
    assert len(got) == 1000


def test_dense_codes(spark):
    df = spark.createDataFrame([(x,) for x in ("b", "a", "c", "a", None)], "label string")
    assert rows(writers.dense_codes(df, "label", "code")) == [("a", 0), ("b", 1), ("c", 2)]


def panel(spark):
    return spark.createDataFrame(
        [("SSP3", m, r, y, 1.5) for m in ("OECD", "IIASA") for r in ("b", "a") for y in (2000, 2001)],
        "scenario string, gdp_model string, hierid string, year int, gdppc double",
    )


def test_cube(spark, tmp_path):
    cube = writers.to_cube(panel(spark), ["gdppc"])
    assert dict(cube.dtypes)["gdppc"] == "float"
    got = {(r.hierid, r.year, r.gdp_model): (r.hierid_code, r.year_code, r.gdp_model_code) for r in cube.collect()}
    assert got["b", 2001, "OECD Env-Growth"] == (1, 1, 1) and got["a", 2000, "IIASA GDP"] == (0, 0, 0)
    writers.write_cube(cube, str(tmp_path / "cube"))
    assert spark.read.parquet(str(tmp_path / "cube")).count() == 8
    with pytest.raises(writers.CubeError, match="full grid"):
        writers.to_cube(panel(spark).where("not (hierid = 'a' and year = 2000 and gdp_model = 'OECD')"), ["gdppc"])
    with pytest.raises(writers.CubeError, match="contiguous"):
        writers.to_cube(panel(spark).withColumn("year", F.col("year") * 2), ["gdppc"])


def gate(spark, ok):
    return spark.createDataFrame([("SSP3", "OECD", "c", ok, 0, "")],
                                 "scenario string, gdp_model string, check string, ok boolean, n_bad int, detail string")


def test_panels_are_written_only_behind_the_gates(spark, tmp_path):
    path = str(tmp_path / "1.0.0")
    with pytest.raises(ChecksFailed):
        writers.write_panels(panel(spark), path, gate(spark, False), "1.0.0")
    with pytest.raises(ValueError, match="version"):
        writers.write_panels(panel(spark), path, gate(spark, True), "1.0.1")
    writers.write_panels(panel(spark), path, gate(spark, True), "1.0.0")
    back = spark.read.csv(path, header=True)
    assert back.count() == 8 and set(back.columns) == set(panel(spark).columns)
    one = spark.read.csv(f"{path}/scenario=SSP3/gdp_model=OECD", header=True)
    assert one.columns == ["hierid", "year", "gdppc"]
    with pytest.raises(Exception, match="already exists"):
        writers.write_panels(panel(spark), path, gate(spark, True), "1.0.0")


def test_stage_files_spell_gaps(spark, tmp_path):
    df = frame(spark, [("a", 1, None), ("b", 1, 2.0)])
    writers.write_stage(df, str(tmp_path / "s"), ["region"])
    text = [r.value for r in spark.read.text(str(tmp_path / "s")).collect()]
    assert "a,1,NA" in text and "b,1,2.0" in text


def test_cached_tables_are_built_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return {"t": spark.range(3)}

    for _ in range(2):
        assert writers.cached(spark, str(tmp_path / "c"), ["t"], build)["t"].count() == 3
    assert calls == [1]


def test_provenance_and_dictionary(spark):
    p = writers.provenance(spark, {"version": "1.0.0"}, panel(spark)).collect()
    assert [r["value"] for r in p if r["item"] == "version"] == ["1.0.0"]
    assert len({r["value"] for r in p if r["item"].startswith("content/SSP3/")}) >= 1 and len(p) == 3
    with_notes = writers.with_dictionary(panel(spark), {"gdppc": {"unit": "2005 USD PPP"}})
    assert with_notes.schema["gdppc"].metadata == {"unit": "2005 USD PPP"}


def test_settings():
    with pytest.raises(ValueError, match="unknown pop_control"):
        PanelConfig(pop_control="bogus")
    assert PanelConfig().handoff == 2023 and handoff_year(2030) == 2030
    for bad in (2019, 2100, "soon"):
        with pytest.raises(ValueError, match="pop_handoff_year"):
            handoff_year(bad)


def test_staging_needs_a_shared_folder(spark, monkeypatch):
    assert scale.staging_path(spark, "x") != scale.staging_path(spark, "x")
    df = scale.materialise(spark.range(5), "five")
    assert df.count() == 5 and "x" not in df.columns
    with pytest.raises(ValueError, match="duplicate"):
        scale.require_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"], "t")


def test_rows_without_a_partner_fail(spark):
    cols = "region string, country string, year int, v double, w double, x double"
    a = spark.createDataFrame([("r1", "A", 1, 1.0, 1.0, 1.0), ("r2", "B", 1, 2.0, 2.0, 2.0)], cols)
    b = spark.createDataFrame([("r1", "A", 1, 1.0, 1.0, 1.0)], cols)
    none = spark.createDataFrame([], "region string")
    keys = ["region", "country", "year"]
    for x, y in ((a, b), (b, a)):
        (row,) = compare.tiered_compare(x, y, none, keys, ["v"]).collect()
        assert (row.tier, row.n_rows, row.n_one_sided, row.ok) == ("A", 1, 1, False)
        found = {r.country: r.one_sided for r in compare.national_agreement(x, y, ["country"], ["v"], [1]).collect()}
        assert found == {"A": False, "B": True}
        (row,) = compare.envelope_compare(x, y, keys, "v", "w", "x").collect()
        assert not row.rows_ok and row.strict_ok
    (row,) = compare.tiered_compare(a, a, none, keys, ["v"]).collect()
    assert row.ok and row.n_one_sided == 0
