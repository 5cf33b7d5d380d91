import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelweft.functions.columns import DEFLATE_2017_TO_2005, DEFLATE_2021_TO_2005
from panelweft.operators import allocate, cohorts, fill, series, smooth


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_linear_and_log_knots(spark):
    df = spark.createDataFrame(
        [("AAA", 2020, 100.0), ("AAA", 2030, 200.0), ("BBB", 2020, 10.0)],
        "iso3 string, year int, value double",
    )
    linear = by_key(series.interpolate(df, ["iso3"]), "iso3", "year")
    assert len(linear) == 11
    assert linear["AAA", 2025].value == 150.0
    log = by_key(series.interpolate(df, ["iso3"], log=True), "iso3", "year")
    assert log["AAA", 2025].value == pytest.approx(math.sqrt(2) * 100)


def test_knots_without_a_positive_value_are_skipped(spark):
    df = spark.createDataFrame(
        [("A", 1, 10.0), ("A", 2, 0.0), ("A", 3, None), ("A", 4, float("nan")), ("A", 5, 50.0)],
        "k string, year int, value double",
    )
    assert [r.value for r in series.interpolate(df, ["k"]).orderBy("year").collect()] == [
        10.0, 20.0, 30.0, 40.0, 50.0,
    ]


def knots(spark):
    out = []
    for i, year in enumerate(range(2020, 2101, 5)):
        value = 1000 * 1.02**i
        for iso in ("AAA", "CCC"):
            out.append(("OECD", iso, year, value))
        if year >= 2025:
            for iso in ("BBB", "CCC"):
                out.append(("IIASA", iso, year, value))
    return spark.createDataFrame(out, "model string, iso3 string, year int, gdppc double")


def test_cross_filled_models_cover_the_same_countries(spark):
    annual = series.interpolate(knots(spark), ["model", "iso3"], value="gdppc", log=True)
    early = annual.where("model = 'OECD'").drop("model")
    late = annual.where("model = 'IIASA'").drop("model")
    oecd = series.growth_since(early, ["iso3"], 2023, value="gdppc")
    iiasa = series.bridge_and_chain(oecd, late, ["iso3"], 2025, value="gdppc").unionByName(
        series.bridge_alone(oecd, late, ["iso3"], 2025, 2030, value="gdppc")
    )
    a = by_key(series.cross_fill(oecd, iiasa, ["iso3"]), "iso3", "year")
    b = by_key(series.cross_fill(iiasa, oecd, ["iso3"]), "iso3", "year")
    want = {(iso, y) for iso in ("AAA", "BBB", "CCC") for y in range(2024, 2101)}
    assert set(a) == set(b) == want
    assert all(a["AAA", y].growth == b["AAA", y].growth for y in range(2024, 2101))
    rate = 1.02 ** (1 / 5)
    assert b["BBB", 2024].growth == pytest.approx(rate)
    assert b["BBB", 2030].growth == pytest.approx(rate**7)


def test_fill_uncovered_without_groups(spark):
    growth = spark.createDataFrame(
        [("A", 1, 2.0), ("B", 1, 8.0), ("A", 2, 3.0)], "c string, year int, growth double"
    )
    wanted = spark.createDataFrame([("A",), ("Z",)], "c string")
    out = by_key(series.fill_uncovered(growth, wanted, "c"), "c", "year")
    assert out["Z", 1].growth == pytest.approx(4.0) and out["Z", 2].growth == pytest.approx(3.0)
    assert len(out) == 5


def test_step_lookup_uses_the_shared_knots(spark):
    df = spark.createDataFrame(
        [("A", 2000, 1.0), ("A", 2005, 2.0), ("B", 2000, 9.0)], "c string, year int, v double"
    )
    out = rows(series.step_lookup(df, 1999, 2006).select("c", "year", "v"))
    assert [r[1] for r in out if r[0] == "B"] == [2000, 2001, 2002, 2003, 2004]
    assert [r[2] for r in out if r[0] == "A"] == [1.0] * 5 + [2.0] * 2


def test_splice_rebases_only_anchored_keys(spark):
    first = spark.createDataFrame(
        [("A", y, 10.0 * y) for y in range(1, 6)] + [("B", y, 5.0) for y in range(1, 6)],
        "k string, year int, value double",
    )
    second = spark.createDataFrame(
        [("A", y, float(y * y)) for y in range(2, 8)] + [("C", y, 1.0) for y in range(1, 8)],
        "k string, year int, value double",
    )
    out = by_key(series.splice_rebase(first, second, ["k"], 3, 2), "k", "year")
    assert {k for k, _ in out} == {"A", "B"}
    assert out["A", 3].value == 30.0
    assert out["A", 6].value == pytest.approx(30.0 * 36 / 9)
    assert out["B", 5].value == 5.0 and ("B", 6) not in out and ("A", 1) not in out


def override_inputs(spark, anchor=True):
    raw = spark.createDataFrame(
        [("VEN", f"VEN.{i}", y, v, 200.0) for i, v in ((1, 100.0), (2, 300.0)) for y in range(2012, 2023)],
        "iso3 string, hierid string, year int, raw double, shape double",
    )
    base = raw.select("iso3", "hierid", "year", F.lit(1.0).alias("value")).unionByName(
        spark.createDataFrame([("VEN", "VEN.1", 2011, 7.0), ("AAA", "AAA.1", 2015, 3.0)],
                              "iso3 string, hierid string, year int, value double")
    )
    anchors = spark.createDataFrame(
        [("VEN", 10000.0 if anchor else None, 20000 * DEFLATE_2017_TO_2005)],
        "iso3 string, start double, end double",
    )
    path = fill.log_path(anchors, ["iso3"], 2011, 2025, 2012, 2023)
    return fill.override_path(base, raw, path, ["iso3"], ["hierid"], 2012, 2023)


def test_override_path(spark):
    out = by_key(override_inputs(spark), "hierid", "year")

    def path(y):
        return 10000 * math.exp(math.log(20000 * DEFLATE_2017_TO_2005 / 10000) * (y - 2011) / 14)

    assert out["VEN.1", 2015].value == pytest.approx(0.5 * path(2015))
    assert out["VEN.2", 2023].value == pytest.approx(1.5 * path(2023))
    assert out["VEN.1", 2011].value == 7.0 and out["AAA.1", 2015].value == 3.0
    assert len(out) == 2 * 12 + 2


def test_no_override_without_an_anchor(spark):
    out = by_key(override_inputs(spark, anchor=False), "hierid", "year")
    assert out["VEN.1", 2015].value == 1.0 and ("VEN.1", 2023) not in out


def test_deflators():
    assert DEFLATE_2021_TO_2005 == pytest.approx(0.74017, abs=1e-5)
    assert DEFLATE_2017_TO_2005 == pytest.approx(0.81556)


@pytest.mark.parametrize(
    "values, want",
    [
        ([10.0, 20.0, 40.0], [10.0, 370 / 25, 810 / 36]),
        ([0.0] * 12 + [100.0], [0.0] * 12 + [100 / 91]),
        ([None, 10.0], [None, 10.0]),
        ([None, None, None], [None, None, None]),
    ],
)
def test_kernel(spark, values, want):
    df = spark.createDataFrame(
        [("r", i, v) for i, v in enumerate(values)], "r string, year int, x double"
    )
    out = smooth.kernel_smooth(df, ["r"], "x", "s").orderBy("year").collect()
    for row, w in zip(out, want):
        assert row.s == (pytest.approx(w) if w is not None else None)


def test_kernel_against_a_plain_loop(spark):
    import random

    random.seed(3)
    xs = [None if random.random() < 0.2 else random.uniform(1, 1e5) for _ in range(60)]
    df = spark.createDataFrame([("r", i, v) for i, v in enumerate(xs)], "r string, year int, x double")
    out = [r.s for r in smooth.kernel_smooth(df, ["r"], "x", "s").orderBy("year").collect()]
    for i, got in enumerate(out):
        frame = xs[max(0, i - 12) : i + 1]
        pairs = [(13 - n, v) for n, v in enumerate(frame) if v is not None]
        if not pairs:
            assert got is None
            continue
        assert got == pytest.approx(sum(w * v for w, v in pairs) / sum(w for w, _ in pairs), rel=1e-11)


def test_allocation_of_zero_weights(spark):
    w = spark.createDataFrame(
        [("a", "A", 0.0), ("b", "A", 0.0), ("c", "B", 1.0), ("d", "B", 3.0), ("e", "C", 2.0)],
        "region string, country string, weight double",
    )
    control = spark.createDataFrame(
        [("A", 1, 10.0), ("B", 1, 8.0), ("B", 3, 4.0)], "country string, year int, total double"
    )
    fixed = by_key(allocate.allocate_fixed(w, control, ["country"]), "region", "year")
    assert fixed["a", 1].value is None and fixed["d", 1].value == 6.0 and fixed["c", 3].value == 1.0
    frozen = by_key(allocate.freeze_uncontrolled(w, control, ["country"]), "region", "year")
    assert {k: v.value for k, v in frozen.items()} == {("e", y): 2.0 for y in (1, 2, 3)}
    yearly = allocate.allocate_yearly(w.withColumn("year", F.lit(1)), control, ["country"])
    assert by_key(yearly, "region")["a",].value == 0.0


def test_both_reconciliations_agree(spark):
    start = spark.createDataFrame(
        [("A", "a", 10.0, 1.0), ("A", "b", 40.0, 3.0), ("A", "z", 5.0, 0.0), ("B", "c", 7.0, 2.0),
         ("A", "n", None, 4.0)],
        "country string, region string, value double, weight double",
    )
    growth = spark.createDataFrame(
        [(c, y, g) for c in "AB" for y, g in ((1, 1.1), (2, 1.4))],
        "country string, year int, growth double",
    )
    target = spark.createDataFrame([("A", 1, 66.0), ("A", 2, 33.0)], "country string, year int, target double")
    moved = series.project(start, growth, ["country"], "value")
    slow = allocate.reconcile_weighted_mean(moved, target, ["country"], since=1)
    fitted = allocate.reconcile_growth(growth, start, target, ["country"])
    fast = series.project(start, fitted, ["country"], "value")
    a, b = (by_key(x, "region", "year") for x in (slow, fast))
    assert set(a) == set(b) and len(a) == 10
    for k in a:
        assert a[k].value == (pytest.approx(b[k].value) if b[k].value is not None else None)
    assert a["c", 1].value == pytest.approx(7.7)
    assert (a["a", 1].value + 3 * a["b", 1].value) / 4 == pytest.approx(66.0)


def test_covered_country_loses_a_missing_knot(spark):
    people = spark.createDataFrame(
        [("a", "A", y, 10.0) for y in (2000, 2005)] + [("x", "X", y, 10.0) for y in (2000, 2005)],
        "region string, country string, year int, value double",
    )
    own = spark.createDataFrame([("A", 2000, 0.5)], "country string, year int, s double")
    typical = spark.createDataFrame([(2000, 0.1), (2005, 0.2)], "year int, s double")
    args = dict(columns={"s": "part"})
    out = by_key(cohorts.apply_or_fallback(people, own, typical, "country", **args), "region", "year")
    assert ("a", 2005) not in out
    assert out["a", 2000].part == 5.0 and out["x", 2005].part == 2.0
    kept = cohorts.apply_or_fallback(people, own, typical, "country", keep_unmatched=True, **args)
    assert by_key(kept, "region", "year")["a", 2005].part is None


def test_whole_group_and_chain_fallbacks(spark):
    df = spark.createDataFrame(
        [("A", 1, 5.0, 1.0), ("A", 2, 5.0, None), ("B", 1, 4.0, None), ("B", 2, None, None)],
        "g string, year int, raw double, value double",
    )
    out = by_key(fill.fallback_whole_group(df, ["g"], "value", F.col("raw") * 10), "g", "year")
    assert out["A", 2].value is None and out["B", 1].value == 40.0 and out["B", 2].value is None
    chained = fill.fallback_chain(df, "value", F.col("raw").isNull(), F.lit(None).cast("double"), F.lit(3.0))
    assert by_key(chained, "g", "year")["B", 2].value == 3.0


def test_update_join_overwrites_with_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    patch = spark.createDataFrame([("a", None), ("c", 3.0)], "k string, v double")
    assert rows(fill.update_join(df, patch, ["k"], "v")) == [("a", None), ("b", 2.0)]


def test_knots_belong_to_their_scenario(spark):
    df = spark.createDataFrame(
        [("A", 2020, 1.0), ("A", 2030, 2.0), ("B", 2020, 3.0), ("B", 2025, 4.0), ("B", 2030, 5.0)],
        "s string, year int, v double",
    )
    out = {(r.s, r.year): r.v for r in series.step_lookup(df, 2020, 2031, within=["s"]).collect()}
    assert len(out) == 24
    assert (out["A", 2027], out["B", 2024], out["B", 2027], out["A", 2031]) == (1.0, 3.0, 4.0, 2.0)


def test_two_knots_in_a_year_are_named(spark):
    df = spark.createDataFrame([("AAA", 2000, 1.0), ("AAA", 2000, 2.0), ("AAA", 2005, 3.0)], "iso3 string, year int, value double")
    with pytest.raises(Exception, match="two knots for .iso3=AAA, year=2000"):
        series.interpolate(df, ["iso3"]).collect()


def test_growth_is_fitted_only_where_there_are_people(spark):
    growth = spark.createDataFrame([("A", y, 1.0 + (y - 2023) / 100) for y in (2040, 2060)], "c string, year int, growth double")
    start = spark.createDataFrame([("A", 10.0, 1.0), ("A", 30.0, 3.0)], "c string, value double, weight double")
    target = spark.createDataFrame([("A", y, 50.0) for y in (2040, 2060)], "c string, year int, target double")
    present = spark.createDataFrame([("A", 2040)], "c string, year int")
    out = {r.year: r.growth for r in allocate.reconcile_growth(growth, start, target, ["c"], present=present).collect()}
    assert out[2040] == pytest.approx(2.0) and out[2060] == pytest.approx(1.37)
