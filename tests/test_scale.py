"""Plans and helpers that matter at scale."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelweft import scale
from panelweft.functions.columns import distinct_years
from panelweft.operators import allocate, cohorts, series


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def weights(spark, n=200):
    # one country holds most regions
    return spark.range(n).select(
        F.concat(F.lit("r"), F.col("id")).alias("region"),
        F.when(F.col("id") % 10 < 7, "HOT").otherwise(F.concat(F.lit("c"), F.col("id") % 5)).alias("country"),
        (F.col("id") % 13).cast("double").alias("weight"),
    )


def control(spark):
    return spark.createDataFrame(
        [(c, y, 100.0 * y) for c in ("HOT", "c3", "c4") for y in range(1, 6)],
        "country string, year int, total double",
    )


def test_lookup_size_decides_the_join(spark, monkeypatch):
    w, c = weights(spark), control(spark)
    small = allocate.allocate_or_freeze(w, c, ["country"])
    assert "BroadcastHashJoin" in plan_of(small)
    want = rows(small.select("region", "year", F.round("value", 9)))
    monkeypatch.setattr(scale, "BROADCAST_BYTES", 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = allocate.allocate_or_freeze(w, c, ["country"])
        assert "BroadcastHashJoin" not in plan_of(large)
        assert rows(large.select("region", "year", F.round("value", 9))) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_pass_forms_equal_their_parts(spark):
    w, c = weights(spark), control(spark)
    whole = allocate.allocate_or_freeze(w, c, ["country"])
    parts = allocate.allocate_fixed(w, c, ["country"]).unionByName(
        allocate.freeze_uncontrolled(w, c, ["country"])
    )
    assert rows(whole.select("region", "year", "value")) == rows(parts.select("region", "year", "value"))
    yearly = w.withColumn("year", F.explode(F.sequence(F.lit(2), F.lit(7))))
    whole = allocate.allocate_or_keep(yearly, c, ["country"])
    parts = allocate.allocate_yearly(yearly, c, ["country"]).unionByName(
        allocate.keep_uncontrolled(yearly, c, ["country"])
    )
    assert rows(whole.select("region", "year", "value")) == rows(parts.select("region", "year", "value"))


def test_share_table_equals_the_three_joins(spark):
    people = weights(spark).withColumn("year", F.explode(F.sequence(F.lit(1), F.lit(4)))).withColumnRenamed(
        "weight", "value"
    )
    own = spark.createDataFrame([("HOT", y, 0.1 * y) for y in (1, 2, 4)] + [("c3", 3, 0.5)],
                                "country string, year int, s double")
    typical = spark.createDataFrame([(y, 0.9) for y in range(1, 5)], "year int, s double")
    want = cohorts.apply_or_fallback(people, own, typical, "country", columns={"s": "part"})
    table = cohorts.shares_for(own, typical, people.select("country"), "country")
    got = people.join(table, ["country", "year"]).withColumn("part", F.col("value") * F.col("s"))
    assert rows(got.select("region", "year", "part")) == rows(want.select("region", "year", "part"))


def test_late_growth_equals_its_two_branches(spark):
    lead = spark.createDataFrame(
        [("A", y, 1.01**y) for y in range(1, 9)] + [("L", y, 1.5) for y in range(1, 9)],
        "k string, year int, growth double",
    )
    late = spark.createDataFrame(
        [(k, y, v * 1.1**y) for k, v in (("A", 5.0), ("B", 7.0)) for y in range(2, 10)],
        "k string, year int, value double",
    )
    both = series.bridge_and_chain(lead, late, ["k"], 2).unionByName(series.bridge_alone(lead, late, ["k"], 2, 7))
    assert rows(series.late_growth(lead, late, ["k"], 2, 7)) == rows(both)
    assert both.where("k = 'L'").count() == 0 and both.where("k = 'B'").count() == 9


def test_distinct_years_are_exact(spark):
    df = spark.createDataFrame([(y,) for y in [*range(1900, 2101), *range(1900, 2000, 3), 1850, 2200]] + [(None,)], "y int")
    got = df.agg(distinct_years("y", 1900, 2100).alias("n"), distinct_years("y", 1901, 1902).alias("m")).collect()[0]
    assert (got.n, got.m) == (201, 2)
    assert df.where("y > 2150").agg(distinct_years("y", 1900, 2100).alias("n")).collect()[0].n == 0


def test_a_cluster_needs_its_shared_folder(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "x"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scale.shared_dir(Session())
    assert scale.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_staging_is_cleared(spark):
    table = scale.materialise(spark.range(10), "kept")
    assert table.count() == 10
    path = table.inputFiles()[0]
    assert path.startswith("file:") and scale.staging_root(spark) in path
    assert scale.stored_bytes(spark, path) > 0
    scale.clear_staging(spark)
    with pytest.raises(Exception, match="(?i)not.*exist|FileNotFound"):
        scale.stored_bytes(spark, path)
    assert scale.materialise(spark.range(3), "again").count() == 3
