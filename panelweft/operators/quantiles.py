"""Exact quantiles of many columns and groups at once, by radix selection.

Values become whole numbers in the same order. Each round counts them by sixteen
more bits, for all columns and groups together, and finds the bucket in which each
wanted rank lies; the next round only reads values of these buckets. After four
rounds a bucket is one value. Nothing is sorted, a value that occurs often is one
count, and a group of any size is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweft.functions.columns import as_col
from panelweft.scale import bounded, materialise

DIGIT, BITS = 16, 64
HIDDEN = 1 << 52  # of a mantissa


def ordered_bits(value) -> Column:
    """A double as a long with the same order: the bits of its size, with its
    sign. NULL for NULL and NaN; both zeros are 0."""
    x = as_col(value).cast("double")
    a = F.abs(x)
    guess = F.floor(F.log2(a)).cast("double")
    power = F.pow(F.lit(2.0), guess)
    # the logarithm may be off by one next to a power of two
    exponent = F.when(a < power, guess - 1).when(a / 2 >= power, guess + 1).otherwise(guess)
    mantissa = (a / F.pow(F.lit(2.0), exponent) - 1) * float(HIDDEN)
    normal = (exponent.cast("long") + 1023) * HIDDEN + mantissa.cast("long")
    small = (a * 2.0**537 * 2.0**537).cast("long")  # below the least normal number
    size = F.when(a == float("inf"), F.lit(2047 * HIDDEN)).when(a < 2.0**-1022, small).otherwise(normal)
    return F.when(F.isnan(x), F.lit(None)).when(x < 0, -size).otherwise(size)


def from_bits(bits) -> Column:
    """The double of `ordered_bits`."""
    b = as_col(bits)
    size = F.abs(b)
    exponent = F.shiftright(size, 52) - 1023
    normal = (size.bitwiseAND(F.lit(HIDDEN - 1)) / float(HIDDEN) + 1) * F.pow(F.lit(2.0), exponent.cast("double"))
    small = size.cast("double") * 2.0**-537 * 2.0**-537
    value = F.when(size == 2047 * HIDDEN, float("inf")).when(size < HIDDEN, small).otherwise(normal)
    return F.when(b < 0, -value).otherwise(value)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), probs: Sequence[float] = (0.5,)
) -> DataFrame:
    """(by..., column, prob, n, value): for each group, column and probability p the
    value at rank 1 + p (n - 1), between two ranks as far along as that says. NULL
    and NaN do not count; a group without any value of a column has no row."""
    group = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))
    wide = materialise(df.select(group.alias("g"), *[ordered_bits(c).alias(f"k{n}") for n, c in enumerate(columns)]), "radix")
    rows = wide.select("g", F.posexplode(F.array(*[F.col(f"k{n}") for n in range(len(columns))])).alias("c", "key"))
    rows = rows.where("key is not null")
    key, wanted, counts = ["g", "c"], None, None
    for shift in range(BITS - DIGIT, -1, -DIGIT):
        if wanted is not None:
            parents = bounded(wanted.select(*key, "bucket").distinct().withColumnRenamed("bucket", "parent"))
            rows = rows.withColumn("parent", F.shiftright("key", shift + DIGIT)).join(parents, [*key, "parent"], "left_semi")
            rows = materialise(rows.select(*key, "key"), "radix")
        bucket = F.shiftright("key", shift).alias("bucket")
        found = rows.groupBy(*key, bucket).agg(F.count(F.lit(1)).alias("n"))
        if wanted is None:
            found = found.withColumn("parent", F.lit(0).cast("long"))
        else:
            found = found.withColumn("parent", F.shiftright("bucket", DIGIT))
        found = materialise(found, "histogram")  # 65,536 rows at most for each parent
        if wanted is None:
            counts = materialise(found.groupBy(*key).agg(F.sum("n").alias("total")), "counts")
            ranks = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.lit(hi).alias("hi")) for p in probs for hi in (0, 1)]))
            asked = counts.select(*key, "total", ranks.alias("w")).select(*key, "total", "w.*")
            at = F.col("prob") * (F.col("total") - 1)
            rank = F.when(F.col("hi") == 1, F.ceil(at)).otherwise(F.floor(at)) + 1
            wanted = asked.select(*key, "prob", "hi", rank.alias("rank"), F.lit(0).cast("long").alias("bucket"))
        line = Window.partitionBy(*key, "parent").orderBy("bucket")
        upto = F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        cumulated = found.select(*key, "parent", "bucket", (upto - F.col("n")).alias("before"), upto.alias("upto"))
        asked = bounded(wanted.withColumnRenamed("bucket", "parent"))
        hit = (F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("upto"))
        wanted = materialise(
            cumulated.join(asked, [*key, "parent"]).where(hit)
            .select(*key, "prob", "hi", (F.col("rank") - F.col("before")).alias("rank"), "bucket"),
            "ranks",
        )
    ends = wanted.groupBy(*key, "prob").agg(
        F.max(F.when(F.col("hi") == 0, from_bits("bucket"))).alias("low"), F.max(F.when(F.col("hi") == 1, from_bits("bucket"))).alias("high")
    )
    part = F.col("prob") * (F.col("total") - 1) - F.floor(F.col("prob") * (F.col("total") - 1))
    low, high = F.col("low"), F.col("high")
    value = F.when(low == high, low).when(part == 0.5, (low + high) / 2).otherwise(low + (high - low) * part)
    names = F.array(*[F.lit(c) for c in columns])
    return ends.join(counts, key).select(
        *[F.col(f"g.{c}").alias(c) for c in by], F.get(names, F.col("c")).alias("column"), "prob", F.col("total").alias("n"), value.alias("value")
    )
