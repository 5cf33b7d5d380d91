"""Helpers that keep plans safe at scale: shared staging, measured lookups,
exact global order.

National tables are joined to region rows through `bounded`: the table is
written once, its files are measured, and it is broadcast only if they are
small, so the region rows are not shuffled. A larger one goes through an
ordinary join, where Spark sorts and merges and adaptive execution splits hot
keys.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

ROWS_PER_TASK = 1 << 15  # rows of a region table, before they are multiplied
PARTS_IN_TURN = 16  # parts of the regions that one task sums up, one after the other
BROADCAST_BYTES = 4 << 20  # of compressed files: some tens of MB in memory

_own_dirs: dict[str, str] = {}
_owned: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Only a local session without
    that setting gets a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    return _own_dirs.setdefault(app, tempfile.mkdtemp(prefix="panelweft-"))


def staging_root(spark: SparkSession) -> str:
    """The folder that holds all that this application stages."""
    return f"{shared_dir(spark)}/panelweft/{spark.sparkContext.applicationId}"


def _hadoop(spark: SparkSession, path: str):
    """The file system that a path lies in, and the path as it knows it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def staging_path(spark: SparkSession, label: str) -> str:
    """A new path in the staging folder, which goes when the driver ends."""
    root = staging_root(spark)
    if root not in _owned:
        _owned.add(root)
        files, at = _hadoop(spark, root)
        files.mkdirs(at)
        files.deleteOnExit(at)
    return f"{root}/{label}-{uuid.uuid4().hex[:12]}"


def clear_staging(spark: SparkSession) -> None:
    """Remove what this application has staged. Frames read from it end too."""
    files, at = _hadoop(spark, staging_root(spark))
    files.delete(at, True)
    _owned.discard(staging_root(spark))


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there to its end."""
    files, at = _hadoop(spark, f"{path}/_SUCCESS")
    return files.exists(at)


def mark_complete(spark: SparkSession, path: str) -> None:
    """Say that all below a path was written to its end."""
    files, at = _hadoop(spark, f"{path}/_SUCCESS")
    files.create(at, True).close()


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The size of the files below a path."""
    files, at = _hadoop(spark, path)
    return files.getContentSummary(at).getLength()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder of one store; it must not be there yet."""
    files, at = _hadoop(spark, source)
    _, to = _hadoop(spark, target)
    files.mkdirs(to.getParent())
    if files.exists(to) or not files.rename(at, to):
        raise FileExistsError(f"{target} cannot be made from {source}")


def remove(spark: SparkSession, path: str) -> None:
    files, at = _hadoop(spark, path)
    files.delete(at, True)


def listed_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names and sizes of the files below a path, hidden ones left out."""
    files, at = _hadoop(spark, path)
    found, each = [], files.listFiles(at, True)
    while each.hasNext():
        one = each.next()
        if not one.getPath().getName().startswith((".", "_")):
            found.append((one.getPath().toString(), one.getLen()))
    return sorted(found)


class Observed:
    """Aggregates that are worked out while a frame is written, at no further pass:
    name -> aggregate column. `values` holds them after that."""

    def __init__(self, **aggregates):
        self.aggregates = aggregates
        self._seen = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, *(a.alias(n) for n, a in self.aggregates.items()))

    @property
    def values(self) -> dict:
        return self._seen.get


def materialise(df: DataFrame, label: str, metrics: Observed | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Used where several consumers share a result: it is computed once, its
    lineage is cut, it outlives lost executors, and its true size is known to
    the planner when it is joined.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    (metrics.on(df) if metrics else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame) -> DataFrame:
    """A lookup table, staged, and broadcast only if its files are small."""
    spark, path = df.sparkSession, staging_path(df.sparkSession, "lookup")
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    return F.broadcast(table) if stored_bytes(spark, path) <= BROADCAST_BYTES else table


def running_total(df: DataFrame, order: list[str], amount: str, into: str) -> DataFrame:
    """Running sum of an integer column over one global order, without one
    big task. `order` must be unique.

    The rows are range-partitioned and sorted, so each task holds a
    consecutive stretch; stretch totals (one row per task) are accumulated
    and added to the running sums inside the stretches.
    """
    stretch = "__stretch"
    fixed = materialise(
        df.repartitionByRange(*order).withColumn(stretch, F.spark_partition_id()),
        "ordered",
    )
    before = Window.orderBy(stretch).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        fixed.groupBy(stretch)
        .agg(F.sum(amount).alias("__total"))
        .select(stretch, F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__offset"))
    )
    inside = Window.partitionBy(stretch).orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        fixed.withColumn(into, F.sum(amount).over(inside))
        .join(offsets, stretch)
        .withColumn(into, F.col(into) + F.col("__offset"))
        .drop(stretch, "__offset")
    )


def exact_median(df: DataFrame, value: str, into: str = "median") -> DataFrame:
    """One row holding the exact median of the non-null values.

    Values are counted first (a hot value becomes one row), then ranked with
    `running_total`; no task ever holds the whole column.
    """
    counts = (
        df.where(F.col(value).isNotNull() & ~F.isnan(value))
        .groupBy(F.col(value).alias("__v"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    ranked = running_total(counts, ["__v"], "__n", "__hi")
    total = ranked.agg(F.coalesce(F.sum("__n"), F.lit(0))).scalar()
    low_rank, high_rank = F.floor((total + 1) / 2), F.floor(total / 2) + 1
    lo, hi = F.col("__hi") - F.col("__n"), F.col("__hi")

    def at(rank):
        return F.max(F.when((lo < rank) & (rank <= hi), F.col("__v")))

    return ranked.withColumn("__low", low_rank).withColumn("__high", high_rank).agg(
        ((at(F.col("__low")) + at(F.col("__high"))) / 2).alias(into)
    )


def tasks_for(df: DataFrame) -> int:
    """How many tasks share the rows of a table that each of them multiplies. The
    number is given to `repartition`, as a measured size would put the small table
    of before into few tasks."""
    return tasks_of(df.sparkSession, df.count(), ROWS_PER_TASK)


def tasks_of(spark: SparkSession, rows: int, per_task: int) -> int:
    """How many tasks share so many rows; every core has one at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // per_task))


def in_turn(df: DataFrame, parts: int) -> DataFrame:
    """The frame's `parts` in fewer tasks, each of which takes some of them one after
    the other. For sums that every part has in full, such as those of countries: a
    task sends them once. Sorts give way after each part, hash tables of joins do not."""
    least = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(least, -(-parts // PARTS_IN_TURN)))


@contextmanager
def shared_partitioning(spark: SparkSession):
    """Inside, a join may use a partitioning on some of its keys, so that frames
    laid out by region are not shuffled again to be joined by region and year.
    The session's own setting comes back after it; so run the plan inside."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def require_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """Raise if a key occurs twice; otherwise hand the frame back."""
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if twice:
        shown = ", ".join(f"{k}={twice[0][k]}" for k in keys)
        raise ValueError(f"{what}: duplicate rows for key ({shown})")
    return df
