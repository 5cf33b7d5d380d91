"""Versions of a table compared from the top of a tree of hashes.

Rows are summed up by the prefixes of their key columns: all rows, then those of each
value of the first level, and so on. A node holds the number of its rows and two
independent sums of their hashes, so the order of rows does not matter, equal rows do
not cancel, and a node's sums are those of its children. Two trees are compared from
the root; only children of differing nodes are looked at, and only rows below
differing leaves are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from panelweft.scale import bounded, materialise

SUMS = ("n_rows", "sum_a", "sum_b")


def row_hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two hashes of a row; which columns are missing counts too."""
    missing = F.concat(*[F.col(c).isNull().cast("string") for c in columns])
    cells = [F.col(c) for c in columns]
    return F.xxhash64(*cells, missing), F.xxhash64(F.lit("again"), missing, *cells)


def content_sums(columns: Sequence[str]) -> list[Column]:
    """Aggregates: number of rows and both sums of their hashes, exact."""
    hashes = row_hashes(columns)
    sums = [F.sum(h.cast("decimal(20,0)")).alias(name) for h, name in zip(hashes, SUMS[1:])]
    return [F.count(F.lit(1)).alias(SUMS[0]), *sums]


def hash_tree(df: DataFrame, levels: Sequence[str]) -> DataFrame:
    """(depth, levels..., n_rows, sum_a, sum_b): one row per node. Columns below a
    node's depth are NULL. Hashes cover all columns, whatever their order."""
    leaves = materialise(df.groupBy(*levels).agg(*content_sums(sorted(df.columns))), "leaves")
    kinds = {f.name: f.dataType for f in leaves.schema}
    parts = []
    for depth in range(len(levels) + 1):
        some = leaves if depth == len(levels) else leaves.groupBy(*levels[:depth]).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in SUMS])
        below = [F.lit(None).cast(kinds[c]).alias(c) for c in levels[depth:]]
        parts.append(some.where("n_rows is not null").select(F.lit(depth).alias("depth"), *levels[:depth], *below, *SUMS))
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Difference:
    """`leaves`: the differing prefixes with the row numbers of both sides (NULL
    where a side has none); `steps`: (depth, compared, differing) of the descent."""

    leaves: DataFrame
    steps: list[tuple[int, int, int]]


def _same(levels: Sequence[str], a: str, b: str) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in levels], F.lit(True))


def compare_trees(a: DataFrame, b: DataFrame, levels: Sequence[str]) -> Difference:
    """Descend both trees along the nodes that differ."""
    differing, steps = None, []
    for depth in range(len(levels) + 1):
        path, up = list(levels[:depth]), list(levels[: max(0, depth - 1)])
        sides = []
        for tree in (a, b):
            nodes = tree.where(F.col("depth") == depth)
            if differing is not None:
                nodes = nodes.alias("n").join(differing.alias("d"), _same(up, "n", "d"), "left_semi")
            sides.append(nodes.select(*path, *SUMS))
        left, right = sides[0].alias("x"), sides[1].alias("y")
        pairs = left.join(right, _same(path, "x", "y"), "full")
        equal = reduce(lambda p, q: p & q, [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in SUMS])
        both = materialise(
            pairs.select(
                *[F.coalesce(f"x.{c}", f"y.{c}").alias(c) for c in path], F.col("x.n_rows").alias("n_a"),
                F.col("y.n_rows").alias("n_b"), (~equal).alias("differs"),
            ),
            "compared",
        )
        differing = bounded(both.where("differs").drop("differs"))
        steps.append((depth, both.count(), differing.count()))
        if not steps[-1][2]:
            break
    return Difference(differing if len(steps) == len(levels) + 1 else _none(a, levels), steps)


def _none(tree: DataFrame, levels: Sequence[str]) -> DataFrame:
    return tree.where("false").select(*levels, F.col("n_rows").alias("n_a"), F.col("n_rows").alias("n_b"))


def write_version(df: DataFrame, path: str, levels: Sequence[str], folders: int = 1) -> None:
    """A version of a table: its rows below `rows`, in folders by the first levels
    and sorted by the others, and its tree below `tree`."""
    rows = df.repartitionByRange(*levels).sortWithinPartitions(*levels)
    rows.write.partitionBy(*levels[:folders]).parquet(f"{path}/rows")
    hash_tree(df, levels).write.parquet(f"{path}/tree")


def _rows(spark: SparkSession, path: str, tree: DataFrame, levels: Sequence[str]) -> DataFrame:
    """The rows of a version; names of folders have the types that the tree has."""
    kinds = {f.name: f.dataType for f in tree.schema if f.name in levels}
    form = spark.read.parquet(f"{path}/rows").schema
    form = StructType([StructField(f.name, kinds.get(f.name, f.dataType)) for f in form])
    return spark.read.schema(form).parquet(f"{path}/rows")


def compare_versions(spark: SparkSession, a: str, b: str, levels: Sequence[str], folders: int = 1) -> tuple[Difference, DataFrame]:
    """The differing prefixes of two written versions, and the rows in which they
    differ with how often either side has them (n_a, n_b). Rows are only read
    from folders that hold a difference."""
    trees = [spark.read.parquet(f"{p}/tree") for p in (a, b)]
    found = compare_trees(*trees, levels)
    places = [tuple(r) for r in found.leaves.select(*levels[:folders]).distinct().collect()]  # one per folder
    parts = []
    for n, path in enumerate((a, b)):
        rows = _rows(spark, path, trees[n], levels)
        here = F.lit(False)
        for place in places:
            here = here | reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(levels, place)])
        some = rows.where(here).alias("n").join(found.leaves.alias("d"), _same(levels, "n", "d"), "left_semi")
        parts.append(some.select(*sorted(rows.columns), F.lit(n).alias("side")))
    columns = [c for c in parts[0].columns if c != "side"]
    counted = parts[0].unionByName(parts[1]).groupBy(*columns).agg(
        F.count_if(F.col("side") == 0).alias("n_a"), F.count_if(F.col("side") == 1).alias("n_b")
    )
    return found, counted.where("n_a <> n_b")
