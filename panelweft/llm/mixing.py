"""Mixing sources to target weights by a budget that flows down a tree.

Levels such as domain, language and source form a tree; every node has a whole
weight. The total goes down level by level in proportion to the weights, but no
node gets more tokens than its leaves can give (their tokens times the allowed
epochs). What one child cannot take goes to its siblings first; only what a
whole subtree cannot take is shared out at the level above.

A leaf's budget is spent in epochs. Each epoch is the leaf's documents in a
seeded order of its own; whole epochs come first, then a prefix of the next,
whose last document is taken in part (`take_tokens` < `n_tokens`).

Null level names are a name of their own. Texts without words have no tokens:
they come with every whole epoch and with a prefix that goes past them. Rows
equal in id and text share a place in the order and are taken together. Weight
0 gives nothing. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweft.llm.rules import words_of
from panelweft.scale import bounded, materialise, running_total

NO_NAME = "-"


def token_count(text: str = "text") -> Column:
    return F.size(words_of(F.col(text))).cast("long")


def share_out(children: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Adds `budget` to children with `weight`, `capacity` and `given` (the
    budget of their parent).

    Children are taken by capacity per weight. One is filled up if, at the
    level that fills it, its parent's budget is not yet spent; the others share
    the rest by weight. All numbers are whole; tokens left by rounding go one
    by one to the first names. The windows hold the children of one node.
    """
    big = lambda c: F.col(c).cast("decimal(20,0)")
    usable = children.withColumn("capacity", F.when(F.col("weight") > 0, F.col("capacity")).otherwise(0))
    ratio = F.floor(big("capacity") * 1000000 / F.greatest(big("weight"), F.lit(1)))
    family = Window.partitionBy(*parents)
    order = family.orderBy("__ratio", name)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (
        usable.withColumn("__ratio", F.when(F.col("weight") > 0, ratio).otherwise(-1))
        .withColumn("__caps", F.sum("capacity").over(upto))
        .withColumn("__after", F.sum("weight").over(family) - F.sum("weight").over(upto))
        .withColumn(
            "__full",
            (big("__caps") * big("weight") + big("capacity") * big("__after") <= big("given") * big("weight"))
            | (F.col("capacity") == 0),
        )
    )
    open_weight = F.coalesce(F.sum(F.when(~F.col("__full"), F.col("weight"))).over(family), F.lit(0))
    spent = F.coalesce(F.sum(F.when(F.col("__full"), F.col("capacity"))).over(family), F.lit(0))
    shared = (
        ranked.withColumn("__open", open_weight)
        .withColumn("__rest", F.col("given") - spent)
        .withColumn(
            "__part",
            F.when(F.col("__full"), F.col("capacity")).otherwise(
                F.expr("CAST(CAST(weight AS DECIMAL(20,0)) * CAST(__rest AS DECIMAL(20,0)) DIV greatest(__open, 1) AS BIGINT)")
            ),
        )
    )
    lost = F.col("__rest") - F.coalesce(
        F.sum(F.when(~F.col("__full"), F.col("__part"))).over(family), F.lit(0)
    )
    rank = F.row_number().over(Window.partitionBy(*parents, "__full").orderBy(name))
    return (
        shared.withColumn("__lost", lost)
        .withColumn("budget", F.col("__part") + F.when(~F.col("__full") & (rank <= F.col("__lost")), 1).otherwise(0))
        .drop(*[f"__{c}" for c in ("ratio", "caps", "after", "full", "open", "rest", "part", "lost")])
    )


def leaf_budgets(
    leaves: DataFrame, levels: list[str], weights: list[Column], total: Column, max_epochs: int
) -> DataFrame:
    """Leaf table (levels, tokens) with `budget`, from the top level down.

    `weights[k]` is the weight of a node at level k, over the level columns;
    `total` is an expression over the column `tokens` of the whole corpus.
    """
    given = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).select(
        total.cast("long").alias("given")
    )
    plan = None
    for depth, weight in enumerate(weights):
        path = levels[: depth + 1]
        nodes = leaves.groupBy(*path).agg(F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumn("capacity", F.col("tokens") * max_epochs).withColumn("weight", weight.cast("long"))
        if plan is None:
            nodes = nodes.withColumn("given", given.scalar())
        else:
            nodes = nodes.join(plan, path[:-1])
        plan = share_out(nodes, path[:-1], path[-1]).select(
            *path, *([F.col("budget").alias("given")] if depth + 1 < len(levels) else ["tokens", "budget"])
        )
    return plan


def plan_mix(
    docs: DataFrame, levels: list[str], weights: list[Column], total: Column, max_epochs: int, seed: int,
    text: str = "text", id_col: str = "doc_id",
) -> DataFrame:
    """One row per leaf: budget, `epochs` (whole ones), `rest` (tokens of the
    prefix) and where the prefix ends: the order key of its last document and
    how many of its tokens are taken. As large as the tree, not the corpus."""
    sized = materialise(
        docs.select(
            *[F.coalesce(F.col(c).cast("string"), F.lit(NO_NAME)).alias(c) for c in levels],
            F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("__id"),
            F.xxhash64(text).alias("__h"),
            token_count(text).alias("__tokens"),
        ),
        "tokens",
    )
    leaves = materialise(sized.groupBy(*levels).agg(F.sum("__tokens").alias("tokens")), "leaves")
    plan = leaf_budgets(leaves, levels, weights, total, max_epochs)
    plan = plan.withColumn("epochs", F.expr("budget DIV greatest(tokens, 1)")).withColumn(
        "rest", F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(0)
    )
    before = Window.orderBy(*levels).rowsBetween(Window.unboundedPreceding, -1)  # rows of the tree
    plan = bounded(
        plan.withColumn("__base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    )
    # rows equal in id and text count as one place, so the order has no ties
    places = sized.groupBy(*levels, "__id", "__h").agg(F.sum("__tokens").alias("__tokens"))
    order = [*levels, "__order", "__id", "__h"]
    ranked = running_total(
        places.join(plan, levels).withColumn("__order", order_key(seed, F.col("epochs"), F.col("__id"))),
        order, "__tokens", "__upto",
    )
    start = F.col("__upto") - F.col("__tokens") - F.col("__base")
    ends = (
        ranked.where(start < F.col("rest"))
        .groupBy(*levels)
        .agg(
            F.max(F.struct("__order", "__id", "__h")).alias("__last"),
            F.max(F.col("__upto") - F.col("__base")).alias("__taken"),
        )
    )
    return plan.drop("__base").join(ends, levels, "left")


def order_key(seed: int, epoch: Column, doc: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), doc).cast("binary"))


OWN = ("__epoch", "__n_tokens", "__take_tokens")


def take(docs: DataFrame, plan: DataFrame, levels: list[str], seed: int, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents of a mix: their own columns and `__epoch`, `__n_tokens`,
    `__take_tokens` (which replace columns of these names), a row for each epoch.
    Each document is measured against
    its leaf's plan where it lies; texts are not shuffled when the plan fits."""
    mine = plan.select(
        *[F.col(c).alias(f"__leaf_{c}") for c in levels],
        F.col("epochs").alias("__epochs"), F.col("rest").alias("__rest"), "__last", "__taken",
    )
    mine = bounded(mine)
    doc = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    # the columns travel as one struct, so that none can clash with a name used here
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), doc.alias("__id"),
        F.xxhash64(text).alias("__h"), token_count(text).alias("__n_tokens"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(NO_NAME)).alias(f"__of_{c}") for c in levels],
    )
    same = [packed[f"__of_{c}"] == mine[f"__leaf_{c}"] for c in levels]
    key = F.struct(order_key(seed, F.col("__epochs"), F.col("__id")).alias("__order"), F.col("__id"), F.col("__h"))
    here = packed.join(mine, same).withColumn("__key", key)
    in_rest = (F.col("__rest") > 0) & (F.col("__key") <= F.col("__last"))
    last_cut = F.greatest(F.lit(0), F.col("__n_tokens") - (F.col("__taken") - F.col("__rest")))
    cut = F.when(F.col("__key") == F.col("__last"), last_cut).otherwise(F.col("__n_tokens"))
    whole = F.transform(
        F.when(F.col("__epochs") > 0, F.sequence(F.lit(0).cast("long"), F.col("__epochs") - 1)).otherwise(
            F.array().cast("array<bigint>")
        ),
        lambda e: F.struct(e.alias("e"), F.col("__n_tokens").alias("t")),
    )
    part = F.when(in_rest, F.array(F.struct(F.col("__epochs").alias("e"), cut.alias("t")))).otherwise(
        F.array().cast("array<struct<e:bigint,t:bigint>>")
    )
    return (
        here.withColumn("__one", F.explode(F.concat(whole, part)))
        .select(
            *[F.col(f"__row.`{c}`").alias(c) for c in docs.columns if c not in OWN],
            F.col("__one.e").alias("__epoch"), "__n_tokens", F.col("__one.t").alias("__take_tokens"),
        )
    )


def mix(
    docs: DataFrame, levels: list[str], weights: list[Column], total: Column, max_epochs: int, seed: int,
    text: str = "text", id_col: str = "doc_id",
) -> DataFrame:
    plan = plan_mix(docs, levels, weights, total, max_epochs, seed, text, id_col)
    return take(docs, plan, levels, seed, text, id_col)
