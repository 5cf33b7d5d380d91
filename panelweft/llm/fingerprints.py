"""Bottom-k sketches of five-word shingles.

A sketch is the sorted array of the k smallest distinct 64-bit hashes of a
text's shingles. Sketches of parts merge into the sketch of the whole; two of
them estimate resemblance, containment and the number of distinct shingles.
While a text has fewer than k shingles everything is exact.

A text of one to four words is one shingle; an empty or null text has an empty
sketch. Two empty sketches resemble each other wholly, an empty and another not
at all. Equal texts have equal sketches. Texts of any length are read whole. Rows
without an id come first, rows with the same id are ordered by text, and rows
equal in both are one document repeated, each of them next to the other. An empty
table gives an empty result. Extra input columns are ignored. Ids are whole numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweft.llm.rules import words_of
from panelweft.scale import bounded, materialise, running_total

K = 128
SHINGLE = 5
PER_BUCKET = 256


def smallest(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(words: Column, k: int = K) -> Column:
    """The sketch of an array of words."""
    size = F.size(words)
    long = F.transform(
        F.sequence(F.lit(0), size - SHINGLE),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE)]),
    )
    none = F.array().cast("array<bigint>")
    short = F.when(size > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(none)
    return smallest(F.when(size >= SHINGLE, long).otherwise(short), k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union, given the sketches of two parts."""
    return smallest(F.concat(a, b), k)


def _pool(a: Column, b: Column, k: int) -> Column:
    """The hashes that stand for the union: all of them if both are whole."""
    whole = (F.size(a) < k) & (F.size(b) < k)
    return F.slice(F.sort_array(F.array_union(a, b)), F.lit(1), F.when(whole, 2 * k).otherwise(k))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness of the shingle sets."""
    pool = _pool(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(pool, a), b))
    return F.when(F.size(pool) == 0, 1.0).otherwise(both / F.greatest(F.size(pool), F.lit(1)))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    top = (F.get(a, F.lit(k - 1)).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / top)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds; 1 for an empty a."""
    shared = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    held = F.least(F.lit(1.0), shared / F.greatest(distinct_count(a, k), F.lit(1.0)))
    return F.when(F.size(a) == 0, 1.0).otherwise(held)


def as_text(a: Column) -> Column:
    """Sixteen hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def sketches(docs: DataFrame, k: int = K, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, sketch: one row per input row, no shuffle."""
    return docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text)).alias("__words")).select(
        "doc_id", sketch(F.col("__words"), k).alias("sketch")
    )


def merge_parts(parts: DataFrame, by: str, k: int = K) -> DataFrame:
    """Sketches of wholes from rows of (by, sketch), however many parts each
    whole has: only hashes are shuffled, and each task keeps k per whole."""
    return (
        parts.select(by, F.explode("sketch").alias("__h"))
        .distinct()
        .withColumn("__salt", F.pmod(F.col("__h"), F.lit(64)))
        .groupBy(by, "__salt")
        .agg(smallest(F.collect_set("__h"), k).alias("__some"))
        .groupBy(by)
        .agg(smallest(F.flatten(F.collect_list("__some")), k).alias("sketch"))
    )


def in_cells(keys: DataFrame, per_cell: int = PER_BUCKET) -> list[DataFrame]:
    """How to cut the order of (__id, __h) into cells of about `per_cell` rows: a
    list of tables for `to_cell`, each cutting the crowded cells of those before.

    A crowded cell is one of four times as many rows. It is cut evenly between its
    own least and greatest id, or hash where it has only one id. As these fall into
    different parts, every round gets nearer, whatever gaps the ids have; even ids
    take one round. Only equal rows stay together.
    """
    cuts: list[DataFrame] = []
    cells = keys.withColumn("__cell", F.array().cast("array<bigint>"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    while True:
        sizes = cells.groupBy("__cell").agg(
            F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{n}{c}") for c in ("__id", "__h") for n, f in (("low", F.min), ("high", F.max))]
        )
        by_id = F.col("low__id") < F.col("high__id")
        low, high = (F.when(by_id, wide(f"{n}__id")).otherwise(wide(f"{n}__h")) for n in ("low", "high"))
        crowded = sizes.where((F.col("n") > 4 * per_cell) & (by_id | (F.col("low__h") < F.col("high__h")))).select(
            "__cell", by_id.alias("__by_id"), low.alias("__low"),
            F.greatest(F.lit(1), F.floor(F.lit(per_cell) * (high - low + 1) / F.col("n"))).cast("decimal(20,0)").alias("__width"),
        )
        crowded = materialise(crowded, "crowded-cells")
        if crowded.isEmpty():
            return cuts
        cuts.append(crowded)
        cells = to_cell(cells, crowded)


def to_cell(rows: DataFrame, crowded: DataFrame) -> DataFrame:
    """Rows of crowded cells go on to a part of them."""
    at = F.when(F.col("__by_id"), F.col("__id")).otherwise(F.col("__h")).cast("decimal(20,0)") - F.col("__low")
    part = F.floor(at / F.col("__width")).cast("long")
    found = rows.join(bounded(crowded), "__cell", "left")
    cell = F.when(F.col("__low").isNull(), F.col("__cell")).otherwise(F.concat("__cell", F.array(part)))
    return found.withColumn("__cell", cell).drop("__by_id", "__low", "__width")


def with_next(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, __text, __next (text of the next document by id; after the last
    comes the first), and sketches of both.

    Documents go once to cells of neighbouring ids, about 256 in each. The
    first document of a cell is also sent to the cell before, so that its
    last document finds its neighbour. Order among equal ids: by text hash.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), body.alias("__text")).withColumns({
        "__h": F.xxhash64("__text"), "__id": F.coalesce("doc_id", F.lit(-(1 << 63))),
    })
    slim = materialise(base.select("__id", "__h"), "order-keys")
    cuts = in_cells(slim)
    base, slim = (df.withColumn("__cell", F.array().cast("array<bigint>")) for df in (base, slim))
    for crowded in cuts:
        base, slim = to_cell(base, crowded), to_cell(slim, crowded)
    keys = ["__cell"]
    firsts = slim.groupBy(*keys).agg(F.min(F.struct("__id", "__h")).alias("__first"))
    order = running_total(firsts.withColumn("__one", F.lit(1)), keys, "__one", "__rank")
    n = order.agg(F.max("__rank")).first()[0] or 0
    before = order.select(
        *[F.col(c).alias(f"__before{c}") for c in keys],
        (F.col("__rank") % F.lit(max(1, n)) + 1).alias("__rank"),
    )
    halo = bounded(
        order.join(before, "__rank").select(
            *keys, F.col("__first.__id").alias("__id"), F.col("__first.__h").alias("__h"),
            *[f"__before{c}" for c in keys],
        )
    )
    own = F.struct(*[F.col(c) for c in keys], F.lit(0).alias("__late"))
    other = F.struct(*[F.col(f"__before{c}").alias(c) for c in keys], F.lit(1).alias("__late"))
    sent = (
        base.join(halo, [*keys, "__id", "__h"], "left")
        .withColumn("__to", F.explode(F.when(F.col("__before__cell").isNull(), F.array(own)).otherwise(F.array(own, other))))
        .select("doc_id", "__text", "__h", "__id", F.col("__to.*"))
    )
    line = Window.partitionBy(*keys).orderBy("__late", "__id", "__h")
    return (
        sent.repartition(*keys)
        .withColumn("__words", words_of(F.col("__text")))
        .withColumn("__sketch", sketch(F.col("__words")))
        .drop("__words")
        .withColumn("__next", F.lead("__text").over(line))
        .withColumn("__next_sketch", F.lead("__sketch").over(line))
        .where("__late = 0")
        .select("doc_id", "__text", "__next", "__sketch", "__next_sketch")
    )


def document_fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """The contract's digest: each text, the text edited with its neighbour's
    beginning, and how alike their fingerprints are."""
    size, half = F.length("__text"), F.floor(F.length("__text") / 2).cast("int")
    pairs = with_next(docs).withColumn(
        "__edited",
        F.concat(
            F.substring("__text", F.lit(1), size - half), F.substring("__next", F.lit(1), half)
        ),
    )
    done = pairs.withColumn("__edited_words", words_of(F.col("__edited"))).select(
        "doc_id",
        size.cast("long").alias("n_chars"),
        F.sha2(F.col("__edited").cast("binary"), 256).alias("edited_sha256"),
        "__sketch",
        "__next_sketch",
        sketch(F.col("__edited_words"), k).alias("__edited_sketch"),
    )
    mine, edited, following = (F.col(c) for c in ("__sketch", "__edited_sketch", "__next_sketch"))
    return done.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(mine).alias("fingerprint"),
        as_text(edited).alias("edited_fingerprint"),
        resemblance(mine, edited, k).alias("near_edited"),
        resemblance(mine, following, k).alias("near_next"),
        containment(mine, edited, k).alias("held_by_edited"),
        distinct_count(mine, k).alias("n_shingles"),
    )
