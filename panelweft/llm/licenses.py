"""Licence scan: passages against templates, then inheritance by directory.

Passages of a text are, after comment marks at line starts are taken off: every
sentence of a line with a licence word, every paragraph (between blank lines)
with one, and the whole text if it has one. So a wrapped header is compared as a
whole, and a licence file as one vector. Passages and templates are sparse TF-IDF
vectors, and each pair with a term in common has its cosine. Document frequencies
count the sentences of the whole corpus, copies included, and the templates; a
term that none of them has weighs most.

A file is a licence file if its whole text reaches MIN_FILE with a notice or a
whole licence, or its first paragraph with the title of a licence. Headers make
no licence file. It speaks for its directory. Any other file has the licence of
its best passage from MIN_COSINE on. A file without a licence of its own takes
that of the nearest directory above it that has one.

Null and empty texts have no passage and only inherit. Texts of any length are
read whole. Null ids and names are the name `-` in a path. Equal rows get equal
answers. Of equal scores the smaller licence counts; of two licence files in a
directory the better match, then the smaller path. An empty table gives an empty
result. Extra input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweft.llm.license_texts import TEMPLATES
from panelweft.llm.rules import BLANKS
from panelweft.scale import bounded, materialise

TRIGGER = (
    "licen[cs]e|copyright|rights reserved|spdx|permission[ \\t\\r\\n]+is[ \\t\\r\\n]+hereby[ \\t\\r\\n]+granted"
    "|redistribution[ \\t\\r\\n]+and[ \\t\\r\\n]+use|free[ \\t\\r\\n]+and[ \\t\\r\\n]+unencumbered"
)
MARKS = "(^|\\n)[ \\t\\r]*[#*/;%!<>-]*[ \\t\\r]*"
PARAGRAPH = "\\n\\n+"
SENTENCE_END = "\\n|(?<=[.!?])[ \\t]+"
TERM = "[a-z0-9]+(?:\\.[0-9]+)*"
MIN_COSINE = 0.6
MIN_FILE = 0.8


def says(text: Column) -> Column:
    """Whether there is a licence word."""
    return F.lower(text).rlike(TRIGGER)


def notices_of(text: Column) -> Column:
    """The sentences of lines with a licence word that have one, trimmed, in order."""
    lines = F.filter(F.split(text, "\n"), says)
    parts = F.flatten(F.transform(lines, lambda line: F.split(line, SENTENCE_END)))
    return F.transform(F.filter(parts, says), lambda x: F.btrim(x, F.lit(BLANKS)))


def paragraphs_of(text: Column) -> Column:
    return F.filter(F.split(text, PARAGRAPH), lambda x: F.btrim(x, F.lit(BLANKS)) != "")


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def score_passages(passages: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(key, body, n) -> key and the best (score, license) among all templates
    (`best`), among notices and whole licences (`as_file`) and among titles
    (`as_title`), null where none has a term in common. `n` says how often a
    sentence occurs; other passages have 0 and do not count in frequencies."""
    spark = passages.sparkSession
    known = spark.createDataFrame([(n, *t) for n, t in enumerate(templates)], "id int, name string, kind string, body string")
    ours = materialise(
        passages.select("key", "n", F.explode(terms(F.col("body"))).alias("term"))
        .groupBy("key", "term").agg(F.count(F.lit(1)).alias("tf"), F.first("n").alias("n")),
        "passage-terms",
    )
    theirs = (
        known.select("id", "name", "kind", F.explode(terms(F.col("body"))).alias("term"))
        .groupBy("id", "name", "kind", "term").agg(F.count(F.lit(1)).alias("tf"))
    )
    size = passages.agg((F.coalesce(F.sum("n"), F.lit(0)) + len(templates)).alias("N")).first()["N"]
    weight = lambda df: F.log((F.lit(size) + 1) / (df + 1)) + 1
    held = ours.where("n > 0").select("term", "n").unionByName(theirs.select("term", F.lit(1).cast("long").alias("n")))
    idf = bounded(held.groupBy("term").agg(weight(F.sum("n")).alias("idf")))
    weigh = lambda df: df.join(idf, "term", "left").withColumn(
        "w", F.col("tf") * F.coalesce("idf", weight(F.lit(0)))
    ).drop("idf", "tf")
    mine, theirs = materialise(weigh(ours).select("key", "term", "w"), "weighed"), weigh(theirs)
    length = lambda df, key: df.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    # the templates are a parameter of this function: some thousand terms
    small = F.broadcast(
        theirs.join(length(theirs, "id"), "id").select("id", "name", "kind", "term", (F.col("w") / F.col("norm")).alias("tw"))
    )
    dots = mine.join(small, "term").groupBy("key", "id", "name", "kind").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    scored = dots.join(length(mine, "key"), "key").withColumn(
        "__s", F.struct((-F.round(F.col("dot") / F.col("norm"), 6)).alias("score"), F.col("name").alias("license"))
    )
    of = lambda *kinds: F.min(F.when(F.col("kind").isin(*kinds), F.col("__s")))
    found = scored.groupBy("key").agg(
        of("notice", "header", "file").alias("best"), of("notice", "file").alias("as_file"), of("title").alias("as_title")
    )
    plus = lambda c: F.struct((-F.col(f"{c}.score")).alias("score"), F.col(f"{c}.license").alias("license"))
    return found.select("key", *[F.when(F.col(c).isNotNull(), plus(c)).alias(c) for c in ("best", "as_file", "as_title")])


def folder(path: Column) -> Column:
    """The directory of a path; '' for the root."""
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def folders_above(path: Column) -> Column:
    """A directory and all above it, as structs of depth and name, root first."""
    parts = F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(path, "/"))
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("dir")),
    )


def inherit(folders: DataFrame, speaking: DataFrame) -> DataFrame:
    """(dir) and (dir, license) -> dir, license, from_dir for the directories
    that have a licensed directory at or above them. Directories are resolved
    once each, however many files they hold."""
    above = folders.distinct().withColumn("__up", F.explode(folders_above(F.col("dir"))))
    held = speaking.select(F.col("dir").alias("__dir"), "license")
    near = F.max(F.struct(F.col("__up.depth"), F.col("__dir"), F.col("license")))
    return (
        above.join(held, F.col("__up.dir") == F.col("__dir"))
        .groupBy("dir").agg(near.alias("__n"))
        .select("dir", F.col("__n.license").alias("license"), F.col("__n.__dir").alias("from_dir"))
    )


def scan_licenses(
    files: DataFrame, path: Column, templates=TEMPLATES,
    min_cosine: float = MIN_COSINE, min_file: float = MIN_FILE, text: str = "text", id_col: str = "doc_id",
) -> DataFrame:
    """doc_id, path, n_notices, own_license, score, is_license_file, license,
    from_dir: one row per input row. `from_dir` is null unless inherited.

    Texts are read once; from then on passages, digests and paths move. Texts
    without a licence word have no passage. Equal passages are scored once.
    """
    bare = F.when(says(F.col(text)), F.regexp_replace(text, MARKS, "$1"))
    passage = lambda kind, n: lambda x: F.struct(
        F.lit(kind).alias("kind"), F.md5(x).alias("key"), x.alias("body"), F.lit(n).cast("long").alias("n")
    )
    # texts without passages have keys that match nothing, and are spread by them
    key = lambda x: F.coalesce(F.md5(x), F.concat(F.lit("-"), "path"))
    found = materialise(
        files.select(F.col(id_col).alias("doc_id"), path.alias("path"), F.md5(text).alias("__h"), bare.alias("__bare"))
        .withColumn("__notices", notices_of(F.col("__bare")))
        .withColumn("__paragraphs", paragraphs_of(F.col("__bare")))
        .select(
            "doc_id", "path", "__h", F.coalesce(F.size("__notices"), F.lit(0)).cast("long").alias("n_notices"),
            key("__bare").alias("__whole"), key(F.get("__paragraphs", F.lit(0))).alias("__title"),
            F.concat(
                F.transform("__notices", passage("sentence", 1)),
                F.transform(
                    F.filter("__paragraphs", lambda x, i: (i == 0) | says(x)), passage("paragraph", 0)
                ),
                F.transform(F.array("__bare"), passage("whole", 0)),
            ).alias("__passages"),
        ),
        "passages",
    )
    each = found.select("path", "__h", F.explode("__passages").alias("p")).select("path", "__h", "p.*")
    distinct = materialise(each.groupBy("key").agg(F.first("body").alias("body"), F.sum("n").alias("n")), "distinct-passages")
    known = bounded(
        score_passages(distinct, templates).where(
            (F.col("best.score") >= min_cosine) | (F.col("as_file.score") >= min_file) | (F.col("as_title.score") >= min_file)
        )
    )
    rank = lambda c: F.struct((-F.col(f"{c}.score")).alias("s"), F.col(f"{c}.license").alias("license"))
    own = (
        each.select("path", "__h", "key").distinct().join(known.select("key", "best"), "key")
        .where(F.col("best.score") >= min_cosine)
        .groupBy("path", "__h").agg(F.min(rank("best")).alias("b"))
    )
    files_like = lambda key, kind: known.where(F.col(f"{kind}.score") >= min_file).select(
        F.col("key").alias(key), rank(kind).alias(f"__{kind}")
    )
    decided = F.least("__as_file", "__as_title")
    files_with = materialise(
        found.drop("__passages").join(own, ["path", "__h"], "left")
        .join(files_like("__whole", "as_file"), "__whole", "left")
        .join(files_like("__title", "as_title"), "__title", "left")
        .withColumn("__file", decided).withColumn("__own", F.coalesce("__file", "b"))
        .select(
            "doc_id", "path", "n_notices", F.col("__own.license").alias("own_license"),
            (-F.col("__own.s")).alias("score"), F.col("__file").isNotNull().alias("is_license_file"),
            folder(F.col("path")).alias("dir"),
        ),
        "files",
    )
    pick = F.min(F.struct((-F.col("score")).alias("s"), F.col("path"), F.col("own_license")))
    speaking = (
        files_with.where("is_license_file").groupBy("dir").agg(pick.alias("p"))
        .select("dir", F.col("p.own_license").alias("license"))
    )
    given = bounded(inherit(files_with.select("dir"), speaking))
    return files_with.join(given, "dir", "left").select(
        "doc_id", "path", "n_notices", "own_license", "score", "is_license_file",
        F.coalesce("own_license", "license").alias("license"),
        F.when(F.col("own_license").isNull(), F.col("from_dir")).alias("from_dir"),
    )
