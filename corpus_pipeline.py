"""From raw documents to token ids in five stages.

Every stage is a function of the session, the documents that the stage before
it kept, and the folder of the tables. All but the last return the columns of
documents; each result is written to the shared folder and read again.

In all stages: null and empty texts have no words, so the rules reject them, and a
stage that meets them all the same keeps them as they are (near dedup as one text).
Texts of any length are read whole. Null ids come last where ids decide. Rows equal
in id and text are one document, of which near dedup keeps one row; mixing may
give a document more than once. An empty table stays empty. Further columns pass
through, whatever their names; the last stage replaces columns named token_ids and
round_trip. Ids are whole numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweft.llm import line_dedup, mixing, near_dedup, pieces, queries, rules
from panelweft.scale import materialise

POLICY = "v2"
MAX_EPOCHS, SEED = 2, 17


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule of the policy rejects go."""
    return rules.keep_passing(docs, POLICY)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of two lines or more go, and documents that had nothing
    else. Single long lines stay: without them a near copy would be no more than
    what it does not share, which the next stage cannot tell."""
    return line_dedup.dedup_lines(docs, long=None).where("text <> ''")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, shared out by weight; a document comes
    once for each epoch that takes it, the last one of a prefix as a whole."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc")
    packed = queries.with_domain(docs.select(whole, "doc_id", "text", "lang", "source"))
    mixed = mixing.mix(packed, queries.LEVELS, queries.weights(), F.col("tokens"), MAX_EPOCHS, SEED)
    return mixed.select(*[F.col(f"__doc.`{c}`").alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids beside the columns of documents, and whether decoding them
    gives the text again."""
    coded = pieces.encode(docs, queries.MODEL_PATH)
    return coded.select(
        *[F.col(f"__row.`{c}`").alias(c) for c in docs.columns if c not in ("token_ids", "round_trip")],
        F.col("__ids").alias("token_ids"),
        F.col("__round_trip").alias("round_trip"),
    )


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near dedup", near_copies),
    ("mixing", mix),
    ("pieces", encode),
]

#: Near dedup cannot be put in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{n}")
    return docs
