"""Quality by compression: which of two dictionaries packs a text better.

One Zstandard dictionary is trained from texts labelled good, one from texts
labelled bad. A text is compressed with each, block by block, and the
difference of the two sizes, divided by the length of the text, becomes a
probability by logistic calibration.

Only labelled rows whose crc32 of the id leaves a remainder other than 0 modulo
5 are learned from: remainders 1 and 2 feed the dictionaries (a sample bounded
by `sample_docs` and `sample_blocks`), 3 and 4 the calibration (all of them).
Scores read the text and nothing else, and all of it.

Null and empty texts have a difference of 0 and the score that goes with it. A
label without a document, a null label or a null id teaches nothing; a document
labelled twice teaches twice. If a class has no sample, every difference is 0
and the score is the smoothed share of good labels. Repeated rows get equal
scores. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweft.scale import bounded

FOLDS = 5
SAMPLE_DOCS = 2000  # of each class, in the order of a hash
SAMPLE_BLOCKS = 4  # of each of these documents, spread over it
SAMPLE_BLOCK = 1024
DICTIONARY = 1 << 16
BLOCK = 4096
LEVEL = 3
THRESHOLD = 0.3


def fold(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % FOLDS


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float


def _spread(text: bytes, most: int) -> list[bytes]:
    """So many blocks at most, spread evenly over a text."""
    starts = range(0, max(1, len(text)), SAMPLE_BLOCK)
    step = max(1, -(-len(starts) // most))
    return [text[s : s + SAMPLE_BLOCK] for s in starts[::step]]


def _sample(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = [_spread(t.as_py().encode(), most) for t in batch.column("__text")]
            yield pa.record_batch(
                [batch.column("__order"), pa.array(blocks, pa.list_(pa.binary()))], names=["__order", "blocks"]
            )

    return run


def first_by(rows: DataFrame, order: str, n: int) -> DataFrame:
    """The rows with the n least values of a 64-bit hash, and those with the same
    first 32 bits as the last of them. Two rounds count the hashes by 16 more
    bits, so that nothing but 65,536 counts comes to the driver at a time."""
    parent, left = None, n
    for shift in (48, 32):
        some = rows if parent is None else rows.where(F.shiftright(order, 48) == parent)
        counts = some.groupBy(F.shiftright(order, shift).alias("b")).agg(F.count(F.lit(1)).alias("n")).orderBy("b").collect()
        if parent is None and sum(r["n"] for r in counts) <= n:
            return rows
        for r in counts:
            parent, left = r["b"], left - r["n"]
            if left <= 0:
                left += r["n"]  # still wanted from this bucket
                break
    return rows.where(F.shiftright(order, 32) <= parent)


def train_dictionary(
    labelled: DataFrame, quality: int, sample_docs: int = SAMPLE_DOCS, sample_blocks: int = SAMPLE_BLOCKS
) -> bytes:
    """A dictionary from a bounded sample: the first documents in hash order."""
    import zstandard

    wanted = labelled.where((F.col("quality") == quality) & F.col("__fold").isin(1, 2) & (F.col("__text") != "")).select(
        F.xxhash64("__id", "__text").alias("__order"), "__text"
    )
    rows = (
        first_by(wanted, "__order", sample_docs)
        .mapInArrow(_sample(sample_blocks), "__order long, blocks array<binary>")
        .orderBy("__order")
        .limit(sample_docs)
        .collect()
    )
    blocks = [bytes(b) for r in rows for b in r["blocks"]]
    try:
        return zstandard.train_dictionary(DICTIONARY, blocks).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself
        return b"\n".join(blocks)[:DICTIONARY]


def _differences(good: bytes, bad: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        def packer(content: bytes):
            table = zstandard.ZstdCompressionDict(content)
            table.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(
                level=LEVEL, dict_data=table, write_checksum=False, write_content_size=False, write_dict_id=False
            )

        sides = (packer(good), packer(bad)) if good and bad else ()
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for i, text in enumerate(batch.column("__text")):
                body = text.as_buffer() if text.is_valid else b""
                if not sides or not len(body):
                    continue
                view = memoryview(body)
                less = 0
                for at in range(0, len(view), BLOCK):
                    block = view[at : at + BLOCK]
                    less += len(sides[1].compress(block)) - len(sides[0].compress(block))
                out[i] = less / len(view)
            rest = [batch.column(n) for n in batch.schema.names if n != "__text"]
            names = [n for n in batch.schema.names if n != "__text"]
            yield pa.record_batch([*rest, pa.array(out)], names=[*names, "__x"])

    return run


def differences(rows: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    """Replaces `__text` by `__x`, the difference of sizes per byte."""
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text"]
    return rows.mapInArrow(_differences(good, bad), ", ".join([*kept, "__x double"]))


def calibrate(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of y over x, with weights n; one
    made-up label of each class keeps them finite."""
    spread = float(np.sqrt(np.average(x**2, weights=n))) if len(x) else 0.0
    z = np.concatenate([x / spread if spread else x * 0, [0.0, 0.0]])
    y, n = np.concatenate([y, [0.0, 1.0]]), np.concatenate([n, [1.0, 1.0]])
    beta = np.zeros(2)
    design = np.stack([z, np.ones_like(z)], axis=1)
    ridge = np.diag([1e-3, 1e-9])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (n * (y - p)) - ridge @ beta
        bend = (design * (n * p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(bend, slope)
        beta += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return (float(beta[0] / spread) if spread else 0.0), float(beta[1])


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id",
    sample_docs: int = SAMPLE_DOCS, sample_blocks: int = SAMPLE_BLOCKS,
) -> Model:
    """Both dictionaries and the calibration, from labelled training rows.

    The calibration gathers counts by difference rounded to 1e-4: some 10,000
    numbers at most, from all its rows.
    """
    known = bounded(
        labels.select(F.col(id_col).alias("__id"), "quality")
        .where(F.col("quality").isin(0, 1) & F.col("__id").isNotNull() & (fold(F.col("__id")) != 0))
    )
    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    labelled = texts.join(known, "__id").withColumn("__fold", fold(F.col("__id")))
    good, bad = (train_dictionary(labelled, q, sample_docs, sample_blocks) for q in (1, 0))
    counts = (
        differences(labelled.where(F.col("__fold").isin(3, 4)).select("quality", "__text"), good, bad)
        .groupBy(F.round("__x", 4).alias("x"), "quality")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("x", "quality")
        .collect()
    )
    slope, offset = calibrate(*(np.array([float(r[c]) for r in counts]) for c in ("x", "quality", "n")))
    return Model(good, bad, slope, offset)


def score(docs: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, score: one row per input row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("__text"))
    logit = F.col("__x") * F.lit(model.slope) + F.lit(model.offset)
    return differences(rows, model.good, model.bad).select(
        "doc_id", (F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))).alias("score")
    )


def quality_scores(
    docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_blocks: int = SAMPLE_BLOCKS
) -> DataFrame:
    """The contract's digest."""
    model = fit(docs, labels, sample_docs=sample_docs, sample_blocks=sample_blocks)
    return score(docs, model).select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
