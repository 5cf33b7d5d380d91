"""Line dedup over content-defined chunks of lines.

A text is cut into chunks of whole lines. A line ends a chunk if the rolling hash of
it and the line before is divisible by `average` and that of the two lines before it
is not; neither leaves a single line at either end of the text. A line of `long`
bytes or more is a chunk of its own. So a boundary depends on three lines before it
and one behind it: what stands elsewhere shifts no boundary, and no state is carried
along. Chunks of two lines or more and long lines that occur again anywhere are
removed, except their first occurrence (smallest id, then text hash, then place).
Hashes only find candidates: a chunk goes only if its bytes equal those of an earlier
one. Short single lines stay, whatever stands around them; without `long` so do long
ones.

Null texts stay null, empty ones empty; neither has a chunk. Null ids come
last in the order. Rows equal in id and text are one document: they lose the
same chunks, and none on account of each other. A document that loses all its
lines keeps an empty text. An empty table gives an empty result. Other columns
pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweft.scale import bounded, materialise

AVERAGE = 3  # one of so many lines may end a chunk
LONG = 150  # bytes of a line that is a chunk of its own: about 25 words
OFTEN = 10_000  # occurrences of a chunk that are not sent to one task
PART = 256  # documents whose chunks a worker holds at once
BASE, PRIME = 1_000_003, (1 << 31) - 1


def line_hash(line: bytes) -> int:
    return int.from_bytes(hashlib.md5(line).digest()[:4], "big") % PRIME


def chunks_of(text: bytes, average: int = AVERAGE, long: int | None = LONG) -> list[tuple[int, int, int, int]]:
    """(place, lines, start, size) of each chunk of a text. The chunks, joined
    by line feeds, are the text."""
    found, begin, at, lines, before, may = [], 0, 0, 0, 0, False
    parts = text.split(b"\n")
    large = [long is not None and len(x) >= long for x in parts]
    for n, line in enumerate(parts, 1):
        here = line_hash(line)
        rolling, before = (before * BASE + here) % PRIME, here
        lines += 1
        at += len(line) + 1
        might, may = may, rolling % average == 0 and 2 <= n <= len(parts) - 2
        if n < len(parts) and (large[n - 1] or large[n] or may and not might):
            found.append((len(found), lines, begin, at - 1 - begin))
            begin, lines = at, 0
    found.append((len(found), lines, begin, len(text) - begin))
    return found


def _candidates(average: int, long: int | None, digest_bytes: int, bodies: bool):
    """Per document the chunks of two lines or more and the long lines, with their
    bytes if asked for; these are sliced from the Arrow buffer, one document at a
    time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([
            ("__id", pa.int64()), ("__h", pa.int64()), ("place", pa.int32()), ("digest", pa.binary()),
            *([("body", pa.binary())] if bodies else []),
        ])
        for batch in batches:
            for at in range(0, batch.num_rows, PART):
                part, rows = batch.slice(at, PART), []
                ids, hashes, texts = part.columns
                for i in range(part.num_rows):
                    if not texts[i].is_valid or not (body := texts[i].as_buffer().to_pybytes()):
                        continue
                    for place, lines, start, size in chunks_of(body, average, long):
                        if lines > 1 or (long is not None and size >= long):
                            chunk = body[start : start + size]
                            digest = hashlib.md5(chunk).digest()[:digest_bytes]
                            row = (ids[i].as_py(), hashes[i].as_py(), place, digest)
                            rows.append((*row, chunk) if bodies else row)
                cols = list(zip(*rows)) if rows else [[]] * len(kind)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, kind)], kind)

    return run


def _cut(average: int, long: int | None):
    """Removes the named chunks from a text. Two neighbours that stay are
    joined by the line feed that stood between them or their lost ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lost = batch.column("__text"), batch.column("__lost")
            kept, n_lines, n_lost = [], [], []
            for text, gone in zip(texts, lost.to_pylist()):
                if not text.is_valid:
                    kept.append(None), n_lines.append(0), n_lost.append(0)
                    continue
                body = text.as_buffer().to_pybytes()
                if not gone:
                    kept.append(body), n_lines.append(body.count(b"\n") + 1), n_lost.append(0)
                    continue
                gone, stay, total, less = set(gone), [], 0, 0
                for place, lines, start, size in chunks_of(body, average, long):
                    total += lines
                    if place in gone:
                        less += lines
                    else:
                        stay.append(body[start : start + size])
                kept.append(b"\n".join(stay)), n_lines.append(total), n_lost.append(less)
            out = {n: batch.column(n) for n in batch.schema.names if n not in ("__text", "__lost")}
            out |= {
                "__kept": pa.array(kept, pa.binary()).cast(pa.string()),
                "__lines": pa.array(n_lines, pa.int64()), "__lost_lines": pa.array(n_lost, pa.int64()),
            }
            yield pa.record_batch(list(out.values()), names=list(out))

    return run


def repeated_chunks(
    docs: DataFrame, average: int = AVERAGE, long: int | None = LONG, text: str = "text", id_col: str = "doc_id",
    digest_bytes: int = 16,
) -> DataFrame:
    """(__id, __h, lost): for each document that has any, the places of the
    chunks that occurred before. The bytes of a chunk are shuffled once, after equal
    ones of a task have become one; where a digest turns out to stand for one chunk
    only, its occurrences are told by the digest from then on. Digests that stand
    for several chunks are joined with the bytes. All joins are the same at every
    size, but for chunks that occur very often: those are a measured lookup, so that
    their occurrences meet no common task."""
    base = docs.select(
        F.coalesce(F.col(id_col), F.lit((1 << 63) - 1)).cast("long").alias("__id"),
        F.xxhash64(text).alias("__h"), F.col(text).alias("__text"),
    )
    kind = "__id long, __h long, place int, digest binary"
    chunks = materialise(base.mapInArrow(_candidates(average, long, digest_bytes, False), kind), "chunks")
    whole = base.mapInArrow(_candidates(average, long, digest_bytes, True), f"{kind}, body binary")
    where = F.struct("__id", "__h", "place")
    # rows equal in id, text and place are one occurrence
    compared = whole.groupBy("digest", "body").agg(
        F.min(where).alias("first"), F.max(where).alias("last"), F.count(F.lit(1)).alias("n")
    )
    repeated = materialise(
        compared.groupBy("digest").agg(
            F.count(F.lit(1)).alias("bodies"), F.min("first").alias("first"), F.max("last").alias("last"),
            F.sum("n").alias("n"),
        )
        .where("first < last"),
        "repeated",
    )
    one = repeated.where("bodies = 1").select("digest", "first", "n")
    often = bounded(one.where(F.col("n") >= OFTEN).select("digest", "first"))
    later = (
        chunks.join(often, "digest", "left_anti")
        .join(one.where(F.col("n") < OFTEN).select("digest", "first").hint("merge"), "digest")
        .unionByName(chunks.join(often, "digest"))
    )
    several = repeated.where("bodies > 1").select("digest")
    if not several.isEmpty():
        again = materialise(whole.join(bounded(several), "digest"), "several")
        first = again.groupBy("digest", "body").agg(F.min(where).alias("first"))
        later = later.unionByName(again.join(first, ["digest", "body"]).drop("body"))
    later = later.where(where > F.col("first"))
    return later.groupBy("__id", "__h").agg(F.collect_set("place").alias("lost"))


def remove_chunks(
    docs: DataFrame, lost: DataFrame, average: int = AVERAGE, long: int | None = LONG, text: str = "text", id_col: str = "doc_id",
    lookup=bounded,
) -> DataFrame:
    """All columns of `docs` as a struct `__row`, with `__kept` (the text
    without its repeated chunks), `__lines` and `__lost_lines`."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("__row"),
        F.col(text).alias("__text"),
        F.coalesce(F.col(id_col), F.lit((1 << 63) - 1)).cast("long").alias("__id"),
        F.xxhash64(text).alias("__h"),
    )
    marked = rows.join(lookup(lost), ["__id", "__h"], "left").select("__row", "__text", F.col("lost").alias("__lost"))
    kind = T.StructType([
        marked.schema["__row"], T.StructField("__kept", T.StringType()),
        T.StructField("__lines", T.LongType()), T.StructField("__lost_lines", T.LongType()),
    ])
    return marked.mapInArrow(_cut(average, long), kind)


def dedup_lines(
    docs: DataFrame, average: int = AVERAGE, long: int | None = LONG, text: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """The documents with their columns, texts without repeated chunks, and
    `n_chars` (where there is such a column) counted anew."""
    lost = repeated_chunks(docs, average, long, text, id_col)
    cut = remove_chunks(docs, lost, average, long, text, id_col)

    def column(c: str) -> Column:
        if c == text:
            return F.col("__kept").alias(c)
        if c == "n_chars":
            return F.length("__kept").cast(docs.schema[c].dataType).alias(c)
        return F.col(f"__row.`{c}`").alias(c)

    return cut.select(*[column(c) for c in docs.columns])


def line_dedup(docs: DataFrame, average: int = AVERAGE, long: int | None = LONG) -> DataFrame:
    """Digest for the query: each document's cleaned text and what it lost. So many
    documents hold a repeated line that the table of them is no lookup: texts are
    joined with it in the same way at every size."""
    lost = repeated_chunks(docs, average, long)
    cut = remove_chunks(docs, lost, average, long, lookup=lambda df: df.hint("merge"))
    return cut.select(
        F.col("__row.doc_id").alias("doc_id"), F.col("__kept").alias("text"),
        F.col("__lines").alias("n_lines"), F.col("__lost_lines").alias("n_lost_lines"),
    )
