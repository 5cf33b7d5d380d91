"""Input files checked against a manifest of checksums.

Files of any size: those up to `WHOLE` bytes are read as rows by Spark's own reader,
from any store it can open. Larger ones are listed, cut into byte ranges and read
piece by piece in the workers, from stores that pyarrow opens (paths on shared
disks, s3, gs, hdfs). Each file has two digests: its md5, which one task streams
through in constant memory, and the md5 of the hexadecimal md5 digests of its parts
of `part` bytes one after another, which many tasks work out together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweft.scale import listed_files

WHOLE = 256 << 20
PART = 64 << 20
STEP = 4 << 20  # bytes read at once


class InputsNotReady(Exception):
    """Some inputs are missing or differ; the message lists them all."""


def _range_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """md5 of byte ranges (path, begin, length), read step by step."""
    from pyarrow import fs

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            store, path = fs.FileSystem.from_uri(row["path"])
            digest, left = hashlib.md5(), row["length"]
            with store.open_input_file(path) as file:
                file.seek(row["begin"])
                while left:
                    some = file.read(min(STEP, left))
                    if not some:
                        raise OSError(f"{row['path']} ends early")
                    digest.update(some)
                    left -= len(some)
            out.append(digest.hexdigest())
        yield pa.record_batch(
            [batch.column("path"), batch.column("begin"), batch.column("length"), pa.array(out, pa.string())],
            names=["path", "begin", "length", "md5"],
        )


def _digests(ranges: DataFrame, tasks: int) -> DataFrame:
    return ranges.repartition(max(1, tasks), "path", "begin").mapInArrow(
        _range_digests, "path string, begin long, length long, md5 string"
    )


def file_digests(spark: SparkSession, folder: str, whole: int = WHOLE, part: int = PART) -> DataFrame:
    """(path relative to the folder, bytes, md5, tree) of every file below it. The
    driver lists names and sizes."""
    root = folder.rstrip("/")
    relative = F.substring_index(F.col("path"), root + "/", -1).alias("path")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    small = files.where(F.col("length") <= whole).select("path", "length", "content")
    begins = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("length") / part), F.lit(1)) - 1)
    each = F.transform(begins, lambda i: F.md5(F.substring("content", (i * part + 1).cast("int"), F.lit(part))))
    out = small.select(relative, F.col("length").alias("bytes"), F.md5("content").alias("md5"), F.md5(F.array_join(each, "").cast("binary")).alias("tree"))
    listing = listed_files(spark, root)
    empty = [path for path, size in listing if not size]  # Spark's reader leaves these out
    if empty:
        nothing = hashlib.md5().hexdigest()
        sums = (0, nothing, hashlib.md5(nothing.encode()).hexdigest())
        rows = spark.createDataFrame([(path, *sums) for path in empty], "path string, bytes long, md5 string, tree string")
        out = out.unionByName(rows.withColumn("path", relative))
    large = [(path, size) for path, size in listing if size > whole]
    if not large:
        return out
    listed = spark.createDataFrame(large, "path string, bytes long")
    plain = _digests(listed.select("path", F.lit(0).cast("long").alias("begin"), F.col("bytes").alias("length")), len(large))
    begins = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(part).cast("long"))).alias("begin")
    ranges = listed.select("path", "bytes", begins).select("path", "begin", F.least(F.lit(part), F.col("bytes") - F.col("begin")).cast("long").alias("length"))
    n_parts = sum(-(-size // part) for _, size in large)
    parts = _digests(ranges, n_parts).groupBy("path").agg(F.sort_array(F.collect_list(F.struct("begin", "md5"))).alias("at"))
    tree = parts.select("path", F.md5(F.array_join("at.md5", "").cast("binary")).alias("tree"))
    big = plain.select("path", F.col("length").alias("bytes"), "md5").join(tree, "path")
    return out.unionByName(big.select(relative, "bytes", "md5", "tree"))


def verify_inputs(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """(path, status) for every manifest entry (path, md5, fetch): ok,
    mismatch, or missing with the way the file is obtained."""
    found = files.select("path", F.col("md5").alias("__found"))
    how = F.coalesce(F.col("fetch"), F.lit("auto"))
    status = (
        F.when(F.col("__found").isNull(), F.concat(F.lit("missing ("), how, F.lit(")")))
        .when(F.col("__found") != F.col("md5"), "mismatch")
        .otherwise("ok")
    )
    return manifest.join(found, "path", "left").select("path", status.alias("status"))


def require_inputs(status: DataFrame) -> None:
    """Print the whole summary, one entry at a time, then raise if anything is
    not ok."""
    bad = []
    for r in status.orderBy("path").toLocalIterator():
        print(f"{r['path']:<52} {r['status']}")
        if r["status"] != "ok":
            bad.append(f"{r['path']}: {r['status']}")
    if bad:
        raise InputsNotReady("; ".join(bad))
