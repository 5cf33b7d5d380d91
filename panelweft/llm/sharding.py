"""Shards of equal bytes by histogram sort.

Rows are ordered by a key and cut into shards. The cuts are found without
sorting: each round counts the exact bytes between candidate boundaries of the
key, in all partitions at once, and only the interval that holds a cut's target
is divided again, until a boundary lies within the tolerance. Then the rows are
exchanged once, straight to the shard that the cuts name.

The key is a hash of the text, so copies lie side by side and share a shard
unless a group is too large for the tolerance; then, and only then, the cut
goes on inside the group by `doc_id`. Rows equal in text and id are never
parted. Null text is an empty one, a null id sorts first. An empty table has no
cuts. Extra input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweft.scale import materialise

KEY_BITS = 60
FIRST_DIGIT, DIGIT = 16, 11  # bits of the key that one round looks at
ROW_BYTES = 16
ROWS_PER_TASK = 4_000_000


def sized(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, and the sort key."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(body) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(body), 64 - KEY_BITS).alias("__key"),
    )


def _steps(bits: int, first: int) -> list[int]:
    """Shifts of one round after the other, down to 0."""
    shifts = [max(0, bits - first)]
    while shifts[-1]:
        shifts.append(max(0, shifts[-1] - DIGIT))
    return shifts


def find_cuts(rows: DataFrame, targets: list[tuple[int, int]], tie_bits: int) -> list[tuple[int, int]]:
    """For each (target, tolerance) in bytes the cut (key, tie): rows at or
    above it come after the cut.

    `rows` has __key, __tie (not negative) and size. A round brings one number
    per probed interval to the driver: at most 2**16 in the first, 2**11 per
    open cut after that, whatever the number of rows.
    """
    levels = [("__key", s) for s in _steps(KEY_BITS, FIRST_DIGIT)]
    levels += [("__tie", s) for s in _steps(tie_bits, DIGIT)]
    found: dict[int, tuple[int, int]] = {}
    # open cuts: (digits of the key, digits of the tie) so far, bytes below
    still: dict[int, tuple[int, int, int]] = {n: (0, 0, 0) for n in range(len(targets))}
    seen = {"__key": None, "__tie": None}  # shift that the digits so far refer to
    last = len(levels) - 1
    for n, (name, shift) in enumerate(levels):
        if not still:
            break
        inside = rows
        if name == "__tie":
            inside = inside.where(F.col("__key").isin(sorted({k for k, _, _ in still.values()})))
        if seen[name] is not None:
            part = {(t if name == "__tie" else k) for k, t, _ in still.values()}
            inside = inside.where(F.shiftright(name, seen[name]).isin(sorted(part)))
        key = F.col("__key") if name == "__tie" else F.lit(0)
        bins: dict[tuple[int, int], list[tuple[int, int]]] = {}
        up = 63 if seen[name] is None else seen[name] - shift
        for r in (
            inside.groupBy(key.alias("__k"), F.shiftright(name, shift).alias("__bin"))
            .agg(F.sum("size").alias("__bytes"))
            .collect()
        ):
            bins.setdefault((r["__k"], r["__bin"] >> up), []).append((r["__bin"], r["__bytes"]))
        for group in bins.values():
            group.sort()
        for cut, (k, t, below) in list(still.items()):
            target, tolerance = targets[cut]
            group = bins[(k, t)] if name == "__tie" else bins[(0, k)]
            for place, size in group:
                if target < below + size:
                    break
                below += size
            low, high = target - below, below + size - target
            edge = place if low <= high else place + 1
            if min(low, high) <= tolerance or n == last:
                at = edge << shift
                found[cut] = (at, 0) if name == "__key" else (k, at)
                del still[cut]
            else:
                still[cut] = (place, 0, below) if name == "__key" else (k, place, below)
        seen[name] = shift
    return [found[n] for n in range(len(targets))]


def part_of(cuts: list[tuple[int, int]], key: Column, tie: Column) -> Column:
    """How many cuts lie at or below a row, by binary search."""
    if not cuts:
        return F.lit(0)
    here = F.struct(key.alias("k"), tie.alias("t"))
    table = F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(t).cast("long").alias("t")) for k, t in cuts])
    steps = [1 << b for b in reversed(range(len(cuts).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(cuts)) & (F.get(table, at + step - 1) <= here), at + step
        ).otherwise(at),
    )


def shard_by_bytes(
    docs: DataFrame,
    shards: int,
    tolerance: float = 0.01,
    rows_per_task: int = ROWS_PER_TASK,
    text: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard.

    `tolerance` is how far a cut may lie from its target, as a share of a
    shard; where no boundary between two texts is that near, the nearest
    boundary between two rows is taken. Shards of more than `rows_per_task`
    rows are exchanged in several parts, cut in the same way, so no task ever
    holds a large shard; slots run on from part to part.
    """
    rows = materialise(sized(docs, text, id_col), "sizes")  # texts are read once
    facts = rows.agg(
        F.sum("size").alias("size"),
        F.count(F.lit(1)).alias("n"),
        F.min("doc_id").alias("low"),
        F.max("doc_id").alias("high"),
    ).first()
    low = facts["low"] or 0
    tie_bits = max(1, ((facts["high"] or 0) - low + 1).bit_length())
    rows = rows.withColumn("__tie", F.coalesce(F.col("doc_id") - F.lit(low) + 1, F.lit(0)).cast("long"))
    parts = max(1, -(-facts["n"] // (shards * rows_per_task)))
    share = (facts["size"] or 0) / (shards * parts)
    targets = [
        (int(share * n), int(tolerance * share * parts) if n % parts == 0 else int(share / 4))
        for n in range(1, shards * parts)
    ]
    cuts = find_cuts(rows, targets, tie_bits) if facts["n"] else []
    placed = rows.withColumn("__part", part_of(cuts, F.col("__key"), F.col("__tie")))
    start: Column = F.lit(0).cast("long")
    if parts > 1:
        held = {r[0]: r[1] for r in placed.groupBy("__part").count().collect()}
        starts, shift = [], 0
        for n in range(shards * parts):
            shift = shift if n % parts else 0
            starts.append(shift)
            shift += held.get(n, 0)
        start = F.get(F.array(*[F.lit(s).cast("long") for s in starts]), F.col("__part"))
    return (
        placed.repartitionById(shards * parts, F.col("__part"))
        .sortWithinPartitions("__key", "__tie")
        .withColumn("__place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            F.floor(F.col("__part") / parts).cast("int").alias("shard"),
            (start + F.col("__place")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
