"""Near-duplicate detection by order MinHash.

A text's k-mers are its runs of five words, each labelled with how often the
same run occurred before; of a stretch that goes on repeating one to five words
only the first of its rounds has k-mers, or a long filler would be all that a
sketch holds. For each of several seeded orders a sketch slot takes
the two least k-mers and keeps them in the order of the text; two texts are
candidates if a slot is equal. Candidates are aligned word by word in a band:
two texts are linked if 1 - edits / words of the longer is 0.8 or more. One kind
of pair is exempt: texts that share little but a filler repeated many times. It
is told by the words outside of all runs that repeat in both texts: if not even
half of those of the text that has fewer lie in the other's too, the pair is not
linked. Pairs without a run that repeats in both are never exempt.

Copies are one text from the start. In each bucket of equal slots all texts
are aligned with the least one, and in a few more rounds those that are still
apart from it with another member of its component; what that connects needs no
more work. Then every pair of a bucket whose texts are still in different
components is aligned too, unless its lengths or its word signatures rule a link
out. So no candidate pair goes untested unless its texts are connected already
or cannot be linked, and a large group of near copies costs its size, not its
square.

Null and empty texts are one text without words, linked to no other; so are
texts of white space only, if equal. Texts of one to four words have one k-mer.
Null ids come last when a class is named after its least id. An empty table
gives an empty result. Extra input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweft.llm.components import components
from panelweft.llm.words import mix, word_hashes
from panelweft.scale import bounded, materialise, running_total

K = 5  # words of a k-mer
LEAST = 2  # k-mers of a slot
STRETCH = 10  # words of a stretch that repeats itself, three times at least
SLOTS = 128  # enough for scattered edits down to SIMILARITY
SIMILARITY = 0.8
OWN = 0.5  # common words outside of fillers, of texts that repeat the same run
ROUNDS = 3  # of leaders, after the first
SIGNATURE = 16  # longs of 64 bits
CELLS = 1 << 19  # numbers of a sketch that a worker handles at once
PART = 512  # texts that a worker unpacks at once
TABLE = 1 << 21  # cells of a band that a worker lays out as a table
BITS = 1 << 15  # words of a text whose places are kept as bits


def runs(words: np.ndarray) -> np.ndarray:
    """Hashes of the runs of K words; one for a shorter text."""
    if not len(words):
        return words.astype(np.uint64)
    size = max(1, len(words) - K + 1)
    out = np.zeros(size, np.uint64)
    for n in range(min(K, len(words))):
        out = mix(out + words[n : n + size].astype(np.uint64) + np.uint64(n))
    return out


def told_apart(hashes: np.ndarray) -> np.ndarray:
    """Hashes that also hold how often the same one occurred before."""
    size = len(hashes)
    if not size:
        return hashes
    order = np.argsort(hashes, kind="stable")
    run = hashes[order]
    new = np.append(True, run[1:] != run[:-1])
    begin = np.nonzero(new)[0]
    nth = np.arange(size) - np.repeat(begin, np.diff(np.append(begin, size)))
    labelled = hashes.copy()
    labelled[order] = mix(run + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return labelled


def kmers(words: np.ndarray) -> np.ndarray:
    """Hashes of the runs of K words, told apart by occurrence."""
    return told_apart(runs(words))


def without_rounds(words: np.ndarray) -> np.ndarray:
    """The words without those that only repeat the ones before them: a stretch of
    STRETCH words or more with a period of up to K words, three times its period at
    least, keeps its first period."""
    keep = np.ones(len(words), bool)
    for q in range(1, min(K, len(words) - 1) + 1):
        same = np.concatenate(([False], words[q:] == words[:-q], [False]))
        turns = np.nonzero(same[1:] != same[:-1])[0]
        for begin, end in zip(turns[::2], turns[1::2]):
            if end - begin >= max(2 * q, STRETCH - q):
                keep[begin + q : end + q] = False
    return words[keep]


def sketch(words: np.ndarray) -> np.ndarray:
    """One number for each slot; none for a text without words."""
    grams = kmers(words)
    if not len(grams):
        return np.zeros(0, np.int64)
    seeds = mix(np.arange(1, SLOTS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
    factors = mix(seeds) | np.uint64(1)
    out = np.zeros(SLOTS, np.uint64)
    step = max(1, CELLS // len(grams))
    for at in range(0, SLOTS, step):
        part = slice(at, at + step)
        order = (grams[None, :] ^ seeds[part, None]) * factors[part, None]
        every = np.arange(len(order))
        chosen = np.zeros((min(LEAST, len(grams)), len(order)), np.int64)
        for n in range(len(chosen)):
            chosen[n] = np.argmin(order, axis=1)
            order[every, chosen[n]] = np.iinfo(np.uint64).max
        value = np.zeros(len(order), np.uint64)
        for one in np.sort(chosen, axis=0):
            value = mix(value + grams[one])
        out[part] = value
    return out.view(np.int64)


def signature(words: np.ndarray) -> np.ndarray:
    """The parity of the words, told apart by occurrence, at each of the bits.
    Where two texts differ in a bit, one has a word that the other lacks."""
    place = told_apart(words.astype(np.uint64)) & np.uint64(64 * SIGNATURE - 1)
    odd = np.bincount(place.astype(np.int64), minlength=64 * SIGNATURE) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in smaller ones, so that few texts are unpacked at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, PART):
            yield batch.slice(at, PART)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches):
        words = word_hashes(batch.column("__text").to_pylist())
        yield pa.record_batch(
            [
                batch.column("doc_id"), batch.column("key"),
                pa.array([len(w) for w in words], pa.int32()),
                pa.array([sketch(without_rounds(w)) for w in words], pa.list_(pa.int64())),
                pa.array([signature(w) for w in words], pa.list_(pa.int64())),
            ],
            names=["doc_id", "key", "n_words", "slots", "bits"],
        )


def _word_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words as 32-bit numbers, half the size of a text."""
    for batch in _parts(batches):
        words = word_hashes(batch.column("__text").to_pylist())
        numbers = [(w >> np.uint64(32)).astype(np.uint32).view(np.int32) for w in words]
        yield pa.record_batch([batch.column("node"), pa.array(numbers, pa.list_(pa.int32()))], names=["node", "words"])


def edits(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Word edits from a to b, or most + 1 if there are more.

    What both begin and end with is left out. The band of the diagonals that the
    edits allow is held as bits of long numbers, so a word of b is a few operations
    on those. For longer texts the band is widened fourfold until the alignment
    fits: on each diagonal the next difference is looked up in a table of the band,
    so a round of one more edit is a few vector operations; bands too large for a
    table are aligned row by row.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    if len(a) > len(b):
        a, b = b, a
    values, counts = np.unique(a, return_counts=True)
    other, theirs = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(values, other, assume_unique=True, return_indices=True)
    if len(b) - int(np.minimum(counts[i], theirs[j]).sum()) > most:
        return most + 1
    for _ in range(2):  # from the front, then from the back
        same = a == b[: len(a)]
        n = len(a) if same.all() else int(np.argmin(same))
        a, b = a[n:][::-1], b[n:][::-1]
    if not len(a) or not most:
        return min(len(b), most + 1)
    if len(b) <= BITS:
        return _edits_by_bits(a.tolist(), b.tolist(), min(most, len(b)))
    band = max(8, len(b) - len(a))
    while True:
        band = min(band, most)
        if (2 * band + 1) * (len(a) + 1) > TABLE:
            return _edits_by_rows(a, b, most)
        found = _edits_by_diagonals(a, b, band)
        if found <= band or band == most:
            return found if found <= band else most + 1
        band *= 4


def _edits_by_bits(short: list[int], long: list[int], most: int) -> int:
    """The band column by column: bit k of a column stands for the place of `long`
    that lies k above the lowest one of the band there. `up` and `down` hold where
    the count of edits grows or falls from one place to the next."""
    width = 2 * most + 2
    every, top = (1 << width) - 1, 1 << (width - 1)
    places = dict.fromkeys(short, 0)
    for n, word in enumerate(long):
        if word in places:
            places[word] |= 1 << n
    up, down = ((1 << (most + 1)) - 1) << (width - most - 1), 0
    found, enough, low = most, 2 * most + len(short) - len(long), most + 1 - width
    mark = top >> 1
    for n, word in enumerate(short):
        at = places[word]
        at = (at >> low if low >= 0 else at << -low) & every
        straight = ((((at & up) + up) ^ up) | at | down) & every
        right, left = down | (every & ~(straight | up)), straight & up
        if n < len(long) - most:  # along the band's last diagonal
            found += not straight & top
        else:  # along the last place of `long`
            found += bool(right & mark) - bool(left & mark)
            mark >>= 1
        if found > enough:
            return most + 1
        straight >>= 1
        up, down = left | (every & ~(straight | right)), straight & right
        low += 1
    return min(found, most + 1)


def _edits_by_diagonals(a: np.ndarray, b: np.ndarray, band: int) -> int:
    n, m = len(a), len(b)
    # outside of b stands a number that no word has
    padded = np.full(m + 2 * band + n, 1 << 40, np.int64)
    padded[band : band + m] = b
    here = np.lib.stride_tricks.sliding_window_view(padded, n)[: 2 * band + 1] if n else None
    differs = np.full((2 * band + 1, n + 1), n, np.int32)
    if n:
        differs[:, :n] = np.where(here == a, n, np.arange(n, dtype=np.int32))
        differs = np.minimum.accumulate(differs[:, ::-1], axis=1)[:, ::-1]
    diagonals = np.arange(2 * band + 1)
    limit = np.minimum(n, m - (diagonals - band))
    reach = np.full(2 * band + 3, -2, np.int64)  # one more at either side
    reach[band + 1] = differs[band, 0] if n else 0
    goal = m - n + band
    for e in range(band + 1):
        if reach[goal + 1] >= n:
            return e
        step = np.maximum(np.maximum(reach[1:-1] + 1, reach[:-2]), reach[2:] + 1)
        step = np.minimum(step, limit)
        ok = (step >= 0) & (step + diagonals - band >= 0)
        reach[1:-1] = np.where(ok, differs[diagonals, np.maximum(step, 0)], -2)
    return band + 1


def _edits_by_rows(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """The banded table row by row: memory for one row of the band only."""
    n, m = len(a), len(b)
    offset = np.arange(-most, most + 1)
    high = 2 * most + 2
    row = np.where((offset >= 0) & (offset <= m), offset, high)
    padded = np.full(m + 2 * most + n + 1, 1 << 40, np.int64)
    padded[most + 1 : most + 1 + m] = b
    for i in range(1, n + 1):
        same = padded[i : i + 2 * most + 1] == a[i - 1]  # b at column i + offset - 1
        best = np.minimum(row + ~same, np.append(row[1:], high) + 1)
        best[(offset + i < 0) | (offset + i > m)] = high
        best = np.minimum(best, np.minimum.accumulate(best - offset) + offset)
        best[(offset + i < 0) | (offset + i > m)] = high
        row = best
        if row.min() > most:
            return most + 1
    return int(min(row[m - n + most], most + 1))


def _outside(words: np.ndarray, grams: np.ndarray, fillers: np.ndarray) -> np.ndarray:
    """The words that no run of a filler covers."""
    covered = np.zeros(len(words), bool)
    at = np.nonzero(np.isin(grams, fillers))[0]
    for n in range(min(K, len(words))):
        covered[at + n] = True
    return words[~covered]


def only_filler(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two texts share little but runs that repeat in both."""
    grams = [runs(a), runs(b)]
    (x, often), (y, others) = (np.unique(g, return_counts=True) for g in grams)
    fillers = np.intersect1d(x[often > 1], y[others > 1], assume_unique=True)
    if not len(fillers):
        return False
    own, theirs = (told_apart(_outside(w, g, fillers).astype(np.uint64)) for w, g in zip((a, b), grams))
    both = len(np.intersect1d(own, theirs, assume_unique=True))
    return both < OWN * min(len(own), len(theirs))


def _aligned(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.zeros(batch.num_rows)
            left, right = batch.column("a_words"), batch.column("b_words")
            for n in range(batch.num_rows):
                a, b = (np.asarray(side[n].values, np.int64) for side in (left, right))
                longer = max(len(a), len(b))
                most = int((1 - similarity) * longer + 1e-9)
                found = edits(a, b, most)
                if found <= most and not only_filler(a, b):
                    score[n] = 1 - found / longer if longer else 1.0
            yield pa.record_batch([batch.column("a"), batch.column("b"), pa.array(score)], names=["a", "b", "similarity"])

    return run


def texts_of(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.md5(body.cast("binary")).alias("key"), body.alias("__text"))


def words_of_nodes(base: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, words) of the wanted nodes: the texts are read once for all
    alignments, copies become one before they are shuffled, and each travels as
    numbers from then on."""
    asked = wanted.select("node").distinct().join(nodes.select("node", "key"), "node")
    texts = base.groupBy("key").agg(F.first("__text").alias("__text"))
    return materialise(
        texts.join(asked.hint("merge"), "key").select("node", "__text")
        .mapInArrow(_word_numbers, "node long, words array<int>"),
        "words",
    )


def align(pairs: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes that are linked, with their similarity."""
    side = lambda c: words.select(F.col("node").alias(c), F.col("words").alias(f"{c}_words"))
    both = pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a")
    return (
        both.select("a", "b", "a_words", "b_words")
        .mapInArrow(_aligned(similarity), "a long, b long, similarity double")
        .where(F.col("similarity") >= similarity)
    )


def _may_link(similarity: float):
    """Whether two texts (a, b) with sizes and signatures can be linked: lengths
    that differ cost edits, and an edit changes two words at most, or one where
    the lengths come closer."""
    most = F.floor(F.greatest("a_size", "b_size") * F.lit(1 - similarity) + F.lit(1e-9))
    apart = sum(
        (F.bit_count(F.get("a_bits", n).bitwiseXOR(F.get("b_bits", n))) for n in range(SIGNATURE)), F.lit(0)
    )
    longer = F.abs(F.col("a_size") - F.col("b_size"))
    return (longer <= most) & (apart <= 2 * most - longer)


def _joined(parts: DataFrame, found: DataFrame) -> DataFrame:
    """(node, part) after the parts that new links connect have become one."""
    side = lambda c: parts.select(F.col("node").alias(c), F.col("part").alias(f"{c}_part"))
    edges = found.select("a", "b").join(side("a"), "a").join(side("b"), "b").where("a_part <> b_part")
    merged = components(edges.select(F.col("a_part").alias("a"), F.col("b_part").alias("b")).distinct())
    merged = bounded(merged.withColumnRenamed("node", "part"))
    return parts.join(merged, "part", "left").select("node", F.coalesce("component", "part").alias("part"))


def near_duplicates(
    docs: DataFrame, similarity: float = SIMILARITY, text: str = "text", id_col: str = "doc_id"
) -> tuple[DataFrame, DataFrame]:
    """Two tables: documents (doc_id, key, node, class_id, first) with the
    least id of the class and whether the row stands for it, and links
    (a, b, similarity) between the nodes, the distinct texts."""
    base = texts_of(docs, text, id_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    made = base.mapInArrow(_sketches, f"doc_id {id_type}, key string, n_words int, slots array<long>, bits array<long>")
    rows = materialise(made.withColumn("__row", F.monotonically_increasing_id()), "sketches")
    distinct = rows.groupBy("key").agg(
        F.min("doc_id").alias("least_id"), F.first("n_words").alias("n_words"),
        F.first("bits").alias("bits"), F.min("__row").alias("__row"),
    )
    # distinct texts are numbered by least id, so the least number names a class
    order = distinct.withColumns({"__null": F.col("least_id").isNull(), "__one": F.lit(1)})
    nodes = materialise(
        running_total(order, ["__null", "least_id", "key"], "__one", "node")
        .select("key", "least_id", "n_words", "bits", "__row", F.col("node").cast("long")),
        "nodes",
    )
    # one row of each text; texts with an equal value share k-mers, in whatever slot
    chosen = nodes.select("key", "__row", "node").hint("merge")
    once = materialise(rows.join(chosen, ["key", "__row"]).select("node", "slots"), "texts")
    held = once.select("node", F.explode(F.array_distinct("slots")).alias("value"))
    shared = held.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("value")
    buckets = materialise(held.join(shared, "value", "left_semi"), "buckets")

    def possible(pairs: DataFrame) -> DataFrame:
        """The pairs that lengths and signatures do not rule out."""
        side = lambda c: nodes.select(
            F.col("node").alias(c), F.col("n_words").alias(f"{c}_size"),
            F.col("bits").alias(f"{c}_bits"),
        )
        return pairs.join(side("b"), "b").join(side("a"), "a").where(_may_link(similarity)).select("a", "b")

    words = words_of_nodes(base, nodes, buckets)
    parts = buckets.select("node").distinct().withColumn("part", F.col("node"))
    links, tested = None, None
    for turn in range(1 + ROUNDS):
        member = buckets.join(parts, "node")
        lead = member.groupBy("value").agg(
            F.min(F.struct("part", F.xxhash64("node", F.lit(turn)).alias("order"), "node")).alias("lead"),
            F.max("part").alias("last"),
        )
        lead = lead.where(F.col("lead.part") < F.col("last")).select(
            "value", F.col("lead.part").alias("lead_part"), F.col("lead.node").alias("lead")
        )
        pairs = (
            member.join(lead, "value").where("part <> lead_part")
            .select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()
        )
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "pairs")
        tested = pairs if tested is None else materialise(tested.union(pairs), "tested")
        found = materialise(align(possible(pairs), words, similarity), "found")
        if found.isEmpty():
            break
        links = found if links is None else materialise(links.union(found), "links")
        parts = materialise(_joined(parts, found), "parts")

    # what is left: buckets that still hold more than one component
    member = buckets.join(parts, "node")
    mixed = member.groupBy("value").agg(F.min("part").alias("p"), F.max("part").alias("q"))
    band = F.floor(F.log(F.col("n_words")) / F.lit(-float(np.log(similarity)))).cast("int")
    left = materialise(
        member.join(mixed.where("p < q").select("value"), "value")
        .join(nodes.select("node", "n_words", "bits"), "node")
        .select(
            "value", band.alias("band"), F.col("node").alias("a"), F.col("part").alias("a_part"),
            F.col("n_words").alias("a_size"), F.col("bits").alias("a_bits"),
        ),
        "open-buckets",
    )
    # texts whose lengths differ by a fifth at most lie in neighbouring bands
    near = left.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    other = near.select("value", "band", *(F.col(f"a{c}").alias(f"b{c}") for c in ("", "_part", "_size", "_bits")))
    apart = (F.col("a") < F.col("b")) & (F.col("a_part") != F.col("b_part")) & _may_link(similarity)
    rest = (
        left.join(other, (left["value"] == other["value"]) & (left["band"] == other["band"]) & apart)
        .select("a", "b").distinct()
    )
    rest = materialise(rest.join(tested, ["a", "b"], "left_anti"), "rest-pairs")
    found = materialise(align(rest, words, similarity), "last-links")
    links = found if links is None else links.union(found)
    parts = _joined(parts, found)
    joined = parts.withColumnRenamed("part", "component")
    named = nodes.join(joined, "node", "left").select("key", "node", F.coalesce("component", "node").alias("class"))
    names = nodes.select(F.col("node").alias("class"), F.col("least_id").alias("class_id"))
    found = rows.select("doc_id", "key").join(named, "key").join(names, "class")
    first = (F.col("node") == F.col("class")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    return found.select("doc_id", "key", "node", "class_id", first.alias("first")), links


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents without all but the first of each class; all columns. Of
    rows equal in id and text one is kept."""
    found, _ = near_duplicates(docs, similarity, text, id_col)
    found = materialise(found.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), "first"), "classes")
    # the columns travel as one struct, so that none can clash with a name used here
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(id_col).alias("__id"),
        F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("__key"),
    )
    mine = lambda t: (keyed["__id"].eqNullSafe(t["__id"])) & (keyed["__key"] == t["__key"])
    lost = bounded(found.where(~F.col("first")).select("__id", "__key").distinct())
    kept = keyed.join(lost, mine(lost), "left_anti")
    unpacked = lambda df: df.select(*[F.col(f"__row.`{c}`").alias(c) for c in docs.columns])
    again = found.where("first").groupBy("__id", "__key").count().where("count > 1").select("__id", "__key")
    if again.isEmpty():
        return unpacked(kept)
    twice = bounded(again)
    same = (kept["__id"].eqNullSafe(twice["__id"])) & (kept["__key"] == twice["__key"])
    once = kept.join(twice, same, "left_anti")
    one = kept.join(twice, same, "left_semi").dropDuplicates(["__id", "__key"])
    return unpacked(once.unionByName(one))


def near_dedup(docs: DataFrame) -> DataFrame:
    """Digest for the query: one row per document with its class; `n_links` is
    the number of tested links: texts whose alignment with its text was made and
    linked them. Pairs that are connected already are not aligned, so it is no
    degree; among near copies the leader has many and the others few."""
    found, links = near_duplicates(docs)
    degree = (
        links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    )
    return found.join(degree, "node", "left").select(
        "doc_id", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("first").alias("kept")
    )
