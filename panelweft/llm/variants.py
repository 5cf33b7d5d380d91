"""Spelling variants: words one edit apart, found by pivotal bigrams.

Bigrams are ordered by the number of words that hold them, rare ones first. A
word's prefix is its three first bigrams in that order, with all places of the
last one; any three places hold two that do not overlap, and a dynamic program
chooses the two disjoint ones of least total frequency: the pivots. One edit
destroys one of two disjoint bigrams at most. So if two words are one edit apart,
a pivot of the word whose prefix ends earlier in the order lies in the prefix of
the other, and the edit lies as a whole before or behind it. That limits its
place: with the edit behind, both words are equal up to the bigram's end; with the
edit before, they are equal from its start on. Pivots meet prefixes in a join on
that equal part and on lengths that differ by one at most; whatever meets is
verified.

The alphabet is a-z and U+00C0 to U+00FF, so there are at most 8,100 bigrams; only
their counts come to the driver. Words are counted in the workers before they are
shuffled, all pairs lie in distributed tables, and forms are followed by jumping
over twice as many steps in each round.

A word's form is its near word of largest count (ties: smallest in code-point
order), if that is at least `times` the word's own. Forms have larger counts, so
following them ends.

Null and empty texts hold no words; texts of any length are read whole. A null id
counts as an empty string where ids choose letters to delete. Repeated rows count
as often as they are there. An empty table gives an empty result. Extra columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweft.scale import bounded, materialise

Q = 2  # code points of a gram
EDITS = 1
LEAST_CHARS, LEAST_COUNT = 6, 5
TIMES = 5
DELETE_EVERY = 199
HELD_WORDS = 1 << 18  # distinct words that a worker counts before it hands them on

#: Runs of A-Z, a-z and U+00C0 to U+00FF (in UTF-8: 0xC3 and one more byte).
RUN = re.compile(rb"(?:[a-z]++|(?:\xc3[\x80-\xbf])++)++")


def lose_letters(doc_id: int | None) -> Callable[[bytes], bytes]:
    """What a document makes of its words: some lose a code point."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())

    def edited(word: bytes) -> bytes:
        h = zlib.crc32(word, seed)
        if h % DELETE_EVERY:
            return word
        letters = word.decode()
        at = h % len(letters)
        return (letters[:at] + letters[at + 1 :]).encode()

    return edited


def _counter(edit: Callable | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out():
            words = pa.array(held.keys(), pa.binary()).cast(pa.string())
            return pa.record_batch([words, pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("__text")):
                change = edit(doc_id) if edit else None
                for word, n in Counter(RUN.findall(text.as_py().encode().lower())).items():
                    if len(word) < LEAST_CHARS:
                        continue
                    word = change(word) if change else word
                    if len(word) >= LEAST_CHARS and (word.isascii() or len(word.decode()) >= LEAST_CHARS):
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return run


def vocabulary(
    docs: DataFrame, edit: Callable | None = None, least_count: int = LEAST_COUNT, text: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """word, n: words of enough letters that occur often enough. Only A-Z are
    lower-cased. `edit` gives for an id what becomes of that document's words."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("__text")).where(F.col("__text") != "")
    parts = rows.mapInArrow(_counter(edit), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def pivots(places: list[int], weights: list[int], k: int = EDITS + 1) -> tuple[int, ...]:
    """The k grams of least total weight that do not overlap, of those at the
    given ascending places. chosen[j] of a row is the cheapest choice of j grams
    among the first ones; a gram is added to the last row that ends before it."""
    rows: list[list] = [[(0, ())] + [None] * k]
    for n, (place, weight) in enumerate(zip(places, weights)):
        free = n
        while free and places[free - 1] > place - Q:
            free -= 1
        row = list(rows[n])
        for j in range(1, k + 1):
            if rows[free][j - 1] is not None:
                total, taken = rows[free][j - 1]
                if row[j] is None or total + weight < row[j][0]:
                    row[j] = (total + weight, (*taken, place))
        rows.append(row)
    return rows[-1][k][1]


def grams_of(word: str, counts: dict[str, int], order: dict[str, int]):
    """Prefix places, pivot places, and the number of the prefix's last gram."""
    ranks = [order[word[n : n + Q]] for n in range(len(word) - Q + 1)]
    last = sorted(ranks)[Q * EDITS]
    prefix = [n for n, r in enumerate(ranks) if r <= last]
    chosen = pivots(prefix, [counts[word[n : n + Q]] for n in prefix])
    return ranks, prefix, chosen, last


def _indexer(counts: dict[str, int]):
    order = {g: n for n, g in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, last, pivot, size, word = [], [], [], [], []
            for w in batch.column("word").to_pylist():
                _, prefix, chosen, end = grams_of(w, counts, order)
                for n in prefix:
                    part += ["<" + w[: n + Q], ">" + w[n:]]  # equal with the edit behind, and before
                    last += [end] * 2
                    pivot += [n in chosen] * 2
                    size += [len(w)] * 2
                    word += [w] * 2
            columns = [pa.array(x, t) for x, t in ((part, pa.string()), (size, pa.int32()), (last, pa.int32()), (pivot, pa.bool_()), (word, pa.string()))]
            yield pa.record_batch(columns, names=["part", "size", "last", "pivot", "word"])

    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """a, b with a < b in code-point order: the words (column `word`) that
    differ by exactly one inserted, deleted or replaced code point."""
    places = F.sequence(F.lit(1), F.length("word") - Q + 1)
    held = words.select(F.explode(F.array_distinct(F.transform(places, lambda p: F.substring("word", p, F.lit(Q))))).alias("gram"))
    counts = {r["gram"]: r["n"] for r in held.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()}  # 8,100 at most
    index = materialise(
        words.select("word").mapInArrow(_indexer(counts), "part string, size int, last int, pivot boolean, word string"),
        "gram-index",
    )
    sizes = F.explode(F.array(*[F.col("size") + d for d in range(-EDITS, EDITS + 1)]))
    probes = index.where("pivot").select("part", sizes.alias("size"), F.col("word").alias("other"), F.col("last").alias("end"))
    near = (F.col("end") <= F.col("last")) & (F.levenshtein("other", "word", EDITS) == 1)
    met = probes.join(index.drop("pivot"), ["part", "size"]).where(near)
    return met.select(F.least("word", "other").alias("a"), F.greatest("word", "other").alias("b")).distinct()


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """word, root: the end of the chain word -> form. A chain has at most `most`
    steps; every round doubles the steps that are jumped over."""
    now, steps = forms.select("word", F.col("form").alias("root")), 1
    while steps < most:
        onward = bounded(now.select(F.col("word").alias("root"), F.col("root").alias("next")))
        now = materialise(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        steps *= 2
    return now


def spelling_forms(words: DataFrame, times: int = TIMES) -> DataFrame:
    """For a table of distinct words with their counts (word, n): word, form,
    root, n, n_near, form_n."""
    words = materialise(words.select("word", "n"), "vocabulary")
    pairs = near_pairs(words)
    both = pairs.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x"))
    near = both.select(F.col("x.a").alias("word"), F.col("x.b").alias("near"))
    counted = near.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    far = F.col("best.less") * -1 >= F.col("n") * times
    found = materialise(
        words.join(best, "word", "left").select(
            "word", F.when(far, F.col("best.near")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(far, F.col("best.less") * -1).alias("form_n"),
        ),
        "forms",
    )
    forms = found.where("form is not null")
    most, top = 0, forms.agg(F.max(F.col("form_n") / LEAST_COUNT)).first()[0] or 0
    while top >= times:
        most, top = most + 1, top / times
    roots = bounded(_roots(forms, most + 1))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
