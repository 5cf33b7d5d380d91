"""Periodic runs of words, by sparse diagonals.

A run is a stretch of words with smallest period q (words q apart are equal)
that no neighbouring word extends, at least `least` words and `times` periods
long. On the diagonal of lag q it is a stretch of matches: words that occurred q
places earlier.

Every word meets its earlier occurrences, and each of them adds one to the match
length of its lag; a diagonal whose next word does not match ends, and gives a
run if it is long enough. This is done for all words of a block of texts at once,
by bands of lags. An occurrence counts only together with the words before it
that every run of its band must have matched: a lag from w / 2 to w - 1 needs w
words in common. These contexts are found by doubling, exactly: ranks of pairs of
ranks, kept only where the same text has the context twice.

So frequent words make no pairs, and a repeated word has at most two lags in a
band. Let p be the distance of two neighbouring occurrences of a context of w
words, p <= w / 2: it is the context's own period, and all occurrences chained by
it lie in one stretch of that period, so their lags are multiples of p and no
smallest periods there. An occurrence outside of the chain lies in another
stretch of period p; the two overlap by less than p words, so its lag is above
w - p, and there is one such occurrence at most: the last before the chain. The
work is n log n for a text of n words, whatever the text.

Null and empty texts have no words and no runs. A text of any length is handled
in memory of its own size. Repeated rows get equal answers. A null id is no
number, so such a row is not edited by `repeat_some`. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweft.llm.words import blocks

LEAST, TIMES = 24, 3
DIRECT = 8  # lags below are compared word by word


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each stretch of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], same, [False]))))
    return edge[::2], edge[1::2] - 1


def _contexts(rank: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
    """Ranks of the contexts of twice the width, from those of the width; -1
    where a text has the context only once."""
    at = np.flatnonzero((rank >= 0) & (place >= 2 * width - 1))
    at = at[rank[at - width] >= 0]
    out = np.full(len(rank), -1, np.int64)
    if len(at):
        pair = rank[at - width] * (int(rank.max()) + 1) + rank[at]
        _, number, count = np.unique(pair, return_inverse=True, return_counts=True)
        often = count[number] > 1
        out[at[often]] = number[often]
    return out


def _band(rank: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The places and lags, from half the width to below the width, at which a
    context occurred before."""
    at = np.flatnonzero(rank >= 0)
    at = at[np.argsort(rank[at], kind="stable")]
    if len(at) < 2:
        return at[:0], at[:0]
    same = rank[at[1:]] == rank[at[:-1]]
    gap = np.append(0, np.where(same, np.diff(at), 0))  # 0: first occurrence
    opens = (gap == 0) | (gap > width // 2)
    first = np.maximum.accumulate(np.where(opens, np.arange(len(at)), 0))
    before = np.where(gap[first] > 0, at - at[first - 1], width)
    half = gap == width // 2
    found = before < width
    return np.append(at[half], at[found]), np.append(gap[half], before[found])


def runs_of(words: np.ndarray, sizes: np.ndarray, least: int = LEAST, times: int = TIMES):
    """Runs in texts that lie one after another: `words` are numbers, equal for
    equal words; `sizes` says how many each text has. Returns text, start (within
    the text), length and period, by text, start and period.

    Needs least >= 24 and times >= 3, from which the widths of contexts follow.
    """
    if least < LEAST or times < TIMES:
        raise ValueError("runs of fewer words or periods are not supported")
    sizes = np.asarray(sizes, np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    size = sizes[text]
    found = []

    def emit(first, last, lag):
        length = last - first + 1 + lag
        long = length >= np.maximum(least, times * lag)
        found.append(np.stack([first - lag, length, np.broadcast_to(lag, length.shape)])[:, long])

    for lag in range(1, min(DIRECT, len(words))):
        same = np.append(np.zeros(lag, bool), words[lag:] == words[:-lag]) & (place >= lag)
        emit(*_stretches(same), lag)
    if len(words) and size.max() >= least:
        # texts too short for any run take no part
        _, rank, count = np.unique((text << 32) | words, return_inverse=True, return_counts=True)
        rank = np.where((count[rank] > 1) & (size >= least), rank, -1)
        width = 1
        while (rank >= 0).any():
            rank = _contexts(rank, place, width)
            width *= 2
            if width < 2 * DIRECT:
                continue
            at, lag = _band(rank, width)
            if len(at):
                order = np.lexsort((at, lag))
                at, lag = at[order], lag[order]
                new = np.append(True, (np.diff(at) != 1) | (np.diff(lag) != 0))
                first, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(at)) - 1
                emit(at[first] - width + 1, at[last], lag[first])
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start))  # of equal stretches the smallest period counts
    start, length, period = start[order], length[order], period[order]
    once = np.append(True, (np.diff(start) != 0) | (np.diff(length) != 0))[: len(start)]
    start, length, period = start[once], length[once], period[once]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    return text[start], place[start], length, period


def repeat_some(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which original word stands at each place of an edited text: in one of
    ten documents, chosen by id, the end repeats a period. None: not edited."""
    if doc_id is None or not n:
        return None
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def _finder(least: int, times: int, edit: Callable | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for begin, texts in blocks(batch.column("__text").to_pylist()):
                here = ids.slice(begin, len(texts))
                words = [t.encode().split() for t in texts]  # at the six ASCII white spaces
                for n, i in enumerate(here.to_pylist() if edit else ()):
                    takes = edit(i, len(words[n]))
                    if takes is not None:
                        words[n] = [words[n][k] for k in takes]
                sizes = np.array([len(w) for w in words], np.int64)
                flat = pa.array([x for w in words for x in w], pa.binary()).dictionary_encode().indices
                found = runs_of(flat.to_numpy().astype(np.int64), sizes, least, times)
                text, start, length, period = found
                firsts = np.searchsorted(text, np.arange(len(texts) + 1))
                # words inside a run, after its first period
                base = (np.cumsum(sizes) - sizes)[text] + start
                depth = np.zeros(int(sizes.sum()) + 1, np.int64)
                np.add.at(depth, base + period, 1)
                np.add.at(depth, base + length, -1)
                stays = np.split(np.cumsum(depth[:-1]) == 0, np.cumsum(sizes)[:-1])
                left = [
                    b" ".join(w if firsts[n] == firsts[n + 1] else [x for x, s in zip(w, stays[n]) if s])
                    for n, w in enumerate(words)
                ]
                parts = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
                yield pa.record_batch(
                    [
                        here, pa.array(sizes), pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), parts),
                        pa.array(left, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return run


def periodic_runs(
    docs: DataFrame, least: int = LEAST, times: int = TIMES, edit: Callable | None = None,
    text: str = "text", id_col: str = "doc_id",
) -> DataFrame:
    """doc_id, n_words, runs (start, length, period, by start and period), and
    the text with runs collapsed: its words joined by one space, of each run the
    first period. One row per input row, no shuffle. `edit` may name the word
    that stands at each place: (id, number of words) -> places, or None."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(
        _finder(least, times, edit),
        f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string",
    )


def run_report(found: DataFrame) -> DataFrame:
    """The contract's digest of `periodic_runs`."""

    def ahead(a, b):  # by exact exponent, greatest first; then start, then period
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        later = lambda c: F.when(a[c] < b[c], -1).when(a[c] > b[c], 1)
        return F.when(x > y, -1).when(x < y, 1).otherwise(F.coalesce(later("start"), later("period"), F.lit(0)))

    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("__best", F.get(F.array_sort("runs", ahead), F.lit(0)))
    part = lambda c: F.col(f"__best.{c}")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        part("start").alias("start"), part("length").alias("length"), part("period").alias("period"),
        F.expr("1000 * __best.length div __best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )
