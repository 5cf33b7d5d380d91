"""Hashes of the words of many texts at once, for Python workers."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)
BLOCK_CHARS = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all of them."""
    x = (x ^ (x >> np.uint64(30))) * MIX
    x = (x ^ (x >> np.uint64(27))) * BASE
    return x ^ (x >> np.uint64(31))


def blocks(texts: list[str]):
    """Runs of neighbouring texts of about BLOCK_CHARS characters together."""
    begin, held = 0, 0
    for n, text in enumerate(texts):
        held += len(text)
        if held >= BLOCK_CHARS:
            yield begin, texts[begin : n + 1]
            begin, held = n + 1, 0
    if begin < len(texts):
        yield begin, texts[begin:]


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    """For each text the 64-bit hashes of its words, in order. Words are runs
    of characters other than space and U+0009 to U+000D."""
    out: list[np.ndarray] = []
    for _, some in blocks(texts):
        sizes = np.array([len(t) + 1 for t in some])
        codes = np.frombuffer(" ".join([*some, ""]).encode("utf-32-le"), np.uint32)
        space = (codes == 32) | ((codes >= 9) & (codes <= 13))
        starts = np.nonzero(~space & np.append(True, space[:-1]))[0]
        if not len(starts):
            out.extend(np.zeros(0, np.uint64) for _ in some)
            continue
        ends = np.nonzero(space & np.append(False, ~space[:-1]))[0]
        widths = ends - starts
        at = np.arange(int(widths.sum())) + np.repeat(starts - (np.cumsum(widths) - widths), widths)
        place = at - np.repeat(starts, widths)
        powers = np.ones(int(widths.max()) + 1, np.uint64)
        np.multiply.accumulate(np.full(int(widths.max()), BASE, np.uint64), out=powers[1:])
        values = (codes[at].astype(np.uint64) + np.uint64(1)) * powers[place]
        hashes = mix(np.add.reduceat(values, np.cumsum(widths) - widths))
        first = np.searchsorted(starts, np.cumsum(sizes) - sizes)
        out.extend(np.split(hashes, first[1:]))
    return out
