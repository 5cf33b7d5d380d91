"""SentencePiece encoding and decoding in batches.

A block of texts becomes one array of code points. It is cut wherever no piece
holds the two characters on either side, so no piece can cross a cut, and every
distinct stretch between cuts is encoded once. Stretches of equal length advance
together: hashes of their substrings probe the sorted hashes of the pieces, and
at each position the best sum of scores and its backpointer are kept for all of
them at once (Viterbi).

The vocabulary given is of the BPE kind, where the encoder's answer is the
outcome of merges, not the best sum. A path is that outcome exactly if each of
its pieces is what its own characters merge to and no two neighbours would merge
across their border. So the best path is tested for this, and where it fails,
the same Viterbi runs over permitted transitions only: the one permitted path is
the answer. Ids therefore equal those of the sentencepiece library.

Characters without a piece become byte pieces. A space is written as U+2581, and
a text starts with one more; decoding takes that away again. Texts that hold
U+2581 themselves decode to a space there, and their round trip is reported as
false. Null texts have null ids, empty texts none. Long texts are taken in
slices that end before a space. Repeated rows get equal ids, an empty table an
empty result; extra input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = 0x2581
BASE = np.uint64(0x9E3779B97F4A7C15)
FILTER_BITS = 20
BLOCK_CHARS = 1 << 20
CELLS = 1 << 20  # characters of equal-length stretches that advance at once
CACHE = 400_000  # stretches that a worker remembers
NEVER = np.int64(1 << 40)


class Tables:
    """What the encoder needs of a model, as arrays; made once on the driver
    and sent to the executors (a few MB, fixed by the vocabulary)."""

    def __init__(self, model: bytes):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = lib.get_piece_size()
        words = {}
        self.byte_ids = np.full(256, lib.unk_id(), np.int32)
        blobs = []
        for i in range(size):
            word = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.byte_ids[int(word[3:5], 16)] = i
                blobs.append(bytes([int(word[3:5], 16)]))
            elif lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i):
                blobs.append(b" \xe2\x81\x87 " if lib.is_unknown(i) else b"")
            else:
                words[word] = i
                blobs.append(word.replace(chr(SPACE), " ").encode())
        self.blob = np.frombuffer(b"".join(blobs), np.uint8)
        self.blob_size = np.array([len(b) for b in blobs], np.int64)
        self.blob_start = np.cumsum(self.blob_size) - self.blob_size
        score = {w: lib.get_score(i) for w, i in words.items()}
        order = {s: n for n, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = np.full(size, NEVER)
        self.score = np.zeros(size)
        for w, i in words.items():
            self.rank[i], self.score[i] = order[score[w]], score[w]
        self.longest = max(map(len, words))
        self.by_length = []
        for n in range(1, self.longest + 1):
            own = [w for w in words if len(w) == n]
            codes = np.array([[ord(c) for c in w] for w in own], np.uint64).reshape(len(own), n)
            keys = horner(codes)[:, n]
            at = np.argsort(keys)
            seen = np.zeros(1 << FILTER_BITS, bool)
            seen[keys >> np.uint64(64 - FILTER_BITS)] = True
            self.by_length.append((keys[at], np.array([words[w] for w in own], np.int32)[at], seen))
        self.inside = np.zeros(1 << FILTER_BITS, bool)
        for w in words:
            if len(w) > 1:
                codes = np.array([ord(c) for c in w], np.uint64)
                self.inside[pair_slot(codes[:-1], codes[1:])] = True
        self._merges(words)

    @classmethod
    def of(cls, arrays: dict) -> Tables:
        """From what a broadcast holds: arrays and numbers, no class."""
        tables = cls.__new__(cls)
        tables.__dict__.update(arrays)
        return tables

    def _merges(self, words: dict[str, int]) -> None:
        """Ranks of all two-piece merges, and for each piece how the symbols at
        its left and right edge follow each other while it is merged."""
        joined = {}
        for w, i in words.items():
            for k in range(1, len(w)):
                a, b = words.get(w[:k]), words.get(w[k:])
                if a is not None and b is not None:
                    joined[(a << 32) | b] = int(self.rank[i])
        keys = np.array(sorted(joined), np.int64)
        self.pair_keys, self.pair_ranks = keys, np.array([joined[k] for k in keys.tolist()], np.int64)
        size = len(self.rank)
        self.proper = np.zeros(size, bool)
        depth = self.longest + 1
        self.edge = np.zeros((2, size, depth), np.int32)  # left edge, right edge
        self.ends = np.full((2, size, depth), NEVER)  # when a symbol is merged away
        for w, i in words.items():
            if any(c not in words for c in w):
                continue
            symbols, now = list(w), -1
            steps = [0, 0]
            self.edge[0, i, 0], self.edge[1, i, 0] = words[w[0]], words[w[-1]]
            while len(symbols) > 1:
                ranks = [self.rank[words[a + b]] if a + b in words else NEVER for a, b in zip(symbols, symbols[1:])]
                k = int(np.argmin(ranks))
                if ranks[k] == NEVER:
                    break
                now = max(now, int(ranks[k]))
                symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
                for side, touched in ((0, k == 0), (1, k == len(symbols) - 1)):
                    if touched:
                        self.ends[side, i, steps[side]] = now
                        steps[side] += 1
                        self.edge[side, i, steps[side]] = words[symbols[k]]
            self.proper[i] = len(symbols) == 1
        used = 1 + int(np.nonzero((self.ends < NEVER).any(axis=(0, 1)))[0].max(initial=0)) + 1
        self.edge, self.ends = self.edge[:, :, :used].copy(), self.ends[:, :, :used].copy()

    def lookup(self, codes_hash: np.ndarray, n: int) -> np.ndarray:
        """Ids of the pieces of n characters with these hashes; -1 for none."""
        keys, ids, seen = self.by_length[n - 1]
        out = np.full(codes_hash.shape, -1, np.int32)
        if len(keys):
            maybe = np.nonzero(seen[codes_hash >> np.uint64(64 - FILTER_BITS)])
            asked = codes_hash[maybe]
            at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
            out[maybe] = np.where(keys[at] == asked, ids[at], -1)
        return out

    def stays_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces a and b, side by side, never merge across their
        border: their edge symbols are followed through time together."""
        good = np.zeros(len(a), bool)
        left, right = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            i, j = left[live], right[live]
            key = (self.edge[1, x, i].astype(np.int64) << 32) | self.edge[0, y, j]
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            rank = np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)
            end_x, end_y = self.ends[1, x, i], self.ends[0, y, j]
            crossed = (rank < end_x) & (rank <= end_y) & (rank < NEVER)  # ties go to the left
            over = (end_x == NEVER) & (end_y == NEVER)
            good[live[over & ~crossed]] = True
            first = end_x <= end_y
            left[live], right[live] = i + first, j + ~first
            live = live[~crossed & ~over]
        return good


def horner(codes: np.ndarray) -> np.ndarray:
    """Prefix hashes of rows of equal length, one column more than these."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    for k in range(codes.shape[1]):
        out[:, k + 1] = out[:, k] * BASE + codes[:, k] + np.uint64(1)
    return out


def pair_slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (((a << np.uint64(21)) | b) * BASE) >> np.uint64(64 - FILTER_BITS)


def viterbi(tables: Tables, codes: np.ndarray, strict: bool) -> tuple[np.ndarray, np.ndarray]:
    """Best paths of stretches of equal length: ids (padded at the front) and
    their number. `strict` allows only transitions that merging leaves alone."""
    rows, width = codes.shape
    hashes = horner(codes)
    power = np.ones(1, np.uint64)
    ids = []
    for n in range(1, min(width, tables.longest) + 1):
        power = power * BASE
        ids.append(tables.lookup(hashes[:, n:] - hashes[:, :-n] * power, n))
    best = np.full((rows, width + 1), -np.inf)
    best[:, 0] = 0
    back = np.zeros((rows, width + 1), np.int64)
    last = np.full((rows, width + 1), -1, np.int32)
    every = np.arange(rows)
    for j in range(1, width + 1):
        most = min(j, len(ids))
        found = np.stack([ids[n - 1][:, j - n] for n in range(1, most + 1)], axis=1)
        before = best[:, j - most : j][:, ::-1]
        value = np.where(found >= 0, before + tables.score[found], -np.inf)
        if strict:
            can = np.isfinite(value)
            r, n = np.nonzero(can)
            here, prior = found[r, n], last[r, j - 1 - n]
            allowed = tables.proper[here]
            joins = allowed & (prior >= 0)
            allowed[joins] = tables.stays_apart(prior[joins], here[joins])
            value[r[~allowed], n[~allowed]] = -np.inf
        pick = np.argmax(value, axis=1)
        best[:, j] = value[every, pick]
        back[:, j] = pick + 1
        last[:, j] = np.where(np.isfinite(best[:, j]), found[every, pick], -1)
    out = np.full((rows, width), -1, np.int32)
    count, at = np.zeros(rows, np.int64), np.full(rows, width)
    live = every
    while len(live):
        count[live] += 1
        out[live, width - count[live]] = last[live, at[live]]
        at[live] -= back[live, at[live]]
        live = live[at[live] > 0]
    return out, count


def best_paths(tables: Tables, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out, count = viterbi(tables, codes, strict=False)
    ok = np.ones(len(codes), bool)
    width = codes.shape[1]
    for k in range(width):
        here = np.nonzero(k >= width - count)[0]
        ok[here] &= tables.proper[out[here, k]]
        pairs = here[k > width - count[here]]
        pairs = pairs[ok[pairs]]
        ok[pairs] &= tables.stays_apart(out[pairs, k - 1], out[pairs, k])
    redo = np.nonzero(~ok)[0]
    if len(redo):
        out[redo], count[redo] = viterbi(tables, codes[redo], strict=True)
    return out, count


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of stretches laid end to end."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


class Encoder:
    """Encodes blocks of texts; remembers a bounded number of stretches."""

    def __init__(self, tables: Tables):
        self.tables = tables
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def _learn(self, keys: np.ndarray, begins: np.ndarray, widths: np.ndarray, codes: np.ndarray) -> None:
        pool, start, size = [self.pool], np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at = len(self.pool)
        for width in np.unique(widths):
            group = np.nonzero(widths == width)[0]
            step = max(1, CELLS // int(width))
            for k in range(0, len(group), step):
                part = group[k : k + step]
                rows = codes[begins[part][:, None] + np.arange(width)]
                known = np.ones(len(part), bool)
                if width == 1:  # a character without a piece stands alone
                    known = self.tables.lookup(horner(rows)[:, 1], 1) >= 0
                ids = [np.zeros(0, np.int32)]
                if known.any():
                    out, count = best_paths(self.tables, rows[known])
                    size[part[known]] = count
                    ids.append(out[np.arange(width) >= (width - count)[:, None]])
                for n in np.nonzero(~known)[0]:
                    raw = np.frombuffer(chr(int(rows[n, 0])).encode(), np.uint8)
                    size[part[n]] = len(raw)
                    ids.append(self.tables.byte_ids[raw])
                order = np.concatenate([part[known], part[~known]])
                start[order] = at + np.cumsum(size[order]) - size[order]
                ids = np.concatenate(ids)
                pool.append(ids)
                at += len(ids)
        self.pool = np.concatenate(pool)
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.start = np.concatenate([self.start, start])[order]
        self.size = np.concatenate([self.size, size])[order]

    def encode(self, texts: list[str], fresh: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has. `fresh` says
        which ones begin a document and so get the leading space."""
        whole = [chr(SPACE) + t if f else t for t, f in zip(texts, fresh)]
        sizes = np.array([len(t) for t in whole], np.int64)
        if not sizes.sum():
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        codes = np.frombuffer("".join(whole).encode("utf-32-le"), np.uint32).astype(np.uint64)
        codes[codes == 32] = SPACE
        cut = np.ones(len(codes), bool)
        cut[1:] = ~self.tables.inside[pair_slot(codes[:-1], codes[1:])]
        first = np.cumsum(sizes) - sizes
        cut[first[sizes > 0]] = True
        begins = np.nonzero(cut)[0]
        widths = np.diff(np.append(begins, len(codes)))
        place = (np.arange(len(codes)) - np.repeat(begins, widths)).astype(np.int64)
        powers = np.ones(int(widths.max()) + 1, np.uint64)
        np.multiply.accumulate(np.full(int(widths.max()), BASE, np.uint64), out=powers[1:])
        keys = np.add.reduceat((codes + np.uint64(1)) * powers[place], begins)
        distinct, sample, which = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) > CACHE:
            self._forget()
        new = np.ones(len(distinct), bool)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, distinct), len(self.keys) - 1)
            new = self.keys[at] != distinct
        if new.any():
            self._learn(distinct[new], begins[sample[new]], widths[sample[new]], codes)
        at = np.searchsorted(self.keys, distinct)[which]
        ids = self.pool[ragged(self.start[at], self.size[at])]
        upto = np.concatenate([[0], np.cumsum(self.size[at])])
        at_text = np.searchsorted(begins, np.append(first, len(codes)))
        return ids, np.diff(upto[at_text])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each run of ids, with the leading space."""
        t = self.tables
        body = t.blob[ragged(t.blob_start[ids], t.blob_size[ids])].tobytes()
        upto = np.concatenate([[0], np.cumsum(t.blob_size[ids])])
        ends = upto[np.cumsum(counts)]
        return [body[a:b] for a, b in zip(upto[np.cumsum(counts) - counts], ends)]


def slices(text: str) -> list[str]:
    """A text in stretches of about BLOCK_CHARS that end before a space which
    follows another character."""
    out, begin = [], 0
    while len(text) - begin > BLOCK_CHARS:
        end = begin + BLOCK_CHARS
        while (end := text.find(" ", end)) >= 0 and text[end - 1] in (" ", chr(SPACE)):
            end += 1
        if end < 0:
            break
        out.append(text[begin:end])
        begin = end
    return [*out, text[begin:]]


def _run(shared, with_trip: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Tables.of(shared.value))
        for batch in batches:
            texts = batch.column("__text")
            n = batch.num_rows
            counts, trips, parts = np.zeros(n, np.int64), [None] * n, []
            block, owner, fresh, held = [], [], [], 0

            def flush() -> None:
                nonlocal block, owner, fresh, held
                ids, sizes = encoder.encode(block, fresh)
                np.add.at(counts, owner, sizes)
                parts.append(ids)
                if with_trip:
                    for k, i, f, body in zip(range(len(block)), owner, fresh, encoder.decode(ids, sizes)):
                        same = (body[1:] if f else body) == block[k].encode()
                        trips[i] = same if trips[i] is None else trips[i] and same
                block, owner, fresh, held = [], [], [], 0

            for i in range(n):
                if not texts[i].is_valid:
                    continue
                text = texts[i].as_py()
                if not text:
                    trips[i] = True
                    continue
                for k, part in enumerate(slices(text)):
                    block.append(part), owner.append(i), fresh.append(k == 0)
                    held += len(part)
                    if held >= BLOCK_CHARS:
                        flush()
            if block:
                flush()
            ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            valid = texts.is_valid()
            column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            column = pa.compute.if_else(valid, column, pa.scalar(None, column.type))
            rest = [batch.column(c) for c in batch.schema.names if c != "__text"]
            names = [c for c in batch.schema.names if c != "__text"]
            yield pa.record_batch(
                [*rest, column, pa.array(trips, pa.bool_())], names=[*names, "__ids", "__round_trip"]
            )

    return run


def encode(docs: DataFrame, model_path: str, check: bool = True, text: str = "text") -> DataFrame:
    """All columns of `docs` as a struct `__row`, with `__ids` and, if asked
    for, whether decoding gives the text again."""
    spark = docs.sparkSession
    with open(model_path, "rb") as f:
        shared = spark.sparkContext.broadcast(vars(Tables(f.read())))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(text).alias("__text")
    )
    kind = T.StructType([
        rows.schema["__row"], T.StructField("__ids", T.ArrayType(T.IntegerType())), T.StructField("__round_trip", T.BooleanType())
    ])
    return rows.mapInArrow(_run(shared, check), kind)


def decode(coded: DataFrame, model_path: str, ids: str = "token_ids", into: str = "text") -> DataFrame:
    """Adds the text of a column of ids."""
    spark = coded.sparkSession
    with open(model_path, "rb") as f:
        shared = spark.sparkContext.broadcast(vars(Tables(f.read())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Tables.of(shared.value))
        for batch in batches:
            out = []
            for cell in batch.column("__ids"):
                if not cell.is_valid:
                    out.append(None)
                    continue
                row = np.array(cell.as_py(), np.int32)
                body = encoder.decode(row, np.array([len(row)])) if len(row) else [b" "]
                out.append(body[0][1:].decode("utf-8", "replace"))
            yield pa.record_batch([batch.column("__row"), pa.array(out, pa.string())], names=["__row", "__text"])

    rows = coded.select(
        F.struct(*[F.col(f"`{c}`") for c in coded.columns]).alias("__row"), F.col(ids).alias("__ids")
    )
    back = rows.mapInArrow(run, T.StructType([rows.schema["__row"], T.StructField("__text", T.StringType())]))
    kept = [c for c in coded.columns if c != into]
    return back.select(*[F.col(f"__row.`{c}`").alias(c) for c in kept], F.col("__text").alias(into))


def token_ids(docs: DataFrame, model_path: str) -> DataFrame:
    """Digest for the query."""
    return encode(docs, model_path).select(
        F.col("__row.doc_id").alias("doc_id"), F.col("__ids").alias("token_ids"),
        F.coalesce(F.size("__ids"), F.lit(0)).cast("long").alias("n_tokens"),
        F.col("__round_trip").alias("round_trip"),
    )
