"""Secret scan over a trigram index.

From each rule's regex follows a Boolean query of trigrams that every match
must hold: an AND of clauses, each an OR of literal alternatives, each the AND
of its trigrams. The index has a posting for every document and every trigram
that some rule asks for. A rule's postings are intersected and united, and only
the documents left are searched with its regex. Rules whose regex demands no
trigram are searched in all documents, while these are read for the index.

Matches are leftmost and do not overlap within a kind; a match that is too
short is dropped after it was found. Positions count code points, ends are
exclusive. Null texts count as empty: no spans. Null ids are one id. Rows equal
in id and text have equal spans. An empty table gives an empty result. Extra
input columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweft.scale import bounded, materialise

try:
    from re import _constants as op, _parser as parser
except ImportError:  # before Python 3.11
    import sre_constants as op
    import sre_parse as parser

MOST_ALTERNATIVES = 12  # literal alternatives followed at once


@dataclass(frozen=True)
class Rule:
    """`least` is the shortest match, `least_value` the shortest `value` group."""

    kind: str
    pattern: str
    flags: int = re.ASCII
    least: int = 0
    value: int = 0
    least_value: int = 0

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        for m in re.compile(self.pattern, self.flags).finditer(text):
            if m.end() - m.start() >= self.least and len(m[self.value]) >= self.least_value:
                yield m.start(), m.end()


ASSIGNMENT = (
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
BASE_RULES = (
    Rule("assign", ASSIGNMENT, re.ASCII | re.IGNORECASE, value=2, least_value=8),
    Rule("access", "AKIA[A-Z0-9]+", least=16),
    Rule("hex", "[0-9a-f]+", least=32),
)
RULES = BASE_RULES + (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]{24,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

Clause = tuple[frozenset[str], ...]


def trigrams(literal: str) -> frozenset[str]:
    return frozenset(literal[i : i + 3] for i in range(len(literal) - 2))


def _clause(literals: set[str]) -> list[Clause]:
    """The clause that one of some literals occurs; none if one is too short."""
    sets = {trigrams(x) for x in literals}
    return [] if frozenset() in sets else [tuple(sorted(sets, key=sorted))]


def _walk(tree, heads: set[str]) -> tuple[set[str], list[Clause], bool]:
    """Follows a sequence of regex nodes from the literals that may stand right
    before it. Returns the literals that may stand at its end, the clauses met,
    and whether the literals are all that it can match."""
    clauses: list[Clause] = []
    plain = True

    def stop() -> None:
        """What came so far makes a clause; what follows starts anew."""
        nonlocal heads, plain
        clauses.extend(_clause(heads))
        heads, plain = {""}, False

    def extend(tails: set[str]) -> None:
        nonlocal heads
        if len(heads) * len(tails) > MOST_ALTERNATIVES:
            stop()
        heads = {a + b for a in heads for b in tails}
        if len(tails) > MOST_ALTERNATIVES:
            stop()

    def either(ways: list[tuple[set[str], list[Clause], bool]]) -> None:
        if all(whole for _, _, whole in ways):
            extend(set().union(*(tails for tails, _, _ in ways)))
        else:  # one way is no plain literal, so nothing is sure
            stop()

    for kind, value in tree:
        if kind is op.LITERAL:
            extend({chr(value).lower()})
        elif kind is op.IN and all(k is op.LITERAL for k, _ in value):
            extend({chr(c).lower() for _, c in value})
        elif kind is op.SUBPATTERN:
            heads, inner, whole = _walk(value[3], heads)
            clauses.extend(inner)
            plain = plain and whole
        elif kind is op.BRANCH:
            either([_walk(way, {""}) for way in value[1]])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            least, most, body = value
            if (least, most) == (0, 1):
                either([_walk(body, {""}), ({""}, [], True)])
                continue
            for _ in range(min(least, 3)):  # three times a character make a trigram
                heads, inner, whole = _walk(body, heads)
                clauses.extend(inner)
                plain = plain and whole
            if most > min(least, 3):
                stop()
        elif kind is not op.AT:
            stop()
    return heads, clauses, plain


def trigram_query(rule: Rule) -> list[Clause]:
    """The clauses that hold in the lower-cased text of every match. Empty if
    the regex demands no trigram."""
    heads, clauses, _ = _walk(parser.parse(rule.pattern), {""})
    return list(dict.fromkeys(clauses + _clause(heads)))


def vocabulary(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({g for r in rules for clause in trigram_query(r) for way in clause for g in way})


SPANS = "array<struct<start:int,kind:int,end:int>>"
_span_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))


def _search(text: str, rules: tuple[Rule, ...], kinds) -> list[dict]:
    return [{"start": a, "kind": k, "end": b} for k in kinds for a, b in rules[k].spans(text)]


def _index(rules: tuple[Rule, ...]):
    words = vocabulary(rules)
    full = [k for k, r in enumerate(rules) if not trigram_query(r)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, spans = [], []
            for text in batch.column("__text"):
                whole = text.as_py()
                low = whole.lower()
                grams.append([n for n, g in enumerate(words) if g in low])
                spans.append(_search(whole, rules, full))
            yield pa.record_batch(
                [*(batch.column(c) for c in ("doc_id", "__id", "__h")), pa.array(grams, pa.list_(pa.int32())), pa.array(spans, _span_type)],
                names=["doc_id", "__id", "__h", "grams", "spans"],
            )

    return run


def _verify(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                _search(text.as_py(), rules, kinds.as_py())
                for text, kinds in zip(batch.column("__text"), batch.column("kinds"))
            ]
            yield pa.record_batch(
                [batch.column("__id"), batch.column("__h"), pa.array(spans, _span_type)], names=["__id", "__h", "more"]
            )

    return run


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(__id, __h, kinds): the documents that satisfy a rule's trigram query,
    from the postings of its trigrams."""
    words = {g: n for n, g in enumerate(vocabulary(rules))}
    asked = [
        (k, c, w, words[g], len(way), len(clauses))
        for k, clauses in ((k, trigram_query(r)) for k, r in enumerate(rules))
        for c, clause in enumerate(clauses)
        for w, way in enumerate(clause)
        for g in way
    ]
    spark = index.sparkSession
    # one row for each trigram of the rules, a parameter of the scan
    terms = F.broadcast(spark.createDataFrame(asked, "kind int, clause int, way int, gram int, n_grams int, n_clauses int"))
    postings = index.select(F.explode("grams").alias("gram"), "__id", "__h").distinct()
    ways = (
        postings.join(terms, "gram")
        .groupBy("__id", "__h", "kind", "clause", "way")
        .agg(F.count(F.lit(1)).alias("n"), F.first("n_grams").alias("n_grams"), F.first("n_clauses").alias("n_clauses"))
        .where("n = n_grams")
    )
    held = ways.groupBy("__id", "__h", "kind").agg(
        F.size(F.collect_set("clause")).alias("n"), F.first("n_clauses").alias("n_clauses")
    )
    return held.where("n = n_clauses").groupBy("__id", "__h").agg(F.sort_array(F.collect_set("kind")).alias("kinds"))


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, spans (array of start, kind as number, end; sorted): one row per
    input row."""
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(id_col), F.lit((1 << 63) - 1)).cast("long").alias("__id"),
        F.xxhash64(text).alias("__h"), F.coalesce(F.col(text), F.lit("")).alias("__text"),
    )
    id_type = docs.schema[id_col].dataType.simpleString()
    index = materialise(
        base.mapInArrow(_index(rules), f"doc_id {id_type}, __id long, __h long, grams array<int>, spans {SPANS}"), "trigrams"
    )
    asked = bounded(candidates(index, rules))
    found = bounded(
        base.select("__id", "__h", "__text").join(asked, ["__id", "__h"])
        .mapInArrow(_verify(rules), f"__id long, __h long, more {SPANS}")
        .where(F.size("more") > 0).dropDuplicates(["__id", "__h"])
    )
    none = F.array().cast(SPANS)
    return index.join(found, ["__id", "__h"], "left").select(
        "doc_id", F.sort_array(F.concat("spans", F.coalesce("more", none))).alias("spans")
    )


def secret_scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The contract's digest: counts of the base kinds, their checksum, spans."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )
    of_kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return find_secrets(docs, rules).select(
        "doc_id",
        *[of_kind(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE_RULES)],
        F.sha2(written(F.filter("spans", lambda s: s["kind"] < len(BASE_RULES))).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
