"""Quality rules kept as a ledger of bits.

`ledger` evaluates every rule once per document and stores what it measured
and one bit per failed rule. Policies are masks over those bits: applying
another version, or asking what each rule changes, reads the ledger only.
A rule's bit never moves and a version never changes; new ones are added.

Words are maximal runs of characters other than space, tab, line feed,
vertical tab, form feed and carriage return. Null text counts as no words, so
does empty text; both fail `few_words` and `no_words`. Texts of any length are
read whole. Repeated rows are judged alike. An empty table gives an empty ledger
and an empty report. Extra input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"

#: (name, SQL condition of failing over the measurements); the bit is the place.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "n_symbols > n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("no_words", "n_words < 1"),
    ("many_symbols", "10 * n_symbols > n_words"),
    ("shouting", "n_words >= 10 AND n_capitals > n_small"),
    ("ellipses", "10 * n_ellipsis_lines > 3 * n_lines"),
    ("bullets", "10 * n_bullet_lines > 9 * n_lines"),
    ("digits", "3 * n_digits > word_chars"),
)
#: Versioned policies: the rules that each of them enforces. By the report on
#: labelled documents `few_words` costs v1 and v2 many good documents for few bad
#: ones, and by the ledger `digits` fails more good than bad; v3 does without them.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols"),
    "v2": ("few_words", "repeated_words", "symbols", "repeated_lines", "short_words", "long_words"),
    "v3": (
        "no_words", "repeated_words", "many_symbols", "repeated_lines", "short_words", "long_words",
        "shouting", "ellipses", "bullets",
    ),
}
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
BULLETS = ("-", "*", "•")
#: What the ledger measures.
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_capitals", "n_small", "n_digits", "n_ellipsis_lines", "n_bullet_lines",
)


def mask_of(policy: str) -> int:
    """The bits that a policy enforces."""
    order = [name for name, _ in RULES]
    return sum(1 << order.index(name) for name in POLICIES[policy])


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for null and blank texts."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_RUN))


def ledger(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id, the measurements, and `fail_bits`.

    A repeated word is one inside a window of three words that the text holds
    twice or more; the windows are sorted by hash inside the row, so the work
    is n log n in the length of a text, however repetitive it is.
    """
    count = lambda chars: (
        F.length("__text") - F.length(F.translate("__text", chars, ""))
    ).cast("long")
    bare = lambda line: F.btrim(line, F.lit(BLANKS))
    ends = lambda line: bare(line).endswith("...") | bare(line).endswith("…")
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("__text"),
    ).withColumn("__words", words_of(F.col("__text")))
    sized = base.select(
        "doc_id",
        "__words",
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"),
        count(CAPITALS).alias("n_capitals"),
        count(CAPITALS.lower()).alias("n_small"),
        count(DIGITS).alias("n_digits"),
        F.filter(F.split("__text", "\n"), lambda line: bare(line) != "").alias("__lines"),
    )
    windows = sized.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_capitals",
        "n_small",
        "n_digits",
        F.size("__lines").cast("long").alias("n_lines"),
        F.size(F.filter("__lines", ends)).cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter("__lines", lambda x: F.substring(bare(x), 1, 1).isin(*BULLETS)))
        .cast("long")
        .alias("n_bullet_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            "CASE WHEN n_words < 3 THEN array() ELSE sort_array(transform("
            "sequence(0, size(__words) - 3), i -> struct("
            "xxhash64(__words[i], __words[i + 1], __words[i + 2]) AS h, i AS i))) END"
        ).alias("__windows"),
    )
    measured = windows.withColumn(
        "__starts",
        F.expr(
            "transform(filter(__windows, (x, k) -> x.h <=> get(__windows, k - 1).h"
            " OR x.h <=> get(__windows, k + 1).h), x -> x.i)"
        ),
    ).withColumn(
        "n_repeat_words",
        F.expr("size(array_distinct(flatten(transform(__starts, i -> array(i, i + 1, i + 2)))))")
        .cast("long"),
    )
    bits = sum(
        (F.when(F.expr(cond), F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, cond) in enumerate(RULES)),
        F.lit(0),
    )
    return measured.select("doc_id", *MEASURES, bits.cast("int").alias("fail_bits"))


def apply_policy(entries: DataFrame, policy: str) -> DataFrame:
    """Adds `kept` and the policy's name; the bits are not evaluated again."""
    return entries.withColumn("policy", F.lit(policy)).withColumn(
        "kept", F.col("fail_bits").bitwiseAND(F.lit(mask_of(policy))) == 0
    )


def policy_report(entries: DataFrame, policies=tuple(POLICIES), by: tuple[str, ...] = ()) -> DataFrame:
    """by, policy, rule, n_docs, n_failed, n_failed_alone, n_kept: what each rule
    of each policy does: documents that fail it, and documents that fail nothing
    else and so would be kept without it.

    Rows are first counted by their bits (2**rules groups at most, summed
    before the shuffle), and all policies and rules read those counts.
    """
    order = [name for name, _ in RULES]
    counts = entries.groupBy(*by, "fail_bits").agg(F.count(F.lit(1)).alias("__n"))
    return _report(counts, [(p, mask_of(p), r, 1 << order.index(r)) for p in policies for r in POLICIES[p]], by)


def _report(counts: DataFrame, enforced: list[tuple[str, int, str, int]], by: tuple[str, ...]) -> DataFrame:
    """The report from counts by bits: (by, fail_bits, __n)."""
    rules = F.explode(
        F.array(*[
            F.struct(F.lit(p).alias("policy"), F.lit(m).alias("mask"), F.lit(r).alias("rule"), F.lit(bit).alias("bit"))
            for p, m, r, bit in enforced
        ])
    )
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("__n"))), F.lit(0))
    caught = F.col("fail_bits").bitwiseAND(F.col("__rule.mask"))
    return (
        counts.withColumn("__rule", rules)
        .groupBy(*by, F.col("__rule.policy").alias("policy"), F.col("__rule.rule").alias("rule"))
        .agg(
            F.sum("__n").alias("n_docs"),
            total(F.col("fail_bits").bitwiseAND(F.col("__rule.bit")) != 0).alias("n_failed"),
            total(caught == F.col("__rule.bit")).alias("n_failed_alone"),
            total(caught == 0).alias("n_kept"),
        )
    )


def ablations(entries: DataFrame, policy: str) -> DataFrame:
    """rule, n_failed, n_failed_alone, n_kept: the report of one policy."""
    return policy_report(entries, (policy,)).drop("policy", "n_docs")


def labelled_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The report of all policies by `quality` of the labels (null: no label;
    of several labels of a document the highest). Documents are counted by id and
    bits before they meet the labels, so repeated and null ids are few rows."""
    marks = labels.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    found = ledger(docs).groupBy("doc_id", "fail_bits").agg(F.count(F.lit(1)).alias("__n"))
    order = [name for name, _ in RULES]
    counts = found.join(marks, "doc_id", "left").groupBy("quality", "fail_bits").agg(F.sum("__n").alias("__n"))
    return _report(counts, [(p, mask_of(p), r, 1 << order.index(r)) for p in POLICIES for r in POLICIES[p]], ("quality",))


def sole_rule(policy: str) -> Column:
    """The rule without which a policy would keep the document; else null."""
    caught = F.col("fail_bits").bitwiseAND(F.lit(mask_of(policy)))
    order = [name for name, _ in RULES]
    return F.coalesce(*[F.when(caught == (1 << order.index(r)), r) for r in POLICIES[policy]])


def keep_passing(docs: DataFrame, policy: str, text: str = "text") -> DataFrame:
    """The documents that a policy keeps, with the columns they came with.

    Each row is measured where it lies: the ledger rides along in the row, so
    nothing is joined back. The row number in the condition keeps the planner
    from moving it below the measurements, where it would repeat all of them.
    """
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc_id"), F.col(text).alias("text"))
    judged = apply_policy(ledger(packed), policy).withColumn("__row", F.monotonically_increasing_id())
    judged = judged.where(F.col("kept") & (F.col("__row") >= 0))
    return judged.select(*[F.col(f"doc_id.`{c}`").alias(c) for c in names])


def quality_rules(docs: DataFrame, policy: str = "v3") -> DataFrame:
    """The contract's digest: measurements, the base verdict, the policy's
    verdict, and beside them the ledger, every version's verdict and the rule
    that decided alone."""
    judged = apply_policy(ledger(docs), policy)
    passes = lambda name: F.col("fail_bits").bitwiseAND(F.lit(mask_of(name))) == 0
    return judged.select(
        "doc_id",
        *MEASURES,
        (~passes("base")).alias("base_failed"),
        (F.col("kept") & passes("base")).alias("kept"),
        "fail_bits",
        "policy",
        *[passes(name).alias(f"passes_{name}") for name in POLICIES if name != "base"],
        sole_rule(policy).alias("sole_rule"),
    )
