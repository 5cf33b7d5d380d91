"""Quality rules, shards, fingerprints, mixing, licences on small tables."""

import hashlib
import re
import textwrap
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from panelweft.llm import fingerprints, license_texts, licenses, mixing, rules, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, __x string"


def docs_of(spark, rows):
    """(doc_id, text, lang, source) rows with columns whose names clash."""
    return spark.createDataFrame([(*r, len(r[1] or ""), "own", "own") for r in rows], SCHEMA)


PROSE = " ".join(f"word{n}" for n in range(60))
HARD = [
    (1, PROSE, "en", "a"),
    (1, PROSE, "en", "a"),
    (2, None, "en", None),
    (3, "", None, "b"),
    (None, "no id here", "de", "b"),
    (4, " \n\t ", "de", "b"),
    (5, "Ünï cödé 漢字 😀\n\nsame line\nsame line\n" + "a b c " * 40, "fr", "a"),
    (6, "x" * 200_000 + " tail", "fr", "a"),
    (7, "!! *** $$$ %%% && || <>" * 20, "en", "c"),
    (2, "same id other text", "en", "c"),
]

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(inside),
    )


def test_rules_match_plain_python(spark):
    got = rules.quality_rules(docs_of(spark, HARD)).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = Counter((r[0], *measured(r[1])) for r in HARD)
    assert Counter((r["doc_id"], *(r[c] for c in columns)) for r in got) == want
    for r in got:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_rules_keep_columns_and_handle_no_rows(spark):
    docs = docs_of(spark, HARD)
    kept = rules.keep_passing(docs, "v2")
    assert kept.columns == docs.columns
    assert [r["doc_id"] for r in kept.collect()] == [1, 1]
    assert rules.quality_rules(docs.limit(0)).count() == 0


def test_ablation_counts_sole_failures(spark):
    entries = spark.createDataFrame([(0,), (1,), (1,), (5,), (4,), (32,)], "fail_bits int")
    got = {r["rule"]: tuple(r)[1:] for r in rules.ablations(entries, "v1").collect()}
    assert got == {"few_words": (3, 2, 2), "repeated_words": (0, 0, 2), "symbols": (2, 1, 2)}


def test_versions_and_sole_rules(spark):
    menu = " ".join(f"home{n} | page{n}" for n in range(40))
    rows = [
        (1, PROSE, "en", "a"), (2, "a short note", "en", "a"), (3, None, "en", "a"), (4, menu, "en", "a"),
        (5, PROSE.upper(), "en", "a"), (6, "\n".join(f"- point{n} about{n}" for n in range(30)), "en", "a"),
        (7, "\n".join(f"read{n} more{n}…" for n in range(30)), "en", "a"),
        (8, " ".join(str(n) * 7 for n in range(90)), "en", "a"), (9, PROSE + "\n- one point\nmore ...\nand the end", "en", "a"),
    ]
    got = {r["doc_id"]: r for r in rules.quality_rules(docs_of(spark, rows)).collect()}
    assert {i: r["sole_rule"] for i, r in got.items()} == {
        1: None, 2: None, 3: "no_words", 4: "many_symbols", 5: "shouting", 6: "bullets", 7: "ellipses", 8: None, 9: None,
    }
    assert {i for i, r in got.items() if r["passes_v3"]} == {1, 2, 8, 9}
    assert {i for i, r in got.items() if r["kept"]} == {1, 8, 9}
    assert {i for i, r in got.items() if not r["passes_v2"]} == {2, 3}
    digits = 1 << [name for name, _ in rules.RULES].index("digits")
    assert {i for i, r in got.items() if r["fail_bits"] & digits} == {8}


def test_report_by_label_matches_counting(spark):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 0), (4, 0, 0), (4, 1, 0), (7, 0, 1), (None, 0, 0)], "doc_id long, quality int, toxic int"
    )
    docs = docs_of(spark, HARD)
    got = {(r["quality"], r["policy"], r["rule"]): tuple(r)[3:] for r in rules.labelled_report(docs, labels).collect()}
    quality = {1: 1, 4: 1, 7: 0}
    order = [name for name, _ in rules.RULES]
    entries = [(quality.get(r["doc_id"]), r["fail_bits"]) for r in rules.ledger(docs).collect()]
    want = {}
    for q in {q for q, _ in entries}:
        for policy, names in rules.POLICIES.items():
            mask, mine = rules.mask_of(policy), [bits for x, bits in entries if x == q]
            for name in names:
                bit = 1 << order.index(name)
                want[q, policy, name] = (
                    len(mine), sum(b & bit > 0 for b in mine), sum(b & mask == bit for b in mine), sum(b & mask == 0 for b in mine),
                )
    assert got == want
    assert rules.labelled_report(docs.limit(0), labels).count() == 0


def shards_of(spark, rows, **more):
    got = sharding.shard_by_bytes(docs_of(spark, rows), **more)
    return [r.asDict() for r in got.collect()]


@pytest.mark.parametrize("task_rows", [4_000_000, 7])
def test_shards_are_even_gapless_and_keep_copies(spark, task_rows):
    rows = [(n, f"text {n} " * (1 + n % 17), "en", "a") for n in range(600)]
    rows += [(1000 + n, "the same text", "en", "a") for n in range(300)]
    got = shards_of(spark, rows, shards=5, rows_per_task=task_rows)
    sizes, places = Counter(), {}
    for r in got:
        sizes[r["shard"]] += r["size"]
        places.setdefault(r["shard"], []).append(r["slot"])
    assert max(sizes.values()) - min(sizes.values()) <= 2 * 200
    assert all(sorted(x) == list(range(len(x))) for x in places.values())
    texts = {i: t for i, t, _, _ in rows}
    for r in got:
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 16
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
    singles = Counter(r["text_crc32"] for r in got)
    spread = {}
    for r in got:
        spread.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(spread[c]) == 1 for c, n in singles.items() if n < 100)


def test_one_hot_text_is_cut_by_id(spark):
    got = shards_of(spark, [(n, "hot", "en", "a") for n in range(400)], shards=4)
    assert sorted(Counter(r["shard"] for r in got).values()) == [100] * 4


def test_shards_of_hard_rows(spark):
    got = shards_of(spark, HARD, shards=3)
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in HARD)
    assert next(r["size"] for r in got if r["doc_id"] == 3) == 16
    assert shards_of(spark, [], shards=3) == []
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}


def plain_sketch(text, k=fingerprints.K):
    words = WORD.findall(text or "")
    if len(words) >= 5:
        runs = [words[i : i + 5] for i in range(len(words) - 4)]
    else:
        runs = [[" ".join(words)]] if words else []
    found = set()
    for run in runs:
        seed = 42
        for w in run:
            seed = xxhash.xxh64(w.encode(), seed=seed).intdigest()
        found.add(seed - (1 << 64) if seed >> 63 else seed)
    return sorted(found)[:k]


def plain_likeness(a, b, k=fingerprints.K):
    pool = sorted(set(a) | set(b))
    if len(a) >= k or len(b) >= k:
        pool = pool[:k]
    return len([x for x in pool if x in set(a) and x in set(b)]) / len(pool) if pool else 1.0


def test_fingerprints_match_plain_python(spark):
    rows = [(n * 7, " ".join(f"w{(n * 13 + i * (n % 5 + 1)) % 97}" for i in range(n * 3 % 700)), "en", "a") for n in range(900)]
    rows += [r for r in HARD if r[0] in (5, 6)]
    got = {r["doc_id"]: r for r in fingerprints.document_fingerprints(docs_of(spark, rows)).collect()}
    ordered = sorted(rows)
    written = lambda s: "".join(f"{x & (1 << 64) - 1:016X}" for x in s)
    for n, (i, text, *_) in enumerate(ordered):
        following = ordered[(n + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = map(plain_sketch, (text, edited, following))
        r = got[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == written(a) and r["edited_fingerprint"] == written(b)
        assert r["near_edited"] == plain_likeness(a, b) and r["near_next"] == plain_likeness(a, c)


def test_cells_of_uneven_ids(spark):
    ids = list(range(3000)) + [10**15, 10**18, 10**18 + 1, -(10**17)] + [77] * 3000 + [None] * 1500
    rows = [(i, f"text {n} of it", "en", "a") for n, i in enumerate(ids)] + [(5, "copy", "en", "a")] * 9
    docs = docs_of(spark, rows).select(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("__id"), F.xxhash64("text").alias("__h"), "text"
    )
    cells = docs.withColumn("__cell", F.array().cast("array<bigint>"))
    for crowded in fingerprints.in_cells(docs.select("__id", "__h"), 64):
        cells = fingerprints.to_cell(cells, crowded)
    got = sorted((tuple(r["__cell"]), r["__id"], r["__h"]) for r in cells.collect())
    assert [(i, h) for _, i, h in got] == sorted((i, h) for _, i, h in got)
    assert max(Counter(c for c, _, _ in got).values()) <= 256


def test_next_of_uneven_ids(spark):
    ids = list(range(1500)) + [10**15, 10**18, -(10**17)]
    texts = {i: f"one two three four five six {i}" for i in ids}
    got = {r["doc_id"]: r["__next"] for r in fingerprints.with_next(docs_of(spark, [(i, t, "en", "a") for i, t in texts.items()])).collect()}
    order = sorted(ids)
    assert got == {i: texts[order[(n + 1) % len(order)]] for n, i in enumerate(order)}


def test_fingerprints_of_hard_rows_and_parts(spark):
    got = fingerprints.document_fingerprints(docs_of(spark, HARD)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in HARD)
    assert fingerprints.document_fingerprints(docs_of(spark, [])).count() == 0
    one = fingerprints.document_fingerprints(docs_of(spark, [(1, "a b c d e f", "en", "a")])).first()
    assert one["near_next"] == 1.0
    words = [f"w{n}" for n in range(800)]
    parts = [("p", " ".join(words[a : a + 104])) for a in range(0, 800, 100)]
    table = spark.createDataFrame(parts, "doc_id string, text string")
    merged = fingerprints.merge_parts(fingerprints.sketches(table), "doc_id").first()["sketch"]
    assert merged == plain_sketch(" ".join(words))
    count = spark.range(1).select(fingerprints.distinct_count(F.array(*[F.lit(x) for x in merged]))).first()[0]
    assert abs(count - 796) < 250


def plan(spark, leaves, weights, total, epochs=1):
    table = spark.createDataFrame(leaves, "domain string, lang string, tokens long")
    rows = mixing.leaf_budgets(table, ["domain", "lang"], [F.expr(w) for w in weights], F.lit(total), epochs).collect()
    return {(r["domain"], r["lang"]): r["budget"] for r in rows}


def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = [("web", "en", 1000), ("web", "de", 10), ("books", "en", 1000), ("books", "de", 1000)]
    even = ["1", "1"]
    # web's German is short by 240: its sibling takes it, books gets no more
    assert plan(spark, leaves, even, 1000) == {
        ("web", "en"): 490, ("web", "de"): 10, ("books", "en"): 250, ("books", "de"): 250,
    }
    # all of web is short: books takes the rest
    short = [("web", "en", 100), ("web", "de", 10), ("books", "en", 1000), ("books", "de", 1000)]
    assert plan(spark, short, even, 1000) == {
        ("web", "en"): 100, ("web", "de"): 10, ("books", "en"): 445, ("books", "de"): 445,
    }
    # more asked for than there is; weight 0; rounding loses nothing
    assert sum(plan(spark, short, even, 10**9, 2).values()) == 2 * 2110
    assert plan(spark, short, ["1", "CASE lang WHEN 'de' THEN 0 ELSE 1 END"], 101)[("books", "de")] == 0
    assert sum(plan(spark, leaves, ["3", "7"], 1001).values()) == 1001


LEVELS = ["lang", "source"]


def plain_take(rows, budgets, seed):
    """(doc_id, epoch, taken) from the leaves' budgets."""
    out = Counter()
    for leaf, budget in budgets.items():
        mine = [r for r in rows if (r[2] or "-", r[3] or "-") == leaf]
        tokens = sum(len(WORD.findall(t or "")) for t in {(i, t): t for i, t, *_ in mine}.values())
        if not tokens:
            continue
        whole, rest = divmod(budget, tokens)
        name = lambda i: "" if i is None else str(i)
        for e in range(whole):
            out.update((i, e, len(WORD.findall(t or ""))) for i, t, *_ in mine)
        at = 0
        key = lambda r: (hashlib.md5(f"{seed}:{whole}:{name(r[0])}".encode()).hexdigest(), name(r[0]))
        for i, t, *_ in sorted(mine, key=key):
            if at < rest:
                out[(i, whole, min(len(WORD.findall(t or "")), rest - at))] += 1
            at += len(WORD.findall(t or ""))
    return out


def test_mix_matches_plain_python(spark):
    rows = [(n, " ".join("w" * (n % 3 + 1) for _ in range(n % 40)), "de" if n % 5 == 0 else "en", f"s{n % 3}") for n in range(300)]
    rows += [(400, None, None, None), (401, "one two", None, None)]
    docs = docs_of(spark, rows)
    weights = [F.lit(1), F.expr("CASE source WHEN 's1' THEN 5 ELSE 1 END")]
    mixed = mixing.mix(docs, LEVELS, weights, F.expr("tokens * 9 DIV 10"), 3, 5)
    assert mixed.columns[: len(docs.columns)] == docs.columns
    got = Counter((r["doc_id"], r["__epoch"], r["__take_tokens"]) for r in mixed.collect())
    leaves = docs.groupBy(*[F.coalesce(c, F.lit("-")).alias(c) for c in LEVELS]).agg(
        F.sum(mixing.token_count()).alias("tokens")
    )
    budgets = mixing.leaf_budgets(leaves, LEVELS, weights, F.expr("tokens * 9 DIV 10"), 3).collect()
    want = plain_take(rows, {(r["lang"], r["source"]): r["budget"] for r in budgets}, 5)
    assert got == want
    assert sum(r["budget"] for r in budgets) == sum(len(WORD.findall(t or "")) for _, t, *_ in rows) * 9 // 10


def test_mix_of_hard_and_no_rows(spark):
    weights = [F.lit(1), F.lit(1)]
    whole = mixing.mix(docs_of(spark, HARD), LEVELS, weights, F.col("tokens"), 1, 5).collect()
    # blank texts come along where their leaf gives a whole epoch
    assert Counter(r["doc_id"] for r in whole)[1] == 2
    assert mixing.mix(docs_of(spark, []), LEVELS, weights, F.col("tokens"), 1, 5).count() == 0


def test_licenses_are_found_and_inherited(spark):
    rows = [
        (1, "some code\nmore code\nReleased under the MIT License.", "src/a.txt", None),
        (2, "Licensed under the Apache License, Version 2.0.", "LICENSE", None),
        (3, "This work is licensed under the GNU General Public License, version 3.\nx", "src/deep/COPYING", None),
        (4, "nothing", "src/deep/er/b.txt", None),
        (5, None, "src/c.txt", None),
        (6, "", "other/d.txt", None),
        (7, "a licence to thrill, said the agent of the crown in his usual manner", "other/e.txt", None),
        (None, "nothing", "src/deep/er/b.txt", None),
        (4, "nothing", "src/deep/er/b.txt", None),
    ]
    files = spark.createDataFrame(rows, "doc_id long, text string, path string, license string")
    got = licenses.scan_licenses(files, F.col("path")).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    assert by_id[1]["license"] == "MIT" and not by_id[1]["from_dir"] and by_id[1]["own_license"] == "MIT"
    assert by_id[2]["is_license_file"] and by_id[3]["license"] == "GPL-3.0"
    assert (by_id[4]["license"], by_id[4]["from_dir"]) == ("GPL-3.0", "src/deep")
    assert (by_id[5]["license"], by_id[5]["from_dir"]) == ("Apache-2.0", "")
    assert by_id[7]["own_license"] is None and by_id[7]["n_notices"] == 1
    assert by_id[None]["license"] == "GPL-3.0"
    assert licenses.scan_licenses(files.limit(0), F.col("path")).count() == 0


def wrapped(text, width=70, mark=""):
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


def whole(name, kind="file"):
    return next(body for n, k, body in license_texts.TEMPLATES if (n, k) == (name, kind))


CODE = "\n".join(f"def step{n}(value{n}):\n    return value{n} + offset{n}" for n in range(40))


def test_license_files_and_wrapped_headers(spark):
    named = lambda name: whole(name).replace("Copyright (c)", "\n\nCopyright (c) 2021 Jane Roe and others\n\n")
    files = {name: named(name) for name in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib")}
    files["Unlicense"] = whole("Unlicense")
    rows = [(n, "\n\n".join(wrapped(x) for x in text.split("\n\n")), f"{name}/LICENSE") for n, (name, text) in enumerate(files.items())]
    gpl = "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n" + wrapped(PROSE * 30)
    rows += [(20, gpl, "GPL-3.0/COPYING"), (21, whole("Apache-2.0", "title") + "\n\n" + PROSE, "Apache-2.0/LICENSE")]
    heads = {"Apache-2.0": "# ", "GPL-3.0": " * ", "GPL-2.0": "// ", "LGPL-3.0": "-- ", "MPL-2.0": "; "}
    rows += [
        (30 + n, f"{mark}Copyright 2020 Some Body\n{mark}\n{wrapped(whole(name, 'header'), 60, mark)}\n\n{CODE}", f"src{n}/{name}.x")
        for n, (name, mark) in enumerate(heads.items())
    ]
    rows += [(50, f"{wrapped(whole('Apache-2.0', 'header'), 60, '# ')}\n\n{CODE}\n" * 400, "long/a.py"), (51, CODE, "long/b.py")]
    rows += [(60, CODE, f"{name}/sub/code.py") for name in files]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, path string"), F.col("path")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] < 30:
            assert r["is_license_file"] and r["license"] == r["path"].split("/")[0], r
        elif r["doc_id"] < 50:
            assert not r["is_license_file"] and r["license"] == r["path"].split("/")[1][:-2], r
        elif r["doc_id"] == 60:
            assert r["license"] == r["from_dir"] == r["path"].split("/")[0], r
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[50]["own_license"] == "Apache-2.0" and not by_id[50]["is_license_file"]
    assert by_id[51]["license"] is None


def test_equal_license_scores_take_the_smaller_name(spark):
    twice = (("B", "notice", "under the same licence"), ("A", "notice", "under the same licence"))
    rows = [(1, "under the same licence", "x/LICENSE"), (1, "under the same licence", "x/LICENSE"), (2, "other words", "x/y")]
    files = spark.createDataFrame(rows, "doc_id long, text string, path string")
    got = licenses.scan_licenses(files, F.col("path"), twice).collect()
    assert sorted((r["doc_id"], r["license"], r["is_license_file"]) for r in got) == [(1, "A", True), (1, "A", True), (2, "A", False)]
