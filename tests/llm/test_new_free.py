"""Chat templates, spelling variants and periodic runs against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelweft.llm import chat, chat_template, periodic, queries, variants
from panelweft.llm.chat_template import TemplateError, compile_template

DOCS = "doc_id long, text string, lang string, source string, n_chars long, __text string, word string, n string"
sha = lambda text: hashlib.sha256(text.encode()).hexdigest()


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "a", len(t or ""), "x", "y", "z") for i, t in rows], DOCS)


# -- periodic runs ---------------------------------------------------------------


def plain_runs(w, least=24, times=3):
    """Every lag over every text; of equal stretches the smallest lag."""
    out = {}
    for q in range(1, len(w) // times + 1):
        i = q
        while i < len(w):
            begin = i
            while i < len(w) and w[i] == w[i - q]:
                i += 1
            if i - begin + q >= max(least, times * q):
                out.setdefault((begin - q, i - begin + q), q)
            i += 1
    return sorted(((s, z, q) for (s, z), q in out.items()), key=lambda r: (r[0], r[2]))


def made_text(rnd):
    w = []
    for _ in range(rnd.randint(0, 6)):
        kind = rnd.random()
        if kind < 0.3:
            w += [rnd.randint(0, 2) for _ in range(rnd.randint(0, 60))]
        elif kind < 0.9:
            block = [rnd.randint(0, rnd.choice([0, 1, 3, 50])) for _ in range(rnd.randint(1, rnd.choice([3, 20, 70])))]
            if w and rnd.random() < 0.5:
                at = rnd.randrange(len(w))
                block = w[at : at + rnd.randint(1, 70)]
            if rnd.random() < 0.3:
                block = block * rnd.randint(1, 4) + [rnd.randint(0, 2)]
            many = rnd.randint(1, rnd.choice([4, 12]))
            w += (block * many)[: len(block) * many - rnd.randint(0, len(block) - 1)]
        else:
            w += w[: rnd.randint(0, len(w))] * rnd.randint(1, 4)
    return w[:1500]


def test_runs_match_every_lag():
    rnd = random.Random(3)
    for _ in range(12):
        texts = [made_text(rnd) for _ in range(30)]
        flat = np.array([x for t in texts for x in t], np.int64)
        found = periodic.runs_of(flat, np.array([len(t) for t in texts]))
        got = defaultdict(list)
        for text, *run in zip(*(x.tolist() for x in found)):
            got[text].append(tuple(run))
        assert all(got[n] == plain_runs(t) for n, t in enumerate(texts))


def test_runs_of_a_million_words():
    for words in ([0] * 1_000_000, list(range(100)) * 10_000):
        _, start, length, period = periodic.runs_of(np.array(words), np.array([len(words)]))
        assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [len(words)], [len(set(words))])
    with pytest.raises(ValueError):
        periodic.runs_of(np.zeros(3, np.int64), np.array([3]), least=5)


def plain_report(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    lost = {i for s, z, q in runs for i in range(s + q, s + z)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{z},{q}\n" for s, z, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in lost)),
    )


REPORT = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_periodic_report_matches_plain_python(spark):
    rnd = random.Random(8)
    rows = [(i, "  ".join(f"w{x}é" for x in made_text(rnd)) + rnd.choice(["", "\n", "\x0b"])) for i in range(150)]
    rows += [(0, None), (None, None), (None, "a b " * 40), (900, ""), (901, " \n\t"), (902, "x\x1cy\x85 " * 30), rows[5], rows[5]]
    rows += [(903, "tie " * 24 + "other " * 24), (904, ("lorem ipsum dolor " * 40 + "stop ") * 300)]
    found = periodic.periodic_runs(docs_of(spark, rows), edit=periodic.repeat_some)
    got = periodic.run_report(found).select(*REPORT).collect()
    assert Counter(map(tuple, got)) == Counter(plain_report(*r) for r in rows)
    assert any(r["n_runs"] > 1 for r in got)
    empty = periodic.run_report(periodic.periodic_runs(docs_of(spark, []), edit=periodic.repeat_some))
    assert empty.count() == 0 and empty.columns[:8] == REPORT


def test_periodic_query_matches_plain_python(spark):
    folder = "/root/testdata/sf0.001"
    texts = [tuple(r) for r in queries.documents(spark, folder).select("doc_id", "text").collect()]
    got = queries.op13_periodic(spark, folder).select(*REPORT).collect()
    assert Counter(map(tuple, got)) == Counter(plain_report(*r) for r in texts)


# -- spelling variants -------------------------------------------------------------


def plain_vocabulary(rows):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def plain_forms(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return Counter(out)


FORMS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_forms_match_all_pairs(spark):
    rnd = random.Random(2)
    words = {}
    for _ in range(60):
        base = "".join(rnd.choice("aabcdéÿ") for _ in range(rnd.randint(6, 11)))
        words[base] = rnd.choice([5, 30, 200, 5000])
        for _ in range(rnd.randint(0, 8)):
            at, x = rnd.randrange(len(base)), rnd.choice("abcdé")
            new = rnd.choice([base[:at] + base[at + 1 :], base[:at] + x + base[at:], base[:at] + x + base[at + 1 :], base + x])
            if len(new) >= 6:
                words.setdefault(new, rnd.choice([5, 6, 25, 26, 150, 800, 4000, 20000]))
                base = rnd.choice([base, new])
    words |= {"a" * n: 5**n for n in range(6, 12)} | {"ababababab": 7, "abababababa": 40, "bababababab": 40}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = variants.spelling_forms(table.withColumn("near", F.lit(1))).select(*FORMS).collect()
    want = plain_forms(words)
    assert Counter(map(tuple, got)) == want
    assert sum(1 for r in got if r["form"] and r["root"] != r["form"]) > 5


def test_pivots_are_the_cheapest_disjoint_pair():
    rnd = random.Random(4)
    for _ in range(300):
        places = sorted(rnd.sample(range(12), rnd.randint(3, 8)))
        weight = dict(zip(places, (rnd.randint(1, 9) for _ in places)))
        chosen = variants.pivots(places, list(weight.values()))
        pairs = [(a, b) for a in places for b in places if b - a >= variants.Q]
        assert chosen in pairs and sum(weight[p] for p in chosen) == min(weight[a] + weight[b] for a, b in pairs)


def test_variants_of_hard_texts(spark):
    rows = [(1, None), (2, ""), (None, "Straße Straße straße STRASSE naïveté×÷ naïveté×÷ ÀÉÎÕÜ ŒŒŒŒŒŒ"), (3, "ab" * 100_000 + " kitten")]
    rows += [(i, f"recieve receive{' receive' * 9} résumés Résumés tie{'kitten ' * 2}{'mitten ' * 2}") for i in range(400)]
    rows += [rows[7], rows[7]]
    got = variants.vocabulary(docs_of(spark, rows), variants.lose_letters)
    assert {r["word"]: r["n"] for r in got.collect()} == plain_vocabulary(rows)
    found = variants.spelling_forms(got).select(*FORMS).collect()
    assert Counter(map(tuple, found)) == plain_forms(plain_vocabulary(rows))
    assert variants.spelling_forms(variants.vocabulary(docs_of(spark, []))).count() == 0


def test_variants_query_matches_plain_python(spark):
    folder = "/root/testdata/sf0.001"
    texts = [tuple(r) for r in queries.documents(spark, folder).select("doc_id", "text").collect()]
    got = queries.op12_variants(spark, folder).select(*FORMS).collect()
    assert Counter(map(tuple, got)) == plain_forms(plain_vocabulary(texts))


# -- chat formatting ------------------------------------------------------------------


def test_template_language():
    render = lambda source, **given: compile_template(source, names=given, constants={"mark": "#"}).render(**given)
    two = [{"role": "a", "n": 1}, {"role": "b", "n": 2}]
    assert render("{% for m in ms %}{{ m.role }}{{ loop.index }}{% if not loop.last %}, {% endif %}{% endfor %}", ms=two)[0] == "a1, b2"
    assert render("{{ 'x' if v in 'xyz' and v != 'z' else \"no\\n\" }}", v="z")[0] == "no\n"
    assert render("a {{- v['k'][1] -}} b{# no #}", v={"k": [1, 2]})[0] == "a2b"
    assert render("{% set x = 1 + 2 %}{{ x }}{{ '3' + x }}{{ v | trim }}", v=" t ")[0] == "333t"
    assert render("{% if v == 1 %}one{% elif v == 2 %}two{% else %}many{% endif %}", v=2)[0] == "two"
    assert render("p{% generation %}é{{ v }}{% endgeneration %}q", v="xy") == ("péxyq", [(1, 4)])
    assert render("{{ none }}{{ true }}{{ v.missing }}{{ v not in 'q' }}", v="w")[0] == "truetrue"


def test_constants_are_folded():
    tree = compile_template("a{{ mark + 'b' }}{% if mark == '#' %}c{% else %}{{ messages }}{% endif %}{{ 1 + 1 }}", constants={"mark": "#"}).tree
    assert tree == (chat_template.Write(chat_template.Const("a#bc2")),)
    kept = compile_template("{% set mark = messages[0] %}{{ mark }}", constants={"mark": "#"})
    assert kept.render(messages=["z"])[0] == "z"


@pytest.mark.parametrize(
    "source",
    ["{{ x }}", "{{ messages() }}", "{{ messages | eval }}", "{% for x in messages %}", "{% while true %}", "{{ 1 ++ }}", "{{ 'a' b }}",
     "{% if true %}{% endfor %}", "{{ messages.__class__.x + }}", "{% include 'f' %}", "{{ lambda }}", "{% endif %}"],
)
def test_bad_templates_are_refused(source):
    with pytest.raises(TemplateError):
        compile_template(source)


def test_the_sandbox_sees_no_attributes():
    show = compile_template("{{ messages.__class__ }}{{ messages['append'] }}{{ messages[0].upper }}")
    assert show.render(messages=["x"])[0] == ""
    with pytest.raises(TemplateError):
        compile_template("{{ messages }}").render(messages=[1])
    with pytest.raises(TemplateError):
        compile_template("{% for x in messages.keys %}{% endfor %}").render(messages={})
    grow = "{% set x = 'ab' %}" + "{% set x = x + x %}" * 40
    with pytest.raises(TemplateError):
        compile_template(grow + "{% set x = x + messages[0] %}").render(messages=["y"])


pieces_of_text = st.lists(st.sampled_from([*chat.CONTROL, "\\", "[", "<", "</", "s>", "INST]", " ", "\n", "é", "ok", "SYS>>"]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), pieces_of_text), pieces_of_text), max_size=5))
def test_formatting_is_reversible(turns):
    template = compile_template(chat.TEMPLATE, constants={"bos": chat.BOS, "eos": chat.EOS}, filters={"escape": chat.escaper()})
    text, spans = template.render(messages=[{"role": r, "text": t} for r, t in turns])
    assert list(chat.read_turns(text, True)) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    escape = chat.escaper()
    assert not any(c in escape(t) for _, t in turns for c in chat.CONTROL)


def plain_chat(rows):
    """conv_id -> digest; the formatted length from each turn by itself."""
    escape = chat.escaper()
    big, held = 1 << 62, defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv].append((turn if turn is not None else big, role or "", text or ""))
    extra = {"user": 15, "assistant": 5, "system": 15}
    out = Counter()
    for conv, turns in held.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        chars = 3 + sum(len(escape(t)) + (extra[r] if r in extra else 19 + len(escape(r))) for _, r, t in turns)
        out[conv, len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss), chars] += 1
    return out


CONVS = "conv_id long, turn long, role string, text string, part int, spans string"


def convs_of(spark, rows):
    return spark.createDataFrame([(*r, 7, "own") for r in rows], CONVS)


def test_conversations_match_plain_python(spark):
    rnd = random.Random(6)
    texts = ["</s>", "[INST] ok [/INST]", "\\", "plain", "", None, "ünï 😀", "<<SYS>>\\[INST]"]
    rows = [
        (rnd.randrange(20), rnd.randrange(9), rnd.choice(["user", "assistant", "system", "tool\n", None, "[TEXT]"]), "".join(filter(None, rnd.choices(texts, k=3))) or rnd.choice(texts))
        for _ in range(400)
    ]
    rows += [(None, 1, "user", "no id"), (None, None, "assistant", "last"), (50, 1, "assistant", "long " * 400_000), (50, 2, "user", "x")]
    rows += [(60, n, "assistant", f"turn {n} " * 30) for n in range(9000)] + [rows[3], rows[3], (70, 1, None, None)]
    rnd.shuffle(rows)
    formatted = chat.format_conversations(convs_of(spark, rows))
    assert Counter(map(tuple, chat.read_back(formatted).collect())) == plain_chat(rows)
    parts = formatted.where("conv_id in (50, 60)").select("conv_id", "part", "last", F.length("text").alias("size")).collect()
    assert {(r["conv_id"], r["part"], r["last"]) for r in parts} == {(50, 0, False), (50, 1, True), (60, 0, False), (60, 1, False), (60, 2, True)}
    assert chat.read_back(chat.format_conversations(convs_of(spark, []))).count() == 0


def test_chat_query_matches_plain_python(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    assert Counter(map(tuple, queries.op11_chat(spark, folder).collect())) == plain_chat(rows)
