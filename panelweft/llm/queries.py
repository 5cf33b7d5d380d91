"""The registered queries of this subpackage: name -> (function, SQL or None)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweft.llm import (
    chat,
    fingerprints,
    licenses,
    line_dedup,
    mixing,
    near_dedup,
    periodic,
    pieces,
    quality_model,
    rules,
    secrets,
    sharding,
    variants,
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# -- 1: line dedup -----------------------------------------------------------


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(documents(spark, sf_dir))


def _op1_sql() -> str:
    base, prime = line_dedup.BASE, line_dedup.PRIME
    return f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text <> ''),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT % {prime} AS h FROM l),
m AS (SELECT *, (coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0) * {base} + h) % {prime} % {line_dedup.AVERAGE} = 0
  AND i >= 2 AND i <= count(*) OVER (PARTITION BY doc_id) - 2 AS may FROM h),
r AS (SELECT *, strlen(line) >= {line_dedup.LONG} OR coalesce(strlen(lead(line) OVER w) >= {line_dedup.LONG}, false)
    OR (may AND NOT coalesce(lag(may) OVER w, false)) AS ends FROM m WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
c AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM r),
k AS (SELECT doc_id, c, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS n,
  count(*) > 1 OR max(strlen(line)) >= {line_dedup.LONG} AS whole FROM c GROUP BY 1, 2),
f AS (SELECT *, whole AND row_number() OVER (PARTITION BY body, whole ORDER BY doc_id, c) > 1 AS lost FROM k),
o AS (SELECT doc_id, coalesce(string_agg(body, chr(10) ORDER BY c) FILTER (NOT lost), '') AS text,
  coalesce(sum(n) FILTER (lost), 0)::BIGINT AS n_lost_lines, sum(n)::BIGINT AS n_lines FROM f GROUP BY 1)
SELECT d.doc_id, CASE WHEN d.text = '' THEN '' ELSE o.text END AS text,
  coalesce(n_lines, (d.text IS NOT NULL)::BIGINT) AS n_lines, coalesce(n_lost_lines, 0) AS n_lost_lines
FROM documents d LEFT JOIN o USING (doc_id)
"""

# -- 2: mixing ---------------------------------------------------------------

LEVELS = ["domain", "lang", "source"]
DOMAIN = (
    "CASE WHEN source IN ('src0', 'src3', 'src6', 'src9', 'src12') THEN 'web'"
    " WHEN source IN ('src1', 'src4', 'src7', 'src10', 'src13', 'src16') THEN 'books'"
    " ELSE 'news' END"
)
DOMAIN_WEIGHT = "CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 ELSE 2 END"
LANG_WEIGHT = "CASE lang WHEN 'en' THEN 4 WHEN 'es' THEN 1 ELSE 2 END"
SOURCE_WEIGHT = "CASE source WHEN 'src0' THEN 3 ELSE 1 END"
MIX_EPOCHS, MIX_SEED = 2, 17
MIX_TOTAL = "tokens * 3 DIV 5"


def with_domain(docs: DataFrame) -> DataFrame:
    return docs.withColumn("domain", F.expr(DOMAIN))


def weights():
    return [F.expr(w) for w in (DOMAIN_WEIGHT, LANG_WEIGHT, SOURCE_WEIGHT)]


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(
        with_domain(documents(spark, sf_dir)), LEVELS, weights(), F.expr(MIX_TOTAL), MIX_EPOCHS, MIX_SEED
    )
    return mixed.select(
        "doc_id", *LEVELS, F.col("__epoch").alias("epoch"), F.col("__n_tokens").alias("n_tokens"),
        F.col("__take_tokens").alias("take_tokens"),
    )


def _share_sql(depth: int) -> str:
    """The budgets of one level, from those of the level above."""
    names = LEVELS[: depth + 1]
    up, cols, me = names[:-1], ", ".join(names), names[-1]
    over = f"PARTITION BY {', '.join(up)}" if up else ""
    weight = (DOMAIN_WEIGHT, LANG_WEIGHT, SOURCE_WEIGHT)[depth]
    upto = f"({over} ORDER BY ratio, {me} ROWS UNBOUNDED PRECEDING)"
    source = f"b{depth - 1} p JOIN n{depth} n USING ({', '.join(up)})" if up else f"n{depth} n, total p"
    return f"""
n{depth} AS (SELECT {cols}, sum(tokens)::HUGEINT AS tokens, sum(tokens)::HUGEINT * {MIX_EPOCHS} AS capacity,
  ({weight})::HUGEINT AS weight FROM leaves GROUP BY {cols}),
r{depth} AS (SELECT n.*, p.budget AS given, capacity * 1000000 // weight AS ratio FROM {source}),
f{depth} AS (SELECT *, (sum(capacity) OVER {upto})::HUGEINT * weight
    + capacity * (sum(weight) OVER ({over}) - sum(weight) OVER {upto})::HUGEINT <= given * weight OR capacity = 0 AS is_full
  FROM r{depth}),
s{depth} AS (SELECT *, coalesce(sum(weight) FILTER (NOT is_full) OVER ({over}), 0)::HUGEINT AS open_weight,
    given - coalesce(sum(capacity) FILTER (is_full) OVER ({over}), 0)::HUGEINT AS rest FROM f{depth}),
p{depth} AS (SELECT *, CASE WHEN is_full THEN capacity ELSE weight * rest // greatest(open_weight, 1) END AS part,
    row_number() OVER (PARTITION BY {', '.join([*up, 'is_full'])} ORDER BY {me}) AS place FROM s{depth}),
b{depth} AS (SELECT {cols}, tokens, part + CASE WHEN NOT is_full AND place <=
    rest - coalesce(sum(part) FILTER (NOT is_full) OVER ({over}), 0) THEN 1 ELSE 0 END AS budget FROM p{depth})"""


WORDS_SQL = (
    "CASE WHEN trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = '' THEN []"
    " ELSE string_split_regex(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\\x20\\x09-\\x0D]+') END"
)

OP2_SQL = f"""
WITH d AS (SELECT doc_id, {DOMAIN} AS domain, lang, source, len({WORDS_SQL})::BIGINT AS n_tokens FROM documents),
leaves AS (SELECT {', '.join(LEVELS)}, sum(n_tokens) AS tokens FROM d GROUP BY ALL),
total AS (SELECT (sum(tokens) * 3 // 5)::HUGEINT AS budget FROM leaves),
{_share_sql(0)}, {_share_sql(1)}, {_share_sql(2)},
plan AS (SELECT *, (budget // greatest(tokens, 1))::BIGINT AS epochs,
  CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest FROM b2),
o AS (SELECT d.*, epochs, rest, md5('{MIX_SEED}:' || epochs || ':' || doc_id) AS k
  FROM d JOIN plan USING ({', '.join(LEVELS)})),
c AS (SELECT *, sum(n_tokens) OVER (PARTITION BY {', '.join(LEVELS)} ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) - n_tokens AS begins FROM o)
SELECT doc_id, {', '.join(LEVELS)}, unnest(range(epochs)) AS epoch, n_tokens, n_tokens AS take_tokens FROM c
UNION ALL
SELECT doc_id, {', '.join(LEVELS)}, epochs, n_tokens, least(n_tokens, rest - begins)::BIGINT FROM c WHERE begins < rest
"""

# -- 3: licences -------------------------------------------------------------


def document_path():
    """Documents as files: source, language, then a folder for each digit of
    the id, so that short ids lie above long ones."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    digits = F.regexp_replace(F.regexp_extract(name("doc_id"), "^(.*).$", 1), "(.)", "$1/")
    return F.concat(name("source"), F.lit("/"), name("lang"), F.lit("/"), digits, name("doc_id"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir), document_path())


def _op3_sql() -> str:
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"({n}, {', '.join(map(quoted, t))})" for n, t in enumerate(licenses.TEMPLATES))
    says = f"regexp_matches(lower(x), '{licenses.TRIGGER}')"
    size = f"((SELECT coalesce(sum(n), 0) FROM n) + {len(licenses.TEMPLATES)} + 1)"
    return f"""
WITH f AS (SELECT doc_id, coalesce(source, '-') || '/' || coalesce(lang, '-') || '/'
    || regexp_replace(regexp_extract(doc_id::VARCHAR, '^(.*).$', 1), '(.)', '\\1/', 'g') || doc_id AS path,
  CASE WHEN regexp_matches(lower(text), '{licenses.TRIGGER}') THEN regexp_replace(text, '{licenses.MARKS}', '\\1', 'g') END AS bare
  FROM documents),
l AS (SELECT doc_id, path, bare,
  coalesce(list_transform(list_filter(flatten(list_transform(list_filter(string_split(bare, chr(10)), lambda x: {says}),
    lambda x: string_split(regexp_replace(x, '([.!?])[ \\t]+', '\\1' || chr(10), 'g'), chr(10)))),
    lambda x: {says}), lambda x: trim(x, {blank})), []) AS notices,
  list_filter(string_split_regex(bare, '{licenses.PARAGRAPH}'), lambda x: trim(x, {blank}) <> '') AS paragraphs FROM f),
p AS (SELECT path, unnest(list_distinct(notices || list_filter(paragraphs, lambda x, i: i = 1 OR {says}) || [bare])) AS body
  FROM l WHERE bare IS NOT NULL),
n AS (SELECT body, count(*) AS n FROM (SELECT unnest(notices) AS body FROM l) GROUP BY 1),
d AS (SELECT body, coalesce(n, 0) AS n FROM (SELECT DISTINCT body FROM p) LEFT JOIN n USING (body)),
t(id, name, kind, body) AS (VALUES {known}),
nt AS (SELECT body, n, unnest(regexp_extract_all(lower(body), '{licenses.TERM}')) AS term FROM d),
nv AS (SELECT body, term, n, count(*) AS tf FROM nt GROUP BY ALL),
tt AS (SELECT id, name, kind, unnest(regexp_extract_all(lower(body), '{licenses.TERM}')) AS term FROM t),
tv AS (SELECT id, name, kind, term, count(*) AS tf FROM tt GROUP BY ALL),
df AS (SELECT term, sum(n) AS df FROM (SELECT term, n FROM nv WHERE n > 0 UNION ALL SELECT term, 1 FROM tv) GROUP BY 1),
idf AS (SELECT term, ln({size} / (df + 1)) + 1 AS idf FROM df),
nw AS (SELECT body, term, tf * coalesce(idf, ln({size}) + 1) AS w FROM nv LEFT JOIN idf USING (term)),
tw AS (SELECT id, name, kind, term, tf * idf AS w FROM tv JOIN idf USING (term)),
nn AS (SELECT body, sqrt(sum(w * w)) AS norm FROM nw GROUP BY 1),
tn AS (SELECT id, sqrt(sum(w * w)) AS norm FROM tw GROUP BY 1),
c AS (SELECT nw.body, tw.id, tw.name, tw.kind, round(sum(nw.w * tw.w) / any_value(nn.norm * tn.norm), 6) AS score
  FROM nw JOIN tw USING (term) JOIN nn ON nn.body = nw.body JOIN tn ON tn.id = tw.id GROUP BY ALL),
o AS (SELECT path, name, score FROM p JOIN c USING (body) WHERE kind <> 'title' AND score >= {licenses.MIN_COSINE}
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY score DESC, name) = 1),
y AS (SELECT path, name, score FROM l JOIN c ON (c.body = l.bare AND kind IN ('notice', 'file'))
    OR (c.body = l.paragraphs[1] AND kind = 'title') WHERE score >= {licenses.MIN_FILE}
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY score DESC, name) = 1),
w AS (SELECT doc_id, path, len(notices)::BIGINT AS n_notices, coalesce(y.name, o.name) AS own_license,
  coalesce(y.score, o.score) AS score, y.name IS NOT NULL AS is_license_file,
  regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir FROM l LEFT JOIN o USING (path) LEFT JOIN y USING (path)),
s AS (SELECT dir, own_license AS license FROM w WHERE is_license_file
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, path) = 1),
g AS (SELECT d.dir, s.dir AS from_dir, s.license FROM (SELECT DISTINCT dir FROM w) d
  JOIN s ON d.dir = s.dir OR s.dir = '' OR starts_with(d.dir, s.dir || '/')
  QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY length(s.dir) DESC) = 1)
SELECT doc_id, path, n_notices, own_license, score, is_license_file, coalesce(own_license, license) AS license,
  CASE WHEN own_license IS NULL THEN from_dir END AS from_dir
FROM w LEFT JOIN g USING (dir)
"""

# -- 4: shards ---------------------------------------------------------------


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(documents(spark, sf_dir), shards=40)


# -- 5: secrets --------------------------------------------------------------


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(documents(spark, sf_dir))


# -- 6: quality classifier ---------------------------------------------------


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.quality_scores(documents(spark, sf_dir), labels)


# -- 7: fingerprints ---------------------------------------------------------


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(documents(spark, sf_dir))


# -- 8: pieces ---------------------------------------------------------------

#: Where the public vocabulary lies; a parameter of the operator.
MODEL_PATH = os.environ.get("PANELWEFT_PIECES", "/opt/tokenizers/piece_bpe_32k.model")


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.token_ids(documents(spark, sf_dir), MODEL_PATH)


# -- 9: quality rules --------------------------------------------------------


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(documents(spark, sf_dir))


def rules_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy does to labelled and other documents."""
    return rules.labelled_report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _ledger_sql() -> str:
    conditions = " + ".join(f"CASE WHEN {cond} THEN {1 << k} ELSE 0 END" for k, (_, cond) in enumerate(rules.RULES))
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    bullets = ", ".join(f"'{x}'" for x in rules.BULLETS)
    return f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS_SQL} AS words FROM documents),
m AS (SELECT doc_id, words, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals,
  length(regexp_replace(t, '[^a-z]', '', 'g'))::BIGINT AS n_small,
  length(regexp_replace(t, '[^0-9]', '', 'g'))::BIGINT AS n_digits,
  list_filter(string_split(t, chr(10)), lambda x: trim(x, {blank}) <> '') AS lines FROM w),
x AS (SELECT doc_id, unnest(range(len(words) - 2)) AS i, words FROM m WHERE len(words) >= 3),
y AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i + 1], words[i + 2], words[i + 3]) AS c FROM x),
z AS (SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n FROM y, range(3) r(k) WHERE c > 1 GROUP BY 1),
a AS (SELECT doc_id, n_words, word_chars, n_symbols, n_capitals, n_small, n_digits, len(lines)::BIGINT AS n_lines,
  len(list_filter(lines, lambda x: ends_with(trim(x, {blank}), '...') OR ends_with(trim(x, {blank}), '…')))::BIGINT AS n_ellipsis_lines,
  len(list_filter(lines, lambda x: left(trim(x, {blank}), 1) IN ({bullets})))::BIGINT AS n_bullet_lines,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM m LEFT JOIN z USING (doc_id)),
b AS (SELECT *, ({conditions})::INTEGER AS fail_bits FROM a)"""


def _enforced() -> list[tuple[str, int, str, int]]:
    order = [name for name, _ in rules.RULES]
    return [(p, rules.mask_of(p), r, 1 << order.index(r)) for p, names in rules.POLICIES.items() for r in names]


def _op9_sql(policy: str = "v3") -> str:
    base, mask = rules.mask_of("base"), rules.mask_of(policy)
    versions = ", ".join(f"fail_bits & {rules.mask_of(p)} = 0 AS passes_{p}" for p in rules.POLICIES if p != "base")
    alone = " ".join(f"WHEN {bit} THEN '{r}'" for p, _, r, bit in _enforced() if p == policy)
    return f"""{_ledger_sql()}
SELECT doc_id, {', '.join(rules.MEASURES)}, fail_bits & {base} <> 0 AS base_failed,
  fail_bits & {base | mask} = 0 AS kept, fail_bits, '{policy}' AS policy, {versions},
  CASE fail_bits & {mask} {alone} END AS sole_rule FROM b
"""


def _rules_report_sql() -> str:
    enforced = ", ".join(f"('{p}', {mask}, '{r}', {bit})" for p, mask, r, bit in _enforced())
    return f"""{_ledger_sql()},
l AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1),
e AS (SELECT quality, fail_bits, count(*) AS n FROM b LEFT JOIN l USING (doc_id) GROUP BY ALL),
p(policy, mask, rule, bit) AS (VALUES {enforced})
SELECT quality, policy, rule, sum(n)::BIGINT AS n_docs,
  coalesce(sum(n) FILTER (fail_bits & bit <> 0), 0)::BIGINT AS n_failed,
  coalesce(sum(n) FILTER (fail_bits & mask = bit), 0)::BIGINT AS n_failed_alone,
  coalesce(sum(n) FILTER (fail_bits & mask = 0), 0)::BIGINT AS n_kept
FROM e, p GROUP BY 1, 2, 3
"""

# -- 10: near duplicates -----------------------------------------------------


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(documents(spark, sf_dir))


# -- 11: chat formatting -------------------------------------------------------


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts look like marks."""
    convs = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    tricky = spark.range(2, numPartitions=1).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text")
    )
    return chat.read_back(chat.format_conversations(convs.unionByName(tricky)))


# -- 12: spelling variants -----------------------------------------------------


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_forms(variants.vocabulary(documents(spark, sf_dir), variants.lose_letters))


# -- 13: periodic runs ---------------------------------------------------------


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_report(periodic.periodic_runs(documents(spark, sf_dir), edit=periodic.repeat_some))


QUERIES = {
    "op1_line_dedup": (op1_line_dedup, _op1_sql()),
    "op2_mix": (op2_mix, OP2_SQL),
    "op3_licenses": (op3_licenses, _op3_sql()),
    "op4_shards": (op4_shards, None),
    "op5_secrets": (op5_secrets, None),
    "op6_quality": (op6_quality, None),
    "op7_fingerprints": (op7_fingerprints, None),
    "op8_pieces": (op8_pieces, None),
    "op9_rules": (op9_rules, _op9_sql()),
    "rules_report": (rules_report, _rules_report_sql()),
    "op10_near_dedup": (op10_near_dedup, None),
    "op11_chat": (op11_chat, None),
    "op12_variants": (op12_variants, None),
    "op13_periodic": (op13_periodic, None),
}
