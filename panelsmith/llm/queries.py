"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelsmith.llm import decontaminate, divergence, importance, inner_topk, jaccard_join, license_scan, merkle, mixing, pitman_yor, secret_ledger, surrogates, token_spans, url_rules
from panelsmith.session import read_table, shared_dir

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


# ------------------------------------------------- op1 benchmark decontamination

_SHINGLES = """list_distinct(CASE WHEN len(w) < 5 THEN [] ELSE list_transform(range(1, len(w) - 3),
  lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4]) END)"""

DECONTAMINATE_SQL = f"""
WITH doc_words AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents),
item_words AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM benchmark),
docs AS (SELECT doc_id, unnest({_SHINGLES}) AS t FROM doc_words),
items AS (SELECT item_id, len(s) AS n, unnest(s) AS t FROM (SELECT item_id, {_SHINGLES} AS s FROM item_words)),
short AS (SELECT item_id, ' ' || array_to_string(w, ' ') || ' ' AS t FROM item_words WHERE len(w) BETWEEN 1 AND 4)
SELECT doc_id, item_id, count(*) AS n_shared, max(n) AS n_item, count(*) / max(n) AS containment
FROM docs JOIN items USING (t) GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * max(n)
UNION ALL SELECT DISTINCT doc_id, item_id, 1::BIGINT, 1::BIGINT, 1::DOUBLE
FROM short JOIN doc_words ON contains(' ' || array_to_string(doc_words.w, ' ') || ' ', short.t)
"""


@query("op1_decontamination", DECONTAMINATE_SQL)
def op1_decontamination(spark, sf_dir):
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


# -------------------------------------------------------- op2 n-gram Jaccard join

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER.format('text')}, '[^\\x20\\x09-\\x0D]+')"

JACCARD_SQL = f"""
WITH RECURSIVE docs AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2]) END) AS s FROM docs),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM tokens x JOIN tokens y ON x.t = y.t AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id HAVING 100 * count(*) >= 90 * (max(x.n) + max(y.n) - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM docs UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, len(s.s) AS n_shingles, (SELECT min(b) FROM reach r WHERE r.a = s.doc_id) AS component_id FROM sets s
"""


@query("op2_jaccard_join", JACCARD_SQL)
def op2_jaccard_join(spark, sf_dir):
    found = jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"), n=3, num=90, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


# -------------------------------------------------------------- op3 token counts


@query("op3_token_counts")
def op3_token_counts(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    record, fields = token_spans.field_record(["source", "lang", "text"])
    return token_spans.count_section_tokens(docs, record, fields, rule="first")


# ------------------------------------------------------------ op4 secret scans

_SPLIT = """list_filter(list_transform(range(1, len(m) + 1), lambda i: {{'start': list_sum(list_transform(p[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i-1], lambda x: length(x))), 0),
  'rank': {rank}, 'kind': '{kind}', 'len': length(m[i]), 'size': length(g[i])}}), lambda s: s.size >= {least})"""


def _secret_kind(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    pattern = pattern.replace("'", "''")
    spans = _SPLIT.format(rank=rank, kind=kind, least=least)
    return f"""SELECT doc_id, row_no, {spans} AS s FROM (SELECT doc_id, row_no, string_split_regex(t, '{pattern}') AS p,
  regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {group}) AS g FROM docs)"""


_SAID = "coalesce(array_to_string(list_transform({}, lambda x: concat_ws(':', x.kind, x.start::BIGINT, x.stop::BIGINT)), ','), '')"

SECRETS_SQL = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS row_no, coalesce(text, '') AS t FROM documents),
kinds AS ({" UNION ALL ".join(_secret_kind(i, r.name, r.pattern, r.group, r.min_chars) for i, r in enumerate(secret_ledger.RULES))}),
per_doc AS (SELECT doc_id, row_no, list_sort(flatten(list(list_transform(s, lambda x: {{'start': x.start, 'rank': x.rank, 'kind': x.kind, 'stop': x.start + x.len}})))) AS f
  FROM kinds GROUP BY doc_id, row_no),
said AS (SELECT doc_id, f, {_SAID.format("f")} AS spans, {_SAID.format(f"list_filter(f, lambda x: x.rank < {len(secret_ledger.BASE_RULES)})")} AS base FROM per_doc)
SELECT doc_id, len(list_filter(f, lambda x: x.kind = 'assign')) AS n_assign, len(list_filter(f, lambda x: x.kind = 'access')) AS n_access,
  len(list_filter(f, lambda x: x.kind = 'hex')) AS n_hex, sha256(base) AS base_sha256, spans FROM said
"""


@query("op4_secret_scans", SECRETS_SQL)
def op4_secret_scans(spark, sf_dir):
    """The ledger's table is named by the session's spark.panelsmith.secret_ledger;
    where that is unset, a new one is begun."""
    docs = read_table(spark, sf_dir, "documents")
    path = spark.conf.get("spark.panelsmith.secret_ledger", None) or shared_dir(spark, "ledgers", f"secrets-{uuid.uuid4().hex}")
    ledger = secret_ledger.update_ledger(docs, path)
    found = F.col("found")
    base = F.filter(found, lambda x: x["rank"] < len(secret_ledger.BASE_RULES))
    return secret_ledger.findings_by_path(docs, ledger).select(
        "doc_id",
        *[secret_ledger.count_kind(found, r.name).alias(f"n_{r.name}") for r in secret_ledger.BASE_RULES],
        F.sha2(secret_ledger.spans_text(base), 256).alias("base_sha256"),
        secret_ledger.spans_text(found).alias("spans"),
    )


# ----------------------------------------------------------------------- op5 PII

#: In production the key comes from the caller's secret store.
SURROGATE_KEY = "panelsmith-surrogates"


@query("op5_surrogates")
def op5_surrogates(spark, sf_dir):
    return surrogates.replace_personal(read_table(spark, sf_dir, "documents"), SURROGATE_KEY)


# ---------------------------------------------------------- op6 exact top-k search

TOPK_SQL = """
WITH usable AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query("op6_topk_search", TOPK_SQL)
def op6_topk_search(spark, sf_dir):
    return inner_topk.inner_topk(read_table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0, k=20, scale=64.0)


# -------------------------------------------------------------- op7 URL filters

#: host, path, verdict
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

URLS_SQL = f"""
WITH rules(r_host, r_path, r_verdict) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
urls AS (SELECT page_id, row_number() OVER () AS row_no,
  translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
best AS (SELECT u.row_no, arg_max({{'rule': r_host || r_path, 'verdict': r_verdict}}, length(r_host || r_path)) AS b
  FROM urls u JOIN rules r ON (u.host = r_host OR ends_with(u.host, '.' || r_host)) AND starts_with(u.path, r_path) GROUP BY u.row_no)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict FROM urls LEFT JOIN best USING (row_no)
"""


@query("op7_url_filters", URLS_SQL)
def op7_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(list(URL_RULES), url_rules.RULES_SCHEMA)
    return url_rules.judge_urls(read_table(spark, sf_dir, "pages"), rules)


# -------------------------------------------------------- op8 quality classifier


@query("op8_quality")
def op8_quality(spark, sf_dir):
    return importance.select_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


# --------------------------------------------------------------- op9 LM scoring


def held_out(id_col: str):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 1


@query("op9_lm_scoring")
def op9_lm_scoring(spark, sf_dir):
    return pitman_yor.score_texts(read_table(spark, sf_dir, "documents"), held_out("doc_id"))


# ------------------------------------------------------- op10 mixing to weights

#: Parts of the mix per source; all other sources share OTHER_PARTS.
MIX_WEIGHTS = {"src0": 10} | {f"src{i}": 6 for i in range(1, 10)} | {f"src{i}": 3 for i in range(10, 20)}
OTHER_PARTS = 6
BLOCK_CHARS = 50_000


_WEIGHT_ROWS = ", ".join(f"('{k}', {v})" for k, v in [*MIX_WEIGHTS.items(), (mixing.OTHER, OTHER_PARTS)])

MIX_SQL = f"""
WITH RECURSIVE weights(k, parts) AS (SELECT col0, col1::BIGINT FROM (VALUES {_WEIGHT_ROWS})),
docs AS (SELECT doc_id, source, lang, n_chars, coalesce((SELECT k FROM weights WHERE k = source), '{mixing.OTHER}') AS mix_source,
  coalesce(length(text), 0)::BIGINT AS chars, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 't' || md5(text), '')), 1, 10))::BIGINT AS h FROM documents),
placed AS (SELECT *, coalesce(sum(chars) OVER (PARTITION BY mix_source ORDER BY h, doc_id, chars ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS offset_chars FROM docs),
sums AS (SELECT mix_source AS k, greatest(ceil(sum(chars) / {BLOCK_CHARS}), 1)::BIGINT AS blocks FROM docs GROUP BY mix_source),
sources AS (SELECT k, parts, blocks, (blocks + parts - 1) // parts AS rounds, blocks // parts AS full_rounds FROM sums JOIN weights USING (k)),
ends AS (SELECT DISTINCT rounds AS to_round FROM sources),
phases AS (SELECT to_round, coalesce(lag(to_round) OVER (ORDER BY to_round), 0) AS from_round,
  (SELECT list(k ORDER BY k) FROM sources WHERE rounds >= to_round) AS ks,
  (SELECT list(parts ORDER BY k) FROM sources WHERE rounds >= to_round) AS ps,
  (SELECT sum(parts)::BIGINT FROM sources WHERE rounds >= to_round) AS period FROM ends),
starts AS (SELECT *, coalesce(sum((to_round - from_round) * period) OVER (ORDER BY to_round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_slot FROM phases),
edf AS (SELECT to_round, ks, ps, period, 0::BIGINT AS t, list_transform(ps, lambda x: 0::BIGINT) AS done, NULL::BIGINT AS pick, NULL::BIGINT AS place FROM phases
  UNION ALL SELECT to_round, ks, ps, period, t + 1, list_transform(done, lambda x, i: CASE WHEN i = now THEN x + 1 ELSE x END), now, done[now] FROM (
    SELECT * EXCLUDE (pick, place), list_min(list_filter(list_transform(range(1, len(ps) + 1),
      lambda i: CASE WHEN (done[i] * period) // ps[i] <= t THEN (((done[i] + 1) * period + ps[i] - 1) // ps[i]) * 100000 + i END), lambda c: c IS NOT NULL)) % 100000 AS now
    FROM edf WHERE t < period)),
slots AS (SELECT to_round, ks[pick] AS k, place, t - 1 AS slot FROM edf WHERE pick IS NOT NULL),
dealt AS (SELECT p.*, s.parts, least(offset_chars // {BLOCK_CHARS}, s.blocks - 1) AS block FROM placed p JOIN sources s ON s.k = p.mix_source),
rounds AS (SELECT *, block // parts AS r, block % parts AS place FROM dealt)
SELECT d.doc_id, d.source, d.lang, d.n_chars, d.mix_source, d.block, f.first_slot + (r - f.from_round) * f.period + (d.place * f.period) // d.parts AS release,
  f.first_slot + (r - f.from_round) * f.period + ((d.place + 1) * f.period + d.parts - 1) // d.parts AS deadline,
  f.first_slot + (r - f.from_round) * f.period + s.slot AS slot, d.offset_chars, r < (SELECT min(full_rounds) FROM sources) AS on_target
FROM rounds d JOIN starts f ON f.from_round <= r AND r < f.to_round JOIN slots s ON s.to_round = f.to_round AND s.k = d.mix_source AND s.place = d.place
"""


@query("op10_mix_sources", MIX_SQL)
def op10_mix_sources(spark, sf_dir):
    return mixing.mix_sources(
        read_table(spark, sf_dir, "documents"), MIX_WEIGHTS, BLOCK_CHARS, other_weight=OTHER_PARTS, keep=("lang", "n_chars")
    )


# -------------------------------------------------- op11 source divergence audit

MIN_DOCS, TERM_RANKS = 3, 200

_SHARE = "1 + (1000000000::HUGEINT * (c + 1)) // (n + v)"
DIVERGENCE_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
tokens AS (SELECT row_no, lang, source, unnest(w) AS t FROM docs),
kept AS (SELECT lang, t FROM tokens GROUP BY lang, t HAVING count(DISTINCT row_no) >= {MIN_DOCS}),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counted AS (SELECT lang, source, t, count(*) AS c FROM tokens JOIN kept USING (lang, t) GROUP BY ALL),
grid AS (SELECT lang, g.source, t, coalesce(c, 0) AS c FROM groups g JOIN kept USING (lang) LEFT JOIN counted USING (lang, source, t)),
shares AS (SELECT lang, source, t, c, {_SHARE} AS p FROM (SELECT *, sum(c) OVER (PARTITION BY lang, source) AS n FROM grid) JOIN sizes USING (lang)),
lang_shares AS (SELECT lang, t, {_SHARE} AS q FROM (SELECT lang, t, sum(c) AS c, sum(sum(c)) OVER (PARTITION BY lang) AS n FROM grid GROUP BY lang, t) JOIN sizes USING (lang)),
pair_sums AS (SELECT lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b USING (lang, t) WHERE a.source <> b.source GROUP BY ALL),
pairs AS (SELECT lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b USING (lang) LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source WHERE a.source <> b.source),
terms AS (SELECT lang, source, 'term' AS part, t AS item, (p - q) * (p - q) // q AS value FROM shares JOIN lang_shares USING (lang, t) WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM pairs UNION ALL FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= {TERM_RANKS}
"""


@query("op11_source_divergence", DIVERGENCE_SQL)
def op11_source_divergence(spark, sf_dir):
    return divergence.audit_sources(read_table(spark, sf_dir, "documents"), min_docs=MIN_DOCS, ranks=TERM_RANKS)


# ------------------------------------------------------------ op12 license scans

LICENSE_NUM, LICENSE_DEN = 90, 100


def _list_sql(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


_LICENSE_WORDS = f"regexp_extract_all({_LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_PHRASE_ROWS = ", ".join(f"('{label}', {_list_sql(license_scan.words_of(p))})" for label, p in license_scan.PHRASES)
_TEMPLATE_ROWS = ", ".join(
    f"({i}, '{t.label}', {_list_sql(sorted(set(w)))}, {license_scan.block_step(len(w))})"
    for i, (t, w) in enumerate((t, license_scan.words_of(t.text)) for t in license_scan.TEMPLATES)
)

LICENSE_SQL = f"""
WITH phrases(label, p) AS (VALUES {_PHRASE_ROWS}),
templates(template, label, t, step) AS (VALUES {_TEMPLATE_ROWS}),
docs AS (SELECT doc_id, row_number() OVER () AS row_no, coalesce({_LICENSE_WORDS}, []) AS w FROM documents),
places AS (SELECT row_no, label, unnest(list_filter(range(0, len(w)), lambda i: w[i+1:i+len(p)] = p)) AS word FROM docs, phrases),
base AS (SELECT row_no, count(*) AS n_base, min(word) AS first_word, max(word) AS last_word FROM places GROUP BY row_no),
blocks AS (SELECT row_no, label, t, w, step, unnest(range(0, len(w), step)) AS b FROM docs, templates),
met AS (SELECT row_no, label, len(list_intersect(list_distinct(w[b+1:b+2*step]), t)) AS shared, len(t) AS size FROM blocks),
found AS (SELECT * FROM met WHERE {LICENSE_DEN} * shared >= {LICENSE_NUM} * size),
said AS (SELECT row_no, label, true AS base FROM places UNION ALL SELECT row_no, label, false FROM found),
labels AS (SELECT row_no, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM said GROUP BY row_no),
scores AS (SELECT row_no, max(shared / size) AS score FROM found GROUP BY row_no)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM docs LEFT JOIN base USING (row_no) LEFT JOIN labels USING (row_no) LEFT JOIN scores USING (row_no)
"""


@query("op12_license_scans", LICENSE_SQL)
def op12_license_scans(spark, sf_dir):
    found = license_scan.scan_licenses(read_table(spark, sf_dir, "documents"), num=LICENSE_NUM, den=LICENSE_DEN)
    word, own, met = F.col("phrases.word"), F.col("phrases.label"), F.col("blocks.label")
    shares = F.transform("blocks", lambda b: b["n_shared"] / b["n_template"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("bigint").alias("n_base"),
        F.array_min(word).alias("first_word"),
        F.array_max(word).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(own)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(own, met))), ",").alias("labels"),
        F.coalesce(F.array_max(shares), F.lit(0.0)).alias("score"),
    )


# ------------------------------------------------- op13 Merkle dataset manifest


def _tree_sql(name: str, leaves: str, key: str, levels: int) -> str:
    """CTEs {name}0..{name}{levels} of a tree per ``key`` over ``leaves`` (key,
    pos, h); n is the tree's nodes in the level, ``runs`` has each run joined."""
    out = [f"{name}0 AS (SELECT {key}, pos, h, count(*) OVER (PARTITION BY {key}) AS n FROM {leaves})"]
    for i in range(levels):
        out.append(
            f"""{name}{i + 1} AS (SELECT {key}, pos // {merkle.FANOUT} AS pos,
  CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h,
  list(h ORDER BY pos) AS children, any_value(n) AS below, (any_value(n) + {merkle.FANOUT - 1}) // {merkle.FANOUT} AS n FROM {name}{i} GROUP BY {key}, pos // {merkle.FANOUT})"""
        )
    return ",\n".join(out)


def _field_sql(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"


_LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels the SQL has; 16 to that power leaves and sources.
_SQL_LEVELS = 6
_TAMPERED = "CASE WHEN crc % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"
#: CRC-32 (reflected, 0xEDB88320) of the decimal id, bit by bit.
_CRC_SQL = """(list_reduce([4294967295] || list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT),
  lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))"""


def _ascend_sql(prefix: str, key: str, levels: int, state: str) -> str:
    """Nested selects that ascend (key, spot, folded, proof) level by level."""
    out = state
    for i in range(levels):
        left, right = f"t.children[1:(a.spot % {merkle.FANOUT})]", f"t.children[(a.spot % {merkle.FANOUT}) + 2:]"
        sides = f"array_to_string({left}, ''), array_to_string({right}, '')"
        out = f"""SELECT a.* EXCLUDE (spot, folded, proof), a.spot // {merkle.FANOUT} AS spot,
  CASE WHEN t.below = 1 THEN a.folded ELSE sha256(concat(array_to_string({left}, ''), a.folded, array_to_string({right}, ''))) END AS folded,
  CASE WHEN t.below = 1 THEN a.proof ELSE concat(a.proof, {sides}) END AS proof
  FROM ({out}) a JOIN {prefix}{i + 1} t ON t.{key} IS NOT DISTINCT FROM a.{key} AND t.pos = a.spot // {merkle.FANOUT}"""
    return out


MERKLE_SQL = f"""
WITH crcs AS (SELECT *, xor({_CRC_SQL}, 4294967295) AS crc FROM documents),
leaves AS (SELECT doc_id, source, sha256(concat({", ".join(_field_sql(c) for c in _LEAF_FIELDS)})) AS h,
  sha256(concat({", ".join(_field_sql(c) for c in _LEAF_FIELDS[:-1])}, {_field_sql("(" + _TAMPERED + ")")})) AS claimed FROM crcs),
placed AS (SELECT *, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS key,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM leaves),
{_tree_sql("s", "placed", "key", _SQL_LEVELS)},
tops AS (SELECT 1 AS top, key, h, row_number() OVER (ORDER BY key) - 1 AS pos FROM s{_SQL_LEVELS}),
{_tree_sql("t", "tops", "top", _SQL_LEVELS)},
inside AS ({_ascend_sql("s", "key", _SQL_LEVELS, "SELECT doc_id, key, h AS leaf, pos AS spot, claimed AS folded, '' AS proof FROM placed")}),
above AS ({_ascend_sql("t", "top", _SQL_LEVELS, "SELECT i.doc_id, i.leaf, p.h AS subroot, p.top, p.pos AS spot, i.folded, i.proof FROM inside i JOIN tops p USING (key)")})
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.h AS verified
FROM above CROSS JOIN (SELECT h FROM t{_SQL_LEVELS}) r
"""


@query("op13_merkle_manifest", MERKLE_SQL)
def op13_merkle_manifest(spark, sf_dir):
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, lower).otherwise(F.col("text"))
    manifest = merkle.build_manifest(read_table(spark, sf_dir, "documents"), _LEAF_FIELDS, claimed={"text": tampered})
    return merkle.verify(manifest).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root", "verified"
    )
