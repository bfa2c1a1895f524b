"""The operators as queries over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from . import (
    decontamination,
    html_text,
    jaccard_join,
    license_scan,
    neighbours,
    packing,
    prefix_trie,
    quality,
    secret_scan,
    token_files,
    toxicity,
    url_filter,
    whitening,
)
from .common import table


def op1_packing(spark: SparkSession, data_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, data_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_html_text(spark: SparkSession, data_dir: str) -> DataFrame:
    found = html_text.extract_text(table(spark, data_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_quality(spark: SparkSession, data_dir: str) -> DataFrame:
    docs = table(spark, data_dir, "documents").select("doc_id", "text")
    return quality.quality_scores(docs, table(spark, data_dir, "labels"))


def op4_jaccard_join(spark: SparkSession, data_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, data_dir, "documents"))


def op5_token_files(spark: SparkSession, data_dir: str) -> DataFrame:
    folder = fresh_path(spark, "token-files")
    manifest = token_files.write_token_files(table(spark, data_dir, "documents"), folder)
    read = token_files.read_token_files(spark, manifest, folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_url_filter(spark: SparkSession, data_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, data_dir, "pages").select("page_id", "url")).drop("url")


def op7_decontamination(spark: SparkSession, data_dir: str) -> DataFrame:
    docs = table(spark, data_dir, "documents").select("doc_id", "text")
    judged = decontamination.contamination(docs, table(spark, data_dir, "benchmark"))
    return decontamination.digest_columns(judged)


def op8_license_scan(spark: SparkSession, data_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, data_dir, "documents"))


def op9_toxicity(spark: SparkSession, data_dir: str) -> DataFrame:
    docs = table(spark, data_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity_scores(docs, table(spark, data_dir, "labels"))


def op10_neighbours(spark: SparkSession, data_dir: str) -> DataFrame:
    return neighbours.search(table(spark, data_dir, "embeddings"))


def op11_whitening(spark: SparkSession, data_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, data_dir, "embeddings"))


def op12_secret_scan(spark: SparkSession, data_dir: str) -> DataFrame:
    docs = table(spark, data_dir, "documents").select("doc_id", "text")
    return secret_scan.digest_columns(secret_scan.find_secrets(docs).drop("text"))


def op13_prefix_trie(spark: SparkSession, data_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, data_dir, "conversations")).drop("digest", "parent")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing, op2_html_text, op3_quality, op4_jaccard_join, op5_token_files, op6_url_filter,
        op7_decontamination, op8_license_scan, op9_toxicity, op10_neighbours,
        op11_whitening, op12_secret_scan, op13_prefix_trie,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Words of the contract, as DuckDB's regular expressions spell them.
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit: each character is followed by seven steps without one."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda s: [ascii(s), 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, CAST({bits} AS BIGINT[])), lambda a, b: {step}))"


def _found(kind: str, pattern: str, keep: str) -> str:
    """``doc_id, start, rank, kind, end`` of a kind's matches ``m``: marked in the text, which is then cut at the marks."""
    mark, pieces = "chr(57344)", "string_split(marked, chr(57344))"
    before = "coalesce(list_sum(list_transform(cut[:i - 1], lambda p: length(p))), 0)"
    return f"""
  SELECT doc_id, row_id, CAST({before} AS BIGINT) AS first, {list(secret_scan.KINDS).index(kind)} AS rank, '{kind}' AS kind,
         CAST({before} + length(m) AS BIGINT) AS past
  FROM (SELECT *, cut[i] AS m FROM (
    SELECT *, unnest(range(2, len(cut) + 1, 2)) AS i FROM (
      SELECT doc_id, row_id, {pieces} AS cut FROM (
        SELECT doc_id, row_id, regexp_replace(t, '({pattern})', {mark} || '\\1' || {mark}, 'g') AS marked FROM texts))))
  WHERE {keep}"""


_ASSIGNED = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    for word in ("password", "passwd", "secret", "token", "apikey", "api_key")
)
_ASSIGN = f"""({_ASSIGNED})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Six base 62 digits as a number.
_CHECK = "list_reduce(list_prepend(0, list_transform(string_split({}, ''), lambda s: CAST(strpos('{}', s) - 1 AS BIGINT))), lambda a, b: a * 62 + b)"


def _checked(prefix: int) -> str:
    body, check = f"substr(m, {prefix + 1}, 30)", f"substr(m, {prefix + 31}, 6)"
    return f"CASE WHEN length(m) = {prefix + 36} THEN {_crc32(body)} = {_CHECK.format(check, _BASE62)} ELSE false END"


ORACLES: dict[str, str] = {
    "op4_jaccard_join": f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] ELSE
    list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM worded),
classes AS (SELECT s, min(doc_id) AS rep, count(*) AS size, len(s) AS n FROM sets GROUP BY s),
tokens AS (SELECT rep, n, unnest(s) AS t FROM classes),
often AS (SELECT t FROM tokens GROUP BY t HAVING count(*) > 1),
kept AS (SELECT rep, n, t FROM tokens SEMI JOIN often USING (t)),
pairs AS (
  SELECT a.rep AS a, b.rep AS b, count(*) AS o, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM kept a JOIN kept b USING (t) WHERE a.rep < b.rep GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * o >= 85 * (na + nb - o)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
walk AS (SELECT rep AS a, rep AS b FROM classes WHERE n > 0 UNION SELECT w.a, e.b FROM walk w JOIN both_ways e ON w.b = e.a),
labels AS (SELECT a AS rep, min(b) AS component FROM walk GROUP BY a),
partners AS (SELECT e.a AS rep, sum(c.size) AS links FROM both_ways e JOIN classes c ON c.rep = e.b GROUP BY e.a)
SELECT d.doc_id, CAST(c.n AS BIGINT) AS n_shingles, coalesce(l.component, d.doc_id) AS component_id,
       CAST(CASE WHEN c.n = 0 THEN 0 ELSE c.size - 1 + coalesce(p.links, 0) END AS BIGINT) AS n_links
FROM sets d JOIN classes c ON d.s = c.s LEFT JOIN labels l ON l.rep = c.rep LEFT JOIN partners p ON p.rep = c.rep""",
    "op6_url_filter": """
WITH parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(verdict, h, p) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'),
  ('block', 'com', '/de/')),
fitting AS (
  SELECT page_id, host, path, max_by(struct_pack(r := h || p, v := verdict), length(h || p)) AS best
  FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id, host, path)
SELECT page_id, host, path, best.r AS rule, coalesce(best.v, 'allow') AS verdict FROM fitting""",
    "op7_decontamination": f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k,
         unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2), lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' ')))
           AS phrase
  FROM items WHERE len(w) > 0),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
places AS (
  SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k),
found AS (
  SELECT doc_id, i, s.k, item_id
  FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM places) s JOIN windows USING (k, phrase)),
hits AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS j FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         array_to_string(list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))), ',') AS names FROM found GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op8_license_scan": f"""
WITH docs AS (SELECT doc_id, {_LOWER} AS norm, {_WORDS} AS w FROM documents),
phrases(p, label) AS (VALUES
  (['cc', 'by'], 'cc-by'), (['general', 'public', 'license'], 'gpl'), (['all', 'rights', 'reserved'], 'reserved')),
places AS (
  SELECT doc_id, label, unnest(list_filter(range(0, len(w)), lambda i: w[i + 1:i + len(p)] = p)) AS i FROM docs, phrases),
base AS (SELECT doc_id, count(*) AS n, min(i) AS first, max(i) AS last, list(DISTINCT label) AS labels FROM places GROUP BY doc_id),
templates(label, t) AS (VALUES {", ".join(
    f"('{label}', {list(dict.fromkeys(text.split()))})" for label, text in license_scan.TEMPLATES
)}),
marked AS (
  SELECT doc_id, array_to_string(list_transform(regexp_split_to_array(replace(norm, chr(1), ' '), '\\r\\n|\\n|\\r'),
    lambda x: CASE WHEN regexp_matches(x, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]') THEN x ELSE chr(1) END), chr(10)) AS paragraphs
  FROM docs),
blocks AS (
  SELECT doc_id, list_distinct(regexp_extract_all(b, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w
  FROM (SELECT doc_id, unnest(regexp_split_to_array(paragraphs, '\\x01|[.!?;][ \\t\\n\\x0B\\f\\r]+')) AS b FROM marked)),
shares AS (
  SELECT doc_id, label, CAST(len(list_intersect(t, w)) AS DOUBLE) / len(t) AS share FROM blocks, templates),
met AS (
  SELECT doc_id, list(DISTINCT label) AS labels, max(share) AS best FROM shares
  WHERE share >= {license_scan.CONTAINMENT} - 1e-9 GROUP BY doc_id)
SELECT doc_id, len(docs.w) AS n_words, coalesce(n, 0) AS n_base, first AS first_word, last AS last_word,
       array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(met.labels, [])))), ',') AS labels,
       CASE WHEN n > 0 THEN 1.0 ELSE coalesce(best, 0.0) END AS score
FROM docs LEFT JOIN base USING (doc_id) LEFT JOIN met USING (doc_id)""",
    "op12_secret_scan": f"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS row_id, translate(coalesce(text, ''), chr(57344), chr(57345)) AS t FROM documents),
found AS ({" UNION ALL ".join([
    _found("assign", _ASSIGN, f"length(regexp_extract(m, '{_ASSIGN}', 2)) >= 6"),
    _found("access", "AKIA[A-Z0-9]+", "length(m) >= 20"),
    _found("hex", "[0-9a-f]+", "length(m) >= 24"),
    _found("github", "gh[pousr]_[0-9A-Za-z]+", _checked(4)),
    _found("npm", "npm_[0-9A-Za-z]+", _checked(4)),
])}),
spans AS (
  SELECT row_id, count_if(kind = 'assign') AS n_assign, count_if(kind = 'access') AS n_access, count_if(kind = 'hex') AS n_hex,
         string_agg(kind || ':' || first || ':' || past, ',' ORDER BY first, rank) AS every,
         string_agg(kind || ':' || first || ':' || past, ',' ORDER BY first, rank) FILTER (rank < 3) AS base
  FROM found GROUP BY row_id)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM texts LEFT JOIN spans USING (row_id)""",
    "op13_prefix_trie": f"""
WITH turns AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, list(struct_pack(r := r, x := x) ORDER BY turn NULLS FIRST, r, sha256(length(r) || ':' || r || x)) AS p
  FROM turns GROUP BY c),
heads AS (SELECT c, p, {_crc32("CAST(c AS VARCHAR)")} % 6 AS h FROM own),
made AS (
  SELECT o.c, list_concat(coalesce(b.p, [])[1:o.h], o.p[o.h + 1:]) AS p
  FROM heads o LEFT JOIN own b ON b.c = o.c - o.c % 100),
nodes AS (
  SELECT p[1:d] AS k, d, min(c) AS conv, count(*) AS n, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(p) = d) AS ends
  FROM (SELECT c, p, unnest(range(0, len(p) + 1)) AS d FROM made) GROUP BY ALL),
children AS (SELECT k[1:d - 1] AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
owned AS (
  SELECT nodes.k, d, CASE WHEN children.n IS NULL THEN 1 ELSE 0 END AS leaf,
         CASE WHEN d = 0 THEN 0 ELSE (nodes.n - 1) * length(nodes.k[d].x) END AS saved
  FROM nodes LEFT JOIN children USING (k)),
below AS (
  SELECT k[1:j] AS k, sum(leaf) AS leaves, sum(saved) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM owned) GROUP BY ALL)
SELECT n.conv AS conv_id, n.d AS depth, up.conv AS parent_conv_id, n.n AS n_convs, coalesce(children.n, 0) AS n_children,
       CAST(below.leaves AS BIGINT) AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN below USING (k) LEFT JOIN children USING (k)
LEFT JOIN nodes up ON n.d > 0 AND up.d = n.d - 1 AND up.k = n.k[1:n.d - 1]""",
}
