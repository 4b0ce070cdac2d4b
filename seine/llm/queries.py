"""The registered queries of this subpackage, over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import encode_digest
from .chosen_path import jaccard_classes
from .packing import pack_documents
from .pii import KINDS, pseudonymise
from .quality import judge
from .secrets import BASE, RULES, find_secrets
from .shared import recorded, scratch_dir
from .suffix_dedup import remove_repeats
from .token_codes import read_token_codes, write_token_codes
from .topk import exact_top_k
from .url_filter import judge_urls, rules_frame

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

#: For the registered query alone; a run over real data brings its own.
PSEUDONYM_KEY = "registered query"


#: Words of a passage that may stand in one place alone.
PASSAGE = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pseudonymise(table(spark, sf_dir, "documents"), ["doc_id"], PSEUDONYM_KEY)
    of_kind = lambda kind: F.filter("found", lambda x: x["kind"] == kind)
    return out.select("_kept.doc_id", "text", *(F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS))


def op2_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-codes")
    recorded(spark).append(path)
    write_token_codes(table(spark, sf_dir, "documents"), path, WORD_BPE, end_id=2)
    return read_token_codes(spark, path)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents"), ["doc_id"])
    return out.select("_kept.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_secrets(table(spark, sf_dir, "documents"), ["doc_id"])
    kinds = [r.kind for r in BASE]
    spans = F.col("secret_spans")
    of_kinds = lambda some: F.filter(spans, lambda s: s["kind"].isin(some))
    said = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return out.select("_kept.doc_id", *(F.size(of_kinds([k])).cast("long").alias(f"n_{k}") for k in kinds), F.sha2(said(of_kinds(kinds)), 256).alias("base_sha256"), said(spans).alias("spans"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), WORD_BPE, end_id=1, size=4096)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes as counts and a digest; ``text`` is the text without passages of 50 words that start elsewhere too."""
    out = remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"], length=400, words=PASSAGE, texts=True)
    return out.select("_kept.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_words", "n_passages", F.col("kept_text").alias("text"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rules_frame(spark))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"), k=5)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digest(table(spark, sf_dir, "documents"), BYTE_BPE)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"), n=5, similarity=0.8)


QUERIES = {f.__name__: f for f in (op1_feistel_pseudonyms, op2_token_codes, op3_quality_rules, op4_secret_scan, op5_best_fit_packing, op6_suffix_dedup, op7_url_filter, op8_exact_topk, op9_byte_bpe, op10_jaccard_join)}



def _spans_sql(k: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Matches of one kind with their places: what stands between matches says where each starts."""
    pattern = pattern.replace("'", "''")
    at = "length(array_to_string(p[1:k], '')) + length(array_to_string(m[1:k - 1], ''))"
    return f"""SELECT doc_id, {k} o, '{kind}' kind, {at} a, {at} + length(m[k]) b FROM (
  SELECT doc_id, m, p, unnest(range(1, len(m) + 1)) k FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') m, string_split_regex(t, '{pattern}') p FROM d) WHERE len(m) > 0)
  WHERE length(regexp_extract(m[k], '{pattern}', {group})) >= {least}"""


def _folded(pattern: str) -> str:
    """ASCII letters outside classes in either case."""
    return re.sub(r"\[[^\]]*\]|\\.[0-9A-Fa-f]*|[a-z]", lambda x: f"[{x[0].upper()}{x[0]}]" if len(x[0]) == 1 else x[0], pattern)


ORACLE = {
    "op4_secret_scan": "WITH d AS (SELECT doc_id, coalesce(text, '') t FROM documents),\ns AS ("
    + "\n  UNION ALL ".join(_spans_sql(k, r.kind, _folded(r.pattern) if r.flags else r.pattern, r.group, r.least) for k, r in enumerate(RULES))
    + """)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') n_assign, count(*) FILTER (kind = 'access') n_access, count(*) FILTER (kind = 'hex') n_hex,
  sha256(coalesce(string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, o) FILTER (o < 3), '')) base_sha256, coalesce(string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, o), '') spans
FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id""",
    "op6_suffix_dedup": r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) b FROM documents),
p AS (SELECT doc_id, b, unnest(range(1, octet_length(b) - 398)) i FROM d WHERE octet_length(b) >= 400),
h AS (SELECT doc_id, i, md5(b[i:i + 399]) h FROM p),
m AS (SELECT doc_id, i FROM h WHERE h IN (SELECT h FROM h GROUP BY h HAVING count(*) > 1)),
s AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) before FROM m),
k AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR before + 400 < i THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) run FROM s),
r AS (SELECT doc_id, run, min(i) lo, max(i) + 399 hi FROM k GROUP BY 1, 2),
e AS (SELECT doc_id, list([lo, hi] ORDER BY lo) runs, CAST(sum(hi - lo + 1) AS BIGINT) n_removed, count(*) n_spans FROM r GROUP BY 1),
w AS (SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') w, string_split_regex(t, '[^\x20\x09-\x0D]+') g FROM (SELECT doc_id, coalesce(text, '') t FROM documents)),
wp AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) i FROM w WHERE len(w) >= 50),
wh AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) h FROM wp),
wm AS (SELECT doc_id, i FROM wh WHERE h IN (SELECT h FROM wh GROUP BY h HAVING count(*) > 1)),
wg AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) k FROM wm),
wk AS (SELECT doc_id, w[k] word, g[k + 1] gap, k, wg.k IS NOT NULL gone FROM (SELECT doc_id, w, g, unnest(range(1, len(w) + 1)) k FROM w) LEFT JOIN wg USING (doc_id, k)),
wl AS (SELECT *, lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY k) before, lead(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY k) after FROM wk),
wt AS (SELECT doc_id, count(*) FILTER (gone) n_passage_words, count(*) FILTER (gone AND NOT before) n_passages, string_agg(CASE WHEN gone THEN '' ELSE word END || CASE WHEN gone AND after THEN '' ELSE gap END, '' ORDER BY k) rest FROM wl GROUP BY doc_id)
SELECT doc_id, coalesce(n_passage_words, 0) n_passage_words, coalesce(n_passages, 0) n_passages, g[1] || coalesce(rest, '') AS text, CAST(octet_length(b) AS BIGINT) n_bytes, coalesce(n_removed, 0) n_removed, coalesce(n_spans, 0) n_spans,
  sha256(CASE WHEN runs IS NULL THEN b ELSE list_reduce(list_transform(range(0, len(runs) + 1), lambda x: b[CASE WHEN x = 0 THEN 1 ELSE runs[x][2] + 1 END : CASE WHEN x = len(runs) THEN octet_length(b) ELSE runs[x + 1][1] - 1 END]), lambda x, y: x || y) END) kept_sha256
FROM d LEFT JOIN e USING (doc_id) JOIN w USING (doc_id) LEFT JOIN wt USING (doc_id)""",
    "op10_jaccard_join": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\pL\pN_]+') w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) i FROM w WHERE len(w) > 0),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') s FROM p),
n AS (SELECT doc_id, count(*) n, md5(string_agg(s, ',' ORDER BY s)) f FROM g GROUP BY doc_id),
c AS (SELECT a.doc_id a, b.doc_id b, count(*) k FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b, x.f fa, y.f fb FROM c JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE k >= 0.8 * (x.n + y.n - k) - 1e-9),
t AS (SELECT a, count(*) links, count(DISTINCT CASE WHEN fa <> fb THEN fb END) texts FROM l GROUP BY a),
r AS (WITH RECURSIVE r(id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, l.b FROM r JOIN l ON r.other = l.a) SELECT id, min(other) class_id FROM r GROUP BY id)
SELECT doc_id, class_id, coalesce(links, 0) n_links, coalesce(texts, 0) n_text_links FROM documents JOIN r ON doc_id = id LEFT JOIN t ON doc_id = a""",
    "op7_url_filter": r"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(r_host, r_path, r_verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
met AS (
  SELECT page_id, host, path, max_by(r_host || r_path, length(r_host) + length(r_path)) AS rule, max_by(r_verdict, length(r_host) + length(r_path)) AS r_verdict
  FROM parts LEFT JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
  GROUP BY page_id, host, path)
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict FROM met""",
    "op8_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
terms AS (SELECT vec_id, unnest(w) AS weight, generate_subscripts(w, 1) AS term FROM v),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.weight * c.weight) AS BIGINT) AS score
  FROM terms q JOIN terms c ON q.term = c.term AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, c.vec_id),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
}
