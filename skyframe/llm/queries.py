"""Registered queries of the training-data operators. Each applies its operator
with production parameters to the whole table and returns the full result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import (ann as NN, byte_bpe as BB, language_id as LI, line_dedup as LD, packing as PK, quality_model as QM,
               quality_rules as QR, resampling as RS, secret_scan as SS, simhash as SH, suffix_dedup as SD, url_filter as UF,
               vector_codes as VC)
from .common import crc_mod, documents, written

LLM_QUERIES: dict = {}
LLM_ORACLE_SQL: dict = {}


SQL_QUALITY_RULES = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls
  FROM documents),
win AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
cov AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum([length(x) FOR x IN ws]), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         len(ls) AS n_lines, len(list_distinct(ws)) AS n_distinct, length(t) AS n_chars,
         length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_upper,
         length(t) - length(replace(t, '!', '')) AS n_bangs
  FROM w LEFT JOIN cov USING (r)),
b AS (
  SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END)
    + (CASE WHEN 10 * n_dup_lines > 5 * n_lines AND n_dup_lines >= 3 THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN 10 * n_upper > 4 * n_chars THEN 32 ELSE 0 END)
    + (CASE WHEN 10 * n_bangs > 3 * n_words THEN 64 ELSE 0 END)
    + (CASE WHEN 20 * n_distinct < n_words AND n_words >= 200 THEN 128 ELSE 0 END) AS BIGINT) AS fail_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
       fail_bits = 0 AS kept, fail_bits FROM b
"""


SQL_URL_FILTER = r"""
WITH r(rule_host, rule_path, rule_verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
p AS (
  SELECT row_number() OVER () AS n, page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
listed AS (SELECT DISTINCT host || regexp_replace(path, '/+$', '') AS canonical FROM p
           WHERE regexp_matches(host, '(^|[.-])(ads|bets|casino|track)([.-]|$)')),
fits AS (
  SELECT n, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS k
  FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule,
       coalesce(rule_verdict, CASE WHEN canonical IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM p LEFT JOIN (SELECT * FROM fits WHERE k = 1) USING (n)
       LEFT JOIN listed ON canonical = host || regexp_replace(path, '/+$', '')
"""


# crc32 by nibbles: the 16 table values are the ones of the polynomial 0xEDB88320
SQL_RESAMPLING = r"""
WITH nibble AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0],
      lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c FROM range(16) r(i))),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
dw AS (SELECT r, w, count(*) AS n FROM (SELECT r, unnest(ws) AS w FROM d) GROUP BY r, w),
words AS (SELECT DISTINCT w FROM (SELECT w FROM dw UNION ALL SELECT w FROM b)),
-- low nibble of a byte before its high one
bucket AS (
  SELECT w, xor(list_reduce(list_concat([4294967295], flatten([[strpos('0123456789ABCDEF', x[2]) - 1, strpos('0123456789ABCDEF', x[1]) - 1]
                FOR x IN regexp_extract_all(hex(encode(w)), '..')])),
                lambda c, v: xor(c >> 4, t[1 + (xor(c, v) & 15)])), 4294967295) % 10000 AS k
  FROM words, nibble),
s AS (SELECT k, sum(n) AS s FROM dw JOIN bucket USING (w) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM b JOIN bucket USING (w) GROUP BY k),
gain AS (
  SELECT k, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (SELECT coalesce(sum(s), 0) + 10000 FROM s)::DOUBLE
         / ((s + 1)::DOUBLE * (SELECT coalesce(sum(t), 0) + 10000 FROM t)::DOUBLE))) AS BIGINT) AS g
  FROM s LEFT JOIN t USING (k)),
weight AS (SELECT r, sum(n) AS n, sum(n * g) AS total FROM dw JOIN bucket USING (w) JOIN gain USING (k) GROUP BY r),
scored AS (
  SELECT r, doc_id, CAST(len(ws) AS BIGINT) AS n_features, CAST(coalesce(floor(total / n), 0) AS BIGINT) AS weight,
         CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS noise
  FROM d LEFT JOIN weight USING (r)),
ranks AS (
  SELECT r, row_number() OVER (ORDER BY weight + noise DESC, doc_id NULLS LAST, n_features) AS rank
  FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, weight + noise AS score,
       CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM ranks) THEN rank END AS rank
FROM scored LEFT JOIN ranks USING (r)
"""


def _sql_vector_codes(rounds: int = 4) -> str:
    """The rounds one after the other: ``best`` assigns, ``book`` moves the entries."""
    best = """best{k} AS MATERIALIZED (
  SELECT r, p, min({{'d': d, 'e': e}}) AS b FROM (
    SELECT r, p, e, sum((x - c) * (x - c)) AS d FROM part JOIN book{k} USING (p, i) GROUP BY r, p, e) GROUP BY r, p),
"""
    book = """book{n} AS MATERIALIZED (
  SELECT p, e, i, coalesce(m, c) AS c FROM book{k} LEFT JOIN (
    SELECT p, b.e AS e, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS m FROM part JOIN best{k} USING (r, p) GROUP BY p, b.e, i)
  USING (p, e, i)),
"""
    steps = "".join(best.format(k=k) + book.format(k=k, n=k + 1) for k in range(rounds)) + best.format(k=rounds)
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
         [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS xs
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
part AS MATERIALIZED (
  SELECT r, (j * 4) // len(xs) AS p, j % (len(xs) // 4) AS i, xs[j + 1] AS x
  FROM (SELECT r, xs, unnest(range(len(xs))) AS j FROM v)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, i, x AS c FROM part WHERE r <= 256),
{steps}coded AS (
  SELECT r, string_agg(printf('%02x', b.e), '' ORDER BY p) AS code, CAST(sum(b.d) AS BIGINT) AS error FROM best{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, i)) FROM book{rounds}) AS codebooks_sha256
FROM v JOIN coded USING (r)
"""


def query(name: str, sql: str | None = None):
    def add(fn):
        LLM_QUERIES[name] = fn
        if sql is not None:
            LLM_ORACLE_SQL[name] = sql
        return fn
    return add


def language_model(docs):
    """The model of the contract: learned from rows whose crc32(doc_id) mod 3 is not 1."""
    return LI.train(docs.where(crc_mod("doc_id", 3) != 1))


@query("op1_language_id")
def q_language_id(spark, sf):
    docs = documents(spark, sf)
    out = LI.identify(docs, language_model(docs), keep=["doc_id"])
    return out.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query("op2_secret_scan")
def q_secret_scan(spark, sf):
    out = SS.find_secrets(documents(spark, sf), keep=["doc_id"], with_text=False)
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess",
                      "max_log10_guesses")


@query("op6_byte_bpe")
def q_byte_bpe(spark, sf):
    return BB.encode(documents(spark, sf), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                     keep=["doc_id"], with_ids=False).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op8_best_fit_packing")
def q_best_fit_packing(spark, sf):
    out = PK.pack(documents(spark, sf), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op10_quality_rules", SQL_QUALITY_RULES)
def q_quality_rules(spark, sf):
    rows = QR.ledger(documents(spark, sf), keep=["doc_id"])
    out = QR.apply_policy(QR.apply_policy(rows, "base", "base_kept"), "v1", "policy_kept")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      (~F.col("base_kept")).alias("base_failed"), (F.col("base_kept") & F.col("policy_kept")).alias("kept"),
                      "fail_bits")


@query("op4_simhash")
def q_simhash(spark, sf):
    out = SH.near_duplicates(documents(spark, sf))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op5_line_dedup")
def q_line_dedup(spark, sf):
    """Per document: its lines, the deleted ones, the maximal repeated runs and
    the digest of what is kept (null text: empty)."""
    none = F.lit(0).cast("long")
    return LD.dedup_lines(documents(spark, sf), keep=["doc_id"]).select(
        "doc_id", "n_lines", F.coalesce("n_deleted", none).alias("n_deleted"), F.coalesce("n_runs", none).alias("n_runs"),
        F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@query("op7_learned_partitions")
def q_learned_partitions(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    return NN.search(rows, F.col("id") % 20 == 0)


@query("op9_quality_classifier")
def q_quality_classifier(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(crc_mod("doc_id", 5) != 0)
    out = QM.score(documents(spark, sf), labels, keep=["doc_id"])
    return out.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op3_suffix_dedup")
def q_suffix_dedup(spark, sf):
    return SD.remove_repeats(documents(spark, sf), keep=["doc_id"]).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


# The rules of the contract.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def listed_hosts(pages):
    """The driver tables hold no list of urls. The query lists, as blocked, the
    canonical urls on hosts with a label for advertising or betting."""
    host = UF.host_of(F.col("url"))
    return (pages.where(host.rlike("(^|[.-])(ads|bets|casino|track)([.-]|$)"))
            .select(UF.canonical(host, UF.path_of(F.col("url"))).alias("canonical"), F.lit("block").alias("verdict")).distinct())


@query("op11_url_filter", SQL_URL_FILTER)
def q_url_filter(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return UF.filter_urls(pages, rules, listed_hosts(pages), keep=["page_id"])


@query("op12_importance_resampling", SQL_RESAMPLING)
def q_importance_resampling(spark, sf):
    out = RS.resample(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"), keep=["doc_id"])
    return out.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_vector_codes", _sql_vector_codes())
def q_vector_codes(spark, sf):
    coded, books = VC.compress(spark.read.parquet(f"{sf}/embeddings.parquet"), keep=["vec_id", "label"])
    out = VC.with_label_error(written(coded, "codes"), "label")
    return out.select("vec_id", "code", "error", "label_error", F.lit(VC.codebooks_digest(books)).alias("codebooks_sha256"))
