"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbend.llm import (
    alignment, decontaminate, forest, html_text, packing, phrases, pii, quality, runs, simhash, suffix_array, toxicity, url_filter)
from riverbend.llm.common import table

#: The key of the registered queries; a real run passes its own secret.
PII_KEY = b"riverbend demonstration key"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ALIGNED = alignment.Vocabularies(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                 public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


def op5_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.remove_passages(table(spark, sf_dir, "documents")).drop("n_spans")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_table(table(spark, sf_dir, "documents"), PII_KEY)


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.remove_repeated_bytes(table(spark, sf_dir, "documents"))


def op8_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_table(table(spark, sf_dir, "documents"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``documents`` as the contract of op12 has them: h is the CRC-32 of the id's
    decimal digits and g = h / 10; where h is a multiple of 10, the n words from
    word a = g mod n on become repetitions of their first 1 + (n - a) / (3 + g mod 8).
    A null id has no h, and its text stays."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    own = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    own = own.select("*", F.size("words").alias("n"), F.floor(F.col("h") / 10).cast("long").alias("g")).select("*", (F.col("g") % F.col("n")).cast("int").alias("a"))
    p = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    own = own.select("*", p.alias("p"))
    unit = F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int"))
    planted = F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), F.flatten(unit)), F.lit(1), F.col("n"))
    return own.select("doc_id", F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    found = found.select("doc_id", "runs", "collapsed", runs.strongest(F.col("runs")).alias("best"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(runs.listing(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_table(table(spark, sf_dir, "documents"), ALIGNED)


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_decontamination, op3_quality, op4_packing, op5_phrases, op6_pii, op7_suffix_array, op8_prefix_forest, op9_html, op10_simhash,
    op11_url_filter, op12_periodic_runs, op13_alignment)}


def _url_sql() -> str:
    """Every term as a regular expression with its neighbours."""
    def hits(terms: tuple[str, ...]) -> str:
        return " + ".join(rf"CAST(regexp_matches(u, '(^|[^a-z0-9\x{{80}}-\x{{10FFFF}}]){t}([^a-z0-9\x{{80}}-\x{{10FFFF}}]|$)') AS BIGINT)" for t in terms)

    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    fits = "CASE WHEN (host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}') THEN {{'n': {3}, 'name': '{0}{1}', 'verdict': '{2}'}} END"
    rules = ", ".join(fits.format(r.host, r.path, r.verdict, len(r.name)) for r in url_filter.RULES)
    return f"""
WITH p AS (SELECT page_id, coalesce({lower.format("regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1)")}, '') AS host,
                  coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path, {lower.format("url_decode(coalesce(url, ''))")} AS u FROM pages),
  r AS (SELECT page_id, host, path, list_sort(list_filter([{rules}], lambda x: x IS NOT NULL), 'DESC')[1] AS fit,
               {hits(url_filter.STRICT_TERMS)} AS n_strict, {hits(url_filter.SOFT_TERMS)} AS n_soft FROM p)
SELECT page_id, host, path, fit.name AS rule,
       coalesce(fit.verdict, CASE WHEN n_strict >= 1 OR n_soft >= 2 THEN 'block' ELSE 'allow' END) AS verdict, n_strict, n_soft
FROM r
"""


# whole tables, by brute force: every window is a row
SQL: dict[str, str] = {
    "op11_url_filter": _url_sql(),
    "op5_phrases": r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
  win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h FROM w, range(1, len(ws) - 48) r(i)),
  least AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
  gone AS (SELECT DISTINCT doc_id, i + k AS p FROM win JOIN least USING (h), range(50) t(k) WHERE m < doc_id),
  words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
  kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""",
    "op7_suffix_array": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
  win AS (SELECT doc_id, i, md5(substr(x, CAST(2 * i + 1 AS BIGINT), 400)) AS h FROM d, range(n - 199) r(i)),
  dup AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
  starts AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step FROM win SEMI JOIN dup USING (h)),
  runs AS (SELECT doc_id, i, sum(CASE WHEN step <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM starts),
  spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 200 AS b FROM runs GROUP BY doc_id, run),
  gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
  kept AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
                  string_agg(substr(x, CAST(2 * before + 1 AS BIGINT), CAST(2 * (a - before) AS BIGINT)), '' ORDER BY a) AS t
           FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(t, '') || substr(x, CAST(2 * coalesce(last, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op12_periodic_runs": r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
                  xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                      lambda crc, c: list_reduce(list_concat([xor(crc, c)], range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS h
           FROM documents),
  g AS (SELECT doc_id, ws, len(ws) AS n, h // 10 AS g, h % 10 = 0 AS planted FROM d),
  a AS (SELECT *, CASE WHEN planted AND n > 0 THEN g % n ELSE n END AS a FROM g),
  p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
  w AS (SELECT doc_id, n, i, ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] AS word FROM p, range(n) r(i)),
  same AS (SELECT x.doc_id, x.n, y.i - x.i AS q, x.i AS i FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND (y.i - x.i) * 4 <= x.n),
  steps AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM same),
  long AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM steps GROUP BY doc_id, q, part HAVING count(*) + q >= greatest(6, 4 * q)),
  runs AS (SELECT * FROM long x WHERE NOT EXISTS (
             SELECT 1 FROM long y WHERE x.doc_id = y.doc_id AND y.q < x.q AND y.s <= x.s AND y.s + y.l >= x.s + x.l)),
  best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CAST(l AS DOUBLE) / q DESC, s, q) = 1),
  lists AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM runs GROUP BY doc_id),
  gone AS (SELECT DISTINCT doc_id, k AS i FROM runs, range(s + q, s + l) r(k)),
  kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, CAST(best.l AS BIGINT) AS length, best.q AS period,
       CAST(1000 * best.l // best.q AS BIGINT) AS exponent_milli, sha256(coalesce(lists.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM d LEFT JOIN lists USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
}
