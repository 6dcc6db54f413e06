"""DuckDB SQL equivalents of the registered queries (independent oracle)."""

from __future__ import annotations

_INCIDENTS = """
  inc AS (
    SELECT n.n_name AS DISTRICT, l.l_partkey AS OFFENSE_CODE,
           CAST(month(l.l_shipdate) AS INTEGER) AS MONTH,
           CAST(l.l_extendedprice AS DECIMAL(18,2)) AS LAT,
           CAST(l.l_discount AS DECIMAL(18,2)) AS LONG
    FROM lineitem l
    LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
    LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey),
  codes AS (
    SELECT CODE, trim(split_part(NAME, ' ', 1)) AS NAME
    FROM (SELECT DISTINCT p_partkey AS CODE, p_name AS NAME FROM part)),
  j AS (SELECT inc.*, codes.NAME FROM inc JOIN codes ON codes.CODE = inc.OFFENSE_CODE)
"""

_TOP3 = """
  top3 AS (
    SELECT DISTRICT, string_agg(NAME, ', ' ORDER BY rk) AS frequent_crime_types
    FROM (SELECT DISTRICT, NAME,
                 row_number() OVER (PARTITION BY DISTRICT ORDER BY counts DESC, NAME) AS rk
          FROM (SELECT DISTRICT, NAME, count(*) AS counts FROM j GROUP BY 1, 2))
    WHERE rk <= 3
    GROUP BY DISTRICT)
"""

_MEDIAN = """
  med AS (
    SELECT DISTRICT, quantile_disc(counts, 0.5) AS crimes_monthly
    FROM (SELECT DISTRICT, MONTH, count(*) AS counts FROM j GROUP BY 1, 2)
    GROUP BY DISTRICT)
"""

SQL = {
    "incident_report": f"""
WITH {_INCIDENTS}, {_TOP3}, {_MEDIAN},
  tot AS (
    SELECT DISTRICT, count(*) AS crimes_total,
           CAST(round(avg(LAT), 4) AS DECIMAL(18,4)) AS lat,
           CAST(round(avg(LONG), 4) AS DECIMAL(18,4)) AS lng
    FROM j GROUP BY DISTRICT)
SELECT tot.DISTRICT, tot.crimes_total, med.crimes_monthly, top3.frequent_crime_types,
       tot.lat, tot.lng
FROM tot JOIN top3 ON tot.DISTRICT = top3.DISTRICT
         JOIN med ON tot.DISTRICT = med.DISTRICT
""",
    "median_monthly": f"""
WITH {_INCIDENTS.replace("JOIN codes ON", "JOIN codes ON")},
  med AS (
    SELECT DISTRICT, quantile_disc(counts, 0.5) AS crimes_monthly
    FROM (SELECT DISTRICT, MONTH, count(*) AS counts FROM inc GROUP BY 1, 2)
    GROUP BY DISTRICT)
SELECT * FROM med WHERE DISTRICT IS NOT NULL
""",
    "top3_types": f"""
WITH {_INCIDENTS}, {_TOP3}
SELECT * FROM top3 WHERE DISTRICT IS NOT NULL
""",
    "code_name_head": """
SELECT CODE, trim(split_part(NAME, '-', 1)) AS NAME
FROM (SELECT DISTINCT o_orderstatus AS CODE, o_orderpriority AS NAME FROM orders)
""",
}


def _stage(table: str, prefix: str) -> str:
    return f"""
    SELECT n.n_name AS District, count(*) AS Crimes_total,
           CAST(sum(CASE WHEN x.{prefix}_acctbal > 0 THEN 1 ELSE 0 END) AS BIGINT) AS Crimes_monthly,
           min(x.{prefix}_name) AS Frequent_crime_types,
           CAST(CAST(min(x.{prefix}_acctbal) AS DECIMAL(18,2)) AS DECIMAL(37,15)) AS Lat,
           CAST(CAST(max(x.{prefix}_acctbal) AS DECIMAL(18,2)) AS DECIMAL(37,15)) AS Lng
    FROM {table} x JOIN nation n ON x.{prefix}_nationkey = n.n_nationkey
    GROUP BY n.n_name"""


_HASHDIFF = """md5(CAST(coalesce(CAST(Crimes_total AS INTEGER), 0) AS VARCHAR)
        || CAST(coalesce(CAST(Crimes_monthly AS INTEGER), 0) AS VARCHAR)
        || coalesce(CAST(Frequent_crime_types AS VARCHAR), 'NULL')
        || CAST(coalesce(CAST(Lat AS DECIMAL(37,15)), CAST(0.0 AS DECIMAL(37,15))) AS VARCHAR)
        || CAST(coalesce(CAST(Lng AS DECIMAL(37,15)), CAST(0.0 AS DECIMAL(37,15))) AS VARCHAR))"""

_REST = """
  rest AS (
    SELECT * FROM stage WHERE District NOT IN (
      SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey
      WHERE r_name IN ('AFRICA', 'AMERICA')))"""

_CUR = "CAST(2 AS BIGINT) AS FILE_ID, TIMESTAMP '2024-01-01 00:00:00' AS LOAD_TS"

_OPS = """(SELECT *, CASE WHEN event_type = 'signup' THEN 'c'
                          WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op FROM events)"""


# the CDC feed: an update before every delete, every second creation a snapshot row
_FEED = f"""(SELECT *, CASE WHEN op = 'c' AND event_id % 2 = 0 THEN 'r' ELSE op END AS code,
                    CASE WHEN op = 'd' THEN 1 ELSE 0 END AS step FROM {_OPS}
             UNION ALL SELECT *, 'u', 0 FROM {_OPS} WHERE op = 'd')"""


def _cdc_side(side: str, skip_ops: str) -> str:
    cols = [("id", "CAST(user_id AS INTEGER)"), ("first_name", "event_type"),
            ("last_name", "CAST(event_id AS VARCHAR)"), ("email", "props")]
    return ",\n       ".join(
        f"CASE WHEN code IN ({skip_ops}) THEN NULL ELSE {expr} END AS {side}_{name}"
        for name, expr in cols)


SQL.update({
    "customer_weight": """
SELECT c.c_custkey AS id, c.c_name AS name, CAST(sum(p.p_size) AS BIGINT) AS total_weight,
       TIMESTAMP '2024-01-01 00:00:00' AS load_dttm
FROM customer c
LEFT JOIN orders o ON c.c_custkey = o.o_custkey
LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY c.c_custkey, c.c_name
""",
    "file_log_once": f"""
WITH stage AS ({_stage('supplier', 's')})
SELECT CAST(1 AS BIGINT) AS FILE_ID, 'ERP' AS SOURCE, 'STG_REF' AS FILE_NAME,
       TIMESTAMP '2023-12-01 00:00:00' AS LOAD_TS
UNION ALL
SELECT 2, 'ERP', 'STG_OPER', TIMESTAMP '2024-01-01 00:00:00' WHERE EXISTS (SELECT 1 FROM stage)
""",
    "latest_file": """
SELECT FILE_ID, SOURCE, FILE_NAME, LOAD_TS FROM (
  SELECT event_id AS FILE_ID, event_type AS SOURCE, CAST(user_id AS VARCHAR) AS FILE_NAME, ts AS LOAD_TS,
         row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events)
WHERE rn = 1
""",
    "ods_delta": f"""
WITH stage AS ({_stage('supplier', 's')}), {_REST}
SELECT {_CUR}, District, Crimes_total, Crimes_monthly, Frequent_crime_types, Lat, Lng FROM rest
""",
    "hub_delta": f"""
WITH stage AS ({_stage('supplier', 's')}), {_REST}
SELECT md5(District) AS HK_DISTRICT, {_CUR}, District AS DISTRICT FROM rest
""",
    "sat_delta": f"""
WITH stage AS ({_stage('supplier', 's')}), {_REST}
SELECT md5(District) AS HK_DISTRICT, {_CUR}, TIMESTAMP '2024-01-01 00:00:00' AS ROW_LOAD_TS,
       CAST(2 AS BIGINT) AS LOAD_SEQ, {_HASHDIFF} AS HASHDIFF,
       Crimes_total AS CRIMES_TOTAL, Crimes_monthly AS CRIMES_MONTHLY,
       Frequent_crime_types AS FREQUENT_CRIME_TYPES, Lat AS LAT, Lng AS LNG
FROM rest
""",
    "vault_current": f"""
WITH v1 AS ({_stage('supplier', 's')}), v2 AS ({_stage('customer', 'c')}),
  cur AS (SELECT * REPLACE (Crimes_total - 1 AS Crimes_total) FROM v2 UNION ALL
          SELECT * FROM v1 WHERE District NOT IN (SELECT District FROM v2))
SELECT District AS DISTRICT, Crimes_total AS CRIMES_TOTAL, Crimes_monthly AS CRIMES_MONTHLY,
       Frequent_crime_types AS FREQUENT_CRIME_TYPES, Lat AS LAT, Lng AS LNG
FROM cur
""",
    "key_check": """
SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY o_custkey
HAVING count(*) > 1 OR o_custkey IS NULL
""",
    "lookup_by_id": """
SELECT o.o_orderkey, o.o_custkey, CAST(c.c_acctbal AS DECIMAL(18,2)) AS ltv
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""",
    "lookup_by_attr": """
WITH store AS (SELECT c_custkey AS customer_id, CAST(c_nationkey AS VARCHAR) AS phone,
                      CAST(c_acctbal AS DECIMAL(18,2)) AS ltv FROM customer),
  first AS (SELECT phone, arg_min(ltv, customer_id) AS ltv FROM store GROUP BY phone)
SELECT s.s_suppkey, s.s_nationkey, f.ltv
FROM supplier s LEFT JOIN first f ON CAST(s.s_nationkey AS VARCHAR) = f.phone
""",
    "apply_changes": f"""
SELECT user_id, ts, event_id, event_type, CAST(value AS DECIMAL(18,2)) AS value, op FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM {_OPS})
WHERE rn = 1 AND op <> 'd'
""",
    "cdc_parse": f"""
SELECT code AS op, epoch_us(ts) // 1000 AS ts_ms,
       {_cdc_side('before', "'c', 'r'")},
       {_cdc_side('after', "'d'")},
       CAST(NULL AS VARCHAR) AS source_version, CAST(NULL AS VARCHAR) AS source_connector,
       CAST(NULL AS VARCHAR) AS source_name, 'shop' AS source_db, epoch_us(ts) // 1000 * 1000 AS source_ts_usec,
       CASE WHEN code <> 'r' THEN event_id END AS source_txid, event_id * 10 + step AS source_lsn,
       CAST(NULL AS VARCHAR) AS source_schema, 'events' AS source_table, code = 'r' AS source_snapshot,
       CAST(NULL AS BOOLEAN) AS source_last_snapshot_record, CAST(NULL AS BIGINT) AS source_xmin
FROM {_FEED}
""",
    "json_flatten": """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events WHERE props IS NOT NULL
""",
    "guarded_counts": """
SELECT event_type AS type, count(*) AS count FROM events
WHERE event_type <> 'error' AND event_type <> '142' GROUP BY event_type
""",
    "slide_300_10": """
SELECT ws AS window_start, ws + INTERVAL 300 SECOND AS window_end, type, count(*) AS count
FROM (SELECT time_bucket(INTERVAL '10 seconds', ts, TIMESTAMP '1970-01-01') - to_seconds(10 * k) AS ws,
             event_type AS type
      FROM events, range(30) r(k)
      WHERE ts IS NOT NULL)
GROUP BY ws, type
""",
    "stream_stats": """
SELECT event_type, count(*) AS total_messages, min(ts) AS first_message, max(ts) AS last_message,
       CAST(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) AS DECIMAL(18,4)) AS messages_per_sec
FROM events GROUP BY event_type
""",
    "search_top10": """
SELECT user_id AS key, count(*) AS doc_count FROM events
WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-22 00:00:00'
GROUP BY user_id ORDER BY doc_count DESC, key ASC LIMIT 10
""",
    "label_balance": """
SELECT l.quality AS label, count(*) AS count
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY l.quality
""",
    "score_bands": """
SELECT CASE WHEN s > 0.55 THEN 'positive' WHEN s < 0.45 THEN 'negative' ELSE 'undefine' END
         AS clean_probability,
       count(*) AS count
FROM (SELECT CASE WHEN length(text) > 0
                  THEN length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) / length(text) END AS s
      FROM documents)
GROUP BY 1
""",
    "histogram10": """
WITH v AS (SELECT CAST(value AS DOUBLE) AS v FROM events WHERE value IS NOT NULL),
  b AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
  c AS (SELECT CAST(CASE WHEN hi - lo = 0 THEN 1
                         ELSE least(floor((v - lo) / (hi - lo) * 10), 9) + 1 END AS INTEGER) AS bin,
               count(*) AS count
        FROM v, b GROUP BY 1),
  f AS (SELECT CAST(i AS INTEGER) AS bin, lo, hi FROM b, range(1, 11) r(i) WHERE lo IS NOT NULL)
SELECT f.bin,
       CAST(lo + (f.bin - 1) * ((hi - lo) / 10) AS DECIMAL(18,4)) AS bin_start,
       CAST(CASE WHEN f.bin = 10 THEN hi ELSE lo + f.bin * ((hi - lo) / 10) END AS DECIMAL(18,4)) AS bin_end,
       coalesce(c.count, 0) AS count
FROM f LEFT JOIN c ON f.bin = c.bin
""",
    "clean_tokens": """
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id,
             list_filter(string_split_regex(regexp_replace(text, '[^a-zA-Z]', ' ', 'g'), '\\s+'),
                         lambda w: length(w) > 3) AS t
      FROM documents)
""",
})


SQL.update({
    "window_append_20_10": """
WITH ne AS (SELECT ts, event_type FROM events WHERE event_type <> 'error' AND ts IS NOT NULL),
  wm AS (SELECT max(ts) - INTERVAL 20 SECOND AS w FROM ne),
  win AS (SELECT time_bucket(INTERVAL '10 seconds', ts, TIMESTAMP '1970-01-01') - to_seconds(10 * k) AS ws,
                 event_type AS type
          FROM ne, range(2) r(k))
SELECT ws AS window_start, ws + INTERVAL 20 SECOND AS window_end, type, count(*) AS count
FROM win, wm WHERE ws + INTERVAL 20 SECOND <= wm.w
GROUP BY ws, type
""",
    "filtered_stream": """
SELECT epoch_us(ts) // 1000 AS CREATEDAT, event_type AS CHANNEL, CAST(user_id AS VARCHAR) AS USERNAME,
       props AS WIKIPAGE, CAST(event_id AS VARCHAR) AS DIFFURL
FROM events WHERE event_type <> 'click' AND event_type <> 'error'
""",
    "cdc_apply_stream": f"""
SELECT CAST(user_id AS INTEGER) AS id, event_type AS first_name, CAST(event_id AS VARCHAR) AS last_name,
       props AS email
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
      FROM {_OPS})
WHERE rn = 1 AND op <> 'd'
""",
})

SQL["incident_report_sql"] = SQL["incident_report"]

SQL["incident_report_csv"] = SQL["incident_report"]
SQL["tweet_labels_csv"] = SQL["label_balance"].replace("l.quality AS label", "CASE WHEN l.quality * 4 = 4 THEN 1 ELSE 0 END AS label").replace("GROUP BY l.quality", "GROUP BY 1")
SQL["json_records"] = """
SELECT CAST(p_partkey AS DECIMAL(38,0)) AS id,
       coalesce(CASE WHEN p_size > 25 THEN p_brand END, 'empty country') AS country,
       CAST(p_size AS DECIMAL(38,0)) AS points,
       coalesce(p_name, 'empty title') AS title,
       coalesce(p_type, 'empty variety') AS variety,
       'empty winery' AS winery
FROM part
"""

SQL["lang_index_search"] = """
SELECT event_type AS key, count(*) AS doc_count FROM events
WHERE event_type <> 'click' AND event_type <> 'error'
  AND ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-22 00:00:00'
GROUP BY event_type ORDER BY doc_count DESC, key ASC LIMIT 10
"""

# event times truncated to whole seconds on the feed fall in the same 10 s
# windows and meet the same watermark tests (window ends are whole multiples)
SQL["window_append_json"] = SQL["window_append_20_10"]

SQL["report_to_vault"] = "SELECT DISTRICT, crimes_total AS CRIMES_TOTAL, crimes_monthly AS CRIMES_MONTHLY, " \
    "frequent_crime_types AS FREQUENT_CRIME_TYPES, CAST(lat AS DECIMAL(37,15)) AS LAT, " \
    "CAST(lng AS DECIMAL(37,15)) AS LNG FROM (" + SQL["incident_report"] + ")"

SQL["customer_weight_upto"] = SQL["customer_weight"].replace("GROUP BY", "WHERE c.c_custkey <= 100\nGROUP BY")

SQL["upsert_last"] = """
WITH last AS (
  SELECT o_custkey AS customer_id, o_orderstatus AS phone, CAST(o_totalprice AS DECIMAL(18,2)) AS ltv FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
  WHERE rn = 1)
SELECT * FROM last UNION ALL
SELECT c_custkey, CAST(c_nationkey AS VARCHAR), CAST(c_acctbal AS DECIMAL(18,2)) FROM customer
WHERE c_custkey NOT IN (SELECT customer_id FROM last)
"""

SQL["search_must_not"] = """
SELECT event_type AS key, count(*) AS doc_count FROM events
WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-22 00:00:00'
  AND user_id IS NOT NULL AND event_type <> 'error'
GROUP BY event_type ORDER BY doc_count DESC, key ASC LIMIT 10
"""

SQL["tweet_text_csv"] = """
SELECT d.doc_id AS id, CASE WHEN l.quality = 1 THEN 1 ELSE 0 END AS label, md5(d.text) AS tweet_md5
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""

SQL["json_append"] = """
SELECT p_partkey AS id, p_name AS title, CAST(n AS BIGINT) AS copies FROM part, (SELECT 2 AS n)
"""

SQL["typed_change_stream"] = """
SELECT event_id AS id, event_type AS type, event_type = 'error' AS bot, CAST(user_id AS VARCHAR) AS "user",
       epoch_us(ts) // 1000000 AS "timestamp", 'dom' || (event_id % 7) AS meta_domain, event_id AS length_new,
       event_id - 1 AS length_old, event_id * 2 AS revision_new, CAST(event_id AS VARCHAR) AS title
FROM events
"""

SQL["legacy_type_counts"] = """
WITH c AS (SELECT event_type AS type, time_bucket(INTERVAL '5 seconds', ts, TIMESTAMP '1970-01-01') AS load, count(*) AS n
           FROM events WHERE event_type <> 'error' AND event_type <> '142' GROUP BY 1, 2)
SELECT time_bucket(INTERVAL '10 seconds', load, TIMESTAMP '1970-01-01') - to_seconds(10 * k) AS window_start,
       time_bucket(INTERVAL '10 seconds', load, TIMESTAMP '1970-01-01') - to_seconds(10 * k) + INTERVAL 300 SECOND AS window_end,
       type, CAST(sum(n) AS BIGINT) AS count
FROM c, range(30) r(k) GROUP BY 1, 2, 3
"""

SQL["block_scores"] = """
WITH f AS (SELECT doc_id, ln(1 + length(text)) AS a,
                  CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) / length(text) ELSE 0 END AS b,
                  length(text) / len(string_split_regex(trim(text), '\\s+')) AS c FROM documents),
  g AS (SELECT l.quality AS y, count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc,
               var_pop(a) AS va, var_pop(b) AS vb, var_pop(c) AS vc
        FROM f JOIN labels l ON f.doc_id = l.doc_id GROUP BY 1),
  p AS (SELECT x.n AS n0, z.n AS n1, x.ma AS a0, z.ma AS a1, x.mb AS b0, z.mb AS b1, x.mc AS c0, z.mc AS c1,
               greatest(1e-12, (x.n * x.va + z.n * z.va) / (x.n + z.n)) AS va,
               greatest(1e-12, (x.n * x.vb + z.n * z.vb) / (x.n + z.n)) AS vb,
               greatest(1e-12, (x.n * x.vc + z.n * z.vc) / (x.n + z.n)) AS vc
        FROM g x, g z WHERE x.y = 0 AND z.y = 1)
SELECT doc_id, CAST(round(1 / (1 + exp(-(
         (a1 - a0) / va * a + (b1 - b0) / vb * b + (c1 - c0) / vc * c + ln(n1 / n0)
         - ((a1*a1 - a0*a0) / (2*va) + (b1*b1 - b0*b0) / (2*vb) + (c1*c1 - c0*c0) / (2*vc))))), 6) AS DECIMAL(18,6)) AS proba
FROM f, p
"""

SQL["vault_catalog"] = SQL["vault_current"]

SQL["legacy_live_counts"] = SQL["legacy_type_counts"]

SQL["window_state_restart"] = """
WITH ne AS (SELECT ts, event_type FROM events WHERE event_type <> 'error' AND ts IS NOT NULL),
  wm AS (SELECT max(ts) - INTERVAL 20 SECOND AS w FROM ne),
  win AS (SELECT time_bucket(INTERVAL '10 seconds', ts, TIMESTAMP '1970-01-01') - to_seconds(10 * k) AS ws, event_type AS type
          FROM ne, range(2) r(k))
SELECT ws AS window_start, ws + INTERVAL 20 SECOND AS window_end, type, count(*) AS count, ws + INTERVAL 20 SECOND <= any_value(wm.w) AS closed
FROM win, wm GROUP BY ws, type
"""

SQL["cdc_redelivered"] = f"""
SELECT c.*, n.n AS n_messages FROM ({SQL["cdc_apply_stream"]}) c
JOIN (SELECT CAST(user_id AS INTEGER) AS id, count(*) AS n FROM {_FEED} GROUP BY 1) n USING (id)
"""

SQL["record_effects"] = SQL["json_records"]

SQL["replicated_join"] = SQL["bloom_join"] = """
SELECT p_brand, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS quantity
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size >= 45 GROUP BY p_brand
"""

# a draw: the first 13 hexadecimal digits of an md5 as a fraction
_DRAW = "CAST('0x' || substr(md5('42:{}:' || doc_id), 1, 13) AS BIGINT) / 4503599627370496.0"

SQL["samples"] = f"""
WITH d AS (SELECT doc_id FROM documents JOIN labels USING (doc_id)),
  rate AS (SELECT 16.0 / greatest(1, count(*)) AS r FROM d),
  steps AS (SELECT list_transform(range(0, 25), lambda k:
              exp(-r) * list_sum(list_transform(range(0, k + 1), lambda i: pow(r, i) / factorial(CAST(i AS INTEGER))))) AS s FROM rate),
  copies AS (SELECT doc_id, len(list_filter(s, lambda p: p <= {_DRAW.format('feed')})) AS n FROM d, steps)
SELECT doc_id, 'sample' AS part FROM d WHERE {_DRAW.format('sample')} < 0.005
UNION ALL SELECT doc_id, 'feed' FROM copies, range(n)
UNION ALL SELECT doc_id, CASE WHEN {_DRAW.format('split')} < 0.7 THEN 'train' ELSE 'test' END FROM d
"""

# Newton's method for three standardised numbers: each step adds up gradient
# and Hessian and solves the system by Cholesky's decomposition
_NEWTON = """
WITH RECURSIVE f AS (SELECT doc_id, ln(1 + length(text)) AS a,
                  CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) / length(text) ELSE 0 END AS b,
                  length(text) / len(string_split_regex(trim(text), '\\s+')) AS c FROM documents),
  l AS (SELECT f.*, CAST(quality AS DOUBLE) AS y FROM f JOIN labels USING (doc_id) WHERE quality IN (0, 1)),
  m AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, stddev_samp(a) AS sa, stddev_samp(b) AS sb, stddev_samp(c) AS sc, 0.001 * count(*) AS r FROM l),
  x AS (SELECT (a - ma) / sa AS x1, (b - mb) / sb AS x2, (c - mc) / sc AS x3, y, r FROM l, m),
  w(k, w0, w1, w2, w3) AS (
    SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)
    UNION ALL
    SELECT k + 1, w0 + d0, w1 + d1, w2 + d2, w3 + d3 FROM (
      SELECT *, z3 / l33 AS d3, (z2 - l32 * d3) / l22 AS d2, (z1 - l21 * d2 - l31 * d3) / l11 AS d1, (z0 - l10 * d1 - l20 * d2 - l30 * d3) / l00 AS d0 FROM (
        SELECT *, sqrt(h00) AS l00, h01 / l00 AS l10, h02 / l00 AS l20, h03 / l00 AS l30, sqrt(h11 - l10 * l10) AS l11,
               (h12 - l20 * l10) / l11 AS l21, (h13 - l30 * l10) / l11 AS l31, sqrt(h22 - l20 * l20 - l21 * l21) AS l22,
               (h23 - l30 * l20 - l31 * l21) / l22 AS l32, sqrt(h33 - l30 * l30 - l31 * l31 - l32 * l32) AS l33,
               g0 / l00 AS z0, (g1 - l10 * z0) / l11 AS z1, (g2 - l20 * z0 - l21 * z1) / l22 AS z2, (g3 - l30 * z0 - l31 * z1 - l32 * z2) / l33 AS z3
        FROM (
          SELECT k, w0, w1, w2, w3, sum(q) AS h00, sum(q * x1) AS h01, sum(q * x2) AS h02, sum(q * x3) AS h03, sum(q * x1 * x1) + any_value(r) AS h11,
                 sum(q * x1 * x2) AS h12, sum(q * x1 * x3) AS h13, sum(q * x2 * x2) + any_value(r) AS h22, sum(q * x2 * x3) AS h23,
                 sum(q * x3 * x3) + any_value(r) AS h33, sum(y - p) AS g0, sum((y - p) * x1) - any_value(r) * w1 AS g1,
                 sum((y - p) * x2) - any_value(r) * w2 AS g2, sum((y - p) * x3) - any_value(r) * w3 AS g3
          FROM (SELECT w.*, x.*, 1 / (1 + exp(-(w0 + w1 * x1 + w2 * x2 + w3 * x3))) AS p, p * (1 - p) AS q FROM w, x WHERE k < 15)
          GROUP BY k, w0, w1, w2, w3)))),
  fit AS (SELECT w0 - w1 / sa * ma - w2 / sb * mb - w3 / sc * mc AS i, w1 / sa AS ca, w2 / sb AS cb, w3 / sc AS cc FROM w, m WHERE k = 15)
"""

SQL["newton_coefficients"] = _NEWTON + """
SELECT term, CAST(round(v, 6) AS DECIMAL(18,6)) AS coefficient
FROM (SELECT unnest(['intercept', 'n_chars', 'letter_share', 'mean_word_len']) AS term, unnest([i, ca, cb, cc]) AS v FROM fit)
"""

SQL["newton_scores"] = _NEWTON + """
SELECT doc_id, CAST(round(1 / (1 + exp(-(i + ca * a + cb * b + cc * c))), 6) AS DECIMAL(18,6)) AS proba FROM f, fit
"""

SQL["newton_stream_bands"] = _NEWTON + """
SELECT CASE WHEN p > 0.55 THEN 'positive' WHEN p < 0.45 THEN 'negative' ELSE 'undefine' END AS clean_probability, count(*) AS count
FROM (SELECT 1 / (1 + exp(-(i + ca * a + cb * b + cc * c))) AS p FROM f, fit) GROUP BY 1
"""

SQL["lower_tokens"] = """
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id, string_split_regex(regexp_replace(lower(text), '[ \\t\\n\\x0B\\f\\r]+$', ''), '[ \\t\\n\\x0B\\f\\r]') AS t FROM documents)
"""
