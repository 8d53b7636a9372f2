"""DuckDB SQL for the registered queries, written against the given tables.

``kmeans_fit`` states what holds for any sound fit: an iterative fit itself has no SQL form.
"""

from __future__ import annotations

RATINGS = """
ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS movie_id, CAST(l_quantity AS INTEGER) AS rating,
         l_shipdate AS rated_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
users AS (SELECT c_custkey AS user_id, c_mktsegment AS gender, c_nationkey AS age FROM customer),
movies AS (SELECT p_partkey AS movie_id, p_name AS title FROM part)
"""

EVENTS = """
ev AS (
  SELECT event_id, user_id, event_type, value, ts, props, epoch_us(ts) // 1000 AS ms,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events)
"""

LOG = (
    EVENTS
    + """,
logged AS (
  SELECT event_id, user_id, ts, ms, k,
    ms AS "timestamp",
    '10.0.' || (user_id % 256) || '.' || (event_id % 256) AS ip,
    'A' || user_id AS ai, k AS am, CAST(k % 5 AS VARCHAR) AS appkey,
    CASE WHEN k % 13 <> 0 THEN
      CASE k % 4 WHEN 0 THEN 'us' WHEN 1 THEN 'cn' WHEN 2 THEN 'fr' ELSE 'de' END END AS c,
    CAST(0 AS BIGINT) AS cc,
    CASE WHEN k % 11 <> 0 THEN 'ch' || (k % 7) END AS ch,
    strftime(ts, '%Y-%m-%d') AS "dateTime",
    CAST(0 AS BIGINT) AS fr, CAST(1280 AS BIGINT) AS h,
    'I' || user_id AS im, event_id % 2 = 0 AS ir, 'en' AS la, 'M' || user_id AS mac,
    CAST(0 AS BIGINT) AS om, 'app.' || event_type AS pn,
    CAST(floor(value) AS BIGINT) AS sv, 'T' || (user_id % 10) AS t, CAST(720 AS BIGINT) AS w,
    event_id % 4 AS n_sessions, event_id % 50 = 0 AS damaged
  FROM ev),
good AS (SELECT * FROM logged WHERE NOT damaged),
sess AS (
  SELECT g.*, i, ms + i * 1000 AS s,
         CASE WHEN k % 3 <> 0 THEN ms + i * 1000 + k * 10 + i END AS e
  FROM good g, LATERAL (SELECT unnest(range(1, g.n_sessions + 1)) AS i)),
keyed AS (
  SELECT *, coalesce(pn, 'null') || '#' || coalesce(ch, 'null') || '#' || coalesce(c, 'null')
            || coalesce(appkey, 'null') AS id
  FROM good)
"""
)

ORDER_DOCS = """
docs AS (
  SELECT CAST(o_custkey AS VARCHAR) || '#' || o_orderpriority AS id, o_orderdate,
         strftime(o_orderdate, '%Y-%m-%d') AS day
  FROM orders),
stored AS (
  SELECT id, count(*) AS n_orders, max(day) AS last_day, 'old' AS origin
  FROM docs WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY id),
incoming AS (
  SELECT id, count(*) AS n_orders, max(day) AS last_day
  FROM docs WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY id)
"""

VISITS = """
visits AS (SELECT user_id AS device_id, event_type, ts, CAST(ts AS DATE) AS day FROM events)
"""


def iso(ms: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


ORACLES: dict[str, str] = {}

ORACLES["audience_profile"] = f"""
WITH {RATINGS}
SELECT gender, age, count(*) AS n
FROM ratings JOIN users USING (user_id)
WHERE movie_id = (SELECT min(movie_id) FROM movies WHERE title = 'red plate')
GROUP BY gender, age
"""

ORACLES["audience_profile_semi"] = f"""
WITH {RATINGS}
SELECT gender, age, count(*) AS n
FROM users
WHERE user_id IN (
  SELECT user_id FROM ratings
  WHERE movie_id = (SELECT min(movie_id) FROM movies WHERE title = 'red plate'))
GROUP BY gender, age
"""

ORACLES["topk_popular"] = f"""
WITH {RATINGS}
SELECT movie_id, count(*) AS n
FROM ratings JOIN users USING (user_id)
WHERE gender = 'MACHINERY' AND age = 18
GROUP BY movie_id ORDER BY n DESC, movie_id LIMIT 10
"""

ORACLES["topk_popular_named"] = f"""
WITH {RATINGS},
best AS (
  SELECT movie_id, count(*) AS n
  FROM ratings
  WHERE user_id IN (SELECT user_id FROM users WHERE gender = 'MACHINERY' AND age = 18)
  GROUP BY movie_id ORDER BY n DESC, movie_id LIMIT 10)
SELECT movie_id, (SELECT max(title) FROM movies m WHERE m.movie_id = best.movie_id) AS title, n
FROM best
"""

ORACLES["topk_rating_sum"] = f"""
WITH {RATINGS}
SELECT movie_id, CAST(sum(rating) AS BIGINT) AS rating_sum
FROM ratings JOIN users USING (user_id)
WHERE gender = 'MACHINERY' AND age = 18
GROUP BY movie_id ORDER BY rating_sum DESC, movie_id LIMIT 10
"""

ORACLES["topk_avg_rating"] = f"""
WITH {RATINGS}
SELECT movie_id, CAST(CAST(sum(rating) AS FLOAT) / CAST(count(*) AS FLOAT) AS FLOAT) AS mean_rating
FROM ratings GROUP BY movie_id ORDER BY mean_rating DESC, movie_id LIMIT 10
"""

ORACLES["topk_users"] = f"""
WITH {RATINGS}
SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id ORDER BY n DESC, user_id LIMIT 10
"""

ORACLES["topk_users_by_group"] = f"""
WITH {RATINGS},
counts AS (
  SELECT gender, user_id, count(*) AS n
  FROM ratings JOIN users USING (user_id)
  WHERE gender IN ('BUILDING', 'MACHINERY') GROUP BY gender, user_id)
SELECT gender, user_id, n
FROM (SELECT *, row_number() OVER (PARTITION BY gender ORDER BY n DESC, user_id) AS rn FROM counts)
WHERE rn <= 10
"""

ORACLES["scan_text"] = """
WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT CAST(length(line) AS INTEGER) AS n_chars, count(*) AS n, min(line) AS first_line,
       max(line) AS last_line
FROM lines GROUP BY 1
"""

ORACLES["scan_delimited"] = f"""
WITH {RATINGS}
SELECT rating, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS user_sum,
       CAST(sum(movie_id) AS BIGINT) AS movie_sum,
       CAST(sum(date_diff('day', DATE '1970-01-01', CAST(rated_at AS DATE))) AS BIGINT) AS day_sum
FROM ratings GROUP BY rating
"""

ORACLES["json_scan"] = """
SELECT o_custkey || '@mail.test' AS author_email, md5(CAST(o_orderkey AS VARCHAR)) AS "commit"
FROM orders
"""

ORACLES["csv_seasons"] = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS season, o_orderstatus AS team, count(*) AS n,
       CAST(0 AS BIGINT) AS n_gs, CAST(sum(o_custkey % 20 + 18) AS BIGINT) AS age_sum,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS points
FROM orders GROUP BY 1, 2
"""

ORACLES["scan_vectors"] = """
SELECT CAST(len(embedding) AS INTEGER) AS dimension, count(*) AS n,
       CAST(min(list_min(embedding)) AS DOUBLE) AS least,
       CAST(max(list_max(embedding)) AS DOUBLE) AS greatest
FROM embeddings GROUP BY 1
"""

ORACLES["range_indicator"] = """
SELECT CAST(sum(CASE WHEN a * a + b * b > 0 THEN 1 ELSE 0 END) AS BIGINT) AS hits
FROM (SELECT i % 7 * 2 - 6 AS a, i % 5 * 2 - 4 AS b
      FROM (SELECT unnest(range(1, (SELECT count(*) FROM lineitem) + 1)) AS i))
"""
ORACLES["range_indicator"] = f"""
SELECT r.hits, i.item_hits FROM ({ORACLES["range_indicator"]}) r, (
  SELECT count(*) FILTER (WHERE l_linenumber * 2 - 6 <> 0
                          OR CAST(trunc(l_quantity) AS BIGINT) % 5 * 2 - 4 <> 0) AS item_hits
  FROM lineitem) i
"""

ORACLES["drop_column"] = """
SELECT o_custkey || '@mail.test' AS author_email, md5(CAST(o_orderkey AS VARCHAR)) AS "commit",
       strftime(o_orderdate, '%Y-%m-%d') AS "date"
FROM orders
"""

ORACLES["filter_equals"] = """
SELECT 'author ' || o_custkey AS author, o_custkey || '@mail.test' AS author_email,
       md5(CAST(o_orderkey AS VARCHAR)) AS "commit", strftime(o_orderdate, '%Y-%m-%d') AS "date"
FROM orders WHERE strftime(o_orderdate, '%Y-%m-%d') = '1997-05-28'
"""

ORACLES["cast_numeric"] = f"""
WITH {EVENTS},
texts AS (SELECT event_type, k, CASE WHEN event_id % 7 = 0 THEN 'x' || k
                                ELSE CAST(k AS VARCHAR) END AS damaged FROM ev)
SELECT event_type, CAST(sum(k) AS BIGINT) AS strict_sum,
       CAST(sum(TRY_CAST(damaged AS BIGINT)) AS BIGINT) AS lenient_sum,
       CAST(sum(CASE WHEN TRY_CAST(damaged AS BIGINT) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_bad
FROM texts GROUP BY event_type
"""

ORACLES["page_offset"] = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderpriority = '5-LOW'
ORDER BY o_totalprice, o_orderkey LIMIT 10 OFFSET 10
"""

ORACLES["word_count"] = """
WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
trimmed AS (SELECT line, rtrim(line, ' ') AS body FROM lines),
pieces AS (
  SELECT unnest(string_split(body, ' ')) AS word FROM trimmed WHERE body <> '' OR line = '')
SELECT word, count(*) AS n FROM pieces GROUP BY word
"""

ORACLES["split_arrays"] = """
WITH trimmed AS (SELECT doc_id, text, rtrim(text, ' ') AS body FROM documents),
pieces AS (
  SELECT doc_id, CASE WHEN body = '' AND text <> '' THEN [] ELSE string_split(body, ' ') END AS p
  FROM trimmed)
SELECT doc_id, CAST(len(p) AS BIGINT) AS n_words, md5(array_to_string(p, '|')) AS joined,
       CAST(1 AS BIGINT) AS one
FROM pieces
"""

ORACLES["distinct_counts"] = """
SELECT count(*) AS "rows", count(DISTINCT user_id) AS distinct_values FROM events
"""

ORACLES["distinct_rows"] = """
SELECT user_id, count(*) AS n_pairs
FROM (SELECT DISTINCT user_id, md5(CAST(event_id AS VARCHAR)) AS row_value FROM events)
GROUP BY user_id
"""

ORACLES["distinct_subset"] = """
SELECT user_id, event_type, event_id, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn
      FROM events)
WHERE rn = 1
"""

ORACLES["side_counters"] = """
SELECT count(*) AS total, CAST(count(*) FILTER (event_type = 'purchase') AS BIGINT) AS purchases,
       CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS errors
FROM events
"""

ORACLES["duration_bucket"] = """
WITH d AS (SELECT event_id, greatest(event_id * 37 % 400000 - 1000, 0) AS s FROM events)
SELECT event_id,
       CAST(CASE WHEN s // 86400 > 0 THEN (s // 86400 + 1) * 86400
                 WHEN s // 3600 > 0 THEN (s // 3600 + 1) * 3600
                 ELSE 3600 END AS INTEGER) AS bucket
FROM d
"""

ORACLES["iso_time"] = f"""
WITH {EVENTS} SELECT event_id, {iso("ms")} AS iso, ms FROM ev
"""

ORACLES["local_day"] = f"""
WITH {EVENTS}
SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS home_day,
       strftime(ts, '%Y-%m-%d') AS utc_day,
       epoch_ms(CAST(CAST(ts + INTERVAL 8 HOUR AS DATE) AS TIMESTAMP)) - 28800000 AS home_day_start,
       strftime(ts + INTERVAL 8 HOUR, '%H:%M:%S') AS clock
FROM ev
"""

ORACLES["parse_basic_date"] = f"""
WITH {EVENTS} SELECT event_id, ms FROM ev
"""

ORACLES["composite_key"] = f"""
WITH {LOG}
SELECT id,
       coalesce(pn, 'null') || '#' || coalesce(ch, 'null') || '#' || coalesce(c, 'null') || '#'
         || coalesce(appkey, 'null') AS safe_id,
       pn || '#' || im AS device_key, count(*) AS n
FROM keyed GROUP BY ALL
"""

ORACLES["json_roundtrip"] = """
SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey
         || ',"c_mktsegment":"' || c_mktsegment || '"}' AS json,
       c_custkey AS back_key, c_mktsegment AS back_segment
FROM customer
"""

ORACLES["json_map"] = f"""
WITH {EVENTS} SELECT event_id, k, CAST(len(json_keys(props)) AS BIGINT) AS n_fields FROM ev
"""

ORACLES["map_merge"] = f"""
WITH {EVENTS}
SELECT event_id, CAST(3 AS BIGINT) AS n_fields, upper(event_type) AS kind,
       CAST(k AS VARCHAR) AS k, CAST(user_id AS VARCHAR) AS "user"
FROM ev
"""

ORACLES["sql_function"] = f"""
WITH {ORDER_DOCS}
SELECT id, coalesce(s.n_orders, 0) + coalesce(i.n_orders, 0) AS n_orders,
       CAST(CAST(s.n_orders AS FLOAT) / nullif(CAST(i.n_orders AS FLOAT), 0) AS FLOAT) AS ratio
FROM stored s FULL OUTER JOIN incoming i USING (id)
"""

ORACLES["log_parse"] = f"""
WITH {LOG}
SELECT "timestamp", ip, ai, am, appkey, c, cc, ch, "dateTime", fr, h, im, ir, la, mac, om, pn, sv,
       t, w, n_sessions
FROM good
"""

ORACLES["malformed_rows"] = f"""
WITH {LOG},
sessions AS (
  SELECT event_id, i,
    '{{' || CASE WHEN k % 3 <> 0 THEN '"e":' || (ms + i * 1000 + k * 10 + i) || ',' ELSE '' END
        || '"s":' || (ms + i * 1000) || '}}' AS item
  FROM logged g, LATERAL (SELECT unnest(range(1, g.n_sessions + 1)) AS i)),
lists AS (SELECT event_id, string_agg(item, ',' ORDER BY i) AS items FROM sessions GROUP BY event_id)
SELECT ms || '|' || ip || '|{{"us":{{"ai":"' || ai || '","am":' || am || ',"appkey":"' || appkey || '"'
       || CASE WHEN c IS NOT NULL THEN ',"c":"' || c || '"' ELSE '' END || ',"cc":0'
       || CASE WHEN ch IS NOT NULL THEN ',"ch":"' || ch || '"' ELSE '' END
       || ',"dateTime":"' || "dateTime" || '","fr":0,"h":1280,"im":"' || im || '","ir":'
       || CASE WHEN ir THEN 'true' ELSE 'false' END || ',"la":"en","mac":"' || mac
       || '","om":0,"pn":"' || pn || '","sv":' || sv || ',"t":"' || t || '","w":720}},"se":['
       || '{{"e":,"s":1}},' || coalesce(items, '') || ']}}' AS line,
       CAST(NULL AS BIGINT) AS session_end
FROM logged LEFT JOIN lists USING (event_id) WHERE damaged
"""

ORACLES["sql_nested"] = f"""
WITH {LOG},
starts AS (SELECT event_id, string_agg(CAST(s AS VARCHAR), ',' ORDER BY i) AS starts
           FROM sess GROUP BY event_id)
SELECT im, pn, "timestamp", coalesce(starts, '') AS starts
FROM good LEFT JOIN starts USING (event_id) WHERE appkey = '4'
"""

ORACLES["session_explode"] = f"""
WITH {LOG} SELECT "timestamp", ai, e FROM sess
"""

ORACLES["explode_outer_union"] = f"""
WITH {LOG}
SELECT "timestamp", ai, e FROM sess
UNION ALL SELECT "timestamp", ai, CAST(NULL AS BIGINT) AS e FROM good WHERE n_sessions = 0
"""

ORACLES["session_flatten"] = f"""
WITH {LOG}
SELECT ai, appkey, c, ch, im, ip, ir, pn, sv, "timestamp", e, s FROM sess
"""

ORACLES["latest_per_key"] = f"""
WITH {LOG}
SELECT im, "timestamp", pn, ch, ip
FROM good JOIN (SELECT im, max("timestamp") AS "timestamp" FROM good GROUP BY im)
  USING (im, "timestamp")
"""

ORACLES["latest_per_key2"] = f"""
WITH {LOG}
SELECT pn, ch, "timestamp", im, ip
FROM good JOIN (SELECT pn, ch, max("timestamp") AS "timestamp" FROM good GROUP BY pn, ch)
  USING (pn, ch, "timestamp")
"""

ORACLES["group_count_notnull"] = f"""
WITH {LOG}
SELECT pn, ch, c, count(*) AS n FROM good WHERE ch IS NOT NULL AND c IS NOT NULL GROUP BY pn, ch, c
"""

ORACLES["keyed_replace"] = f"""
WITH {ORDER_DOCS}
SELECT id, n_orders, last_day, CAST(NULL AS VARCHAR) AS origin FROM incoming
UNION ALL
SELECT id, n_orders, last_day, origin FROM stored WHERE id NOT IN (SELECT id FROM incoming)
"""

ORACLES["keyed_upsert"] = f"""
WITH {ORDER_DOCS}
SELECT id, coalesce(i.n_orders, s.n_orders) AS n_orders, coalesce(i.last_day, s.last_day) AS last_day,
       s.origin
FROM stored s FULL OUTER JOIN incoming i USING (id)
"""

ORACLES["keyed_insert_missing"] = f"""
WITH {ORDER_DOCS}
SELECT id, n_orders, last_day, origin FROM stored
UNION ALL
SELECT id, n_orders, last_day, NULL FROM incoming WHERE id NOT IN (SELECT id FROM stored)
"""

ORACLES["keyed_scan"] = f"""
SELECT last_day, id AS document_id FROM ({ORACLES["keyed_upsert"]})
"""

ORACLES["keyed_lookup"] = f"""
SELECT id, n_orders, last_day, origin FROM ({ORACLES["keyed_upsert"]}) WHERE id = '10#1-URGENT'
"""

ORACLES["keyed_append"] = """
SELECT 2 * count(*) AS "rows", 2 * count(*) AS ids, count(DISTINCT c_custkey) AS people
FROM customer
"""

# Connected components by a keyed recursion: each step lowers the label of a node's neighbours.
ORACLES["device_resolve"] = f"""
WITH RECURSIVE
stored AS (
  SELECT 'D' || c_custkey AS device_id, 'I' || c_custkey AS imei, 'M' || c_custkey AS mac,
         'A' || c_custkey AS android_id, 'stored' AS uuid,
         {iso("c_custkey * 1000")} AS first_time
  FROM customer WHERE (c_custkey // 10) % 2 = 0 AND c_custkey % 2 = 0),
batch AS (
  SELECT 'I' || o_custkey AS imei,
         'M' || ((o_custkey // 10) * 10 + (o_custkey % 10 + o_orderkey % 3) % 10) AS mac,
         'A' || o_custkey AS android_id, md5(CAST(o_orderkey AS VARCHAR)) AS uuid,
         epoch_ms(o_orderdate) + o_orderkey % 1000 AS ms
  FROM orders),
pairs AS (SELECT imei, mac, min(ms) AS since FROM batch GROUP BY imei, mac),
known AS (
  SELECT p.imei, p.mac, p.since,
         coalesce(a.first_time, b.first_time) AS first_time,
         coalesce(a.device_id, b.device_id) AS device_id
  FROM pairs p LEFT JOIN stored a ON p.imei = a.imei LEFT JOIN stored b ON p.mac = b.mac),
open_pairs AS (SELECT 'i:' || imei AS a, 'm:' || mac AS b, * FROM known WHERE device_id IS NULL),
edges AS (SELECT a AS u, b AS v FROM open_pairs UNION SELECT b, a FROM open_pairs),
roots(node, root) USING KEY (node) AS (
  SELECT DISTINCT u, u FROM edges
  UNION
  SELECT e.v, min(r.root)
  FROM roots r JOIN edges e ON r.node = e.u JOIN recurring.roots old ON old.node = e.v
  WHERE r.root < old.root GROUP BY e.v),
touched AS (
  SELECT node, first_time, device_id FROM (
    SELECT 'i:' || imei AS node, first_time, device_id FROM known WHERE device_id IS NOT NULL
    UNION ALL
    SELECT 'm:' || mac, first_time, device_id FROM known WHERE device_id IS NOT NULL)),
linked AS (
  SELECT root, first_time, device_id FROM (
    SELECT root, first_time, device_id,
           row_number() OVER (PARTITION BY root ORDER BY first_time, device_id) AS rn
    FROM roots JOIN touched USING (node)) WHERE rn = 1),
firsts AS (
  SELECT root, since, imei, mac FROM (
    SELECT root, since, imei, mac,
           row_number() OVER (PARTITION BY root ORDER BY since, imei, mac) AS rn
    FROM open_pairs JOIN roots ON a = node) WHERE rn = 1),
named AS (
  SELECT f.root, coalesce(l.first_time, {iso("f.since")}) AS first_time,
         coalesce(l.device_id, sha256(f.imei || '|' || f.mac)) AS device_id
  FROM firsts f LEFT JOIN linked l USING (root)),
resolved AS (
  SELECT imei, mac, device_id, first_time FROM known WHERE device_id IS NOT NULL
  UNION ALL
  SELECT o.imei, o.mac, n.device_id, n.first_time
  FROM open_pairs o JOIN roots r ON o.a = r.node JOIN named n USING (root)),
updates AS (
  SELECT device_id, imei, mac, android_id, uuid, first_time FROM (
    SELECT device_id, b.imei, b.mac, android_id, uuid,
           min(first_time) OVER (PARTITION BY device_id) AS first_time,
           row_number() OVER (PARTITION BY device_id
             ORDER BY ms DESC, b.imei DESC, b.mac DESC, android_id DESC, uuid DESC) AS rn
    FROM batch b JOIN resolved r ON b.imei = r.imei AND b.mac = r.mac) WHERE rn = 1)
SELECT device_id, imei, mac, android_id, uuid, first_time FROM updates
UNION ALL
SELECT device_id, imei, mac, android_id, uuid, first_time FROM stored
WHERE device_id NOT IN (SELECT device_id FROM updates)
"""

_APP_DEVICE_BATCH = """
  SELECT pn || '#' || device_id AS id, ISO AS first_time, appkey AS app_key, ch AS channel,
         c AS country, pn AS pkg_name, device_id, la AS language, t AS model
  FROM (SELECT *, rank() OVER (PARTITION BY device_id ORDER BY "timestamp" DESC) AS r
        FROM identified WHERE CUT) WHERE r = 1
""".replace("ISO", iso('"timestamp"'))

ORACLES["app_devices"] = f"""
WITH {LOG},
identified AS (SELECT *, sha256(im || '|' || mac) AS device_id FROM good),
early AS ({_APP_DEVICE_BATCH.replace("CUT", "ms < epoch_ms(TIMESTAMP '2024-01-15')")}),
late AS ({_APP_DEVICE_BATCH.replace("CUT", "ms >= epoch_ms(TIMESTAMP '2024-01-15')")})
SELECT * FROM late
UNION ALL
SELECT * FROM early WHERE id NOT IN (SELECT id FROM late)
"""

ORACLES["stats_increment"] = f"""
WITH {LOG}
SELECT id, count(*) AS news, count(*) AS starts FROM keyed GROUP BY id
"""

ORACLES["stats_increment_once"] = f"""
WITH {LOG}
SELECT id, count(DISTINCT ms >= epoch_ms(TIMESTAMP '2024-01-15')) AS news,
       count(DISTINCT ms >= epoch_ms(TIMESTAMP '2024-01-15')) AS starts
FROM keyed GROUP BY id
"""

ORACLES["stats_seed"] = f"""
WITH {LOG},
first AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY id ORDER BY "timestamp", appkey, ch NULLS FIRST, c NULLS FIRST, pn) AS rn
    FROM keyed) WHERE rn = 1)
SELECT id, {iso('"timestamp"')} AS "@timestamp", {iso('"timestamp"')} AS create_time,
       appkey AS app_id, appkey AS app_key, ch AS channel, c AS country, pn AS pkg_name,
       CAST(0 AS BIGINT) AS actives, CAST(0 AS BIGINT) AS "day", CAST(0 AS BIGINT) AS keep1,
       CAST(0 AS BIGINT) AS keep3, CAST(0 AS BIGINT) AS keep7, CAST(0 AS BIGINT) AS keep30,
       CAST(0 AS FLOAT) AS "startAvg", CAST(0 AS FLOAT) AS "keep1Ratio",
       CAST(0 AS FLOAT) AS "keep3Ratio", CAST(0 AS FLOAT) AS "keep7Ratio",
       CAST(0 AS FLOAT) AS "keep30Ratio", CAST(1 AS BIGINT) AS news, CAST(1 AS BIGINT) AS starts,
       '' AS agent, '' AS channel_id, '' AS source, '' AS "type"
FROM first WHERE pn NOT IN ('app.click', 'app.view')
"""

ORACLES["seed_new_devices"] = f"""
WITH {LOG},
identified AS (SELECT *, sha256(im || '|' || mac) AS device_id FROM good),
early_apps AS ({_APP_DEVICE_BATCH.replace("CUT", "ms < epoch_ms(TIMESTAMP '2024-01-15')")}),
late_apps AS ({_APP_DEVICE_BATCH.replace("CUT", "ms >= epoch_ms(TIMESTAMP '2024-01-15')")}),
named AS (
  SELECT k.*, k.pn || '#' || sha256(k.im || '|' || k.mac) AS app,
         k."timestamp" >= epoch_ms(TIMESTAMP '2024-01-15') AS late FROM keyed k),
seeding AS (
  SELECT * FROM named WHERE NOT late AND app IN (SELECT id FROM early_apps)
  UNION ALL
  SELECT * FROM named WHERE late AND app IN (SELECT id FROM late_apps)
    AND app NOT IN (SELECT id FROM early_apps)),
first AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY id ORDER BY late, "timestamp", appkey, ch NULLS FIRST, c NULLS FIRST, pn) AS rn
    FROM seeding) WHERE rn = 1)
SELECT id, {iso('"timestamp"')} AS "@timestamp", {iso('"timestamp"')} AS create_time,
       appkey AS app_id, appkey AS app_key, ch AS channel, c AS country, pn AS pkg_name,
       CAST(0 AS BIGINT) AS actives, CAST(0 AS BIGINT) AS "day", CAST(0 AS BIGINT) AS keep1,
       CAST(0 AS BIGINT) AS keep3, CAST(0 AS BIGINT) AS keep7, CAST(0 AS BIGINT) AS keep30,
       CAST(0 AS FLOAT) AS "startAvg", CAST(0 AS FLOAT) AS "keep1Ratio",
       CAST(0 AS FLOAT) AS "keep3Ratio", CAST(0 AS FLOAT) AS "keep7Ratio",
       CAST(0 AS FLOAT) AS "keep30Ratio", CAST(1 AS BIGINT) AS news, CAST(1 AS BIGINT) AS starts,
       '' AS agent, '' AS channel_id, '' AS source, '' AS "type"
FROM first
"""

_NEWS = """
firsts AS (
  SELECT event_type, device_id, min(ts) AS ts FROM visits GROUP BY event_type, device_id),
news AS (
  SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS news FROM firsts GROUP BY ALL)
"""

ORACLES["daily_news"] = f"""
WITH {VISITS}, {_NEWS} SELECT event_type, CAST(day AS VARCHAR) AS day, news FROM news
"""

ORACLES["hourly_news"] = f"""
WITH {VISITS}, {_NEWS}
SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, CAST(hour(ts) AS INTEGER) AS hour,
       count(*) AS news
FROM firsts GROUP BY ALL
"""

ORACLES["daily_activity"] = f"""
WITH {VISITS}
SELECT event_type, CAST(day AS VARCHAR) AS day, count(DISTINCT device_id) AS actives,
       count(*) AS starts
FROM visits GROUP BY ALL
"""

ORACLES["hourly_activity"] = f"""
WITH {VISITS}
SELECT CAST(day AS VARCHAR) AS day, CAST(hour(ts) AS INTEGER) AS hour,
       count(DISTINCT device_id) AS actives, count(*) AS starts
FROM visits GROUP BY ALL
"""

ORACLES["start_avg"] = f"""
WITH {VISITS}
SELECT event_type, CAST(day AS VARCHAR) AS day, count(DISTINCT device_id) AS actives,
       count(*) AS starts,
       CAST(CAST(count(*) AS FLOAT) / CAST(count(DISTINCT device_id) AS FLOAT) AS FLOAT) AS start_avg
FROM visits GROUP BY event_type, day
"""

ORACLES["running_total"] = f"""
WITH {VISITS}, {_NEWS}
SELECT event_type, CAST(day AS VARCHAR) AS day, news,
       CAST(sum(news) OVER (PARTITION BY event_type ORDER BY news.day) AS BIGINT) AS total
FROM news
"""

ORACLES["retention"] = f"""
WITH {VISITS},
active AS (SELECT DISTINCT event_type, device_id, day FROM visits),
aged AS (
  SELECT event_type, a.device_id, install_day, date_diff('day', install_day, day) AS age
  FROM active a JOIN (SELECT event_type, device_id, min(day) AS install_day
                      FROM active GROUP BY event_type, device_id) USING (event_type, device_id)),
kept AS (
  SELECT event_type, install_day, count(*) FILTER (age = 0) AS news,
         count(*) FILTER (age = 1) AS keep_1, count(*) FILTER (age = 3) AS keep_3,
         count(*) FILTER (age = 7) AS keep_7, count(*) FILTER (age = 30) AS keep_30
  FROM aged GROUP BY event_type, install_day)
SELECT event_type, CAST(install_day AS VARCHAR) AS install_day, news, keep_1, keep_3, keep_7, keep_30,
       CAST(CAST(keep_1 AS FLOAT) / CAST(news AS FLOAT) AS FLOAT) AS keep_1_ratio,
       CAST(CAST(keep_3 AS FLOAT) / CAST(news AS FLOAT) AS FLOAT) AS keep_3_ratio,
       CAST(CAST(keep_7 AS FLOAT) / CAST(news AS FLOAT) AS FLOAT) AS keep_7_ratio,
       CAST(CAST(keep_30 AS FLOAT) / CAST(news AS FLOAT) AS FLOAT) AS keep_30_ratio
FROM kept
"""

ORACLES["kmeans_fit"] = """
SELECT count(*) AS vectors, CAST(max(len(embedding)) AS INTEGER) AS dimensions,
       CAST(2 AS BIGINT) AS clusters, CAST(0 AS BIGINT) AS misplaced
FROM embeddings
"""

ORACLES["append_compacted"] = """
SELECT c_mktsegment AS segment, count(*) AS "rows", count(*) AS ids,
       count(DISTINCT c_name) AS people
FROM customer
WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')
GROUP BY c_mktsegment
"""

ORACLES["page_after"] = """
SELECT o_totalprice, o_orderkey, o_custkey FROM orders
WHERE (o_totalprice, o_orderkey) > (
  SELECT (o_totalprice, o_orderkey) FROM orders ORDER BY o_orderkey DESC LIMIT 1)
ORDER BY o_totalprice, o_orderkey LIMIT 25
"""

ORACLES["device_matching"] = f"""
WITH stored AS (
  SELECT 'D' || c_custkey AS device_id, 'I' || c_custkey AS imei, 'M' || c_custkey AS mac,
         {iso("c_custkey * 1000")} AS first_time
  FROM customer WHERE (c_custkey // 10) % 2 = 0 AND c_custkey % 2 = 0)
SELECT device_id, imei, mac, first_time FROM stored
WHERE mac IN (
  SELECT 'M' || ((o_custkey // 10) * 10 + (o_custkey % 10 + o_orderkey % 3) % 10)
  FROM orders WHERE o_custkey % 10 = 7)
"""

ORACLES["identity_batches"] = """
WITH RECURSIVE
links AS (
  SELECT DISTINCT 'i:I' || o_custkey AS a,
         'm:M' || ((o_custkey // 10) * 10 + (o_custkey % 10 + o_orderkey % 3) % 10) AS b
  FROM orders),
edges AS (SELECT a AS u, b AS v FROM links UNION SELECT b, a FROM links),
roots(node, root) USING KEY (node) AS (
  SELECT DISTINCT u, u FROM edges
  UNION
  SELECT e.v, min(r.root)
  FROM roots r JOIN edges e ON r.node = e.u JOIN recurring.roots old ON old.node = e.v
  WHERE r.root < old.root GROUP BY e.v)
SELECT node, root FROM roots
"""

ORACLES["running_total_all"] = f"""
WITH {VISITS}, news AS (
  SELECT day, count(*) AS news
  FROM (SELECT device_id, min(day) AS day FROM visits GROUP BY device_id) GROUP BY day)
SELECT CAST(day AS VARCHAR) AS day, news,
       CAST(sum(news) OVER (ORDER BY news.day) AS BIGINT) AS total
FROM news
"""

ORACLES["active_between"] = f"""
WITH {VISITS}
SELECT event_type, count(DISTINCT device_id) AS actives FROM visits
WHERE day BETWEEN DATE '2024-01-08' AND DATE '2024-01-21' GROUP BY event_type
"""

# Stored bitmaps count what the log rows do.
ORACLES["activity_bitmaps"] = ORACLES["daily_activity"]
ORACLES["retention_bitmaps"] = ORACLES["retention"]
