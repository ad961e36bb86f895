"""DuckDB SQL twins of :mod:`cdrflow.plans.reports`.

They run on the same parquet tables (views ``events``, ``pages``,
``customer``). Expected standard values are derived from the event columns
directly, not by re-parsing text, so the Spark parser, format choice and
dictionaries are checked against an independent derivation.
"""

from __future__ import annotations

# Shared CTEs: the events with their two page URLs, the layout version of
# each line, the raw line text, and the expected standard rows.
_BASE = r"""
np AS (SELECT count(*) AS n FROM pages),
ev AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value,
         p1.url AS url1, p2.url AS url2,
         'dc' || CAST(e.user_id % 2 AS VARCHAR) AS dc,
         CASE e.user_id % 4 WHEN 0 THEN 'alphanet' WHEN 1 THEN 'betacell'
              WHEN 2 THEN 'gammatel' ELSE 'zetanet' END AS op,
         '+33' || CAST(e.user_id + 600000000 AS VARCHAR) AS msisdn,
         CASE WHEN e.user_id % 3 = 0 THEN '' ELSE CAST(e.user_id + 208010000000000 AS VARCHAR) END AS imsi,
         CASE WHEN e.ts >= TIMESTAMP '2024-01-20 00:00:00' THEN 'v3'
              WHEN e.ts >= TIMESTAMP '2024-01-10 00:00:00' THEN 'v2' ELSE 'v1' END AS layout,
         CASE WHEN e.ts >= TIMESTAMP '2024-01-20 00:00:00' THEN 'v3'
              WHEN e.ts >= TIMESTAMP '2024-01-10 00:00:00' THEN 'v2'
              WHEN e.ts >= TIMESTAMP '2024-01-02 00:00:00' THEN 'v1' END AS version,
         e.event_type = 'error' AS sms,
         '#' || CAST(e.event_id % 3 + 700 AS VARCHAR) AS service,
         CAST(floor(epoch(e.ts)) AS BIGINT) AS epoch_s
  FROM events e
  LEFT JOIN pages p1 ON p1.page_id = e.event_id % (SELECT n FROM np)
  LEFT JOIN pages p2 ON p2.page_id = (e.event_id * 7 + 3) % (SELECT n FROM np)
),
txt AS (
  SELECT *,
         CASE WHEN event_id % 4 = 0 THEN '' ELSE 'en' END AS lang,
         CASE WHEN event_id % 7 = 0 THEN 'x' WHEN sms THEN '0'
              ELSE CAST(CAST(url1 IS NOT NULL AS INTEGER) + CAST(url2 IS NOT NULL AS INTEGER) AS VARCHAR) END AS page_sent_txt,
         CAST(CAST(floor(value) AS BIGINT) + CASE WHEN layout = 'v3' AND event_id % 11 = 0 THEN 3000000000 ELSE 0 END AS VARCHAR) AS duration_txt,
         CASE WHEN sms THEN '' ELSE service || '*#=' || coalesce(url1, '') || ',1=' || coalesce(url2, '') END AS action_txt,
         CASE WHEN sms THEN event_type || '#digest' END AS extra_txt
  FROM ev
),
lines AS (
  SELECT event_id AS row_id, dc, op, ts,
         '/landing/' || dc || '/webcdr/CDR_' || op || '_' || strftime(ts, '%Y%m%d_%H') || '0000_host'
           || CAST(user_id % 3 AS VARCHAR) || '_0001' AS source_file,
         CASE layout
           WHEN 'v2' THEN concat_ws(';', msisdn, imsi, '', CAST(user_id % 97 AS VARCHAR), '', lang,
                                    strftime(ts, '%Y-%m-%d %H:%M:%S'), service,
                                    CASE WHEN sms THEN 'sms' ELSE 'U2' END, page_sent_txt, duration_txt,
                                    '4917000', '', action_txt, extra_txt)
           WHEN 'v3' THEN concat_ws('|', msisdn, imsi, '', '', lang, CAST(epoch_s AS VARCHAR), service,
                                    CASE WHEN sms THEN 'sms' ELSE 'U2' END, page_sent_txt, duration_txt,
                                    '4917000', '', action_txt, extra_txt)
           ELSE concat_ws(';', msisdn, imsi, '', '', lang, CAST(epoch_s AS VARCHAR), service,
                          CASE WHEN sms THEN 'sms' ELSE 'U2' END, page_sent_txt, duration_txt,
                          '4917000', '', action_txt, extra_txt)
         END AS line
  FROM txt
),
std AS (
  SELECT event_id AS row_id, dc, op, msisdn, imsi, '' AS imei, '' AS subscription,
         CASE WHEN event_id % 4 = 0 THEN '' ELSE 'en' END AS language,
         epoch_s AS session_time, service AS service_code,
         CASE WHEN sms THEN 'sms' ELSE 'U2' END AS bearer,
         CASE WHEN event_id % 7 = 0 THEN CASE WHEN version = 'v2' THEN 'x' END WHEN sms THEN '0'
              ELSE CAST(CAST(url1 IS NOT NULL AS INTEGER) + CAST(url2 IS NOT NULL AS INTEGER) AS VARCHAR) END AS page_sent,
         CAST(CAST(floor(value) AS BIGINT) + CASE WHEN version = 'v3' AND event_id % 11 = 0 THEN 3000000000 ELSE 0 END AS VARCHAR) AS duration,
         '4917000' AS vlr_number, '' AS session_end,
         CASE WHEN sms THEN NULL ELSE split_part(url1, '?', 1) END AS u1,
         CASE WHEN sms THEN NULL ELSE split_part(url2, '?', 1) END AS u2,
         CASE WHEN sms THEN event_type || '#digest' END AS extra,
         'data_format-webcdr-' || op || '-' || version || '.properties' AS format_name
  FROM ev
  WHERE version IS NOT NULL AND op <> 'zetanet'
),
known_u AS (
  SELECT 'dc' || CAST(c_custkey % 2 AS VARCHAR) AS dc, c_custkey AS user_id,
         CASE c_custkey % 4 WHEN 0 THEN 'alphanet' WHEN 1 THEN 'betacell'
              WHEN 2 THEN 'gammatel' ELSE 'zetanet' END AS op,
         '+33' || CAST(c_custkey + 600000000 AS VARCHAR) AS msisdn,
         CASE WHEN c_custkey % 3 = 0 THEN '' ELSE CAST(c_custkey + 208010000000000 AS VARCHAR) END AS imsi,
         '' AS imei
  FROM customer WHERE c_mktsegment = 'BUILDING'
),
known_p AS (
  SELECT d.dc, p.page_id + 1 AS page_id, split_part(p.url, '?', 1) AS url
  FROM pages p, (SELECT unnest(['dc0', 'dc1']) AS dc) d
  WHERE p.url LIKE 'https:%'
),
ukeys AS (SELECT DISTINCT dc, op, msisdn, imsi, imei FROM std),
new_u AS (
  SELECT k.dc,
         coalesce((SELECT max(user_id) FROM known_u m WHERE m.dc = k.dc), 0)
           + row_number() OVER (PARTITION BY k.dc ORDER BY k.op, k.msisdn, k.imsi, k.imei) AS user_id,
         k.op, k.msisdn, k.imsi, k.imei
  FROM ukeys k
  WHERE NOT EXISTS (SELECT 1 FROM known_u d WHERE d.dc = k.dc AND d.op = k.op AND d.msisdn = k.msisdn
                                              AND d.imsi = k.imsi AND d.imei = k.imei)
),
dim_u AS (SELECT * FROM known_u UNION ALL SELECT * FROM new_u),
hits AS (
  SELECT row_id, dc, 1 AS pos, u1 AS url FROM std WHERE u1 IS NOT NULL
  UNION ALL SELECT row_id, dc, 2 AS pos, u2 AS url FROM std WHERE u2 IS NOT NULL
),
purls AS (SELECT DISTINCT dc, url FROM hits WHERE length(url) > 0),
new_p AS (
  SELECT u.dc,
         coalesce((SELECT max(page_id) FROM known_p m WHERE m.dc = u.dc), 0)
           + row_number() OVER (PARTITION BY u.dc ORDER BY u.url) AS page_id,
         u.url
  FROM purls u
  WHERE NOT EXISTS (SELECT 1 FROM known_p d WHERE d.dc = u.dc AND d.url = u.url)
),
dim_p AS (SELECT * FROM known_p UNION ALL SELECT * FROM new_p),
page_lists AS (
  SELECT h.row_id, string_agg(CAST(d.page_id AS VARCHAR), ',' ORDER BY h.pos) AS page_ids
  FROM hits h LEFT JOIN dim_p d ON d.dc = h.dc AND d.url = h.url
  GROUP BY h.row_id
),
enriched AS (
  SELECT s.row_id, u.user_id, s.subscription, s.language, s.session_time, s.service_code,
         s.bearer, s.page_sent, s.duration, s.vlr_number, s.session_end,
         coalesce(l.page_ids, '') AS page_ids, s.extra
  FROM std s
  LEFT JOIN dim_u u ON u.dc = s.dc AND u.op = s.op AND u.msisdn = s.msisdn AND u.imsi = s.imsi AND u.imei = s.imei
  LEFT JOIN page_lists l ON l.row_id = s.row_id
)
"""


def _q(body: str) -> str:
    return "WITH " + _BASE.strip() + "\n" + body.strip()


_BUCKETS = """
        SELECT dc, op, service_code, bearer,
               strftime(make_timestamp(session_time * 1000000), '%Y-%m-%d %H') AS bucket,
               count(*) AS sessions, CAST(sum(TRY_CAST(duration AS BIGINT)) AS BIGINT) AS duration,
               CAST(sum(TRY_CAST(page_sent AS BIGINT)) AS BIGINT) AS pages
        FROM std GROUP BY ALL"""

ORACLE_SQL: dict[str, str] = {
    "file_operator": _q("SELECT row_id, source_file, op FROM lines"),
    "field_by_position": _q("""
        SELECT row_id, CAST(len(string_split(line, ';')) AS INTEGER) AS n_fields,
               string_split(line, ';')[1] AS f0, string_split(line, ';')[8] AS f7,
               string_split(line, ';')[13] AS f12, string_split(line, ';')[15] AS f14
        FROM lines"""),
    "typed_or_empty": _q("""
        SELECT row_id, coalesce(CAST(page_sent AS VARCHAR), '') AS page_sent,
               coalesce(CAST(duration AS VARCHAR), '') AS duration,
               coalesce(extra, '') AS extra
        FROM std"""),
    "standard_rows": _q("""
        SELECT row_id, dc, op, msisdn, imsi, imei, subscription, language, session_time,
               service_code, bearer, page_sent, duration, vlr_number, session_end,
               coalesce(concat_ws(',', u1, u2), '') AS action_url, extra, format_name
        FROM std"""),
    "format_asof": _q("""
        SELECT e.event_id AS row_id, e.dc, e.op,
               CASE WHEN e.op <> 'zetanet' AND e.version IS NOT NULL THEN e.epoch_s END AS session_time,
               CASE WHEN e.op <> 'zetanet' AND e.version IS NOT NULL
                    THEN 'data_format-webcdr-' || e.op || '-' || e.version || '.properties' END AS format_name
        FROM ev e"""),
    "format_asof_many": _q("""
        SELECT row_id, dc, op, CASE WHEN good THEN epoch_s END AS session_time,
               CASE WHEN good THEN 'data_format-webcdr-' || op || '-' || CAST(least(999, (epoch_s - CAST(epoch(TIMESTAMP '2024-01-02 00:00:00') AS BIGINT)) // 2700) AS VARCHAR)
                    || '.properties' END AS format_name,
               CASE WHEN op = 'zetanet' THEN 'unknown_operator' WHEN version IS NULL THEN 'no_valid_format' END AS reason
        FROM (SELECT event_id AS row_id, *, op <> 'zetanet' AND version IS NOT NULL AS good FROM ev)"""),
    "format_rejects": _q("""
        SELECT event_id AS row_id, dc, op,
               CASE WHEN op = 'zetanet' THEN 'unknown_operator' ELSE 'no_valid_format' END AS reason
        FROM ev WHERE op = 'zetanet' OR version IS NULL"""),
    "reject_counts": _q("""
        SELECT dc, op, CASE WHEN op = 'zetanet' THEN 'unknown_operator' ELSE 'no_valid_format' END AS reason,
               count(*) AS lines
        FROM ev WHERE op = 'zetanet' OR version IS NULL GROUP BY ALL"""),
    "formats_per_operator": _q("""
        SELECT dc, op, string_agg(DISTINCT format_name, ',' ORDER BY format_name) AS formats,
               count(*) AS rows
        FROM std GROUP BY dc, op"""),
    "rows_per_format": _q("SELECT dc, op, format_name, count(*) AS rows FROM std GROUP BY ALL"),
    "page_list": _q("SELECT row_id, dc, CAST(pos - 1 AS INTEGER) AS pos, url FROM hits WHERE length(url) > 0"),
    "page_hits": _q("SELECT dc, url, count(*) AS hits FROM hits GROUP BY dc, url"),
    "landing_files": _q("SELECT dc, url, count(*) AS hits FROM hits GROUP BY dc, url"),
    "user_keys": _q("SELECT dc, op, msisdn, imsi, imei FROM ukeys"),
    "max_user_id": "SELECT 'dc' || CAST(c_custkey % 2 AS VARCHAR) AS dc, CAST(max(c_custkey) AS BIGINT) AS max_user_id FROM customer GROUP BY 1",
    "new_user_ids": _q("SELECT dc, user_id, op, msisdn, imsi, imei FROM new_u"),
    "new_page_ids": _q("SELECT dc, page_id, url FROM new_p"),
    "dim_after_append": _q("SELECT dc, user_id, op, msisdn, imsi, imei FROM dim_u"),
    "user_substitution": _q("SELECT row_id, user_id FROM enriched"),
    "page_substitution": _q("SELECT row_id, page_ids FROM enriched"),
    "enriched_rows": _q("""
        SELECT row_id, user_id, subscription, language, session_time, service_code, bearer,
               page_sent, duration, vlr_number, session_end, page_ids, extra,
               concat_ws(';', coalesce(CAST(user_id AS VARCHAR), ''), subscription, language,
                         CAST(session_time AS VARCHAR), service_code, bearer,
                         coalesce(CAST(page_sent AS VARCHAR), ''), coalesce(CAST(duration AS VARCHAR), ''),
                         vlr_number, session_end, page_ids, coalesce(extra, '')) AS text
        FROM enriched"""),
    "hits_per_page_id": _q("""
        SELECT h.dc, d.page_id, count(*) AS hits
        FROM hits h LEFT JOIN dim_p d ON d.dc = h.dc AND d.url = h.url GROUP BY ALL"""),
    "bucket_counts": _q(_BUCKETS),
    "arrival_counts": _q(_BUCKETS),
    "legacy_page_ids": """
        WITH legacy AS (SELECT 'dc0' AS dc, CAST(floor(page_id / 2) + 1 AS BIGINT) AS page_id,
                               split_part(url, '?', 1) AS url FROM pages),
        per_key AS (SELECT dc, url, min(page_id) AS page_id FROM legacy GROUP BY dc, url),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY dc, page_id ORDER BY url) AS rn FROM per_key),
        keep AS (SELECT dc, page_id, url FROM ranked WHERE rn = 1),
        top AS (SELECT dc, max(page_id) AS m FROM keep GROUP BY dc)
        SELECT dc, page_id, url FROM keep
        UNION ALL
        SELECT r.dc, t.m + row_number() OVER (PARTITION BY r.dc ORDER BY r.url) AS page_id, r.url
        FROM ranked r JOIN top t ON t.dc = r.dc WHERE r.rn > 1""",
    "window_counts": _q("""
        SELECT dc, op, CAST(floor(session_time / 900) * 900 AS BIGINT) AS window_start,
               count(*) AS sessions
        FROM std GROUP BY ALL"""),
    "epoch_time": _q("""
        SELECT row_id, session_time, session_time * 1000 AS session_ms,
               strftime(make_timestamp(session_time * 1000000), '%Y-%m-%d %H:%M:%S') AS session_utc
        FROM std"""),
    "date_parse": _q("""
        SELECT event_id AS row_id,
               CASE WHEN layout = 'v2' THEN epoch_s END AS parsed
        FROM ev"""),
    "json_fields": """
        SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
    "dim_two_batches": _q("""
        , b1 AS (SELECT DISTINCT dc, op, msisdn, imsi, imei FROM std WHERE session_time < 1705276800),
        d1 AS (SELECT dc, row_number() OVER (PARTITION BY dc ORDER BY op, msisdn, imsi, imei) AS user_id,
                      op, msisdn, imsi, imei, 1 AS batch_id FROM b1),
        b2 AS (SELECT DISTINCT dc, op, msisdn, imsi, imei FROM std s WHERE session_time >= 1705276800
               AND NOT EXISTS (SELECT 1 FROM b1 WHERE b1.dc = s.dc AND b1.op = s.op AND b1.msisdn = s.msisdn
                               AND b1.imsi = s.imsi AND b1.imei = s.imei)),
        d2 AS (SELECT dc, coalesce((SELECT max(user_id) FROM d1 WHERE d1.dc = b2.dc), 0)
                      + row_number() OVER (PARTITION BY dc ORDER BY op, msisdn, imsi, imei) AS user_id,
                      op, msisdn, imsi, imei, 2 AS batch_id FROM b2)
        SELECT dc, user_id, op, msisdn, imsi, imei, CAST(batch_id AS BIGINT) AS batch_id FROM d1
        UNION ALL SELECT dc, user_id, op, msisdn, imsi, imei, CAST(batch_id AS BIGINT) FROM d2"""),
}
