"""DuckDB SQL twins of :mod:`cdrflow.plans.jobs`."""

from __future__ import annotations

from ..schema import LINE_FIELDS
from .oracle import _q

_REASON = "CASE WHEN op = 'zetanet' THEN 'unknown_operator' WHEN version IS NULL THEN 'no_valid_format' ELSE '' END"

# The descriptor of each customer, and what is wrong with it.
_NAMES = [n for n in LINE_FIELDS if n not in ("session_time", "imei")]
_FIELDS = [("cell", "STRING"), *((n, "STRING") for n in _NAMES[:4]), ("session_time", None), *((n, "INT") for n in _NAMES[4:])]
_DESC = f"""
f AS (SELECT * FROM (VALUES {', '.join(f"('{n}', {i}, {repr(t) if t else 'NULL'})" for i, (n, t) in enumerate(_FIELDS))}) AS t(field, pos, type)),
d AS (SELECT c_custkey AS k, 'dc' || CAST(c_custkey % 2 AS VARCHAR) AS dc, 'op' || CAST(c_nationkey AS VARCHAR) AS op,
             CASE WHEN c_custkey % 7 = 6 THEN 'format-' || CAST(c_custkey AS VARCHAR) || '.properties'
                  ELSE 'data_format-x-op' || CAST(c_nationkey AS VARCHAR) || '-' || CAST(c_custkey AS VARCHAR) || '.properties' END AS file_name,
             CASE WHEN c_custkey % 6 = 3 THEN chr(92) || 't' || chr(9) || '|' WHEN c_custkey % 3 = 1 THEN '|' ELSE ';' END AS delimiter,
             CAST(1600000000 + (c_custkey % 50) * 86400 AS BIGINT) AS start_time,
             CASE c_custkey % 7 WHEN 6 THEN 'bad_descriptor_name' WHEN 1 THEN 'no_start_time' WHEN 2 THEN 'bad_start_time'
                  WHEN 5 THEN 'no_fields' WHEN 3 THEN 'no_session_time'
                  WHEN 4 THEN CASE WHEN c_custkey % 2 = 0 THEN 'bad_pattern' ELSE '' END ELSE '' END AS problem
      FROM customer)"""

# An import on top of the known dictionary: keys not known, the first holder of
# an id that isn't in use keeps it, the others follow the highest id.
_IMPORT = """
rk AS (SELECT i.*, row_number() OVER (PARTITION BY i.dc, i.id ORDER BY {order}) = 1
              AND NOT EXISTS (SELECT 1 FROM {known} x WHERE x.dc = i.dc AND x.{id} = i.id) AS own FROM imp i),
mx AS (SELECT dc, max(id) AS m FROM (SELECT dc, id FROM rk WHERE own UNION ALL SELECT dc, {id} FROM {known}) GROUP BY dc)
SELECT dc, {id}, {cols} FROM {known}
UNION ALL SELECT dc, id, {cols} FROM rk WHERE own
UNION ALL SELECT rk.dc, CAST(m + row_number() OVER (PARTITION BY rk.dc ORDER BY {order}) AS BIGINT), {cols} FROM rk JOIN mx USING (dc) WHERE NOT own"""

ORACLE_SQL: dict[str, str] = {
    "second_run_reads_nothing": _q(f"SELECT CAST(1 AS BIGINT) AS batch_id, dc, op, {_REASON} AS reason, count(*) AS lines FROM ev GROUP BY ALL"),
    "rerun_totals": _q(f"""
        SELECT {_REASON} AS part, count(*) AS lines FROM ev GROUP BY ALL
        UNION ALL SELECT 'text', count(*) FROM std"""),
    "landing_paths": _q("""
        SELECT CASE dc WHEN 'dc0' THEN '001' ELSE '1' END AS dc, CASE WHEN event_id % 8 = 7 THEN '_unplaced' ELSE 'webcdr' END AS datatype,
               CASE WHEN event_id % 8 = 3 THEN '' ELSE op END AS op, count(*) AS lines FROM ev GROUP BY ALL"""),
    "landing_rejects": _q(f"""
        SELECT dc, CASE event_id % 3 WHEN 1 THEN 'no_operator' WHEN 2 THEN 'bad_path' ELSE {_REASON} END AS reason,
               CAST(count(*) AS BIGINT) AS lines FROM ev GROUP BY ALL"""),
    "two_checkpoints": _q("""
        SELECT s.dc, count(*) AS rows, count(DISTINCT (op, msisdn, imsi, imei)) AS users,
               (SELECT count(*) FROM hits h WHERE h.dc = s.dc) AS hits
        FROM std s GROUP BY s.dc"""),
    "descriptor_fields": f"WITH {_DESC} SELECT file_name AS format_name, delimiter, start_time, field, CAST(pos AS INTEGER) AS pos,"
                         " coalesce(type, CASE WHEN k % 2 = 0 THEN 'STRING' ELSE 'LONG' END) AS type FROM d, f WHERE problem = ''",
    "descriptor_problems": f"WITH {_DESC} SELECT file_name, problem FROM d",
    "catalog_versions": f"""WITH {_DESC} SELECT dc, op, count(*) AS versions, arg_max(file_name, (start_time, k)) AS newest,
        min(start_time) AS first_start FROM d WHERE problem = '' GROUP BY dc, op""",
    "import_users": _q(""", imp AS (
          SELECT 'dc' || CAST(c_custkey % 2 AS VARCHAR) AS dc, CAST(c_custkey + 3 AS BIGINT) AS id,
                 CASE c_custkey % 4 WHEN 0 THEN 'alphanet' WHEN 1 THEN 'betacell' WHEN 2 THEN 'gammatel' ELSE 'zetanet' END AS op,
                 '+33' || CAST(c_custkey + 600000000 AS VARCHAR) AS msisdn,
                 CASE WHEN c_custkey % 3 = 0 THEN '' ELSE CAST(c_custkey + 208010000000000 AS VARCHAR) END AS imsi, '' AS imei
          FROM customer WHERE c_custkey % 13 <> 0 AND c_mktsegment <> 'BUILDING'),""" + _IMPORT.format(
              order="op, msisdn, imsi, imei", known="known_u", id="user_id", cols="op, msisdn, imsi, imei")),
    "import_pages": _q(""", imp AS (
          SELECT d.dc, split_part(url, '?', 1) AS url, min(CAST(floor(page_id / 2) AS BIGINT)) AS id
          FROM pages, (SELECT unnest(['dc0', 'dc1']) AS dc) d
          WHERE split_part(url, '?', 1) NOT IN (SELECT url FROM known_p) GROUP BY ALL),""" + _IMPORT.format(
              order="url", known="known_p", id="page_id", cols="url")),
    "touched_file": _q(f"SELECT dc, op, {_REASON} AS reason, count(*) AS lines FROM ev GROUP BY ALL"),
    "batch_and_stream_one_landing": _q(f"""
        SELECT CASE event_id % 3 WHEN 0 THEN 'batch 1' WHEN 1 THEN 'stream' ELSE 'batch 2' END AS taken_by, {_REASON} AS reason,
               count(*) AS lines FROM ev GROUP BY ALL"""),
    "odd_file_names": _q(f"""
        SELECT CASE event_id % 2 WHEN 0 THEN '1' ELSE '2' END AS batch_id, dc, op, {_REASON} AS reason, count(*) AS lines FROM ev GROUP BY ALL"""),
    # a time that is one falls under v1 or later; under v3 the line has another delimiter, under v2 another form
    "odd_times": _q("""
        SELECT CASE WHEN op = 'zetanet' THEN 'unknown_operator' WHEN good THEN '' ELSE 'no_valid_format' END AS reason,
               CASE WHEN op <> 'zetanet' AND good THEN y ELSE 0 END AS year, count(*) AS lines
        FROM (SELECT op, CASE event_id % 9 WHEN 0 THEN CAST(year(ts) AS INTEGER) WHEN 8 THEN 9999 ELSE 0 END AS y,
                     event_id % 9 = 8 OR (event_id % 9 = 0 AND version IS NOT NULL) AS good FROM ev) GROUP BY ALL"""),
    "half_written_batch": _q("""
        SELECT 'records' AS output, CAST(count(*) AS BIGINT) AS rows FROM ev WHERE event_id % 2 = 0
        UNION ALL SELECT x, (SELECT count(*) FROM std WHERE row_id % 2 = 0) FROM (SELECT unnest(['enriched', 'text', 'usage']) AS x)"""),
    "late_descriptor": _q(f"""
        , b AS (SELECT 1 AS n UNION ALL SELECT 2),
        x AS (SELECT CAST(n AS BIGINT) AS batch_id, CASE WHEN {_REASON} = '' THEN version ELSE {_REASON} END AS read_as, epoch_s
              FROM ev, b WHERE n = 1 OR event_id % 5 = 0)
        SELECT batch_id, read_as, count(*) AS lines, CAST(sum(CASE WHEN read_as LIKE 'v_' THEN epoch_s END) AS BIGINT) AS times FROM x GROUP BY ALL
        UNION ALL SELECT batch_id, 'text', count(*), NULL FROM x WHERE read_as LIKE 'v_' GROUP BY ALL"""),
    "ids_two_writers": _q("""
        , k AS (SELECT DISTINCT dc, op, msisdn, imsi, '' AS imei FROM ev),
        u AS (SELECT dc, op, msisdn, imsi, imei FROM known_u UNION SELECT * FROM k),
        m AS (SELECT dc, max(user_id) AS m, count(*) AS n FROM known_u GROUP BY dc)
        SELECT u.dc, count(*) AS rows, count(*) AS ids, count(*) AS keys, CAST(any_value(m.m) + count(*) - any_value(m.n) AS BIGINT) AS highest
        FROM u JOIN m USING (dc) GROUP BY u.dc"""),
    "usage_stream": _q("""
        SELECT dc, op, CAST(floor(session_time / 900) * 900 AS BIGINT) AS window_start, count(*) AS sessions,
               CAST(sum(TRY_CAST(duration AS BIGINT)) AS BIGINT) AS duration, CAST(sum(TRY_CAST(page_sent AS BIGINT)) AS BIGINT) AS pages
        FROM (SELECT DISTINCT s.dc, s.op, line, session_time, duration, page_sent FROM std s JOIN lines USING (row_id)) GROUP BY ALL"""),
    "archived_landing": _q(f"""
        SELECT {_REASON} AS reason, count(*) AS lines FROM ev GROUP BY ALL
        UNION ALL SELECT 'left of the first run', CAST(0 AS BIGINT)"""),
    "dim_compacted": _q("SELECT row_id, user_id FROM enriched"),
}
