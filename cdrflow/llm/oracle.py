"""DuckDB SQL for the queries that SQL can express."""

# A-Z are lower-cased through translate: lower() also changes other letters.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER)
_BLANK = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')".format(_LOWER)

_OP1 = f"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM} AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(10, len(w)) AS k, list_slice(w, s, s + least(10, len(w)) - 1) AS g
        FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM b WHERE len(w) > 0)),
pos AS (SELECT doc_id, k, s, list_slice(w, s, s + k - 1) AS g
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
              FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
hit AS (SELECT doc_id, p.k, s, item FROM pos p JOIN win ON p.k = win.k AND p.g = win.g),
word AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(s, s + k)) AS x FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS l
        FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(word.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
       sha256(coalesce(its.l, '')) AS items_sha256, coalesce(word.n, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN its USING (doc_id)
"""

_OP9 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_BLANK} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, g FROM (
         SELECT doc_id, list_slice(w, s, s + 3) AS g
         FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS s FROM d WHERE len(w) >= 4)
         UNION ALL SELECT doc_id, w FROM d WHERE len(w) BETWEEN 1 AND 3)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
         FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
         WHERE 100 * i >= 80 * (x.n + y.n - i)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.m, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(c.m, d.doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) c USING (doc_id)
"""


# Thirds of each line against shifted substrings of lines of up to two more
# characters: any two lines within two edits share one. Shorter lines than 24
# characters are classed where they are equal.
_OP2 = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\r\n]+'), lambda x: x <> '') AS v FROM documents),
occ AS (SELECT doc_id, i - 1 AS line, v[i] AS t, length(v[i]) AS n
        FROM (SELECT doc_id, v, unnest(range(1, len(v) + 1)) AS i FROM d)
        WHERE length(v[i]) >= 24 OR regexp_matches(v[i], '[^\x20\x09-\x0D]')),
ln AS (SELECT t, n, min((doc_id, line)) AS first, row_number() OVER (ORDER BY t) AS id FROM occ GROUP BY t, n),
seg AS (SELECT n, k, k * (n // 3) + greatest(0, k - 3 + n % 3) AS s, n // 3 + CASE WHEN k >= 3 - n % 3 THEN 1 ELSE 0 END AS w
        FROM (SELECT DISTINCT n FROM occ WHERE n >= 24), (SELECT unnest([0, 1, 2]) AS k)),
own AS (SELECT id, n, k, substr(t, CAST(s + 1 AS BIGINT), CAST(w AS BIGINT)) AS g FROM ln JOIN seg USING (n)),
sub AS (SELECT DISTINCT id, seg.n, k, substr(t, CAST(s + o + 1 AS BIGINT), CAST(w AS BIGINT)) AS g
        FROM ln JOIN seg ON ln.n >= 24 AND seg.n BETWEEN ln.n - 2 AND ln.n, (SELECT unnest([-2, -1, 0, 1, 2]) AS o)
        WHERE s + o >= 0 AND s + o + w <= ln.n),
cand AS (SELECT DISTINCT own.id AS a, sub.id AS b FROM own JOIN sub USING (n, k, g) WHERE own.id <> sub.id),
link AS (SELECT a, b FROM cand JOIN ln x ON x.id = a JOIN ln y ON y.id = b WHERE levenshtein(x.t, y.t) <= 2),
both_ AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM both_ UNION SELECT r.a, l.b FROM reach r JOIN both_ l ON r.b = l.a),
head AS (SELECT id, least(first, coalesce(m, first)) AS head FROM ln LEFT JOIN
         (SELECT a, min(ln.first) AS m FROM reach JOIN ln ON ln.id = reach.b GROUP BY a) r ON r.a = ln.id),
later AS (SELECT doc_id, line, n, head[1] AS doc FROM occ JOIN ln USING (t, n) JOIN head USING (id) WHERE (doc_id, line) <> head),
per AS (SELECT doc_id, count(*) AS n, sum(CASE WHEN doc <> doc_id THEN n ELSE 0 END) AS c,
        string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) AS l FROM later GROUP BY doc_id),
src AS (SELECT doc_id, string_agg(CAST(doc AS VARCHAR), ',' ORDER BY doc) AS s
        FROM (SELECT DISTINCT doc_id, doc FROM later WHERE doc <> doc_id) GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n, 0) AS n_repeated, CAST(coalesce(c, 0) AS BIGINT) AS repeated_chars,
       coalesce(l, '') AS repeated_lines, coalesce(s, '') AS first_seen_in
FROM documents LEFT JOIN per USING (doc_id) LEFT JOIN src USING (doc_id)
"""

_OP5 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
runs AS (SELECT doc_id, s, list_slice(w, s, s + 4) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS s FROM d WHERE len(w) >= 5)),
twice AS (SELECT doc_id, g FROM runs GROUP BY doc_id, g HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(s, s + 5)) AS x FROM runs JOIN twice USING (doc_id, g)) GROUP BY doc_id),
m AS (SELECT doc_id, t, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
             coalesce(n, 0) AS n_repeat_words FROM d LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR word_chars > 15 * n_words
            OR 10 * n_dup_lines > 3 * len(string_split(t, chr(10)))
            OR 10 * len(regexp_extract_all(t, '[A-Z]')) > 4 * len(regexp_extract_all(t, '[A-Za-z]'))
            OR 10 * len(regexp_extract_all(t, '!')) > 3 * n_words) AS kept
FROM b
"""


def _op8() -> str:
    """Spans of each kind from the pieces between its matches."""
    from .secrets import EXAMPLE_OWNERS, KINDS

    found = []
    for place, (kind, pattern, group, least, _) in enumerate(KINDS):
        p = pattern.replace("'", "''")
        secret = f"regexp_extract_all(t, '{p}', {group})" if group else "ms"
        found.append(f"""
SELECT doc_id, owner, {place} AS place, '{kind}' AS kind, before + inside AS s, before + inside + length(ms[i]) AS e, secret[i] AS value
FROM (SELECT doc_id, owner, ms, i, secret, coalesce(list_sum(list_transform(list_slice(ps, 1, i), lambda x: length(x))), 0) AS before,
             coalesce(list_sum(list_transform(list_slice(ms, 1, i - 1), lambda x: length(x))), 0) AS inside
      FROM (SELECT doc_id, owner, ms, ps, secret, unnest(range(1, len(ms) + 1)) AS i
            FROM (SELECT doc_id, owner, t, ms, string_split_regex(t, '{p}') AS ps, {secret} AS secret
                  FROM (SELECT doc_id, owner, t, regexp_extract_all(t, '{p}') AS ms FROM d)) WHERE len(ms) > 0))
WHERE length(secret[i]) >= {least}""")
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS t FROM documents),
f AS ({' UNION ALL '.join(found)}),
wide AS (SELECT value, count(DISTINCT owner) AS owners FROM f GROUP BY value),
g AS (SELECT f.*, owners >= {EXAMPLE_OWNERS} AS example, kind || ':' || CAST(CAST(s AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(e AS BIGINT) AS VARCHAR) AS span
      FROM f JOIN wide USING (value)),
per AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
               count(*) FILTER (kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY s, place) FILTER (place < 3) AS base,
               string_agg(span, ',' ORDER BY s, place) AS spans, count(*) FILTER (example) AS n_example,
               count(*) FILTER (NOT example) AS n_live FROM g GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_example, 0) AS n_example, coalesce(n_live, 0) AS n_live
FROM d LEFT JOIN per USING (doc_id)
"""

_LABELS = ("(SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic "
           "FROM labels GROUP BY doc_id)")

# Each order tries its letters in turn; a mask goes at the first letter it holds.
_OP11 = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (SELECT doc_id, part, concat(CASE WHEN len(w) < 200 THEN 'A' ELSE '' END,
             CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END,
             CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 'C' ELSE '' END,
             CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
             CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS mask FROM d),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM m LEFT JOIN {_LABELS} USING (doc_id) GROUP BY part, mask),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS x, left(filter_order, step - 1) AS earlier
      FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, x,
             sum(n) FILTER (NOT contains(mask, x) AND translate(mask, earlier, '') = mask) AS passed,
             coalesce(sum(n) FILTER (contains(mask, x) AND translate(mask, earlier, '') = mask), 0) AS removed,
             coalesce(sum(n) FILTER (contains(mask, x) AND translate(mask, earlier, '') <> mask), 0) AS redundant,
             coalesce(sum(n) FILTER (mask = x), 0) AS unique_fails,
             coalesce(sum(good) FILTER (contains(mask, x) AND translate(mask, earlier, '') = mask), 0) AS good_lost,
             coalesce(sum(toxic) FILTER (contains(mask, x) AND translate(mask, earlier, '') = mask), 0) AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, x)
SELECT part, filter_order, step, CAST(coalesce(passed, 0) AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM r
"""

# CRC-32 byte by byte over the distinct words, with the usual table of 256 values.
_OP12 = rf"""
WITH RECURSIVE bits(b, c, k) AS (SELECT b, CAST(b AS BIGINT), 0 FROM (SELECT unnest(range(0, 256)) AS b)
    UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
dw AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM d) GROUP BY word),
bw AS (SELECT word, count(*) AS n FROM (SELECT unnest({_ALNUM}) AS word FROM benchmark) GROUP BY word),
hashed AS (SELECT word, xor(4294967295, list_reduce(list_transform(range(0, CAST(length(hex(encode(word))) / 2 AS BIGINT)),
                  lambda i: CAST(('0x' || substr(hex(encode(word)), 2 * i + 1, 2)) AS BIGINT)),
                  lambda c, x: xor(c >> 8, t[CAST((xor(c, x) & 255) + 1 AS BIGINT)]), CAST(4294967295 AS BIGINT))) % 10000 AS bucket
           FROM (SELECT word FROM dw UNION SELECT word FROM bw), tab),
s AS (SELECT bucket, sum(n) AS n FROM dw JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS n FROM bw JOIN hashed USING (word) GROUP BY bucket),
gain AS (SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t.n, 0) AS DOUBLE) + 1) * (CAST((SELECT sum(n) FROM dw) AS DOUBLE) + 10000)
             / ((CAST(s.n AS DOUBLE) + 1) * (CAST(coalesce((SELECT sum(n) FROM bw), 0) AS DOUBLE) + 10000)))) AS BIGINT) AS g
         FROM s LEFT JOIN t USING (bucket)),
tokens AS (SELECT doc_id, unnest(w) AS word FROM d),
weighed AS (SELECT doc_id, count(*) AS n, sum(g) AS g FROM tokens JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(CAST(floor(CAST(g AS DOUBLE) / n) AS BIGINT), 0) AS weight,
                  CAST(floor(-1000 * ln(-ln((CAST(('0x' || left(sha256('2024:' || CAST(d.doc_id AS VARCHAR)), 8)) AS BIGINT) + 0.5::DOUBLE)
                       / 4294967296::DOUBLE))) AS BIGINT) AS noise
           FROM d LEFT JOIN weighed USING (doc_id)),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY weight + noise DESC, doc_id) AS place,
                  10 * count(*) OVER () // 100 AS drawn FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, weight + noise AS score, CASE WHEN place <= drawn THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""


ORACLE_SQL = {
    "op1_decontaminate": _OP1,
    "op2_line_dedup": _OP2,
    "op5_quality_rules": _OP5,
    "op8_secrets": _op8(),
    "op9_near_duplicates": _OP9,
    "op11_filter_audit": _OP11,
    "op12_importance_resample": _OP12,
}
