"""DuckDB statements that must give the rows of the queries, written apart from the Spark code."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, sha256({LOWER}) AS text_sha256, {LOWER} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY norm)
"""


def mix_sources() -> str:
    return f"""
WITH q AS (SELECT doc_id, max(quality) AS q FROM labels GROUP BY doc_id),
d AS (SELECT x.doc_id, x.source, CAST({WORDS} AS BIGINT) AS size,
             CASE q.q WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END AS weight,
             (CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(x.doc_id AS VARCHAR), 'null')), 1, 12) AS BIGINT) + 0.5)
               / 281474976710656.0 AS u
      FROM documents x LEFT JOIN q ON x.doc_id = q.doc_id),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CAST([5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS DOUBLE) AS w
      FROM d GROUP BY source),
a AS (SELECT sum(source_size) * 1.5 AS budget, sum(w) AS total FROM s),
f AS (SELECT s.*, 2.0 * source_size / w AS full_at,
             coalesce(sum(2.0 * source_size) OVER o, 0) AS cap_before, coalesce(sum(w) OVER o, 0) AS w_before
      FROM s WINDOW o AS (ORDER BY 2.0 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min((budget - cap_before) / (total - w_before), full_at) AS level
      FROM f, a WHERE (budget - cap_before) / (total - w_before) <= full_at),
t AS (SELECT source, source_size, least(2.0 * source_size, coalesce(level, 1e300) * w) AS target FROM s, l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS epochs,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY -ln(u) / weight, d.doc_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - before)) AS BIGINT) AS taken
FROM p
"""


# The canonical form, written apart from the operator's: lines that state a copyright go, then all that is neither a
# letter, a digit nor beyond ASCII (but for typographic quotes and dashes) is one blank.
_SAID = r"(^|\n)[-\t ;#*/]*(copyright[\t ]*(\(c\)|©|\d|\[|<|\{|by )|©|\(c\)[\t ]*(copyright|\d\d\d\d))[^\n]*(\n[-\t ;#*/]*all rights reserved\.?[\t \r]*(\n|$))?"
_OWN = r"(^|\n[\t \r]*\n)[-\t ;#*/]*copyright [^\n]*(\n[\t \r]*\n|\s*$)"
_SPELLED = {"licenc": "licens", "sub licens": "sublicens", "non commercial": "noncommercial", "https": "http", "merchantibility": "merchantability",
            "acknowledgement": "acknowledgment", "favour": "favor", "wilful": "willful", "per cent": "percent", "copyright owner": "copyright holder",
            "third party": "thirdparty"}


def _bare(text: str) -> str:
    s = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # Twice, as lines that follow one another share the line feed between them.
    for _ in range(2):
        s = f"regexp_replace({s}, '{_SAID}', chr(10), 'g')"
    return f"regexp_replace({s}, '{_OWN}', chr(10) || chr(10), 'g')"


def _words(text: str) -> str:
    s = f"trim(regexp_replace({text}, '[\\x09-\\x0D\\x20-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7E‘’“”–—©]+', ' ', 'g'))"
    for variant, one in _SPELLED.items():
        s = f"replace({s}, '{variant}', '{one}')"
    return s


def license_scan() -> str:
    from stockmap.llm.license_scan import LONG_TEXTS, NOTICES, TEXTS

    quoted = lambda t: t.replace("'", "''")
    rows = ", ".join(f"('{k}', '{quoted(t)}')" for known in (NOTICES, TEXTS) for k, texts in known.items() for t in texts)
    long = ", ".join(f"('{k}', '{d}')" for k, found in LONG_TEXTS.items() for d in found)
    return f"""
WITH known AS (SELECT digest, min(license) AS license FROM (
  SELECT license, sha256({_words(_bare('text'))}) AS digest FROM (VALUES {rows}) v(license, text) UNION ALL FROM (VALUES {long}) l(license, digest)) GROUP BY 1),
d AS (SELECT row_number() OVER () AS uid, doc_id, {_bare('text')} AS text FROM documents),
whole AS (SELECT uid, doc_id, sha256({_words('text')}) AS digest FROM d),
lines AS (SELECT uid, unnest(string_split(text, chr(10))) AS line FROM d WHERE contains(text, chr(10))),
hits AS (SELECT uid, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(*) AS n
         FROM lines JOIN known ON sha256({_words('line')}) = digest GROUP BY uid)
SELECT doc_id, whole.digest AS canonical_sha256, license, coalesce(notices, '') AS notices, coalesce(n, 0) AS n_notice_lines
FROM whole LEFT JOIN known ON whole.digest = known.digest LEFT JOIN hits USING (uid)
"""


#: Documents ranked for each item by plain joins over all terms.
LEXICAL_SEARCH = r"""
WITH dt AS (SELECT uid, doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS raw
            FROM (SELECT row_number() OVER () AS uid, doc_id, text FROM documents)),
d AS (SELECT uid, doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM dt),
i AS (SELECT item_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term, count(*) AS times
      FROM (SELECT item_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS raw FROM benchmark)
      GROUP BY ALL),
t AS (SELECT uid, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM d GROUP BY uid, term),
len AS (SELECT uid, CAST(sum(tf) AS BIGINT) AS n FROM t GROUP BY uid),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM len),
df AS (SELECT term, count(*) AS df FROM t GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM df, c),
s AS (SELECT i.item_id, t.uid, any_value(t.doc_id) AS doc_id,
             CAST(sum(i.times * w.w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
      FROM i JOIN t USING (term) JOIN w USING (term) JOIN len ON t.uid = len.uid, c GROUP BY i.item_id, t.uid),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
