"""DuckDB SQL for the operators that SQL can express, over the tables as views."""

from __future__ import annotations

from playlog.llm.license_scan import SPELLINGS, licenses
from playlog.llm.quality_rules import STOP_WORDS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _is_notice(line: str) -> str:
    """A line that names a holder's copyright, or reserves all rights."""
    start = f"ltrim({line}, ' ' || chr(9))"
    return (rf"(regexp_matches({start}, '^copyright[ \t]*(\(c\)|©)') "
            rf"OR regexp_matches({start}, '^copyright[ \t]+[\[<{{(]?(yyyy|year|[0-9][0-9][0-9][0-9])') "
            rf"OR regexp_matches({start}, '^(\(c\)|©)[ \t]*[0-9][0-9][0-9][0-9]') "
            f"OR regexp_matches({start}, '^all rights reserved[. \t]*$'))")


def _canonical(text: str, notices: bool = False) -> str:
    t = f"lower({text})"
    if not notices:
        t = (f"array_to_string(list_filter(string_split({t}, chr(10)), "
             f"lambda l: NOT {_is_notice('l')}), chr(10))")
    t = rf"' ' || regexp_replace({t}, '[^\p{{L}}\p{{N}}]+', ' ', 'g') || ' '"
    for a, b in SPELLINGS:
        t = f"replace({t}, {_text(a)}, {_text(b)})"
    return f"nullif(trim({t}), '')"


def _license_digests() -> str:
    rows = ", ".join(f"({_text(n)}, {_text(t)})" for n, t in licenses())
    return rf"""
WITH text_of AS (SELECT l, t FROM (VALUES {rows}) AS v(l, t)),
known AS (
  SELECT digest, min(l) AS license FROM (
    SELECT l, sha256({_canonical("t")}) AS digest FROM text_of
    UNION ALL SELECT l, sha256({_canonical("t", True)}) FROM text_of)
  WHERE digest IS NOT NULL GROUP BY 1),
d AS (
  SELECT doc_id, sha256({_canonical("text")}) AS digest, sha256({_canonical("text", True)}) AS other,
         text FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
line AS (
  SELECT DISTINCT doc_id, license FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d)
  JOIN known ON known.digest = sha256({_canonical("l")})),
notice AS (
  SELECT doc_id, string_agg(license, ',' ORDER BY license) AS notices FROM line GROUP BY doc_id)
SELECT d.doc_id, d.digest, coalesce(a.license, b.license) AS license, coalesce(notices, '') AS notices
FROM d LEFT JOIN known a ON a.digest = d.digest LEFT JOIN known b ON b.digest = d.other
LEFT JOIN notice USING (doc_id)
"""


#: Pairs of documents that share a shingle, counted; the links; what each can reach.
NEAR_DEDUP = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words
    WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)),
either AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (
  SELECT a AS doc_id, a AS r FROM either
  UNION SELECT reach.doc_id, either.b FROM reach JOIN either ON either.a = reach.r),
lowest AS (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(size.n, 0) AS n_shingles, coalesce(lowest.r, d.doc_id) AS component_id,
       d.doc_id = coalesce(lowest.r, d.doc_id) AS kept
FROM documents d LEFT JOIN size USING (doc_id) LEFT JOIN lowest USING (doc_id)
"""

QUALITY_RULES = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
place AS (
  SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g FROM (
    SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) > 2)),
again AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM place)
  WHERE n > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(0, 3) AS o(k) GROUP BY doc_id),
line AS (
  SELECT doc_id, l FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM t)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS again FROM line GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         length(regexp_replace(text, '[^!]+', '', 'g')) AS shouts,
         len(list_filter(w, lambda x: lower(x) IN (
           {", ".join(_text(x) for x in dict.fromkeys(STOP_WORDS.split()))}))) AS stops,
         coalesce(lines.again, 0) AS n_dup_lines, coalesce(lines.n, 0) AS n_lines,
         coalesce(repeated.n, 0) AS n_repeat_words
  FROM t LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND word_chars >= 2.5 * n_words AND word_chars <= 12 * n_words
         AND n_symbols <= 0.2 * n_words AND shouts <= 0.3 * n_words
         AND stops >= 0.03 * n_words AND stops >= 2
         AND n_dup_lines <= 0.5 * n_lines AS kept
FROM m
"""

#: Every anchor against every row, all in whole numbers.
HARD_NEGATIVES = r"""
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
score AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM score WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                               ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
       n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positive p JOIN score n ON n.anchor_id = p.anchor_id AND NOT n.alike
  AND 100 * n.score BETWEEN 50 * p.positive_score AND 95 * p.positive_score
QUALIFY rank <= 3
"""

EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER alike AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = first_value(doc_id) OVER alike AS kept, sha256(t) AS text_sha256
FROM d WINDOW alike AS (PARTITION BY t ORDER BY n DESC, doc_id)
"""

RANKED_SEARCH = r"""
WITH word AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
tf AS (SELECT doc_id, t, count(*) AS tf FROM word GROUP BY 1, 2),
len AS (SELECT doc_id, count(*) AS n FROM word GROUP BY 1),
corpus AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM len),
rare AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), corpus),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf)
           // (1000 * tf + 20 * (100 - 50 + ((50 * n * big_n) // big_l))))) AS BIGINT) AS score
  FROM asked JOIN rare USING (t) JOIN tf USING (t) JOIN len USING (doc_id), corpus
  GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)
                     AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""


def oracle() -> dict[str, str]:
    return {
        "op2_near_dedup": NEAR_DEDUP,
        "op3_license_digests": _license_digests(),
        "op5_quality_rules": QUALITY_RULES,
        "op11_hard_negatives": HARD_NEGATIVES,
        "op12_exact_dedup": EXACT_DEDUP,
        "op13_ranked_search": RANKED_SEARCH,
    }
