"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

from . import quality_rules as Q
from . import secret_scan as S


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def secret_matches(rank: int, rule: S.Rule) -> str:
    """Spans of one rule, from the lengths of the gaps and matches in front of each.  A run
    of hexadecimal digits is matched whole, so its length can stand in the pattern."""
    pattern = text(f"[0-9a-f]{{{rule.least},}}" if rule.kind == "hex" else rule.pattern)
    return f"""
    SELECT doc_id, {rank} AS rank, {text(rule.kind)} AS kind, begins AS a, begins + length(hits[i]) AS b
    FROM (SELECT *, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                    + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS begins
          FROM (SELECT doc_id, gaps, hits, vals, unnest(range(1, len(hits) + 1)) AS i
                FROM (SELECT doc_id, string_split_regex(t, {pattern}) AS gaps, regexp_extract_all(t, {pattern}, 0) AS hits,
                             regexp_extract_all(t, {pattern}, {rule.group}) AS vals FROM docs)))
    WHERE length(vals[i]) >= {rule.least}"""


SECRETS = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({' UNION ALL '.join(secret_matches(k, r) for k, r in enumerate(S.RULES))}),
listed AS (
    SELECT doc_id,
           count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access,
           count(*) FILTER (WHERE rank = 2) AS n_hex,
           string_agg(concat_ws(':', kind, a, b), ',' ORDER BY a, rank) FILTER (WHERE rank < 3) AS base,
           string_agg(concat_ws(':', kind, a, b), ',' ORDER BY a, rank) AS spans
    FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (doc_id)"""


def distance(p: str, q: str) -> str:
    return (f"sqrt(greatest(sum(CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END"
            f" + CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({p} + {q})) ELSE 0 END) / 2, 0))")


def quality_sql() -> str:
    rest, classes = "t", []
    for name, pattern in Q.CLASSES.items():
        less = f"regexp_replace({rest}, {text(pattern)}, '', 'g')"
        classes.append((name, f"length({rest}) - length({less})"))
        rest = less
    classes.append(("other", f"length({rest})"))
    words = ", ".join(f"({text(lang)}, {text(w)})" for lang, ws in Q.COMMON_WORDS.items() for w in ws)
    forms = ", ".join(text(f) for w in Q.all_common_words() for f in (w, w.capitalize()))
    return f"""
WITH docs AS (
    SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
known(language, word) AS (VALUES {words}),
windows AS (
    SELECT doc_id, i, w[i:i + 2] AS three FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM docs)),
again AS (
    SELECT doc_id, count(DISTINCT i + k) AS n
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, three) AS times FROM windows), (VALUES (0), (1), (2)) AS o(k)
    WHERE times > 1 GROUP BY doc_id),
counted AS (
    SELECT d.doc_id, d.lang, len(w) AS n_words, length(t) AS n_chars,
           coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
           coalesce(again.n, 0) AS n_repeat_words,
           {', '.join(f'{e} AS c_{n}' for n, e in classes)}
    FROM docs d LEFT JOIN again USING (doc_id)),
judged AS (
    SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted),
class_bins AS (
    SELECT doc_id, lang, base_failed, unnest([{', '.join(text(n) for n, _ in classes)}]) AS bin,
           unnest([{', '.join(f'c_{n}' for n, _ in classes)}]) AS n
    FROM judged),
hits AS (
    SELECT doc_id, lower(x) AS word, count(*) AS n
    FROM (SELECT doc_id, unnest(w) AS x FROM docs) WHERE x IN ({forms}) GROUP BY ALL),
word_bins AS (
    SELECT j.doc_id, j.lang, j.base_failed, k.language, k.word AS bin, coalesce(h.n, 0) AS n
    FROM judged j CROSS JOIN known k LEFT JOIN hits h ON h.doc_id = j.doc_id AND h.word = k.word),
all_words AS (
    FROM word_bins UNION ALL
    SELECT j.doc_id, j.lang, j.base_failed, b.language, '' AS bin, j.n_words - b.n AS n
    FROM judged j JOIN (SELECT doc_id, language, sum(n) AS n FROM word_bins GROUP BY ALL) b USING (doc_id)),
class_refs AS (
    SELECT lang, bin, sum(n) / sum(sum(n)) OVER (PARTITION BY lang) AS q FROM class_bins
    WHERE NOT base_failed AND lang IN (SELECT language FROM known) GROUP BY lang, bin),
word_refs AS (
    SELECT language, bin, sum(n) / sum(sum(n)) OVER (PARTITION BY language) AS q FROM all_words
    WHERE NOT base_failed AND lang = language GROUP BY language, bin),
class_shares AS (
    SELECT doc_id, bin, CASE WHEN sum(n) OVER (PARTITION BY doc_id) > 0
        THEN n / sum(n) OVER (PARTITION BY doc_id) ELSE 0 END AS p FROM class_bins),
word_shares AS (
    SELECT doc_id, language, bin, CASE WHEN sum(n) OVER (PARTITION BY doc_id, language) > 0
        THEN n / sum(n) OVER (PARTITION BY doc_id, language) ELSE 0 END AS p FROM all_words),
class_far AS (
    SELECT doc_id, min(d) AS d FROM (
        SELECT s.doc_id, r.lang, {distance('s.p', 'r.q')} AS d
        FROM class_shares s JOIN class_refs r USING (bin) GROUP BY s.doc_id, r.lang) GROUP BY doc_id),
word_far AS (
    SELECT doc_id, min(d) AS d FROM (
        SELECT s.doc_id, r.language, {distance('s.p', 'r.q')} AS d
        FROM word_shares s JOIN word_refs r ON r.language = s.language AND r.bin = s.bin
        GROUP BY s.doc_id, r.language) GROUP BY doc_id)
SELECT j.doc_id, j.n_words, CAST(j.word_chars AS BIGINT) AS word_chars, j.n_symbols,
       len(j.lines) - len(list_distinct(j.lines)) AS n_dup_lines, j.n_repeat_words, j.base_failed,
       NOT j.base_failed AND NOT (
           (j.n_chars >= {Q.GUARD_CHARS} AND c.d > {Q.MAX_CLASS_DISTANCE})
           OR (j.n_words >= {Q.GUARD_WORDS} AND c.d + w.d > {Q.MAX_SUM_OF_DISTANCES})) AS kept,
       round(c.d, 6) AS class_distance, round(w.d, 6) AS word_distance
FROM judged j JOIN class_far c USING (doc_id) JOIN word_far w USING (doc_id)"""


WORDS = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"

SUBSTRINGS = f"""
WITH docs AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
starts AS (
    SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS run
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs)),
owned AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY run) AS owner FROM starts),
gone AS (SELECT DISTINCT doc_id, i + k AS place FROM owned, range(50) AS r(k) WHERE owner < doc_id),
kept AS (
    SELECT d.doc_id, count(*) AS n, string_agg(d.w[d.place], ' ' ORDER BY d.place) AS words
    FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS place FROM docs) d
    ANTI JOIN gone g ON g.doc_id = d.doc_id AND g.place = d.place
    GROUP BY d.doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""

LOWERED = WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

JACCARD = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {LOWERED} AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, CASE WHEN len(w) >= 5 THEN len(w) - 3 WHEN len(w) > 0 THEN 2 ELSE 1 END)) AS i
          FROM docs)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
    SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 100 * shared.n >= 80 * (a.n + b.n - shared.n)),
reached AS (
    SELECT doc_id, doc_id AS least FROM docs
    UNION SELECT y, least FROM reached JOIN links ON x = doc_id WHERE least < y)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT doc_id, min(least) AS component_id FROM reached GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)"""


COLLOCATIONS = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS tongue, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
places AS (
    SELECT tongue, w, unnest(range(1, len(w) + 1)) AS i
    FROM (SELECT tongue, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces)),
totals AS (SELECT tongue, count(*) AS n FROM places GROUP BY tongue),
often AS (
    SELECT tongue, w[i:i + size - 1] AS p, count(*) AS f FROM places, range(1, 6) AS sizes(size)
    WHERE i + size - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
    SELECT c.tongue, c.p, c.f AS a, k, h.f AS l, t.f AS r, n, (CAST(1000 AS HUGEINT) * c.f * n) // (CAST(h.f AS HUGEINT) * t.f) AS score
    FROM (SELECT *, unnest(range(1, len(p))) AS k FROM often) c JOIN totals USING (tongue)
    JOIN often h ON h.tongue = c.tongue AND h.p = c.p[1:k] JOIN often t ON t.tongue = c.tongue AND t.p = c.p[k + 1:]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY tongue, p ORDER BY score, k) = 1),
inner_parts AS (
    SELECT DISTINCT tongue, p[i:j] AS part, f FROM (
        SELECT *, unnest(range(i + 1, len(p) + 1)) AS j FROM (SELECT *, unnest(range(1, len(p))) AS i FROM often))
    WHERE j - i + 1 < len(p))
SELECT tongue AS lang, row_number() OVER (PARTITION BY tongue ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
       array_to_string(p, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM lowest z WHERE NOT EXISTS (
    SELECT 1 FROM inner_parts x WHERE x.tongue = z.tongue AND x.part = z.p AND 100 * x.f >= 100 * z.a)
QUALIFY rank <= 2000"""

TOP_K = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])) AS BIGINT) AS score
      FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
QUALIFY rank <= 5"""


ORACLE: dict[str, str] = {
    "op12_collocations": COLLOCATIONS,
    "op13_topk_threshold": TOP_K,
    "op2_substring_doubling": SUBSTRINGS,
    "op4_jaccard_tiles": JACCARD,
    "op5_secret_ledger": SECRETS,
    "op10_quality_divergence": quality_sql(),
}
