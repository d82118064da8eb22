"""DuckDB SQL for the queries that SQL can express, over the same whole tables."""

from __future__ import annotations

from loomwork.llm import mixing, quality

WORD = r"[^\x20\x09-\x0D]+"

SUBSTRINGS = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
 starts AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS win
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)),
 firsts AS (SELECT win, min((doc_id, i)) AS first FROM starts GROUP BY win),
 gone AS (SELECT doc_id, i FROM starts JOIN firsts USING (win) WHERE (doc_id, i) <> first),
 words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
 marked AS (SELECT words.doc_id, words.i, word,
                   coalesce(max(gone.i) OVER (PARTITION BY words.doc_id ORDER BY words.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) > words.i - 20, false) AS removed
            FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.i = words.i),
 sums AS (SELECT doc_id, count(*) FILTER (WHERE removed) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT removed) AS kept
          FROM marked GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN sums USING (doc_id)
"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_FAILS = " OR ".join([
    f"(NOT regexp_matches(line, {_quoted(quality.TERMINAL)}) AND len(regexp_extract_all(line, '{WORD}')) < {quality.MIN_BARE_WORDS})",
    *[f"regexp_matches(line, {_quoted(p)})" for p in (quality.NAVIGATION, quality.SEPARATORS, quality.BOILERPLATE)]])

QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
 lines AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
           WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
 per_line AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines,
                     sum(CASE WHEN {_FAILS} THEN len(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) ELSE 0 END) AS lost
              FROM lines GROUP BY doc_id),
 starts AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d)),
 twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM starts) WHERE n > 1),
 spans AS (SELECT doc_id, sum(least(5, coalesce(next - i, 5))) AS n_repeat_words
           FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM twice) GROUP BY doc_id),
 m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(array_to_string(ws, '')) AS BIGINT) AS word_chars,
              CAST(len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
              CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(lost, 0) AS lost
       FROM d LEFT JOIN per_line USING (doc_id) LEFT JOIN spans USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND lost <= 0.5 * word_chars AS kept
FROM m
"""

TOPK = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
       FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
 r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10
"""


def _mixing() -> str:
    def rule(words, signs, pattern):
        hits = [f"contains(lower(text), {_quoted(w)})" for w in words]
        return " OR ".join(hits + ([f"regexp_matches(lower(text), {_quoted(pattern)})"] if pattern else []))

    topic = " ".join(f"WHEN {rule(*rest)} THEN '{name}'" for name, *rest in mixing.TOPICS)
    steps = [f"""
 facts AS (SELECT doc_id, source, lang, CASE {topic} ELSE '{mixing.OTHER_TOPIC}' END AS topic,
                  CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS n_tokens FROM documents),
 c0 AS (SELECT source, lang, topic, sum(n_tokens) AS tokens, 1.0::DOUBLE AS weight FROM facts GROUP BY ALL)"""]
    for d in mixing.DIMENSIONS:
        steps.append(f"""
 t_{d} AS (SELECT {d} AS value, p / sum(p) OVER () AS share FROM (SELECT {d}, pow(sum(tokens) / (SELECT sum(tokens) FROM c0), {mixing.TEMPER}) AS p
                                                                FROM c0 GROUP BY {d}))""")
    last = "c0"
    for i in range(mixing.ITERATIONS):
        for d in mixing.DIMENSIONS:
            name = f"c{i}_{d}"
            steps.append(f"""
 {name} AS MATERIALIZED (SELECT x.source, x.lang, x.topic, x.tokens, x.weight * t.share / sum(x.weight * x.tokens) OVER (PARTITION BY x.{d}) AS weight
                         FROM {last} x JOIN t_{d} t ON x.{d} IS NOT DISTINCT FROM t.value)""")
            last = name
    # The weights at which a least share is kept: levels up to which each dimension's values can give what is asked of them, weights raked to
    # those with probabilities of at most 1, and one scale for all. A level is the first, in the order in which values are used up, that
    # the next value still can give.
    steps.append(f"""
 fitted AS (SELECT *, {mixing.KEPT} * sum(tokens) OVER () AS budget, sum(weight * tokens) OVER () AS mass, max(weight) OVER () AS top FROM {last}),
 k0 AS (SELECT source, lang, topic, tokens, weight * budget / mass AS weight FROM fitted)""")
    for d in mixing.DIMENSIONS:
        steps.append(f"""
 r_{d} AS (SELECT value, share, total, total / share AS used_up FROM t_{d} JOIN (SELECT {d} AS v, sum(tokens) AS total FROM c0 GROUP BY {d})
           ON value IS NOT DISTINCT FROM v WHERE share > 0),
 l_{d} AS (SELECT arg_min(level, place) AS level FROM (
   SELECT used_up, row_number() OVER (ORDER BY used_up, value) AS place, ((SELECT max(budget) FROM fitted) - coalesce(sum(total) OVER (ORDER BY used_up, value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          / sum(share) OVER (ORDER BY used_up, value ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r_{d}) WHERE level <= used_up),
 w_{d} AS (SELECT value, least(share * level, total) AS wanted FROM r_{d}, l_{d})""")
    last = "k0"
    for i in range(mixing.ITERATIONS):
        for d in mixing.DIMENSIONS:
            name = f"k{i}_{d}"
            steps.append(f"""
 {name} AS MATERIALIZED (SELECT x.source, x.lang, x.topic, x.tokens, coalesce(x.weight * w.wanted
                           / nullif(sum(least(x.weight, 1) * x.tokens) OVER (PARTITION BY x.{d}), 0), 0) AS weight
                         FROM {last} x LEFT JOIN w_{d} w ON x.{d} IS NOT DISTINCT FROM w.value)""")
            last = name
    steps.append(f"""
 scale AS (SELECT arg_min(factor, place) AS factor FROM (
   SELECT weight, row_number() OVER (ORDER BY weight DESC, source, lang, topic) AS place, ((SELECT max(budget) FROM fitted) - coalesce(sum(tokens) OVER (ORDER BY weight DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          / sum(weight * tokens) OVER (ORDER BY weight DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS factor
   FROM {last} WHERE weight > 0 AND tokens > 0) WHERE weight * factor <= 1),
 c AS (SELECT x.source, x.lang, x.topic, CASE WHEN f.mass / f.top >= f.budget THEN f.weight / f.top ELSE least(1.0, x.weight * factor) END AS probability
       FROM {last} x JOIN fitted f ON x.source IS NOT DISTINCT FROM f.source AND x.lang IS NOT DISTINCT FROM f.lang AND x.topic = f.topic, scale)""")
    return f"""WITH {','.join(steps)},
 p AS (SELECT f.doc_id, f.source, f.lang, f.topic, f.n_tokens, c.probability
       FROM facts f JOIN c ON f.source IS NOT DISTINCT FROM c.source AND f.lang IS NOT DISTINCT FROM c.lang AND f.topic = c.topic)
SELECT doc_id, source, lang, topic, n_tokens, round(probability, 6) AS probability,
       CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 < probability AS drawn
FROM p
"""


JACCARD = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
 sets AS (SELECT doc_id, ws, CASE WHEN len(ws) < 5 THEN NULL ELSE list_sort(list_distinct(list_transform(
                 range(1, len(ws) - 3), lambda i: hash(array_to_string(ws[i:i + 4], ' '))))) END AS s FROM w),
 keyed AS (SELECT doc_id, s, CASE WHEN s IS NULL THEN 'w ' || array_to_string(ws, ' ') ELSE 's ' || md5(CAST(s AS VARCHAR)) END AS k FROM sets),
 owners AS (SELECT k, min(doc_id) AS copy_of, any_value(s) AS s FROM keyed GROUP BY k),
 shingles AS (SELECT copy_of AS m, unnest(s) AS g FROM owners WHERE s IS NOT NULL),
 sizes AS (SELECT m, count(*) AS size FROM shingles GROUP BY m),
 common AS (SELECT a.m AS a, b.m AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.m <> b.m GROUP BY ALL),
 links AS (SELECT a, b FROM common JOIN sizes x ON x.m = a JOIN sizes y ON y.m = b WHERE c >= 0.8 * (x.size + y.size - c) - 1e-9),
 reach AS (SELECT copy_of AS m, copy_of AS r FROM owners UNION SELECT l.b, r.r FROM reach r JOIN links l ON l.a = r.m),
 classes AS (SELECT m, min(r) AS class_id FROM reach GROUP BY m),
 counted AS (SELECT a AS m, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, class_id, copy_of, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM keyed JOIN owners USING (k) JOIN classes ON classes.m = copy_of LEFT JOIN counted ON counted.m = copy_of
"""

SQL = {"op4_substring_dedup": SUBSTRINGS, "op5_line_quality": QUALITY, "op6_topk": TOPK, "op8_mixing": _mixing(), "op9_jaccard": JACCARD}
