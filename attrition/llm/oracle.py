"""DuckDB twins of the corpus queries that SQL can express, written from the contracts rather than from the operators.

The others (tokenizers, seeded draws, CRC-32, a hash that SQL lacks, suffix trees, entropy windows) are tested
against plain Python in tests/llm.
"""

from __future__ import annotations

import string

from attrition.llm.license_scan import TEMPLATES, template_bigrams
from attrition.llm.quality import RULES

_WORDS = r"regexp_extract_all({t}, '[^\x20\x09-\x0D]+')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def near_duplicates(n: int, percent: int) -> str:
    lower = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    grams = f"list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(list_slice(w, i, i + {n - 1}), ' '))"
    return f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_WORDS.format(t=lower)} AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {n} THEN [array_to_string(w, ' ')]
                             ELSE list_distinct({grams}) END AS s FROM docs),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reached(a, b) AS (SELECT doc_id, doc_id FROM docs UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, l.component_id FROM sets s JOIN least l ON l.a = s.doc_id"""


def quality(risk: float = 0.04, delta: float = 0.05) -> str:
    rules = list(RULES)
    grid = ", ".join(f"('{r}', {i}, {c})" for r in rules for i, c in enumerate(RULES[r][1]))
    scores = " UNION ALL ".join(f"SELECT doc_id, stratum, base_failed, '{r}' AS rule, {RULES[r][0]} AS score FROM measured"
                                for r in rules)

    def credited(name: str, rows: str) -> str:
        """(pool, name, rule): the rules with credit for a bad document, each credited to the rule that rejects most."""
        order = "CASE rule " + " ".join(f"WHEN '{r}' THEN {i}" for i, r in enumerate(rules)) + " END"
        return f"""{name} AS (SELECT DISTINCT pool, name, rule FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY caught DESC, {order}) AS place FROM (
    SELECT *, count(*) OVER (PARTITION BY pool, name, rule) AS caught FROM ({rows}) WHERE hit AND NOT good)) WHERE place = 1)"""

    return f"""
WITH grid(rule, place, cutoff) AS (VALUES {grid}),
docs AS (SELECT doc_id, lang AS stratum, coalesce(text, '') AS t FROM documents),
listed AS (SELECT doc_id, stratum, t, {_WORDS.format(t='t')} AS w,
                  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM docs),
windows AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM listed)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM twice) GROUP BY doc_id),
counted AS (SELECT l.doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words,
                   CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
                   CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                   CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                   CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines
            FROM listed l LEFT JOIN covered c ON c.doc_id = l.doc_id),
measured AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted),
scores AS ({scores}),
label AS (SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
held AS (SELECT s.*, l.good, s.score >= (SELECT min(cutoff) FROM grid g WHERE g.rule = s.rule) AS hit
         FROM scores s JOIN label l ON l.doc_id = s.doc_id WHERE NOT base_failed),
{credited('own', 'SELECT *, false AS pool, stratum AS name FROM held')},
strata AS (SELECT h.stratum, count(DISTINCT h.doc_id) AS n, greatest(1, count(DISTINCT o.rule)) AS m
           FROM held h LEFT JOIN own o ON o.name IS NOT DISTINCT FROM h.stratum WHERE h.good GROUP BY h.stratum),
members AS (SELECT stratum, (1 - {risk} / m) ** n > {delta} / (m * (SELECT count(*) FROM strata)) AS pool FROM strata),
grouped AS (SELECT h.*, m.pool, CASE WHEN m.pool THEN NULL ELSE h.stratum END AS name
            FROM held h JOIN members m ON m.stratum IS NOT DISTINCT FROM h.stratum),
{credited('credit', 'SELECT * FROM grouped')},
used AS (SELECT c.pool, c.name, c.rule, count(*) AS n FROM credit c
         JOIN grouped g ON g.good AND g.pool = c.pool AND g.name IS NOT DISTINCT FROM c.name AND g.rule = c.rule
         GROUP BY c.pool, c.name, c.rule),
shared AS (SELECT *, {risk} / count(*) OVER (PARTITION BY pool, name) AS share, {delta} / count(*) OVER () AS level FROM used),
tries AS (SELECT u.pool, u.name, u.rule, u.n, u.share, u.level, g.place, g.cutoff, count(*) FILTER (WHERE h.good AND h.score >= g.cutoff) AS k
          FROM shared u JOIN grid g ON g.rule = u.rule
          JOIN grouped h ON h.pool = u.pool AND h.name IS NOT DISTINCT FROM u.name AND h.rule = u.rule GROUP BY ALL),
tested AS (SELECT *, CASE WHEN k > n * share THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda j: exp(
                   lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(share) + (n - j) * ln(1 - share)))) END AS tail FROM tries),
failed AS (SELECT pool, name, rule, min(place) AS place FROM tested WHERE tail > level GROUP BY pool, name, rule),
passed AS (SELECT t.pool, t.name, t.rule, min(t.cutoff) AS cutoff FROM tested t
           LEFT JOIN failed f ON f.pool = t.pool AND f.name IS NOT DISTINCT FROM t.name AND f.rule = t.rule
           WHERE f.place IS NULL OR t.place < f.place GROUP BY t.pool, t.name, t.rule),
chosen AS (SELECT m.stratum, p.rule, p.cutoff FROM passed p
           JOIN members m ON m.pool = p.pool AND (m.pool OR m.stratum IS NOT DISTINCT FROM p.name)),
broken AS (SELECT DISTINCT s.doc_id FROM scores s JOIN chosen c
           ON c.stratum IS NOT DISTINCT FROM s.stratum AND c.rule = s.rule AND s.score >= c.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM broken) AS kept FROM measured"""


CHAT = r"""
WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (SELECT *, length(role) + length(regexp_replace(role, '[^<\[\\\n]', '', 'g'))
                    + length(text) + length(regexp_replace(text, '[^<\[\\]', '', 'g')) + 8 AS formatted FROM said)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(formatted) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""

EXACT = r"""
WITH hashed AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM hashed WINDOW same AS (PARTITION BY text_sha256)"""


def licences(least: float = 0.8) -> str:
    rows = ", ".join(f"({_quoted(name)}, [{', '.join(map(_quoted, template_bigrams(t)))}])" for name, ts in TEMPLATES.items() for t in ts)
    return f"""
WITH templates(name, grams) AS (VALUES {rows}),
kept AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[^A-Za-z0-9\\n]+', ' ', 'g') AS k FROM documents),
parts AS (SELECT doc_id, unnest(list_concat(string_split(k, chr(10)), regexp_split_to_array(k, '\\n[ \\n]*\\n'), [k],
                                            regexp_split_to_array(t, '[.!?;:]+[\\x20\\x09-\\x0D]+'))) AS u FROM kept),
units AS (SELECT DISTINCT doc_id, lower(trim(regexp_replace(u, '[^A-Za-z0-9]+', ' ', 'g'))) AS u FROM parts),
split AS (SELECT doc_id, u, string_split(u, ' ') AS w FROM units),
grams AS (SELECT doc_id, u, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM split),
scored AS (SELECT doc_id, u, name, max(2.0 * len(list_intersect(g, grams)) / (len(g) + len(grams))) AS dice
           FROM grams JOIN templates ON 2 * least(len(g), len(grams)) >= {least} * (len(g) + len(grams)) GROUP BY doc_id, u, name),
best AS (SELECT * FROM (SELECT *, max(dice) OVER (PARTITION BY doc_id, u) AS top FROM scored) WHERE dice = top AND dice >= {least}),
found AS (SELECT doc_id, count(DISTINCT u) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS names, max(dice) AS top FROM best GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_units, coalesce(names, '') AS licences, CAST(coalesce(top, 0) AS DOUBLE) AS best_dice
FROM documents d LEFT JOIN found f ON f.doc_id = d.doc_id"""


ORACLE = {"op2_ngram_jaccard_join": near_duplicates(4, 85), "op5_quality_rules": quality(), "op6_chat_prefix_tree": CHAT,
          "op7_exact_dedup": EXACT, "op9_license_scan": licences()}
