r"""SQL that gives the rows of the queries, for DuckDB over the same tables.

``op1`` and ``op7`` fit models and ``op10`` needs the places of matches, which SQL has no
function for; tests hold these against brute force and held-out rows.
"""

from __future__ import annotations

from feedlake.llm import license_scan, url_filter
from feedlake.llm.queries import MIX

ORACLES: dict[str, str] = {}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_BLANK = r"regexp_extract_all(" + _LOWER + r", '[^\x20\x09-\x0D]+')"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _weights(column: str, known: dict[str, int], other: int) -> str:
    cases = " ".join(f"WHEN {_text(k)} THEN {v}" for k, v in sorted(known.items()))
    return f"CASE {column} {cases} ELSE {other} END"


def _filled(name: str, nodes: str, parent: list[str], by: str) -> str:
    """CTEs that fill one level: nodes with cap, weight and budget get ``given``."""
    group = f"PARTITION BY {', '.join(parent)}" if parent else ""
    cols = ", ".join([*parent, by])
    return f"""
    {name}_marked AS (
        SELECT *, CAST(cap AS HUGEINT) * sum(weight) OVER ({group} ORDER BY cap / weight, {by}
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                  <= CAST(budget - coalesce(sum(cap) OVER ({group} ORDER BY cap / weight, {by}
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS HUGEINT) * weight AS is_full
        FROM ({nodes}) WHERE weight > 0),
    {name} AS (
        SELECT {cols}, CASE WHEN is_full THEN cap ELSE CAST(
            CAST(budget - coalesce(sum(CASE WHEN is_full THEN cap END) OVER ({group}), 0) AS HUGEINT) * weight
            // sum(CASE WHEN NOT is_full THEN weight END) OVER ({group}) AS BIGINT) END AS given
        FROM {name}_marked)"""


_MIX_RANK = f"md5('{MIX.seed}:' || CAST(epochs AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || digest)"
ORACLES["op2_source_mix"] = rf"""
WITH rows_ AS (
    SELECT doc_id, md5(coalesce(text, '')) AS digest, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens,
           coalesce(CASE TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT) % 3
                    WHEN 0 THEN 'web' WHEN 1 THEN 'reference' WHEN 2 THEN 'forum' END, '(none)') AS domain,
           coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source
    FROM documents),
leaves AS (
    SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(tokens) * {MIX.max_epochs} AS BIGINT) AS cap
    FROM rows_ WHERE tokens > 0 GROUP BY ALL),
total AS (SELECT CAST(coalesce(sum(tokens), 0) * {MIX.share_percent} // 100 AS BIGINT) AS budget FROM leaves),
{_filled("d", f"SELECT domain, CAST(sum(cap) AS BIGINT) AS cap, {_weights('domain', MIX.domain_weights, MIX.other[0])} AS weight, any_value(budget) AS budget FROM leaves, total GROUP BY domain", [], "domain")},
{_filled("l", f"SELECT domain, lang, CAST(sum(cap) AS BIGINT) AS cap, {_weights('lang', MIX.lang_weights, MIX.other[1])} AS weight, any_value(given) AS budget FROM leaves JOIN d USING (domain) GROUP BY domain, lang", ["domain"], "lang")},
{_filled("s", f"SELECT domain, lang, source, CAST(sum(cap) AS BIGINT) AS cap, {_weights('source', MIX.source_weights, MIX.other[2])} AS weight, any_value(given) AS budget FROM leaves JOIN l USING (domain, lang) GROUP BY domain, lang, source", ["domain", "lang"], "source")},
plan AS (SELECT domain, lang, source, given // tokens AS epochs, given % tokens AS rest FROM s JOIN leaves USING (domain, lang, source)),
ranked AS (SELECT *, {_MIX_RANK} AS rank FROM rows_ JOIN plan USING (domain, lang, source) WHERE tokens > 0),
placed AS (
    SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY rank RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              - sum(tokens) OVER (PARTITION BY domain, lang, source, rank) AS before,
           sum(tokens) OVER (PARTITION BY domain, lang, source, rank) AS unit,
           count(*) OVER (PARTITION BY domain, lang, source, rank) AS copies
    FROM ranked)
SELECT doc_id, domain, lang, source, CAST(epoch AS BIGINT) AS epoch, tokens AS n_tokens, CAST(take AS BIGINT) AS take_tokens
FROM (
    SELECT doc_id, domain, lang, source, unnest(range(epochs)) AS epoch, tokens, tokens AS take FROM placed
    UNION ALL
    SELECT doc_id, domain, lang, source, epochs, tokens,
           CASE WHEN before + unit < rest THEN tokens WHEN before < rest THEN (rest - before) // copies ELSE 0 END
    FROM placed)
WHERE take > 0
"""

ORACLES["op3_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

ORACLES["op4_decontaminate"] = rf"""
WITH doc_words AS (SELECT row_number() OVER () AS r, doc_id, {_PLAIN.format("coalesce(text, '')")} AS words FROM documents),
item_words AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_PLAIN.format("coalesce(text, '')")} AS words FROM benchmark),
windows AS (
    SELECT DISTINCT item, least(10, len(words)) AS width, array_to_string(words[pos:pos + least(10, len(words)) - 1], ' ') AS gram
    FROM (SELECT *, unnest(range(1, greatest(1, len(words) - 9) + 1)) AS pos FROM item_words WHERE len(words) > 0)),
widths AS (SELECT DISTINCT width FROM windows),
places AS (
    SELECT r, pos, width, array_to_string(words[pos:pos + width - 1], ' ') AS gram
    FROM (SELECT r, width, words, unnest(range(1, len(words) - width + 2)) AS pos FROM doc_words, widths WHERE len(words) >= width)),
found AS (SELECT r, pos, width, item FROM places JOIN windows USING (width, gram)),
hits AS (SELECT r, count(DISTINCT word) AS n FROM (SELECT r, unnest(range(pos, pos + width)) AS word FROM found) GROUP BY r),
held AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM found GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (r) LEFT JOIN held USING (r)
"""

_RULES = ", ".join(f"({_text(h)}, {_text(p)}, {_text(a)})" for a, h, p in url_filter.PRODUCTION)
_AFTER = "CASE WHEN instr({0}, '://') > 0 THEN substr({0}, instr({0}, '://') + 3) ELSE '' END"
_HOST = _LOWER.format("regexp_extract(" + _AFTER + ", '^([^/?#]*)', 1)")
_PATH = "regexp_extract(" + _AFTER + ", '^[^/?#]*([^?#]*)', 1)"


def _address(url: str) -> str:
    host, path = _HOST.format(url), _PATH.format(url)
    kept = f"list_sort(list_filter(string_split(regexp_extract({url}, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '(?i)^{url_filter.TRACKING}(=|$)')))"
    return (
        f"CASE WHEN {host} <> '' THEN regexp_replace({host}, ':(80|443)$', '') || CASE WHEN {path} = '' THEN '/' ELSE {path} END"
        f" || CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') ELSE '' END END"
    )


ORACLES["op5_url_filter"] = rf"""
WITH RECURSIVE rules(rule_host, rule_path, action) AS (VALUES {_RULES}),
rows_ AS (
    SELECT row_number() OVER () AS r, page_id, url, html, coalesce({_HOST.format("url")}, '') AS host,
           coalesce({_PATH.format("url")}, '') AS path, {_address("url")} AS address FROM pages),
fits AS (
    SELECT r, arg_max(rule_host || rule_path, (length(rule_host || rule_path), length(rule_host), action = 'allow')) AS rule,
           arg_max(action, (length(rule_host || rule_path), length(rule_host), action = 'allow')) AS action
    FROM rows_ JOIN rules ON ('.' || host) LIKE ('%.' || rule_host) AND starts_with(path, rule_path) GROUP BY r),
tags AS (SELECT r, url, address, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\b[^>]*>')) AS tag FROM rows_),
named AS (
    SELECT address, url, regexp_extract(tag, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS t FROM tags
    WHERE regexp_matches(tag, '(?i)^<link\b[^>]*\brel\s*=\s*["'']?canonical\b')
    UNION ALL
    SELECT address, url, regexp_extract(tag, '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1) AS t FROM tags
    WHERE regexp_matches(tag, '(?i)^<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b')),
targets AS (
    SELECT address, CASE WHEN contains(t, '://') THEN t WHEN starts_with(t, '//') THEN regexp_extract(url, '^([A-Za-z][^:/?#]*:)//', 1) || t
           WHEN starts_with(t, '/') THEN regexp_extract(url, '^(.*?://[^/?#]*)', 1) || t END AS target FROM named),
edges AS (SELECT DISTINCT address AS a, b FROM (SELECT address, {_address("target")} AS b FROM targets) WHERE address <> b),
sym AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (SELECT a AS node, a AS pos FROM sym UNION SELECT node, b FROM reach JOIN sym ON pos = a),
linked AS (SELECT node AS address, min(pos) AS component FROM reach GROUP BY node),
nodes AS (
    SELECT address, coalesce(component, address) AS component, regexp_extract(address, '^([^/]*)', 1) AS host,
           regexp_extract(address, '^[^/]*([^?]*)', 1) AS path
    FROM (SELECT address FROM rows_ UNION SELECT a FROM edges UNION SELECT b FROM edges) LEFT JOIN linked USING (address)
    WHERE address IS NOT NULL),
decided AS (
    SELECT address, component, arg_max(action, (length(rule_host || rule_path), length(rule_host), action = 'allow')) AS action
    FROM nodes JOIN rules ON ('.' || host) LIKE ('%.' || rule_host) AND starts_with(path, rule_path) GROUP BY ALL),
inherited AS (SELECT component, min(action) AS inherited FROM decided GROUP BY component)
SELECT page_id, rows_.host, rows_.path, rule, coalesce(action, inherited, 'allow') AS verdict
FROM rows_ LEFT JOIN fits USING (r) LEFT JOIN nodes USING (address) LEFT JOIN inherited USING (component)
"""

_CONTROL = r"<(\\*)\|(im_start|im_end)\|>"
_ESCAPE = r"regexp_replace({}, '" + _CONTROL + r"', '<\1\\|\2|>', 'g')"
ORACLES["op6_chat_format"] = rf"""
WITH rows_ AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length(role) + length({_ESCAPE.format("text")})) AS BIGINT) AS formatted_chars
FROM rows_ GROUP BY conv_id
"""

_PLACES = ", ".join(
    f"({_text(label)}, {whole}, {q}, {_text(gram)}, {n})" for gram, label, whole, _, q, n in license_scan.PRODUCTION.grams()
)
_LONG = license_scan.LONG_GRAM
ORACLES["op8_license_scan"] = rf"""
WITH places(label, whole, q, gram, grams) AS (VALUES {_PLACES}),
doc_words AS (SELECT row_number() OVER () AS r, doc_id, {_PLAIN.format("coalesce(text, '')")} AS words FROM documents),
here AS (
    SELECT r, pos - 1 AS p, words[pos] || ' ' || words[pos + 1] AS gram
    FROM (SELECT r, words, unnest(range(1, len(words))) AS pos FROM doc_words)
    UNION ALL
    SELECT r, pos - 1 AS p, array_to_string(words[pos:pos + {_LONG - 1}], ' ') AS gram
    FROM (SELECT r, words, unnest(range(1, len(words) - {_LONG - 2})) AS pos FROM doc_words)),
votes AS (SELECT DISTINCT r, label, whole, grams, p - q AS diagonal, q FROM here JOIN places USING (gram)),
found AS (
    SELECT r, label, whole, diagonal, 1.0::DOUBLE AS share FROM votes WHERE whole GROUP BY r, label, whole, grams, diagonal HAVING count(*) = grams
    UNION ALL
    SELECT a.r, a.label, a.whole, a.diagonal, count(DISTINCT b.q) / a.grams AS share
    FROM (SELECT DISTINCT r, label, whole, grams, diagonal FROM votes WHERE NOT whole) a
    JOIN votes b ON a.r = b.r AND a.label = b.label AND NOT b.whole AND b.diagonal BETWEEN a.diagonal - 2 AND a.diagonal + 2
    GROUP BY a.r, a.label, a.whole, a.grams, a.diagonal HAVING count(DISTINCT b.q) / a.grams >= 0.8),
summed AS (
    SELECT r, count(*) FILTER (whole) AS n_base, min(diagonal) FILTER (whole) AS first_word, max(diagonal) FILTER (whole) AS last_word,
           array_to_string(list_sort(list(DISTINCT label) FILTER (whole)), ',') AS base_labels,
           array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(share) AS score
    FROM found GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM doc_words LEFT JOIN summed USING (r)
"""

ORACLES["op9_near_dedup"] = rf"""
WITH RECURSIVE doc_words AS (SELECT doc_id, {_BLANK.format("coalesce(text, '')")} AS words FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[pos:pos + least(4, len(words)) - 1], ' ') AS s
    FROM (SELECT *, unnest(range(1, greatest(1, len(words) - 3) + 1)) AS pos FROM doc_words WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS node, a AS pos FROM edges UNION SELECT node, b FROM reach JOIN edges ON pos = a),
components AS (SELECT node, min(pos) AS component FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(least(component, d.doc_id), d.doc_id) AS component_id,
       d.doc_id = coalesce(least(component, d.doc_id), d.doc_id) AS kept
FROM doc_words d LEFT JOIN sizes USING (doc_id) LEFT JOIN components ON node = d.doc_id
"""


def _vectors(scale: int, columns: str = "", where: str = "true") -> str:
    """Rows that take part, with whole components ``e``."""
    return f"""vectors AS (
    SELECT vec_id{columns}, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND {where}
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""


ORACLES["op11_hard_negatives"] = f"""
WITH {_vectors(256, ", CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label", "label IS NOT NULL")},
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
    FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
mined AS (
    SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score
    FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
      AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS INTEGER) AS rank,
       negative_id, positive_score, negative_score
FROM mined QUALIFY rank <= 3
"""

ORACLES["op12_exact_topk"] = f"""
WITH {_vectors(1024)},
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""
