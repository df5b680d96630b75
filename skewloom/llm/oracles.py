"""SQL for the queries of this package that SQL can express."""

from __future__ import annotations

# crc32 of an id's decimal digits, bit by bit.
CRC32 = """xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT)),
    lambda a, b: list_reduce(
        list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384)
    )
), 4294967295)"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MERKLE = f"""
WITH RECURSIVE digests AS (
    SELECT row_number() OVER () AS row, doc_id, lang, {_leaf('text')} AS leaf,
           CASE WHEN {CRC32} % 3 = 0 THEN {_leaf(_LOWER)} ELSE {_leaf('text')} END AS presented
    FROM documents
),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS position,
           count(*) OVER (PARTITION BY lang) AS n
    FROM digests
),
nodes AS (
    SELECT lang, 0 AS level, position, leaf AS node, n FROM leaves
    UNION ALL
    SELECT lang, level + 1, position // 8, sha256(string_agg(node, '' ORDER BY position)), (n + 7) // 8
    FROM nodes WHERE n > 1 GROUP BY lang, level, position // 8, n
),
subroots AS (
    SELECT lang, node, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS position, count(*) OVER () AS n
    FROM nodes WHERE n = 1
),
upper AS (
    SELECT 0 AS level, position, node, n FROM subroots
    UNION ALL
    SELECT level + 1, position // 8, sha256(string_agg(node, '' ORDER BY position)), (n + 7) // 8
    FROM upper WHERE n > 1 GROUP BY level, position // 8, n
),
lower_steps AS (
    SELECT a.lang, a.level, a.position,
           coalesce(string_agg(b.node, '' ORDER BY b.position) FILTER (b.position < a.position), '') AS before,
           coalesce(string_agg(b.node, '' ORDER BY b.position) FILTER (b.position > a.position), '') AS after
    FROM nodes a JOIN nodes b
      ON a.lang IS NOT DISTINCT FROM b.lang AND a.level = b.level AND a.position // 8 = b.position // 8
    WHERE a.n > 1 GROUP BY ALL
),
upper_steps AS (
    SELECT a.level, a.position,
           coalesce(string_agg(b.node, '' ORDER BY b.position) FILTER (b.position < a.position), '') AS before,
           coalesce(string_agg(b.node, '' ORDER BY b.position) FILTER (b.position > a.position), '') AS after
    FROM upper a JOIN upper b ON a.level = b.level AND a.position // 8 = b.position // 8
    WHERE a.n > 1 GROUP BY ALL
),
steps AS (
    SELECT l.row, 0 AS part, s.level, s.before, s.after FROM leaves l JOIN lower_steps s
      ON l.lang IS NOT DISTINCT FROM s.lang AND l.position // CAST(pow(8, s.level) AS BIGINT) = s.position
    UNION ALL
    SELECT l.row, 1, s.level, s.before, s.after
    FROM leaves l JOIN subroots r ON l.lang IS NOT DISTINCT FROM r.lang
    JOIN upper_steps s ON r.position // CAST(pow(8, s.level) AS BIGINT) = s.position
),
paths AS (
    SELECT row, string_agg(before || after, '' ORDER BY part, level) AS others,
           list(before || '|' || after ORDER BY part, level) AS steps
    FROM steps GROUP BY row
),
done AS (
    SELECT l.doc_id, l.leaf, r.node AS subroot, u.node AS root, sha256(coalesce(p.others, '')) AS proof_sha256,
           list_reduce(
               list_concat([l.presented], coalesce(p.steps, [])),
               lambda a, s: sha256(split_part(s, '|', 1) || a || split_part(s, '|', 2))
           ) AS folded_root
    FROM leaves l JOIN subroots r ON l.lang IS NOT DISTINCT FROM r.lang
    CROSS JOIN (SELECT node FROM upper WHERE n = 1) u
    LEFT JOIN paths p ON l.row = p.row
)
SELECT *, folded_root = root AS verified FROM done
"""

_TERMS = f"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SEARCH = f"""
WITH occurrences AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM occurrences GROUP BY ALL),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
corpus AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS length FROM sizes),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
wanted AS (SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
weights AS (
    SELECT item_id, term, repeats, CAST(floor(1000 * ln((2 * documents + 2) / (2 * df + 1))) AS BIGINT) AS weight
    FROM wanted JOIN df USING (term) CROSS JOIN corpus
),
shares AS (
    SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // length)) AS share
    FROM tf JOIN sizes USING (doc_id) CROSS JOIN corpus
),
scores AS (
    SELECT item_id, doc_id, CAST(sum(repeats * weight * share) AS BIGINT) AS score
    FROM weights JOIN shares USING (term) GROUP BY ALL
),
ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""

# One backslash more behind the first character of a control string, for each role the marks around a text.
CHAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized AS (
    SELECT *, regexp_replace(text, '([<\[])(\\*(?:s>|/s>|<SYS>>|</SYS>>|INST\]|/INST\]|ROLE\]|/ROLE\]|/TURN\]))', '\1\\\2', 'g') AS safe,
           CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 WHEN 'system' THEN 18 ELSE 24 + length(role) END AS marks
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(length(safe) + marks) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

_WORD = r"[^\x20\x09-\x0D]+"

JACCARD = rf"""
WITH RECURSIVE worded AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all({_LOWER}, '{_WORD}'), []) AS words FROM documents
),
sets AS (
    SELECT row, doc_id, CASE
        WHEN len(words) = 0 THEN []
        WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]))
    END AS shingles
    FROM worded
),
entries AS (SELECT row, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS (
    SELECT a.row AS a, b.row AS b
    FROM entries a JOIN entries b ON a.shingle = b.shingle AND a.row <> b.row
    GROUP BY a.row, b.row, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
),
reached AS (
    SELECT row, row AS other FROM sets
    UNION
    SELECT r.row, l.b FROM reached r JOIN links l ON r.other = l.a
)
SELECT s.doc_id, CAST(len(any_value(s.shingles)) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
FROM sets s JOIN reached r ON s.row = r.row JOIN sets o ON r.other = o.row
GROUP BY s.row, s.doc_id
"""

RULES = rf"""
WITH given AS (
    SELECT row_number() OVER () AS row, doc_id, source AS host, coalesce(text, '') AS text,
           coalesce(regexp_extract_all(text, '{_WORD}'), []) AS words
    FROM documents
),
lines AS (
    SELECT row, doc_id, host, line, regexp_extract_all(line, '{_WORD}') AS words
    FROM (SELECT row, doc_id, host, unnest(string_split(text, chr(10))) AS line FROM given)
    WHERE regexp_matches(line, '{_WORD}')
),
normal AS (
    SELECT row, host, coalesce(CAST(doc_id AS VARCHAR), 'row ' || row) AS document, len(words) AS n,
           translate(array_to_string(words, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000') AS line
    FROM lines
),
hosts AS (SELECT host, count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), 'row ' || row)) AS docs FROM given GROUP BY host),
frequent AS (
    SELECT n.host, n.line FROM normal n JOIN hosts h ON n.host IS NOT DISTINCT FROM h.host
    GROUP BY n.host, n.line, h.docs HAVING count(DISTINCT document) > 20 AND count(DISTINCT document) > 0.01 * h.docs
),
removed AS (
    SELECT n.row, sum(n.n) AS words FROM normal n JOIN frequent f ON n.host IS NOT DISTINCT FROM f.host AND n.line = f.line
    GROUP BY n.row
),
repeats AS (SELECT row, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY row),
windows AS (
    SELECT row, place, words[place] || ' ' || words[place + 1] || ' ' || words[place + 2] AS three
    FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS place FROM given WHERE len(words) > 2)
),
again AS (
    SELECT row, count(DISTINCT place + step) AS n
    FROM (SELECT row, place, count(*) OVER (PARTITION BY row, three) AS times FROM windows), range(3) AS steps(step)
    WHERE times > 1 GROUP BY row
),
counted AS (
    SELECT g.row, g.doc_id, CAST(len(g.words) AS BIGINT) AS n_words,
           CAST(coalesce(list_sum(list_transform(g.words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(g.text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(coalesce(r.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(a.n, 0) AS BIGINT) AS n_repeat_words,
           CAST(coalesce(x.words, 0) AS BIGINT) AS removed_words
    FROM given g LEFT JOIN repeats r ON g.row = r.row LEFT JOIN again a ON g.row = a.row LEFT JOIN removed x ON g.row = x.row
),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT * EXCLUDE (row), NOT base_failed AND NOT (
    removed_words > 0 AND (n_words - removed_words < 20 OR n_words - removed_words < 0.3 * n_words)
) AS kept
FROM failed
"""
