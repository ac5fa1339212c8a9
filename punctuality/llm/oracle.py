"""DuckDB SQL for those registered queries of the corpus operators that SQL can express."""

from __future__ import annotations

WORDS = "list_filter(string_split_regex({text}, '[\\x09-\\x0D\\x20]+'), lambda x: x <> '')"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SUBSTRING = f"""
WITH w AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 34), ' ') AS k
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w)),
twice AS (SELECT k FROM g GROUP BY k HAVING count(*) > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS pos FROM g JOIN twice USING (k)),
placed AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text
         FROM placed ANTI JOIN covered USING (doc_id, pos) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

ESCAPED = "replace({x}, chr(92), chr(92) || chr(92))"
CONTROLS = "'</?s>|<\\||\\[/?INST\\]|<</?SYS>>'"


def _escaped_length(x: str) -> str:
    held = ESCAPED.format(x=x)
    return f"length({held}) + len(regexp_extract_all({held}, {CONTROLS}))"


CHAT = f"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({_escaped_length("role")} + {_escaped_length("text")} + 9) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id
"""

REACHED = """
reach AS (SELECT id, id AS other FROM nodes UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.other = links.a),
parts AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
"""

EMBEDDINGS = f"""
WITH RECURSIVE nodes AS (SELECT vec_id AS id FROM embeddings),
sound AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
          WHERE len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x <> 0)) > 0),
links AS (SELECT l.vec_id AS a, r.vec_id AS b FROM sound l JOIN sound r
          ON l.vec_id <> r.vec_id AND list_cosine_similarity(l.v, r.v) >= 0.9),
{REACHED.strip()}
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept
FROM parts LEFT JOIN (SELECT a AS id, count(*) AS n FROM links GROUP BY a) USING (id)
"""

MINHASH = f"""
WITH RECURSIVE nodes AS (SELECT doc_id AS id FROM documents),
w AS (SELECT doc_id, {WORDS.format(text=LOWERED)} AS ws FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 2), ' ') AS s
             FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, CASE WHEN len(ws) > 0 THEN 2 ELSE 1 END))) AS i FROM w)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS common FROM shingles l JOIN shingles r ON l.s = r.s AND l.doc_id <> r.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
{REACHED.strip()}
SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, id = component_id AS kept
FROM parts LEFT JOIN (SELECT doc_id AS id, n FROM sizes) USING (id)
"""

LINE_FIRST = f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
runs AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 2), ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, k FROM runs GROUP BY doc_id, k HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT place) AS n
            FROM (SELECT doc_id, unnest(range(i, i + 3)) AS place FROM runs JOIN twice USING (doc_id, k)) GROUP BY doc_id),
lines AS (SELECT doc_id, sum(n - 1) AS n FROM (SELECT doc_id, line, count(*) AS n
              FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x09-\x0D\x20]')
              GROUP BY doc_id, line) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
       len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines,
       coalesce(covered.n, 0) AS n_repeat_words, len(ws) < 50 OR 100 * coalesce(covered.n, 0) > 50 * len(ws) AS base_failed
FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
"""

TERMS = "regexp_extract_all({text}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

LEXICAL = f"""
WITH d AS (SELECT doc_id, {TERMS.format(text=LOWERED)} AS ws FROM documents),
facts AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS uses FROM d WHERE len(ws) > 0),
asked AS (SELECT item_id, term, count(*) AS times
          FROM (SELECT item_id, unnest({TERMS.format(text=LOWERED)}) AS term FROM benchmark) GROUP BY item_id, term),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(ws) AS n, unnest(ws) AS term FROM d)
       WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, n, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), facts),
impacts AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // uses))) AS impact
            FROM tf JOIN weights USING (term), facts),
scores AS (SELECT item_id, doc_id, CAST(sum(times * impact) AS BIGINT) AS score FROM asked JOIN impacts USING (term) GROUP BY item_id, doc_id),
placed AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= 10
"""

RESAMPLING = f"""
WITH steps AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
texts AS (SELECT 0 AS side, doc_id, {TERMS.format(text=LOWERED)} AS ws FROM documents
          UNION ALL SELECT 1, item_id, {TERMS.format(text=LOWERED)} FROM benchmark),
spots AS (SELECT side, doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM texts),
uses AS (SELECT side, doc_id, ws[i] AS f FROM spots
         UNION ALL SELECT side, doc_id, ws[i] || ' ' || ws[i + 1] FROM spots WHERE i < len(ws)),
digits AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM uses)),
crcs AS (SELECT f, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(1, length(h), 2),
             lambda k: (strpos('0123456789ABCDEF', h[k]) - 1) * 16 + strpos('0123456789ABCDEF', h[k + 1]) - 1)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 10000 AS bucket FROM digits, steps),
counts AS (SELECT bucket, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS s, sum(side) AS t FROM uses JOIN crcs USING (f) GROUP BY bucket),
totals AS (SELECT CAST(sum(s) AS BIGINT) AS all_s, CAST(sum(t) AS BIGINT) AS all_t FROM counts),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST(((t + 1) * (all_s + 10000)) AS DOUBLE) / CAST(((s + 1) * (all_t + 10000)) AS DOUBLE))) AS BIGINT) AS g
         FROM counts, totals),
sums AS (SELECT doc_id, count(*) AS n, CAST(sum(g) AS BIGINT) AS g FROM uses JOIN crcs USING (f) JOIN gain USING (bucket) WHERE side = 0 GROUP BY doc_id),
weights AS (SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_features,
                   CASE WHEN n IS NULL THEN 0 ELSE CAST((g - ((g % n) + n) % n) // n AS BIGINT) END AS weight,
                   CAST('0x' || left(sha256('7:' || doc_id), 8) AS BIGINT) AS h
            FROM texts LEFT JOIN sums USING (doc_id) WHERE side = 0),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM weights),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
                  count(*) OVER (PARTITION BY n_words >= 20) AS held FROM scored)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CASE WHEN n_words >= 20 AND place <= 25 * held // 100 THEN place END AS rank FROM placed
"""

ORACLE: dict[str, str] = {
    "op1_relative_lz": SUBSTRING,
    "op2_reply_trees": CHAT,
    "op5_spherical_cells": EMBEDDINGS,
    "op6_b_bit_minhash": MINHASH,
    "line_first_base": LINE_FIRST,
    "op11_range_maximum": LEXICAL,
    "op12_prefix_crc": RESAMPLING,
}
