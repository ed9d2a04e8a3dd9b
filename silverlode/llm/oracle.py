"""Expected answers as DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

from silverlode.llm import quality_rules

OP1 = r"""
WITH page AS (
  SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS lines
  FROM documents),
line AS (
  SELECT DISTINCT r, source, line FROM (SELECT r, source, unnest(lines) AS line FROM page)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
total AS (SELECT source, count(*) AS pages FROM page GROUP BY source),
plate AS (
  SELECT l.source, l.line
  FROM line l JOIN total t ON l.source IS NOT DISTINCT FROM t.source
  GROUP BY l.source, l.line, t.pages HAVING count(*) >= 5 AND count(*) > 0.1 * t.pages),
kept AS (
  SELECT r, array_agg(line ORDER BY k) FILTER (WHERE NOT dropped) AS lines,
         count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped
  FROM (SELECT u.r, u.k, u.line, p.line IS NOT NULL AS dropped
        FROM (SELECT r, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS k
              FROM page) u
        LEFT JOIN plate p ON u.line = p.line AND u.source IS NOT DISTINCT FROM p.source)
  GROUP BY r)
SELECT doc_id, source,
       CASE WHEN text IS NULL THEN NULL ELSE coalesce(array_to_string(kept.lines, chr(10)), '')
       END AS text,
       CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
       CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped
FROM page LEFT JOIN kept USING (r)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3 = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
spans AS (
  SELECT DISTINCT item_id, array_to_string(w[k:least(k + 9, len(w))], ' ') AS span,
         least(10, len(w)) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k
        FROM item WHERE len(w) > 0)),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM spans),
place AS (
  SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM doc, sizes WHERE len(w) >= size),
met AS (
  SELECT p.r, p.k, p.size, s.item_id
  FROM (SELECT r, k, size, array_to_string(w[k:k + size - 1], ' ') AS span FROM place) p
  JOIN spans s USING (span, size)),
hit AS (
  SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(k, k + size)) AS j FROM met)
  GROUP BY r),
listed AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM met WHERE item_id IS NOT NULL)
  GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(listed.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(listed.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""

_PHRASES = " OR ".join(f"contains(lower(line), '{phrase}')" for phrase in quality_rules.PHRASES)
_CLOSING = ", ".join("'" + sign.replace("'", "''") + "'" for sign in quality_rules.CLOSING)
_SEPARATORS = ", ".join(f"'{sign}'" for sign in quality_rules.SEPARATORS)
_SPACED = r"[^\x20\x09-\x0D]+"

OP5 = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w
  FROM documents),
line AS (
  SELECT r, k, line, regexp_extract_all(line, '{_SPACED}') AS w,
         length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS signs
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS k FROM doc)),
judged AS (
  SELECT r, list_sum(list_transform(w, lambda x: length(x))) AS chars,
         row_number() OVER (PARTITION BY r, line ORDER BY k) > 1 AS again,
         5 * signs > len(w)
         OR (len(w) >= 3 AND 3 * len(list_filter(w, lambda x: x[-1] IN ('!', '?'))) > len(w))
         OR (len(w) <= 3 AND NOT w[-1][-1] IN ({_CLOSING}))
         OR (len(list_filter(w, lambda x: x IN ({_SEPARATORS}))) >= 2
             AND 4 * len(list_filter(w, lambda x: x IN ({_SEPARATORS}))) >= len(w))
         OR {_PHRASES} AS failed
  FROM line WHERE len(w) > 0),
lost AS (
  SELECT r, sum(CASE WHEN failed OR again THEN chars ELSE 0 END) AS lost,
         sum(CASE WHEN again THEN 1 ELSE 0 END) AS dup
  FROM judged GROUP BY r),
gram AS (
  SELECT r, k, count(*) OVER (PARTITION BY r, gram) AS times
  FROM (SELECT r, k, w[k:k + 2] AS gram
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS k FROM doc WHERE len(w) >= 3))),
repeated AS (
  SELECT r, count(DISTINCT j) AS n
  FROM (SELECT r, unnest([k, k + 1, k + 2]) AS j FROM gram WHERE times > 1) GROUP BY r),
counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT)
           AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(lost, 0) AS BIGINT) AS lost_chars
  FROM doc LEFT JOIN lost USING (r) LEFT JOIN repeated USING (r))
SELECT *, n_words < 50 OR 2 * n_repeat_words > n_words AS base_failed,
       NOT (n_words < 50 OR 2 * n_repeat_words > n_words) AND 10 * lost_chars <= 3 * word_chars
         AS kept
FROM counted
"""


def _crc_entry(byte: int) -> int:
    for _ in range(8):
        byte = byte >> 1 ^ 0xEDB88320 * (byte & 1)
    return byte


def _crc32(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text as a whole number, one step a byte."""
    table = f"{[_crc_entry(byte) for byte in range(256)]}::BIGINT[]"
    pairs = f"regexp_extract_all(hex(encode({text})), '..')"
    steps = f"list_transform({pairs}, lambda pair: CAST('0x' || pair AS BIGINT))"
    return (
        f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda c, b: "
        f"xor(({table})[CAST(xor(c, b) & 255 AS INTEGER) + 1], c >> 8)), 4294967295)"
    )


def _value(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(
        _value(column) for column in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _tree(name: str, leaves: str) -> str:
    """Nodes of all levels (tree, level, pos, node, n nodes on the level)."""
    return f"""
{name} AS (
  SELECT tree, 0 AS level, pos, node, count(*) OVER (PARTITION BY tree) AS n FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)),
         any_value((n + 1) // 2)
  FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 2)"""


def _steps(leaves: str, tree: str) -> str:
    """The sibling of each leaf's node on each level, before or after it."""
    return f"""
  SELECT l.r, u.tree, u.level,
         CASE WHEN (l.pos >> u.level) & 1 = 1 THEN s.node ELSE '' END AS before,
         CASE WHEN (l.pos >> u.level) & 1 = 0 THEN coalesce(s.node, '') ELSE '' END AS after
  FROM {leaves} l JOIN (SELECT DISTINCT tree, level FROM {tree} WHERE n > 1) u USING (tree)
  LEFT JOIN {tree} s
    ON s.tree = u.tree AND s.level = u.level AND s.pos = xor(l.pos >> u.level, 1)"""


OP11 = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang, coalesce('=' || lang, '-') AS tree, {_leaf('n_chars')} AS node,
         CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_leaf('n_chars + 1')}
         END AS tampered
  FROM documents),
leaf AS (
  SELECT *, row_number() OVER () AS r,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node) - 1 AS pos
  FROM hashed),
{_tree('node', 'leaf')},
subroot AS (
  SELECT 0 AS tree, tree AS of, tree AS r, node AS node,
         row_number() OVER (ORDER BY tree = '-' DESC, tree) - 1 AS pos
  FROM node WHERE n = 1),
{_tree('top', 'subroot')},
lower AS ({_steps('leaf', 'node')}),
upper AS ({_steps('subroot', 'top')}),
step AS (
  SELECT lower.r, level, before, after FROM lower
  UNION ALL
  SELECT leaf.r, 1000 + level, before, after FROM upper JOIN leaf ON leaf.tree = upper.r),
path AS (
  SELECT r, string_agg(before || after, '' ORDER BY level) AS siblings,
         list([before, after] ORDER BY level) AS steps
  FROM step GROUP BY r),
folded AS (
  SELECT doc_id, leaf.node AS leaf, subroot.node AS subroot,
         (SELECT node FROM top WHERE n = 1) AS root,
         sha256(coalesce(siblings, '')) AS proof_sha256,
         list_reduce(list_prepend([coalesce(tampered, leaf.node), ''], coalesce(steps, [])),
           lambda a, s: [sha256(s[1] || a[1] || s[2]), ''])[1] AS folded_root
  FROM leaf JOIN subroot ON subroot.of = leaf.tree LEFT JOIN path ON path.r = leaf.r)
SELECT *, folded_root = root AS verified FROM folded
"""

OP12 = f"""
WITH sized AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) + 16 AS BIGINT) AS size,
         CAST({_crc32("coalesce(text, '')")} AS BIGINT) AS text_crc32
  FROM documents),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32
                            ROWS UNBOUNDED PRECEDING) - size AS before,
         row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) AS place,
         sum(size) OVER () AS total
  FROM sized),
dealt AS (
  SELECT *, CAST(least((2 * before + size) * 40 // (2 * total), 39) AS INTEGER) AS shard
  FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       CAST(place - min(place) OVER (PARTITION BY shard) AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM dealt
"""

OP13 = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM scored WHERE same AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (
           PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM positive JOIN scored USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
       negative_score
FROM ranked WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": OP1, "op3_decontamination": OP3, "op5_quality_rules": OP5,
        "op11_merkle_manifest": OP11, "op12_sharding": OP12, "op13_hard_negatives": OP13,
    }
