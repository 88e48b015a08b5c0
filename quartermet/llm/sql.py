"""DuckDB SQL of those registered queries that SQL can express."""

from __future__ import annotations

_FORM = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    columns = ["doc_id", "source", "lang", n_chars, "text"]
    return "sha256(" + " || ".join(_FORM.format(f"({c})") for c in columns) + ")"


#: Checksum of a short string, bit by bit.
_CRC32 = """xor(list_reduce(list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i, 1))::BIGINT),
    lambda c, b: list_reduce(range(8)::BIGINT[], lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)),
    4294967295::BIGINT), 4294967295)"""

MERKLE = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('1' || lang, '0') AS tree, {_leaf('n_chars')} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_CRC32.format('doc_id::VARCHAR')} % 7 = 0 THEN {_leaf('n_chars + 1')} END AS tampered
  FROM documents),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS n FROM leaves),
up(tree, level, pos, h, n) AS (
  SELECT tree, 0, pos, leaf, n FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
  FROM up WHERE n > 1 GROUP BY tree, level, pos // 2, n),
subroots AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
crown(level, pos, h, n) AS (
  SELECT 0, pos, h, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
  FROM crown WHERE n > 1 GROUP BY level, pos // 2, n),
below AS (
  SELECT p.tree, p.pos, 0 AS part, l.level, (p.pos >> l.level) & 1 AS odd, s.h AS sibling
  FROM placed p JOIN (SELECT DISTINCT tree, level FROM up WHERE n > 1) l ON l.tree = p.tree
  LEFT JOIN up s ON s.tree = p.tree AND s.level = l.level AND s.pos = xor(p.pos >> l.level, 1)),
above AS (
  SELECT r.tree, l.level, (r.pos >> l.level) & 1 AS odd, s.h AS sibling
  FROM subroots r CROSS JOIN (SELECT DISTINCT level FROM crown WHERE n > 1) l
  LEFT JOIN crown s ON s.level = l.level AND s.pos = xor(r.pos >> l.level, 1)),
steps AS (
  SELECT tree, pos, part, level, odd, sibling FROM below
  UNION ALL
  SELECT p.tree, p.pos, 1, a.level, a.odd, a.sibling FROM placed p JOIN above a ON a.tree = p.tree),
proofs AS (
  SELECT tree, pos, coalesce(string_agg(sibling, '' ORDER BY part, level), '') AS siblings,
    list(CASE WHEN sibling IS NULL THEN 'A' WHEN odd = 1 THEN 'L' || sibling ELSE 'R' || sibling END ORDER BY part, level) AS path
  FROM steps GROUP BY tree, pos),
folded AS (
  SELECT p.doc_id, p.leaf, r.h AS subroot, (SELECT h FROM crown WHERE n = 1) AS root, sha256(coalesce(q.siblings, '')) AS proof_sha256,
    list_reduce(coalesce(q.path, []::VARCHAR[]), lambda node, s: CASE left(s, 1)
      WHEN 'A' THEN sha256(node) WHEN 'L' THEN sha256(substr(s, 2) || node) ELSE sha256(node || substr(s, 2)) END,
      coalesce(p.tampered, p.leaf)) AS folded_root
  FROM placed p JOIN subroots r ON r.tree = p.tree LEFT JOIN proofs q ON q.tree = p.tree AND q.pos = p.pos)
SELECT *, folded_root = root AS verified FROM folded
"""
