"""DuckDB SQL for the queries of this subpackage that SQL can express."""

OP11 = r"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists WHERE len(w) > 0),
f1 AS (SELECT lang, w[i] AS p, count(*) AS f FROM words GROUP BY ALL),
f2 AS (SELECT lang, w[i] AS p1, w[i + 1] AS p2, count(*) AS f FROM words WHERE i + 1 <= len(w) GROUP BY ALL),
f3 AS (SELECT lang, w[i] AS p1, w[i + 1] AS p2, w[i + 2] AS p3, count(*) AS f FROM words WHERE i + 2 <= len(w) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
around AS (SELECT lang, p1, p2, max(f) AS longer FROM
  (SELECT lang, p1, p2, f FROM f3 WHERE f >= 10 UNION ALL SELECT lang, p2, p3, f FROM f3 WHERE f >= 10) GROUP BY ALL),
cuts AS (
  SELECT f2.lang, f2.p1 || ' ' || f2.p2 AS phrase, f2.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.p = f2.p1 JOIN f1 y ON y.lang = f2.lang AND y.p = f2.p2
  LEFT JOIN around ON around.lang = f2.lang AND around.p1 = f2.p1 AND around.p2 = f2.p2 WHERE f2.f >= 10 AND (longer IS NULL OR 100 * longer < 50 * f2.f)
  UNION ALL
  SELECT f3.lang, f3.p1 || ' ' || f3.p2 || ' ' || f3.p3, f3.f, 1, x.f, y.f
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.p = f3.p1 JOIN f2 y ON y.lang = f3.lang AND y.p1 = f3.p2 AND y.p2 = f3.p3 WHERE f3.f >= 10
  UNION ALL
  SELECT f3.lang, f3.p1 || ' ' || f3.p2 || ' ' || f3.p3, f3.f, 2, x.f, y.f
  FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.p1 = f3.p1 AND x.p2 = f3.p2 JOIN f1 y ON y.lang = f3.lang AND y.p = f3.p3 WHERE f3.f >= 10),
scored AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least)
SELECT lang, rank, phrase, a, l, r, n.n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

_FIELD = "coalesce(strlen({0})::VARCHAR || ':' || {0}, '-')"


def _leaf(n_chars: str) -> str:
    parts = ["doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text"]
    return "sha256(" + " || ".join(_FIELD.format(p) for p in parts) + ")"


#: crc32 by bits: the register goes over the bytes of the decimal id, then over eight bits each.
_CRC = """list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda q: 0::UBIGINT)),
    lambda v, q: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END))"""

OP12 = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS pos, {_leaf("n_chars")} AS leaf,
         CASE WHEN xor({_CRC}, 4294967295::UBIGINT) % 7 = 0 THEN {_leaf("n_chars::HUGEINT + 1")} END AS forged
  FROM documents),
up AS (
  SELECT lang, 0 AS lvl, pos, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM leaves
  UNION ALL
  SELECT lang, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 1) // 2 FROM up WHERE n > 1 GROUP BY lang, lvl, pos // 2),
base AS MATERIALIZED (SELECT * FROM up),
sub AS MATERIALIZED (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM base WHERE n = 1),
top AS (
  SELECT 0 AS lvl, pos, h, n FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 1) // 2 FROM top WHERE n > 1 GROUP BY lvl, pos // 2),
crown AS MATERIALIZED (SELECT * FROM top),
way AS (
  SELECT leaves.doc_id, leaves.leaf, b.lvl, (leaves.pos >> b.lvl) & 1 AS side, s.h AS sib
  FROM leaves JOIN (SELECT DISTINCT lang, lvl FROM base WHERE n > 1) b ON b.lang IS NOT DISTINCT FROM leaves.lang
  LEFT JOIN base s ON s.lang IS NOT DISTINCT FROM leaves.lang AND s.lvl = b.lvl AND s.pos = xor(leaves.pos >> b.lvl, 1)
  UNION ALL
  SELECT leaves.doc_id, leaves.leaf, 1000 + c.lvl, (sub.pos >> c.lvl) & 1, s.h
  FROM leaves JOIN sub ON sub.lang IS NOT DISTINCT FROM leaves.lang, (SELECT DISTINCT lvl FROM crown WHERE n > 1) c
  LEFT JOIN crown s ON s.lvl = c.lvl AND s.pos = xor(sub.pos >> c.lvl, 1)),
ways AS MATERIALIZED (
  SELECT doc_id, leaf, list(side ORDER BY lvl) AS sides, list(sib ORDER BY lvl) AS sibs, coalesce(string_agg(sib, '' ORDER BY lvl), '') AS proof FROM way GROUP BY doc_id, leaf),
fold AS (
  SELECT l.doc_id, l.leaf, 0 AS step, coalesce(l.forged, l.leaf) AS h FROM leaves l
  UNION ALL
  SELECT f.doc_id, f.leaf, step + 1, sha256(CASE WHEN w.sibs[step + 1] IS NULL THEN f.h WHEN w.sides[step + 1] = 1 THEN w.sibs[step + 1] || f.h ELSE f.h || w.sibs[step + 1] END)
  FROM fold f JOIN ways w ON w.doc_id = f.doc_id AND w.leaf = f.leaf WHERE step < len(w.sibs))
SELECT l.doc_id, l.leaf, sub.h AS subroot, root.h AS root, sha256(coalesce(w.proof, '')) AS proof_sha256, f.h AS folded_root,
       CASE WHEN l.forged IS NOT NULL THEN coalesce(len(w.sibs), 0)::INTEGER END AS copied_nodes, f.h = root.h AS verified
FROM leaves l JOIN sub ON sub.lang IS NOT DISTINCT FROM l.lang CROSS JOIN (SELECT h FROM crown WHERE n = 1) root
LEFT JOIN ways w ON w.doc_id = l.doc_id AND w.leaf = l.leaf
JOIN (SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY doc_id, leaf ORDER BY step DESC) = 1) f ON f.doc_id = l.doc_id AND f.leaf = l.leaf
"""

ORACLES: dict[str, str] = {"op11_phrases": OP11, "op12_merkle_manifest": OP12}
