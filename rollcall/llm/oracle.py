"""DuckDB SQL for results of the training-data operators that SQL can express."""

from __future__ import annotations

#: 3 divides the unsigned crc32 of the decimal doc_id, bit by bit
_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({x}, ''), lambda ch: ascii(ch)::BIGINT)),
               lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                        lambda r, z: xor(r >> 1, (r & 1) * 3988292384::BIGINT + z)))"""
_LOWER = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _field(x: str) -> str:
    return f"coalesce(octet_length(encode(CAST({x} AS VARCHAR)))::VARCHAR || ':' || CAST({x} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_leaf('text')} AS leaf,
         CASE WHEN xor({_CRC.format(x='CAST(doc_id AS VARCHAR)')}, 4294967295) % 3 = 0
              THEN {_leaf(_LOWER.format(x='text'))} END AS tampered
  FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id ASC NULLS FIRST, leaf) - 1 AS pos,
                  count(*) OVER (PARTITION BY lang) AS n FROM leaves),
up AS (
  SELECT 0 AS level, lang, pos, leaf AS node, n FROM placed
  UNION ALL
  SELECT level + 1, lang, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (n + 7) // 8
  FROM up WHERE n > 1 GROUP BY level, lang, pos // 8, n),
tops AS (SELECT lang, level AS depth, node AS subroot, row_number() OVER (ORDER BY encode(lang) ASC NULLS FIRST) - 1 AS pos,
                count(*) OVER () AS n FROM up WHERE n = 1),
over AS (
  SELECT 0 AS level, pos, subroot AS node, n FROM tops
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (n + 7) // 8 FROM over WHERE n > 1 GROUP BY level, pos // 8, n),
siblings AS (
  SELECT u.lang, u.level, u.pos,
         coalesce(string_agg(node, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(node, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM up u WHERE u.n > 1 WINDOW w AS (PARTITION BY u.lang, u.level, u.pos // 8 ORDER BY u.pos)),
over_siblings AS (
  SELECT level, pos, coalesce(string_agg(node, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(node, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM over WHERE n > 1 WINDOW w AS (PARTITION BY level, pos // 8 ORDER BY pos)),
steps AS (
  SELECT p.doc_id, p.lang, p.pos AS leaf_pos, s.level, s.before, s.after
  FROM placed p JOIN siblings s ON p.lang IS NOT DISTINCT FROM s.lang AND s.pos = p.pos // (8 ** s.level)::BIGINT
  UNION ALL
  SELECT p.doc_id, p.lang, p.pos, t.depth + s.level, s.before, s.after
  FROM placed p JOIN tops t ON p.lang IS NOT DISTINCT FROM t.lang
  JOIN over_siblings s ON s.pos = t.pos // (8 ** s.level)::BIGINT),
paths AS (SELECT lang, leaf_pos, list(before ORDER BY level) AS b, list(after ORDER BY level) AS a,
                 string_agg(before || after, '' ORDER BY level) AS proof FROM steps GROUP BY 1, 2),
full_rows AS (
  SELECT p.doc_id, p.leaf, t.subroot, (SELECT node FROM over WHERE n = 1) AS root, sha256(coalesce(x.proof, '')) AS proof_sha256,
         coalesce(list_reduce(list_prepend(coalesce(p.tampered, p.leaf), range(1, len(x.b) + 1)::VARCHAR[]),
                              lambda now, i: sha256(x.b[i::BIGINT] || now || x.a[i::BIGINT])), p.tampered, p.leaf) AS folded_root
  FROM placed p JOIN tops t ON p.lang IS NOT DISTINCT FROM t.lang
  LEFT JOIN paths x ON p.lang IS NOT DISTINCT FROM x.lang AND p.pos = x.leaf_pos)
SELECT *, folded_root = root AS verified FROM full_rows"""

SUBSTRINGS = r"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS pos, len(w) AS n FROM docs),
starts AS (SELECT rid, i AS pos, sha256(array_to_string(w[i + 1:i + 35], ' ')) AS h
           FROM docs, unnest(range(len(w) - 34)) u(i) WHERE len(w) >= 35),
again AS (SELECT rid, pos FROM starts QUALIFY count(*) OVER (PARTITION BY h) > 1),
covered AS (SELECT w.rid, w.word, w.pos,
                   max(CASE WHEN a.pos IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY w.rid ORDER BY w.pos ROWS 34 PRECEDING) AS gone
            FROM words w LEFT JOIN again a ON w.rid = a.rid AND w.pos = a.pos),
kept AS (SELECT rid, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (gone = 0) AS text FROM covered GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.rid = k.rid"""
