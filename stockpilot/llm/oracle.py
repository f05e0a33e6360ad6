"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

# The white space of the contracts.
WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
LOWER = "'abcdefghijklmnopqrstuvwxyz'"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, u.pos, u.line, translate(trim(u.line, {WS}), {UPPER}, {LOWER}) AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) d,
       LATERAL (SELECT unnest(d.parts) AS line, generate_subscripts(d.parts, 1) AS pos) u
), shared AS (
  SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT l.doc_id, l.pos, l.line, s.key IS NOT NULL AND s.owner <> l.doc_id AS gone
  FROM lines l LEFT JOIN shared s ON l.key = s.key AND length(l.key) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

EXACT_DEDUP = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS body
  FROM documents
), g AS (
  SELECT body, count(*) AS n, arg_min(doc_id, (-chars, doc_id)) AS keep_id FROM d GROUP BY body
)
SELECT d.doc_id, g.keep_id, g.n AS group_size, d.doc_id = g.keep_id AS kept, sha256(d.body) AS text_sha256
FROM d JOIN g ON d.body = g.body
"""

# Levels of the tree that the SQL spells out: 3 ** 16 rows in a group.
LEVELS = 16


def _leaf(text: str) -> str:
    fields = ["d.doc_id", "source", "lang", "n_chars", text]
    parts = [f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')" for v in fields]
    return f"sha256({' || '.join(parts)})"


def _tree(name: str, leaves: str) -> str:
    """Tables ``name``_0.. of the nodes of each level (g, i, digest, n nodes of the
    group, and the digests to the left and right of it in its run)."""
    run = "PARTITION BY g, i // 3 ORDER BY i ROWS BETWEEN"
    tables = []
    for level in range(LEVELS + 1):
        nodes = leaves if level == 0 else (
            f"SELECT g, i // 3 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY i)) ELSE any_value(digest) END AS digest"
            f" FROM {name}_{level - 1} GROUP BY g, i // 3"
        )
        tables.append(
            f"""{name}_{level} AS (SELECT g, i, digest, count(*) OVER (PARTITION BY g) AS n,
  coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
FROM ({nodes}))"""
        )
    return ",\n".join(tables)


def _climb(name: str, tree: str, start: str) -> str:
    """Tables ``name``_0.. with the proof so far and the digest folded so far, the
    place of a row being (g, i)."""
    tables = [f"{name}_0 AS ({start})"]
    for level in range(LEVELS):
        tables.append(
            f"""{name}_{level + 1} AS (SELECT c.* EXCLUDE (i, proof, folded), c.i // 3 AS i, c.proof || t.l || t.r AS proof,
  CASE WHEN t.n > 1 THEN sha256(t.l || c.folded || t.r) ELSE c.folded END AS folded
FROM {name}_{level} c JOIN {tree}_{level} t ON c.g = t.g AND c.i = t.i)"""
        )
    return ",\n".join(tables)


# CRC-32 (polynomial 0xEDB88320, reflected), a bit at a time.
MERKLE_MANIFEST = f"""
WITH RECURSIVE crc(doc_id, s, step, acc) AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM documents
  UNION ALL
  SELECT doc_id, s, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS BIGINT)) ELSE v >> 1 END
  FROM (SELECT doc_id, s, step, CASE WHEN step % 8 = 0 THEN xor(acc, CAST(ascii(s[step // 8 + 1]) AS BIGINT)) ELSE acc END AS v
        FROM crc WHERE step < 8 * length(s))
), broken AS (
  SELECT doc_id, bool_and(xor(acc, CAST(4294967295 AS BIGINT)) % 2 = 0) AS broken FROM crc WHERE step = 8 * length(s) GROUP BY doc_id
), leaves AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS i, digest, read
  FROM (SELECT d.doc_id AS doc_id, source, {_leaf("text")} AS digest,
               CASE WHEN broken THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS read
        FROM documents d LEFT JOIN broken b ON d.doc_id = b.doc_id)
), {_tree("a", "SELECT g, i, digest FROM leaves")},
{_tree("b", f"SELECT 0 AS g, g AS i, digest FROM a_{LEVELS}")},
{_climb("up", "a", "SELECT doc_id, digest AS leaf, g, i, '' AS proof, read AS folded FROM leaves")},
{_climb("top", "b", f"SELECT doc_id, leaf, t.digest AS subroot, 0 AS g, u.g AS i, proof, folded FROM up_{LEVELS} u JOIN a_{LEVELS} t ON u.g = t.g")}
SELECT c.doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.digest AS verified
FROM top_{LEVELS} c JOIN b_{LEVELS} t ON c.g = t.g
"""

SQL: dict[str, str] = {"op1_line_dedup": LINE_DEDUP, "op10_exact_dedup": EXACT_DEDUP, "op13_merkle_manifest": MERKLE_MANIFEST}
