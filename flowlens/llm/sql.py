"""DuckDB SQL of operators whose text is generated level by level."""

from __future__ import annotations

#: crc32 of the id as decimal text, unsigned.
CRC = ("xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), "
       "lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))")


def _digest(text: str) -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


def _tree(name: str, levels: int) -> str:
    """Levels 1 to ``levels`` over ``{name}0 (g, n, r, h)``; ``run`` holds a node's children."""
    return ", ".join(
        f"{name}{k + 1} AS (SELECT g, n, r // 16 AS r, list(h ORDER BY r) AS run, CASE WHEN n > {16 ** k} "
        f"THEN sha256(string_agg(h, '' ORDER BY r)) ELSE min(h) END AS h FROM {name}{k} GROUP BY g, n, r // 16)" for k in range(levels))


def manifest_sql(levels: int = 5, top: int = 3) -> str:
    """Manifest of up to 16^levels documents a source and 16^top sources."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes, last, proof = [], "p0", []
    ctes.append("p0 AS (SELECT l.doc_id, l.h AS leaf, coalesce(l.seen, l.h) AS f, l.g, l.n, l.r, s.h AS subroot, s.r AS tr, s.n AS tn "
                "FROM leaf l JOIN t0 s ON l.g = s.k)")
    steps = [("n", k, "g = x.g", "n", "r") for k in range(levels)] + [("t", k, "g = 0", "tn", "tr") for k in range(top)]
    for i, (tree, k, same, n, r) in enumerate(steps):
        at = f"(x.{r} // {16 ** k}) % 16"
        ctes.append(
            f"p{i + 1} AS (SELECT x.* EXCLUDE (f), CASE WHEN x.{n} > {16 ** k} THEN array_to_string(y.run[1:{at}], '') ELSE '' END AS a{i}, "
            f"CASE WHEN x.{n} > {16 ** k} THEN array_to_string(y.run[{at} + 2:], '') ELSE '' END AS b{i}, "
            f"CASE WHEN x.{n} > {16 ** k} THEN sha256(array_to_string(y.run[1:{at}], '') || x.f || array_to_string(y.run[{at} + 2:], '')) ELSE x.f END AS f "
            f"FROM {last} x JOIN {tree}{k + 1} y ON y.{same} AND y.r = x.{r} // {16 ** (k + 1)})")
        last = f"p{i + 1}"
        proof += [f"a{i}", f"b{i}"]
    return f"""
WITH leaf AS (
  SELECT doc_id, h, seen, g, count(*) OVER (PARTITION BY g) AS n, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS r
  FROM (SELECT doc_id, {_digest('text')} AS h, CASE WHEN {CRC} % 5 = 0 THEN {_digest(lower)} END AS seen, dense_rank() OVER (ORDER BY source NULLS FIRST) AS g FROM documents)
), n0 AS (SELECT g, n, r, h FROM leaf), {_tree('n', levels)}
, t0 AS (SELECT 0 AS g, g AS k, count(*) OVER () AS n, g - 1 AS r, h FROM n{levels}), {_tree('t', top)}
, {', '.join(ctes)}
SELECT doc_id, leaf, subroot, t.h AS root, sha256({' || '.join(proof)}) AS proof_sha256, f AS folded_root, f = t.h AS verified
FROM {last} CROSS JOIN t{top} t
"""


JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : least(i + 2, len(w))], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM words WHERE len(w) > 0)
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT x, y FROM common JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)
), reach(x, y) AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y
), least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(l.y, w.doc_id)) AS component_id
FROM words w LEFT JOIN size USING (doc_id) LEFT JOIN least l ON l.x = w.doc_id
"""
