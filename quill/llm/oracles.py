"""DuckDB SQL for the operators that SQL can express, written from their definitions."""

from __future__ import annotations

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UP}', '{_LOW}')"


def _item_words(text: str) -> str:
    return rf"regexp_extract_all({_lower(text)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


OP11 = f"""
WITH item AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_item_words('text')} AS w FROM benchmark),
windows AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM (
  SELECT item, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, {_item_words('text')} AS w FROM documents),
places AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win FROM (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
met AS (SELECT doc_id, k, i, item FROM places JOIN windows USING (k, win)),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT doc_id, i, k FROM met)) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (
  SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
SELECT doc.doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def crc32(text: str) -> str:
    """CRC-32 of an ASCII string, a bit at a time (-1 marks a shift)."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) "
            f"WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384::BIGINT) ELSE s >> 1 END), 4294967295::BIGINT)")


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR) END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, levels: int) -> str:
    """Levels above ``{name}0`` (tree, idx, width, node); trees of one node pass through."""
    return "".join(f"""
{name}r{i} AS (SELECT tree, idx // 16 AS parent, max(width) AS width, list(node ORDER BY idx) AS run FROM {name}{i} WHERE width > 1 GROUP BY tree, idx // 16),
{name}{i + 1} AS (SELECT tree, parent AS idx, (width + 15) // 16 AS width, sha256(array_to_string(run, '')) AS node FROM {name}r{i}
  UNION ALL SELECT tree, idx, width, node FROM {name}{i} WHERE width = 1),""" for i in range(levels))


def _walk(name: str, start: str, levels: int) -> str:
    """Every row of ``start`` (tree, idx, proof, folded) taken up through those levels."""
    out, at = "", start
    for i in range(levels):
        left, right = "array_to_string(run[1:w.idx % 16], '')", "array_to_string(run[w.idx % 16 + 2:], '')"
        out += f"""
{name}w{i} AS (SELECT w.* EXCLUDE (idx, proof, folded), CASE WHEN run IS NULL THEN w.idx ELSE w.idx // 16 END AS idx,
  CASE WHEN run IS NULL THEN proof ELSE proof || {left} || {right} END AS proof,
  CASE WHEN run IS NULL THEN folded ELSE sha256({left} || folded || {right}) END AS folded
  FROM {at} w LEFT JOIN {name}r{i} r ON r.tree = w.tree AND r.parent = w.idx // 16),"""
        at = f"{name}w{i}"
    return out


#: Four levels hold 65,536 rows a source, three hold 4,096 sources.
OP13 = f"""
WITH base AS (SELECT doc_id, source, {_leaf('text')} AS leaf,
  CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {_leaf(_lower('text'))} END AS other FROM documents),
placed AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS width,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM base),
f0 AS (SELECT tree, idx, width, leaf AS node FROM placed),{_tree('f', 4)}
c0 AS (SELECT 0 AS tree, tree AS idx, count(*) OVER () AS width, node FROM f4),{_tree('c', 3)}
start AS (SELECT doc_id, leaf, tree, idx, '' AS proof, coalesce(other, leaf) AS folded FROM placed),{_walk('f', 'start', 4)}
middle AS (SELECT doc_id, leaf, f4.node AS subroot, 0 AS tree, fw3.tree AS idx, proof, folded FROM fw3 JOIN f4 ON f4.tree = fw3.tree),{_walk('c', 'middle', 3)}
top AS (SELECT node AS root FROM c3)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM cw2, top
"""

#: Pairs that share a shingle, then everything reachable by links.
OP2 = rf"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all({_lower('text')}, '[^\x20\x09-\x0D]+') AS w FROM documents),
gram AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM met JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM doc LEFT JOIN size USING (doc_id) JOIN lowest ON lowest.a = doc.doc_id
"""

OP3 = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
many AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT v.vec_id, coalesce(n_links, 0) AS n_links, component_id, v.vec_id = component_id AS kept FROM v JOIN least USING (vec_id) LEFT JOIN many USING (vec_id)
"""

OP9 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to FROM d
"""

SQL = {"op2_ngram_jaccard_join": OP2, "op3_embedding_dedup": OP3, "op9_warc_zip": OP9, "op11_wu_manber": OP11, "op13_merkle_manifest": OP13}
