"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import licenses

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all({_LOWER.format(f'coalesce({text}, {chr(39)}{chr(39)})')}, '{pattern}')"


_PLAIN = r"[a-z0-9\x{80}-\x{10FFFF}]+"
_SPACED = r"[^\x20\x09-\x0D]+"

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_words('text', _PLAIN)} AS w FROM documents),
items AS (SELECT item_id::VARCHAR AS item, {_words('text', _PLAIN)} AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item, w[i:i + 9] AS g FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len(g) AS n FROM grams),
places AS (SELECT doc_id, n, i, w[i:i + n - 1] AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item FROM places JOIN grams USING (g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words('text', _SPACED)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, list_aggregate(w[i:i + 3], 'string_agg', ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
near AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
links AS (SELECT a, b FROM near UNION SELECT b, a FROM near),
reach AS (SELECT a AS doc_id, a AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT doc_id, min(other) AS c FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c, d.doc_id)::BIGINT AS component_id, coalesce(c, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON least.doc_id = d.doc_id
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 20
"""

_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{0}", "text")) + ")"


def _levels(tree: str, leaves: str) -> str:
    """All nodes (g, lvl, pos, h) of the trees over ``leaves`` (g, pos, h); n nodes in a level."""
    return f"""{tree} AS (
  SELECT g, 0 AS lvl, pos, h, count(*) OVER (PARTITION BY g) AS n FROM {leaves}
  UNION ALL
  SELECT g, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM {tree} WHERE n > 1 GROUP BY g, lvl, pos // 2)"""


def _climb(name: str, tree: str, start: str) -> str:
    """From ``start`` (k, g, pos, h, proof) up ``tree``: the last step of each k has its top and the siblings on the way."""
    return f"""{name} AS (
  SELECT k, g, 0 AS lvl, pos, h, proof FROM {start}
  UNION ALL
  SELECT c.k, c.g, c.lvl + 1, c.pos // 2, sha256(CASE WHEN s.h IS NULL THEN c.h WHEN c.pos % 2 = 1 THEN s.h || c.h ELSE c.h || s.h END), c.proof || coalesce(s.h, '')
  FROM {name} c JOIN {tree} o ON o.g = c.g AND o.lvl = c.lvl AND o.pos = c.pos AND o.n > 1 LEFT JOIN {tree} s ON s.g = c.g AND s.lvl = c.lvl AND s.pos = xor(c.pos, 1))"""


MERKLE = f"""
WITH RECURSIVE bits AS (
  SELECT s, 0 AS step, 4294967295::BIGINT AS c FROM (SELECT DISTINCT doc_id::VARCHAR AS s FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT s, step + 1, CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END
  FROM (SELECT s, step, CASE WHEN step % 8 = 0 THEN xor(c, ascii(substr(s, step // 8 + 1, 1))::BIGINT) ELSE c END AS x FROM bits WHERE step < 8 * len(s))),
changed AS (SELECT s FROM bits WHERE step = 8 * len(s) AND xor(c, 4294967295) % 7 = 0),
d AS (
  SELECT doc_id, coalesce('+' || lang, '') AS g, {_LEAF.format('n_chars')} AS leaf, {_LEAF.format('(n_chars::HUGEINT + 1)')} AS other, s IS NOT NULL AS tampered
  FROM documents LEFT JOIN changed ON s = doc_id::VARCHAR),
leaves AS (
  SELECT *, leaf AS h, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, row_number() OVER (ORDER BY g, doc_id NULLS FIRST, leaf) AS k FROM d),
{_levels('tree', 'leaves')},
subs AS (SELECT g AS own, '' AS g, h, row_number() OVER (ORDER BY g) - 1 AS pos FROM tree WHERE n = 1),
{_levels('upper', 'subs')},
start AS (SELECT k, g, pos, CASE WHEN tampered THEN other ELSE leaf END AS h, '' AS proof FROM leaves),
{_climb('low', 'tree', 'start')},
middle AS (SELECT k, '' AS g, subs.pos, arg_max(low.h, lvl) AS h, arg_max(proof, lvl) AS proof FROM low JOIN subs ON subs.own = low.g GROUP BY k, subs.pos),
{_climb('high', 'upper', 'middle')},
ends AS (SELECT k, arg_max(h, lvl) AS folded, sha256(arg_max(proof, lvl)) AS proof FROM high GROUP BY k),
root AS (SELECT h AS root FROM upper WHERE n = 1)
SELECT doc_id, leaf, subs.h AS subroot, root, proof AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM leaves JOIN subs ON subs.own = leaves.g JOIN ends USING (k), root
"""

PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(LOWERED, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents),
f AS (
  SELECT lang, w[i:i + k - 1] AS g, count(*) AS f FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 5) AS t(k) WHERE len(w) >= k) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len(g) = 1 GROUP BY lang),
c AS (SELECT lang, g, f AS a FROM f WHERE len(g) > 1 AND f >= 30),
inner_ AS (
  SELECT lang, g[s:s + m - 1] AS g, max(a) AS top FROM (SELECT lang, g, a, m, unnest(range(1, len(g) - m + 2)) AS s FROM c, range(2, 4) AS t(m) WHERE len(g) > m) GROUP BY ALL),
held AS (SELECT c.* FROM c LEFT JOIN inner_ i USING (lang, g) WHERE top IS NULL OR 100::HUGEINT * top < 80::HUGEINT * a),
cuts AS (SELECT lang, g, a, k, g[1:k] AS head, g[k + 1:] AS tail FROM (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM held)),
scored AS (
  SELECT c.lang, c.g, c.a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = head JOIN f y ON y.lang = c.lang AND y.g = tail),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
ranked AS (SELECT *, array_to_string(g, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
""".replace("LOWERED", _LOWER.format("coalesce(text, '')"))

ORACLE: dict[str, str] = {
    "op1_decontaminate": DECONTAMINATE,
    "op2_license_scan": licenses.oracle(),
    "op5_minhash_near_dedup": NEAR_DUPLICATES,
    "op6_exact_top_k": TOP_K,
    "op11_phrase_mining": PHRASES,
    "op12_merkle_manifest": MERKLE,
}
