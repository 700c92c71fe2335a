"""Check SQL for DuckDB, where SQL can say what an operator returns."""

REPEATS = """WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, encode(coalesce(text, '')) AS t, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, p, array_slice(t, p + 1, p + 50) AS s FROM (
  SELECT doc_id, t, unnest(range(0, greatest(n - 49, 0))) AS p FROM d)),
f AS (SELECT s, min(doc_id) AS m FROM w GROUP BY s),
g AS (SELECT w.doc_id, p, p + 50 AS e FROM w JOIN f ON w.s = f.s AND f.m < w.doc_id),
o AS (SELECT *, max(e) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM g),
r AS (SELECT *, sum(CASE WHEN before IS NULL OR p > before THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM o),
x AS (SELECT doc_id, min(p) AS a, max(e) AS b FROM r GROUP BY doc_id, k),
y AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM x GROUP BY doc_id),
z AS (SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS s0, a AS s1 FROM x
  UNION ALL SELECT doc_id, max(b), NULL FROM x GROUP BY doc_id),
q AS (SELECT z.doc_id, string_agg(substr(h, 2 * s0 + 1, 2 * (coalesce(s1, n) - s0)), '' ORDER BY s0) AS kept
  FROM z JOIN d ON z.doc_id = d.doc_id GROUP BY z.doc_id)
SELECT d.doc_id, cast(n AS bigint) AS n_bytes, cast(coalesce(n_removed, 0) AS bigint) AS n_removed,
  cast(coalesce(n_spans, 0) AS bigint) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN y ON d.doc_id = y.doc_id LEFT JOIN q ON d.doc_id = q.doc_id"""

VECTORS = """WITH RECURSIVE v AS (
  SELECT vec_id, label, cast(embedding AS double[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT c.a AS vec_id, cast(coalesce(n.n, 0) AS bigint) AS n_links, component_id, c.a = component_id AS kept
FROM c LEFT JOIN n ON c.a = n.a"""

_DIGEST_OF = "coalesce(octet_length(encode({0})) || ':' || {0}, '-')"
# CRC-32 bit by bit over the digits of the id; the inverted last bit tells odd from even.
_EVEN = """(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda ch: ascii(ch)::bigint)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
  lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::bigint) ELSE x >> 1 END)) & 1) = 1"""


def _leaf(text: str) -> str:
    fields = ["cast(doc_id as varchar)", "source", "lang", "cast(n_chars as varchar)", text]
    return f"sha256({' || '.join(_DIGEST_OF.format(f) for f in fields)})"


def _tree(name: str, start: str) -> str:
    """All nodes (t, level, i, h, n) above the nodes of ``start``."""
    return f"""{name} AS ({start} UNION ALL
  SELECT t, level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 2) // 3
  FROM {name} WHERE n > 1 GROUP BY t, level, i // 3)"""


def _step(steps: str, nodes: str, start: str) -> str:
    """Walks (row r, tree t, place i, proof p, digest f) from ``start`` up to the tree's last node."""
    return f"""{steps} AS ({start} UNION ALL
  SELECT s.r, s.t, any_value(s.level) + 1, s.i // 3, any_value(s.p) || coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i <> s.i), ''),
  sha256(string_agg(CASE WHEN b.i = s.i THEN s.f ELSE b.h END, '' ORDER BY b.i)), (any_value(s.n) + 2) // 3
  FROM {steps} s JOIN {nodes} b ON b.t = s.t AND b.level = s.level AND b.i // 3 = s.i // 3
  WHERE s.n > 1 GROUP BY s.r, s.t, s.i)"""


MANIFEST = f"""WITH RECURSIVE leaves AS (
  SELECT *, CASE WHEN {_EVEN} THEN {_leaf("replace(text, chr(10), '')")} ELSE leaf END AS now,
  row_number() OVER (ORDER BY t, doc_id NULLS FIRST, leaf) AS r,
  row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY t) AS n
  FROM (SELECT *, {_leaf('text')} AS leaf, coalesce('s' || source, '-') AS t FROM documents)),
{_tree("own", "SELECT t, 0 AS level, i, leaf AS h, n FROM leaves")},
subroots AS (SELECT t AS name, h, row_number() OVER (ORDER BY encode(t)) - 1 AS i, count(*) OVER () AS n FROM own WHERE n = 1),
{_tree("roof", "SELECT '' AS t, 0 AS level, i, h, n FROM subroots")},
{_step("low", "own", "SELECT r, t, 0 AS level, i, '' AS p, now AS f, n FROM leaves")},
{_step("high", "roof", "SELECT r, '' AS t, 0 AS level, q.i AS i, p, f, q.n AS n FROM low JOIN subroots q ON q.name = low.t WHERE low.n = 1")}
SELECT doc_id, leaf, q.h AS subroot, (SELECT h FROM roof WHERE n = 1) AS root, sha256(p) AS proof_sha256, f AS folded_root,
  f = (SELECT h FROM roof WHERE n = 1) AS verified
FROM leaves JOIN high ON high.r = leaves.r AND high.n = 1 JOIN subroots q ON q.name = leaves.t"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

WINNOWING = f"""WITH b AS (SELECT cast(item_id as varchar) AS item_id, w, least(len(w), 10) AS m FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, m, array_to_string(w[p:p + m - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS p FROM b)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT r, m, p, array_to_string(w[p:p + m - 1], ' ') AS s FROM (
  SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, (SELECT DISTINCT m FROM b) WHERE len(w) >= m)),
x AS (SELECT r, dw.m AS m, p, item_id FROM dw JOIN bw ON dw.s = bw.s AND dw.m = bw.m),
h AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(p, p + m)) AS k FROM x) GROUP BY r),
i AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM x GROUP BY r)
SELECT doc_id, cast(len(w) as bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.r = h.r LEFT JOIN i ON d.r = i.r"""

AUDIT = r"""WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY text) AS first FROM t),
m AS (SELECT doc_id, part, (len(w) < 100)::int + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::int
  + 4 * (100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text))::int + 8 * regexp_matches(text, '[#$%&*|]')::int
  + 16 * coalesce(doc_id > first, false)::int AS mask FROM w),
l AS (SELECT doc_id, max((quality = 1)::int) AS good, max((toxic = 1)::int) AS toxic FROM labels GROUP BY 1),
c AS (SELECT part, mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n FROM m LEFT JOIN l ON m.doc_id = l.doc_id GROUP BY ALL),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(x, bit)),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, cast(step as int) AS step, bit AS own, x AS letter,
  (SELECT coalesce(sum(g.bit), 0) FROM f g WHERE strpos(filter_order, g.x) < step)::int AS earlier
  FROM o, range(1, 6) AS r(step), f WHERE f.x = substr(filter_order, step, 1)),
z AS (SELECT part, filter_order, step, letter,
  sum(CASE WHEN mask & (own | earlier) = 0 THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN mask & own > 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN mask & own > 0 AND mask & earlier > 0 THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN mask & own > 0 AND mask & earlier = 0 AND good = 1 THEN n ELSE 0 END) AS good_lost,
  sum(CASE WHEN mask & own > 0 AND mask & earlier = 0 AND toxic = 1 THEN n ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, cast(kept as bigint) AS kept, cast(removed as bigint) AS removed, cast(redundant as bigint) AS redundant,
  cast(unique_fails as bigint) AS unique_fails, cast(good_lost as bigint) AS good_lost, cast(toxic_lost as bigint) AS toxic_lost,
  cast(sum(removed) OVER (PARTITION BY part, letter) as bigint) AS shapley FROM z"""
