"""SQL equivalents of the corpus queries."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    text = _LOWER.format(f"coalesce({text}, '')")
    return rf"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


ORACLES["op1_benchmark_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_words("text")} AS w FROM documents),
b AS (SELECT item_id, {_words("text")} AS w FROM benchmark),
g AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
         array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i
        FROM b WHERE len(w) > 0)),
s AS (SELECT DISTINCT n FROM g),
x AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, s WHERE len(w) >= n)),
h AS (SELECT doc_id, x.n, i, item_id FROM x JOIN g ON x.n = g.n AND x.k = g.k),
c AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
m AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS id FROM h) GROUP BY doc_id)
SELECT d.doc_id, cast(len(w) AS BIGINT) AS n_words,
       cast(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       cast(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)
"""

ORACLES["op6_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i : i + 2], ' ') FOR i IN range(1, len(w) - 1)]) END AS s
  FROM w),
t AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
o AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS i
  FROM t a JOIN t b ON a.t = b.t AND a.doc_id < b.doc_id AND 100 * a.n >= 90 * b.n
    AND 100 * b.n >= 90 * a.n
  GROUP BY ALL),
e AS MATERIALIZED (
  SELECT a, b FROM o WHERE 100 * i >= 90 * (na + nb - i)
  UNION SELECT b, a FROM o WHERE 100 * i >= 90 * (na + nb - i)),
r AS (
  SELECT a AS v, b AS x FROM e
  UNION SELECT r.v, e.b FROM r JOIN e ON r.x = e.a)
SELECT s.doc_id, cast(len(s) AS BIGINT) AS n_shingles,
       least(s.doc_id, coalesce(m, s.doc_id)) AS component_id
FROM s LEFT JOIN (SELECT v, min(x) AS m FROM r GROUP BY v) ON v = s.doc_id
"""

ORACLES["op2_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, pos, trim(ls[pos + 1], ' ') AS line,
         len(regexp_extract_all(ls[pos + 1], '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, ls, unnest(range(len(ls))) AS pos
        FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents
              WHERE text IS NOT NULL))),
c AS (
  SELECT doc_id, pos, line, n, sum(n) OVER (PARTITION BY doc_id ORDER BY pos) AS e
  FROM l WHERE n > 0),
w AS (
  SELECT doc_id, min(pos) OVER f AS s, max(pos) OVER f AS t, sum(n) OVER f AS n,
         list(line) OVER f AS k
  FROM (SELECT *, e - n AS b FROM c)
  WINDOW f AS (PARTITION BY doc_id ORDER BY b RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION
  SELECT doc_id, min(pos) OVER f, max(pos) OVER f, sum(n) OVER f, list(line) OVER f
  FROM c
  WINDOW f AS (PARTITION BY doc_id ORDER BY e RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
r AS (
  SELECT doc_id, s, t,
         row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS i
  FROM w WHERE n >= 50),
x AS (SELECT DISTINCT doc_id, unnest(range(s, t + 1)) AS pos FROM r WHERE i > 1)
SELECT d.doc_id, CASE WHEN m IS NULL THEN text ELSE coalesce(kept, '') END AS text,
       cast(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines,
       cast(coalesce(m, 0) AS BIGINT) AS n_deleted
FROM documents d
LEFT JOIN (SELECT doc_id, count(*) AS m FROM x GROUP BY doc_id) USING (doc_id)
LEFT JOIN (
  SELECT doc_id, string_agg(part, chr(10) ORDER BY pos) AS kept
  FROM (SELECT doc_id, ls[pos + 1] AS part, pos
        FROM (SELECT doc_id, ls, unnest(range(len(ls))) AS pos
              FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)))
  ANTI JOIN x USING (doc_id, pos)
  GROUP BY doc_id) USING (doc_id)
"""

_CRC32 = (
    "xor(4294967295, list_reduce([4294967295] || list_transform("
    "string_split({0}, ''), lambda c: ascii(c)::BIGINT), lambda a, b: "
    "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], "
    "lambda v, z: xor(v >> 1, (v & 1) * 3988292384))))"
)


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    fields = ["doc_id", "source", "lang", n_chars, "text"]
    return f"sha256({' || '.join(map(_field, fields))})"


# Place 0 and up within a tree; tree 1 of each level-wise step is the tree of subroots.
_TREE = """
{name} AS (
  SELECT tree, 0 AS level, place, node, count(*) OVER (PARTITION BY tree) AS nodes FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)),
         (max(nodes) + 1) // 2
  FROM {name} WHERE nodes > 1 GROUP BY tree, level, place // 2)"""

ORACLES["op12_merkle_manifest"] = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
    CASE WHEN {_CRC32.format("doc_id::VARCHAR")} % 7 = 0
         THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS found
  FROM documents),
l AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, leaf AS node, found,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM d),
{_TREE.format(name="t", leaves="l").strip()},
r AS MATERIALIZED (
  SELECT tree AS name, '' AS tree, node, row_number() OVER (ORDER BY tree) - 1 AS place
  FROM t WHERE nodes = 1),
{_TREE.format(name="u", leaves="r").strip()},
s AS MATERIALIZED (
  SELECT l.doc_id, l.tree, l.place, o.level, o.place AS at, o.node FROM l JOIN t o
    ON l.tree = o.tree AND o.place = xor(l.place >> o.level::BIGINT, 1)
  UNION ALL
  SELECT l.doc_id, l.tree, l.place, 100 + o.level, o.place, o.node FROM l JOIN r ON l.tree = r.name
    JOIN u o ON o.place = xor(r.place >> o.level::BIGINT, 1)),
p AS (
  SELECT tree, place, string_agg(node, '' ORDER BY level) AS proof FROM s GROUP BY tree, place),
h AS (  -- levels up to the subroot, and from there to the root
  SELECT l.tree, l.place, (SELECT max(level) FROM t WHERE t.tree = l.tree) AS low,
         (SELECT max(level) FROM u) AS high, r.place AS upper, l.found
  FROM l JOIN r ON l.tree = r.name),
f AS (
  SELECT tree, place, 0 AS step, low, high, upper, found AS node FROM h
  UNION ALL
  SELECT f.tree, f.place, step + 1, low, high, upper,
    sha256(CASE WHEN s.node IS NULL THEN f.node WHEN s.at % 2 = 0 THEN s.node || f.node
           ELSE f.node || s.node END)
  FROM f LEFT JOIN s ON s.tree = f.tree AND s.place = f.place
    AND s.level = CASE WHEN step < low THEN step ELSE 100 + step - low END
  WHERE step < low + high)
SELECT l.doc_id, l.node AS leaf, r.node AS subroot, u.node AS root,
       sha256(coalesce(proof, '')) AS proof_sha256, f.node AS folded_root,
       f.node = u.node AS verified
FROM l JOIN r ON l.tree = r.name JOIN u ON u.nodes = 1
LEFT JOIN p ON p.tree = l.tree AND p.place = l.place
JOIN f ON f.tree = l.tree AND f.place = l.place AND f.step = f.low + f.high
"""

# Two hexadecimal digits stand for each byte.
ORACLES["op13_suffix_dedup"] = """
WITH d AS MATERIALIZED (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, length(hex(encode(coalesce(text, '')))) // 2 AS n
  FROM documents),
w AS MATERIALIZED (
  SELECT doc_id, i, md5_number(substr(x, 2 * i + 1, 100)) AS s
  FROM (SELECT doc_id, x, unnest(range(n - 49)) AS i FROM d WHERE n >= 50)),
m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
h AS MATERIALIZED (SELECT DISTINCT doc_id, i FROM w JOIN m USING (s) WHERE least < doc_id),
r AS (
  SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50
                               THEN 0 ELSE 1 END AS fresh FROM h)),
p AS MATERIALIZED (
  SELECT doc_id, min(i) AS low, max(i) + 50 AS high FROM r GROUP BY doc_id, run),
k AS (  -- what stays: before each run, and behind the last one
  SELECT d.doc_id, low,
    substr(x, 2 * coalesce(lag(high) OVER (PARTITION BY d.doc_id ORDER BY low), 0) + 1,
           2 * (low - coalesce(lag(high) OVER (PARTITION BY d.doc_id ORDER BY low), 0))) AS part
  FROM d JOIN p USING (doc_id)
  UNION ALL
  SELECT d.doc_id, d.n, substr(x, 2 * coalesce(high, 0) + 1)
  FROM d LEFT JOIN (SELECT doc_id, max(high) AS high FROM p GROUP BY doc_id) USING (doc_id)),
t AS (SELECT doc_id, string_agg(part, '' ORDER BY low) AS kept FROM k GROUP BY doc_id)
SELECT d.doc_id, n AS n_bytes, n - length(kept) // 2 AS n_removed,
       (SELECT count(*) FROM p WHERE p.doc_id = d.doc_id) AS n_spans,
       sha256(unhex(kept)) AS kept_sha256
FROM d JOIN t USING (doc_id)
"""
