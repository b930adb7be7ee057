"""The operators that SQL can express, as plain SQL over the given tables.

Written independently of the operators: every window, shingle and pair is taken as
text and compared in full. Meant for small tables only.
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM items WHERE len(w) > 0)),
places AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM docs, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n)),
hits AS (SELECT doc_id, s, n, item_id FROM places JOIN wins USING (n, win)),
hit_words AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""

WARC = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
sized AS (
  SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
         CASE WHEN strlen(payload) >= 1000 THEN max(page_id) OVER (PARTITION BY payload) ELSE page_id END AS response
  FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM sized"""

MINHASH = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    ELSE list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
                                                lambda s: array_to_string(w[s:s + 4], ' ')))) END AS found
  FROM docs),
classes AS (SELECT found, min(doc_id) AS class, len(found) AS size FROM sets WHERE len(found) > 0 GROUP BY found),
members AS (SELECT class, size, unnest(found) AS shingle FROM classes),
links AS (
  SELECT a.class AS a, b.class AS b
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.class <> b.class
  GROUP BY a.class, b.class, a.size, b.size
  HAVING 100 * count(*) >= 75 * (a.size + b.size - count(*))),
reach(a, b) AS (SELECT class, class FROM classes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
parts AS (SELECT a AS class, min(b) AS root FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s.found) AS BIGINT) AS n_shingles, coalesce(root, doc_id) AS component_id,
       coalesce(root, doc_id) = doc_id AS kept
FROM sets s LEFT JOIN classes c ON s.found = c.found LEFT JOIN parts USING (class)"""



SUFFIXES = """
WITH docs AS (
  SELECT row_number() OVER () AS i, doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
chunks AS (SELECT i, doc_id, n, unnest(range(0, n - 49, 500)) AS c, h FROM docs),
parts AS (SELECT i, doc_id, c, least(c + 500, n - 49) AS stop, substr(h, c * 2 + 1, 1098) AS part FROM chunks),
places AS (SELECT i, doc_id, c, part, unnest(range(c, stop)) AS s FROM parts),
windows AS (SELECT i, doc_id, s, substr(part, (s - c) * 2 + 1, 100) AS w FROM places),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT i, s FROM windows JOIN firsts USING (w) WHERE first < doc_id),
begun AS (SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY i ORDER BY s) + 50 THEN 0 ELSE 1 END AS new FROM hits),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY i ORDER BY s) AS run FROM begun),
runs AS (SELECT i, run, min(s) AS a, max(s) + 50 AS b FROM numbered GROUP BY i, run),
gaps AS (SELECT *, lag(b, 1, 0) OVER (PARTITION BY i ORDER BY a) AS before FROM runs),
cut AS (
  SELECT i, sum(b - a) AS removed, count(*) AS spans, max(b) AS last,
         string_agg(substr(h, before * 2 + 1, (a - before) * 2), '' ORDER BY a) AS kept
  FROM gaps JOIN docs USING (i) GROUP BY i)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, coalesce(last, 0) * 2 + 1))) AS kept_sha256
FROM docs LEFT JOIN cut USING (i)"""

#: Levels that the SQL of the Merkle manifest has for each tree: up to 16^4 leaves.
_LEVELS = 4


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _tree(name: str, leaves: str) -> str:
    """CTEs for the trees over ``leaves`` (tree, pos, n, digest): levels and paths from the root down."""
    steps = [f"{name}0 AS ({leaves})"]
    for level in range(_LEVELS):
        steps.append(f"""{name}{level + 1} AS (
  SELECT tree, pos // 16 AS pos, (any_value(n) + 15) // 16 AS n,
         CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
  FROM {name}{level} GROUP BY tree, pos // 16)""")
    steps.append(f"""{name}_path{_LEVELS} AS (
  SELECT tree, pos, digest AS root, CAST([] AS STRUCT(l VARCHAR, r VARCHAR)[]) AS path FROM {name}{_LEVELS})""")
    for level in reversed(range(_LEVELS)):
        steps.append(f"""{name}_path{level} AS (
  SELECT a.tree, a.pos, up.root, CASE WHEN any_value(a.n) = 1 THEN up.path ELSE list_prepend({{
           'l': coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), ''),
           'r': coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '')}}, up.path) END AS path
  FROM {name}{level} a JOIN {name}{level} b ON a.tree = b.tree AND a.pos // 16 = b.pos // 16
  JOIN {name}_path{level + 1} up ON up.tree = a.tree AND up.pos = a.pos // 16
  GROUP BY a.tree, a.pos, up.root, up.path)""")
    return ",\n".join(steps)


_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"

MERKLE = f"""
WITH crcs AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, b: {_CRC_STEP})) AS t),
docs AS (
  SELECT *, coalesce('=' || source, '') AS tree,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                         lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8)), 4294967295) AS crc
  FROM documents, crcs),
hashed AS (
  SELECT doc_id, tree, {_leaf('text')} AS leaf,
         CASE WHEN crc % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
              ELSE {_leaf('text')} END AS start
  FROM docs),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n FROM hashed),
{_tree('low', 'SELECT tree, pos, n, leaf AS digest FROM leaves')},
{_tree('top', f"SELECT '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n, digest, tree AS source FROM low{_LEVELS}")},
proofs AS (
  SELECT doc_id, leaf, low.root AS subroot, up.root AS root, list_concat(low.path, up.path) AS path, start
  FROM leaves JOIN low_path0 low USING (tree, pos)
  JOIN top0 ON top0.source = leaves.tree JOIN top_path0 up ON up.pos = top0.pos),
folded AS (
  SELECT *, list_reduce(list_prepend(start, list_transform(path, lambda s: s.l || '|' || s.r)),
                        lambda c, s: sha256(split_part(s, '|', 1) || c || split_part(s, '|', 2))) AS folded_root
  FROM proofs)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s.l || s.r), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontamination": DECONTAMINATION,
        "op3_warc": WARC,
        "op5_suffixes": SUFFIXES,
        "op6_minhash": MINHASH,
        "op12_merkle": MERKLE,
    }
