"""The queries that SQL can express, as DuckDB SQL over the same tables."""

from __future__ import annotations

from lodestay.llm.quality import LineRules
from lodestay.llm.vector_codes import CodeSpec

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"'[^\x20\x09-\x0D]+'"
_NORMAL = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _texts(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


PASSAGES = rf"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS words FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(words) - 48)) AS i, words FROM d),
v AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS win FROM w),
f AS (SELECT doc_id, i, MIN(doc_id) OVER (PARTITION BY win) AS first FROM v),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM f WHERE first < doc_id),
u AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
k AS (SELECT u.doc_id, COUNT(gone.i) AS n_removed, string_agg(word, ' ' ORDER BY u.i) FILTER (WHERE gone.i IS NULL) AS kept
  FROM u LEFT JOIN gone ON u.doc_id = gone.doc_id AND u.i = gone.i GROUP BY u.doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON d.doc_id = k.doc_id"""


def quality(rules: LineRules = LineRules()) -> str:
    ends = _texts(x.decode() for x in rules.ends)
    separators = _texts(sorted(x.decode() for x in rules.separators))
    phrases = " OR ".join(f"contains(lower(line), {_texts([p.decode()])})" for p in rules.phrases)
    return rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS words FROM documents),
v AS (SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM d),
x AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS win FROM v),
w AS (SELECT doc_id, list(i) AS places FROM x GROUP BY doc_id, win HAVING COUNT(*) > 1),
y AS (SELECT doc_id, unnest(places) AS i FROM w),
r AS (SELECT doc_id, COUNT(DISTINCT i + k) AS n_repeat_words FROM y, (SELECT unnest(range(5)) AS k) GROUP BY doc_id),
split AS (SELECT doc_id, string_split(text, chr(10)) AS all_lines FROM d),
l AS (SELECT doc_id, unnest(all_lines) AS line, unnest(range(len(all_lines))) AS place FROM split),
m AS (SELECT doc_id, line, regexp_extract_all(line, {_WORD}) AS lw,
  ROW_NUMBER() OVER (PARTITION BY doc_id, line ORDER BY place) > 1 AS repeated FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
j AS (SELECT doc_id, repeated, len(lw) AS n,
  len(list_filter(lw, lambda x: x IN ({separators}))) AS n_separators,
  length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  len(list_filter(lw, lambda x: right(x, 1) IN ({ends}))) AS n_ends,
  regexp_matches(line, '[A-Za-z]|[^\x00-\x7F]') AS has_letter, ({phrases}) AS has_phrase FROM m),
b AS (SELECT doc_id, CAST(COUNT(*) FILTER (WHERE repeated) AS BIGINT) AS n_dup_lines,
  coalesce(SUM(n) FILTER (WHERE repeated OR (n_separators >= {rules.min_separators} AND n_separators >= {rules.separator_share} * n)
    OR n_symbols >= {rules.symbols_per_word} * n OR (n >= {rules.long_line} AND n_ends = 0) OR NOT has_letter
    OR (n <= {rules.boilerplate_words} AND has_phrase)), 0) AS removed FROM j GROUP BY doc_id),
e AS (SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(removed, 0) AS removed
  FROM d LEFT JOIN r ON d.doc_id = r.doc_id LEFT JOIN b ON d.doc_id = b.doc_id)
SELECT * EXCLUDE removed, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND removed <= {rules.max_removed} * n_words AS kept FROM e"""


def url_rules(rules, default: str) -> str:
    listed = ", ".join(f"({_texts([r.host, r.path, r.verdict])})" for r in rules)
    return rf"""WITH rules(h, p, v) AS (VALUES {listed}),
u AS (SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '') AS raw_host,
  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
s AS (SELECT page_id, translate(raw_host, '{_UPPER}', '{_LOWER}') AS host, path FROM u),
j AS (SELECT s.*, h || p AS rule, v, ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST, v DESC) AS place
  FROM s LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, '{default}') AS verdict FROM j WHERE place = 1"""


CONTAMINATION = rf"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_NORMAL}) AS words FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_NORMAL}) AS words FROM benchmark),
c AS (SELECT item, words, least(13, len(words)) AS size FROM b WHERE len(words) > 0),
p AS (SELECT item, size, words, unnest(range(1, len(words) - size + 2)) AS i FROM c),
iw AS (SELECT DISTINCT item, size, array_to_string(words[i:i + size - 1], ' ') AS win FROM p),
q AS (SELECT doc_id, words, size FROM d, (SELECT DISTINCT size FROM c) WHERE len(words) >= size),
o AS (SELECT doc_id, size, words, unnest(range(1, len(words) - size + 2)) AS i FROM q),
dw AS (SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS win FROM o),
h AS (SELECT doc_id, i, dw.size, item FROM dw JOIN iw ON dw.win = iw.win AND dw.size = iw.size),
n AS (SELECT doc_id, COUNT(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id),
r AS (SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256 FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN t ON d.doc_id = t.doc_id)
SELECT *, n_hit > 0 AND 20 * n_hit >= n_words AS contaminated FROM r"""


#: crc32 bit by bit: 32 bits of register, a byte of the decimal id every eight steps. A node is counted in the path of its
#: smallest member, all of whose beginnings are above it.
PREFIX_TRIE = """WITH RECURSIVE r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT conv_id, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place,
  md5(strlen(role) || ':' || role || text) AS digest, strlen(text) AS n_bytes FROM r),
crc AS (SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS c FROM t WHERE place = 0
  UNION ALL SELECT conv_id, s, i + 1, xor(x >> 1, CASE WHEN x % 2 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END)
  FROM (SELECT *, CASE WHEN i % 8 = 0 THEN xor(c, CAST(ascii(substr(s, i // 8 + 1, 1)) AS BIGINT)) ELSE c END AS x FROM crc) WHERE i < 8 * length(s)),
f AS (SELECT conv_id, conv_id - conv_id % 5 AS source, xor(c, CAST(4294967295 AS BIGINT)) % 9 AS h FROM crc WHERE i = 8 * length(s)),
g AS (SELECT f.*, coalesce(n, 0) AS n FROM f LEFT JOIN (SELECT conv_id, COUNT(*) AS n FROM t GROUP BY conv_id) k ON k.conv_id = source),
p AS (SELECT conv_id, 0 AS depth, '' AS digest, 0 AS n_bytes FROM f
  UNION ALL SELECT g.conv_id, place + 1, digest, n_bytes FROM g JOIN t ON t.conv_id = source WHERE place < h
  UNION ALL SELECT g.conv_id, least(h, n) + place - h + 1, digest, n_bytes FROM g JOIN t ON t.conv_id = g.conv_id WHERE place >= h),
q AS (SELECT *, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth) AS node, COUNT(*) OVER (PARTITION BY conv_id) - 1 AS length FROM p),
v AS (SELECT node, MAX(depth) AS depth, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs, MAX(n_bytes) AS n_bytes,
  coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE depth = length), '') AS ends FROM q GROUP BY node),
u AS (SELECT *, CASE WHEN depth > 0 THEN left(node, 32 * (depth - 1)) END AS parent FROM v),
c AS (SELECT parent AS node, COUNT(*) AS n_children FROM u WHERE parent IS NOT NULL GROUP BY parent),
w AS (SELECT u.*, coalesce(n_children, 0) AS n_children FROM u LEFT JOIN c ON u.node = c.node),
s AS (SELECT q.node, SUM((w.n_convs - 1) * w.n_bytes) AS saved, COUNT(*) FILTER (WHERE w.n_children = 0) AS n_leaves
  FROM w JOIN q ON q.conv_id = w.conv_id AND q.depth <= w.depth GROUP BY q.node)
SELECT w.conv_id, CAST(w.depth AS BIGINT) AS depth, o.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, sha256(w.ends) AS ends_sha256
FROM w JOIN s ON w.node = s.node LEFT JOIN u AS o ON w.parent = o.node"""

ARCHIVE = """WITH p AS (SELECT page_id, url, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
q AS (SELECT *, ROW_NUMBER() OVER w AS k, FIRST_VALUE(page_id) OVER w AS first FROM p
  WINDOW w AS (PARTITION BY digest ORDER BY page_id NULLS LAST, url NULLS LAST))
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN n < 100 OR k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN n >= 100 AND k > 1 THEN first END AS refers_to FROM q"""


def vector_codes(spec: CodeSpec = CodeSpec()) -> str:
    """Every round written out; integers throughout, floors rounding down."""
    distance = "list_sum(list_transform(range(1, len(v.x) + 1), lambda i: (v.x[i] - b.x[i]) * (v.x[i] - b.x[i])))"
    steps = [
        f"""kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({spec.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""parts AS MATERIALIZED (SELECT vec_id, label, p, x[p * (len(x) // {spec.parts}) + 1:(p + 1) * (len(x) // {spec.parts})] AS x
  FROM kept, (SELECT unnest(range({spec.parts})) AS p))""",
        f"""b0 AS MATERIALIZED (SELECT p, ROW_NUMBER() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {spec.entries}))"""]
    for k in range(spec.rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (SELECT v.vec_id, v.label, v.p, v.x, MIN({distance} * {spec.entries} + b.e) AS best
  FROM parts v JOIN b{k} b ON v.p = b.p GROUP BY ALL)""")
        if k < spec.rounds:
            steps.append(f"""m{k} AS (SELECT p, best % {spec.entries} AS e, i, SUM(x[i]) AS s, COUNT(*) AS n
  FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM a{k}) GROUP BY ALL)""")
            steps.append(f"""b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(y, b.x) AS x FROM b{k} b LEFT JOIN
  (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS y FROM m{k} GROUP BY p, e) n ON b.p = n.p AND b.e = n.e)""")
    return f"""WITH {", ".join(steps)},
c AS (SELECT vec_id, label, string_agg(printf('%02x', CAST(best % {spec.entries} AS INTEGER)), '' ORDER BY p) AS code,
  CAST(SUM(best // {spec.entries}) AS BIGINT) AS error FROM a{spec.rounds} GROUP BY vec_id, label),
books AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{spec.rounds})
SELECT vec_id, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM c, books"""
