"""DuckDB SQL for the queries that SQL can express on whole tables."""

ORACLES: dict[str, str] = {}

# Components as the smallest id reachable; a recursive table of (node, reached) over the links.
_REACH = """
reach(node, id) AS (SELECT id, id FROM nodes UNION SELECT r.node, l.b FROM reach r JOIN both_ways l ON l.a = r.id),
"""

ORACLES["op7_minhash"] = (
    r"""
WITH RECURSIVE lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), worded AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(t, '[\x09-\x0D ]+') IF x <> ''] AS w FROM lowered
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) = 1 THEN [w[1]]
    ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS s FROM worded
), nodes AS (SELECT doc_id AS id, s, len(s) AS n FROM sets),
items AS (SELECT id, n, unnest(s) AS x FROM nodes),
-- Two sets of similarity 0.8 share one of the rarest fifth of either's items, plus one.
ranked AS (
  SELECT id, n, x, row_number() OVER (PARTITION BY id ORDER BY f, x) AS k
  FROM (SELECT id, n, x, count(*) OVER (PARTITION BY x) AS f FROM items)
), prefix AS (SELECT id, n, x FROM ranked WHERE k <= n - ceil(0.8 * n) + 1),
pairs AS (
  SELECT DISTINCT p.id AS a, q.id AS b FROM prefix p JOIN prefix q ON p.x = q.x AND p.id < q.id
  WHERE 100 * least(p.n, q.n) >= 80 * greatest(p.n, q.n)
), links AS (
  SELECT a, b FROM (
    SELECT p.a, p.b, l.n + r.n AS total, len(list_intersect(l.s, r.s)) AS same
    FROM pairs p JOIN nodes l ON l.id = p.a JOIN nodes r ON r.id = p.b
  ) WHERE 100 * same >= 80 * (total - same)
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),"""
    + _REACH
    + """
least_of AS (SELECT node, min(id) AS component_id FROM reach GROUP BY node)
SELECT n.id AS doc_id, n.n AS n_shingles, l.component_id, n.id = l.component_id AS kept
FROM nodes n JOIN least_of l ON l.node = n.id
"""
)

ORACLES["op6_vectors"] = (
    """
WITH RECURSIVE nodes AS (
  SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings
), usable AS (
  SELECT id, v FROM nodes WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_dot_product(v, v) > 0
), both_ways AS (
  SELECT p.id AS a, q.id AS b FROM usable p JOIN usable q ON p.id <> q.id AND len(p.v) = len(q.v)
  WHERE list_cosine_similarity(p.v, q.v) >= 0.9
),"""
    + _REACH
    + """
least_of AS (SELECT node, min(id) AS component_id FROM reach GROUP BY node),
degree AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT n.id AS vec_id, coalesce(d.n, 0) AS n_links, l.component_id, n.id = l.component_id AS kept
FROM nodes n JOIN least_of l ON l.node = n.id LEFT JOIN degree d ON d.a = n.id
"""
)

ORACLES["op9_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), seen AS (
  SELECT *, lag(role) OVER w AS before, replace(replace(text, '~', '~0'), '<|', '<~1') AS escaped
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  -- A turn is its text and a part mark of 11 characters, or, in a new message, a header and an end: 12 + role + 1 and 10 + 1.
  sum(length(escaped) + CASE WHEN before = role THEN 11 ELSE 24 + length(role) END)::BIGINT AS formatted_chars
FROM seen GROUP BY conv_id
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES["op12_collocations"] = rf"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM texts
), listed AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM pieces
), grams AS (
  SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM listed, (VALUES (1), (2), (3), (4)) sizes(k) WHERE len(ws) >= k)
  GROUP BY ALL
), totals AS (SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang),
often AS (SELECT *, string_split(phrase, ' ') AS ws FROM grams WHERE f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, cut, l.f AS l, r.f AS r, (2000000::HUGEINT * c.f) // (l.f + r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM often WHERE k > 1) c
  JOIN often l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1 : cut], ' ')
  JOIN often r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[cut + 1 : c.k], ' ')
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM often WHERE k > 2)) GROUP BY ALL
)
SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, c.phrase) AS rank, c.phrase, a, l, r,
  t.n::BIGINT AS n, score::BIGINT AS score
FROM lowest c JOIN totals t USING (lang) LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase
WHERE i.longer IS NULL OR 100 * i.longer < 80 * a
QUALIFY rank <= 2000
"""
