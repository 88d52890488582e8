"""DuckDB SQL of the queries that SQL can express."""

WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"

RULES_SQL = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '{_WORD}') AS ws FROM t),
g AS (
  SELECT r, unnest(range(1, len(ws) - 1)) AS i,
    unnest(list_transform(range(1, len(ws) - 1), lambda k: [ws[k], ws[k + 1], ws[k + 2]])) AS t
  FROM w WHERE len(ws) >= 3),
d AS (SELECT r, t FROM g GROUP BY r, t HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM g JOIN d USING (r, t)) GROUP BY 1),
m AS (
  SELECT t.r, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '{_SPACE}+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM t JOIN w USING (r) LEFT JOIN rep USING (r)),
b AS (
  SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, n_repeat_words FROM m),
f AS (
  SELECT *, CAST(
    (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > word_chars THEN 4 ELSE 0 END) + (CASE WHEN n_lines >= 4 AND 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END) + (CASE WHEN word_chars > 40 * n_words THEN 32 ELSE 0 END) AS BIGINT) AS fail_bits
  FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
  fail_bits = 0 AS kept, fail_bits
FROM f
"""

MINHASH_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS ws
  FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 1 THEN [[ws[1]]] ELSE list_transform(range(1, len(ws)), lambda i: [ws[i], ws[i + 1]]) END) AS shingle FROM w),
d AS MATERIALIZED (SELECT DISTINCT doc_id, hash(shingle) AS h FROM s),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM d GROUP BY 1),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM d a JOIN d b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
reach AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY 1)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(least.y, w.doc_id)) AS component_id,
  w.doc_id = least(w.doc_id, coalesce(least.y, w.doc_id)) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least ON least.x = w.doc_id
"""

# Unsigned crc32 of an ASCII string: the table's entry of a byte is eight shifts, then one look-up a character.
_CRC_TABLE = "list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"
_MANIFEST_LEVELS = 12  # 8^12 leaves


def _crc(text: str) -> str:
    """Unsigned crc32 of an ASCII string, beside ``crc_table``."""
    codes = f"list_transform(range(1, 1 + length({text})), lambda i: CAST(ascii(substring({text}, i, 1)) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, x: xor(c // 256, t[1 + xor(c % 256, x)])), 4294967295)"


def _manifest_sql() -> str:
    """The tree level by level: ``n{k}`` the nodes, ``p{k}`` every leaf's proof and fold up to there."""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: f"sha256(concat({field('doc_id')}, {field('source')}, {field('lang')}, {field('n_chars')}, {field(text)}))"
    steps = [
        f"""crc_table AS (SELECT {_CRC_TABLE} AS t),
d AS MATERIALIZED (SELECT doc_id, lang, {leaf('text')} AS leaf,
  {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lower_leaf,
  {_crc('CAST(doc_id AS VARCHAR)')} % 3 = 0 AS tampered
  FROM documents, crc_table),
leaves AS MATERIALIZED (SELECT doc_id, leaf, CASE WHEN tampered THEN lower_leaf ELSE leaf END AS claim,
  dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d)"""
    ]

    def tree(nodes: str, paths: str, tag: str, keep: str) -> tuple[str, str]:
        """Climb from ``nodes (g, i, h)`` and ``paths (g, i, claim, proof, keep)`` to one node a group."""
        for k in range(_MANIFEST_LEVELS):
            steps.append(
                f"""{tag}r{k} AS MATERIALIZED (SELECT g, i // 8 AS r, list(h ORDER BY i) AS hs, any_value(n) AS n FROM (
  SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {nodes}) GROUP BY 1, 2)"""
            )
            steps.append(
                f"""{tag}n{k} AS MATERIALIZED (SELECT g, r AS i, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {tag}r{k})"""
            )
            left, right = "array_to_string(hs[1 : p.i % 8], '')", "array_to_string(hs[p.i % 8 + 2 : 8], '')"
            steps.append(
                f"""{tag}p{k} AS MATERIALIZED (SELECT p.g, r AS i, {keep},
  CASE WHEN n > 1 THEN sha256(concat({left}, claim, {right})) ELSE claim END AS claim,
  CASE WHEN n > 1 THEN concat(proof, {left}, {right}) ELSE proof END AS proof
  FROM {paths} p JOIN {tag}r{k} x ON x.g = p.g AND x.r = p.i // 8)"""
            )
            nodes, paths = f"{tag}n{k}", f"{tag}p{k}"
        return nodes, paths

    nodes, paths = tree("(SELECT g, i, leaf AS h FROM leaves)", "(SELECT *, '' AS proof FROM leaves)", "a", "doc_id, leaf")
    steps.append(f"tops AS (SELECT 0 AS g, g AS i, h FROM {nodes})")
    steps.append(f"lower AS (SELECT 0 AS g, p.g AS i, doc_id, leaf, claim, proof, h AS subroot FROM {paths} p JOIN {nodes} n ON n.g = p.g)")
    nodes, paths = tree("tops", "lower", "b", "doc_id, leaf, subroot")
    return f"""WITH {", ".join(steps)}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, claim AS folded_root, claim = h AS verified
FROM {paths} CROSS JOIN {nodes}
"""


MANIFEST_SQL = _manifest_sql()

# The given pages hold their main text in one article element, with p, h1, b and br elements inside: that is what is taken here.
EXTRACT_SQL = r"""
WITH a AS (SELECT row_number() OVER () AS r, page_id, url, coalesce(regexp_extract(html, '(?s)<article>(.*?)(?:</article>|$)', 1), '') AS inside FROM pages),
b AS (SELECT r, unnest(string_split_regex(inside, '</?(?:p|h1)>')) AS part, unnest(range(len(string_split_regex(inside, '</?(?:p|h1)>')))) AS i FROM a),
c AS (SELECT r, i, replace(regexp_replace(part, '</?b>', '', 'g'), '<br>', ' ') AS part FROM b),
d AS (SELECT r, i, replace(replace(regexp_replace(part, '&quot;?', '"', 'g'), '&lt;', '<'), '&gt;', '>') AS part FROM c),
e AS (SELECT r, i, trim(regexp_replace(regexp_replace(part, '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS part FROM d),
t AS (SELECT r, string_agg(part, chr(10) ORDER BY i) AS text FROM e WHERE part <> '' GROUP BY 1)
SELECT page_id, url, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars FROM a LEFT JOIN t USING (r)
"""


def _structure_sql() -> str:
    """The search row by row in a recursion; a state is a string: cost in 12 digits, edits, chr(1), what is left."""
    cost = lambda x: f"CAST(substring({x}, 1, 12) AS BIGINT)"
    edits = lambda x: f"substring({x}, 13, instr({x}, chr(1)) - 13)"
    left = lambda x: f"substring({x}, instr({x}, chr(1)) + 1)"

    def edit(x, more, letter, message=None):
        rest = left(x) if message is None else f"{left(x)} || chr(10) || {message}"
        return f"(lpad(CAST({cost(x)} + {more} AS VARCHAR), 12, '0') || {edits(x)} || '{letter}' || chr(1) || {rest})"

    def inserted(source):
        u = ", ".join(edit(f"x{k}", 5, "I", "'user:'") for k in (0, 1, 3))
        return f"(SELECT * EXCLUDE (x2, x3), least(x2, {u}) AS x2, least(x3, {edit('x2', 5, 'I', quoted)}) AS x3 FROM {source})"

    quoted = "'assistant:'"
    more = "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END"
    kept = lambda x, initial: f"CASE WHEN first = '{initial}' THEN {edit(x, more, 'K', 'said')} END"
    given = lambda x, role: edit(x, f"1 + {more}", "R", f"'{role}:' || text")
    free = lambda old, *new: f"CASE WHEN fault IN ('blank', 'duplicate') THEN {old} ELSE least({', '.join((old, *new))}) END"
    to_u = [f(x, v) for x in ("x0", "x1", "x3") for f, v in ((kept, "u"), (given, "user"))]
    step = inserted(inserted("(SELECT s.*, f.first, f.said, f.text, f.fault FROM search s JOIN f ON f.g = s.g AND f.place = s.place)"))
    start = "'000000000000' || chr(1)"
    return f"""
WITH RECURSIVE crc_table AS (SELECT {_CRC_TABLE} AS t),
c AS (SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
k AS (SELECT g, turn, role, text, {_crc('name')} % 20 AS kind FROM c, crc_table),
d AS (SELECT g, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM k),
o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text) AS place FROM d),
f AS MATERIALIZED (SELECT g, place, turn, role, text, substring(role, 1, 1) AS first, role || ':' || text AS said,
  lag(substring(role, 1, 1)) OVER (PARTITION BY g ORDER BY place) AS before,
  CASE WHEN NOT regexp_matches(text, '{_WORD}') THEN 'blank' WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY place) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?]{_SPACE}*$') THEN 'truncated' END AS fault FROM o),
search AS (
  SELECT DISTINCT g, CAST(1 AS BIGINT) AS place, {start} AS x0, CAST(NULL AS VARCHAR) AS x1, CAST(NULL AS VARCHAR) AS x2, CAST(NULL AS VARCHAR) AS x3 FROM c
  UNION ALL
  SELECT g, place + 1, {edit('x0', 2, 'D')},
    {free(edit('x1', 2, 'D'), kept('x0', 's'))},
    {free(edit('x2', 2, 'D'), *to_u)},
    {free(edit('x3', 2, 'D'), kept('x2', 'a'), given('x2', 'assistant'))}
  FROM {step}),
ends AS (SELECT g, max(place) AS place FROM search GROUP BY 1),
best AS (SELECT g, least(x0, x3) AS x FROM {inserted(inserted("(SELECT s.* FROM search s JOIN ends USING (g, place))"))}),
n AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (before IS NOT NULL AND (before || first) NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY 1)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, {cost('x')} AS cost, {edits('x')} AS audit, sha256(substring({left('x')}, 2)) AS repaired_sha256
FROM (SELECT DISTINCT g, conv_id FROM c) JOIN best USING (g) LEFT JOIN n USING (g)
"""


STRUCTURE_SQL = _structure_sql()
