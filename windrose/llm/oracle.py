"""DuckDB SQL for the corpus queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op1_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z in lower case
_WORDS = """list_filter(string_split_regex(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"""

ORACLE["op3_decontaminate"] = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
b AS (SELECT cast(item_id AS VARCHAR) AS item, {_WORDS.format(text="coalesce(text, '')")} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
       FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
       FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
             FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size)),
hit AS (SELECT doc_id, i, size, item FROM dw JOIN bw USING (size, win)),
words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_COMPONENTS = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {size} - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {size} + 1, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
          JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
          GROUP BY x.doc_id, y.doc_id, nx.n, ny.n HAVING 100 * count(*) >= {percent} * (nx.n + ny.n - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(least.b, w.doc_id)) AS component_id{more}
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN least ON least.a = w.doc_id
"""

ORACLE["op2_minhash"] = _COMPONENTS.format(size=5, percent=75, more=""",
       w.doc_id = least(w.doc_id, coalesce(least.b, w.doc_id)) AS kept""")

ORACLE["op11_jaccard_join"] = _COMPONENTS.format(size=4, percent=85, more="")

# unsigned crc32 of an ASCII text, bit by bit
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, (a & 1) * 3988292384::BIGINT))),
    4294967295::BIGINT)"""

_PART = "coalesce(strlen(cast({c} AS VARCHAR)) || ':' || cast({c} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_PART.format(c=c) for c in ("doc_id", "source", "lang", "n_chars")) + " || " + _PART + ")"

ORACLE["op12_merkle"] = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_LEAF.format(c="text")} AS leaf, {_LEAF.format(c="changed")} AS tampered,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, {_LEAF.format(c="text")}) - 1 AS idx
  FROM (SELECT *, CASE WHEN {_CRC32.format(text="cast(doc_id AS VARCHAR)")} % 3 = 0
        THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed FROM documents)),
keys AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT lang FROM leaves)),
low(tree, lvl, idx, h) AS (
  SELECT tree, 0, idx, leaf FROM leaves JOIN keys ON leaves.lang IS NOT DISTINCT FROM keys.lang
  UNION ALL
  SELECT tree, lvl + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM low) WHERE n > 1 GROUP BY tree, lvl, idx // 8),
subroots AS (SELECT tree, max(lvl) AS lvl, arg_max(h, lvl) AS h FROM low GROUP BY tree),
high(lvl, idx, h) AS (
  SELECT 0, tree, h FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS n FROM high) WHERE n > 1 GROUP BY lvl, idx // 8),
root AS (SELECT arg_max(h, lvl) AS h, max(lvl) AS lvl FROM high),
nodes AS (SELECT low.tree, low.lvl, idx, low.h, subroots.lvl AS top FROM low JOIN subroots USING (tree) WHERE low.lvl < subroots.lvl
          UNION ALL SELECT -1, high.lvl, idx, high.h, root.lvl FROM high, root WHERE high.lvl < root.lvl),
links AS (SELECT a.tree, a.lvl, a.idx, a.top,
                 coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS ahead,
                 coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after
          FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.lvl = b.lvl AND a.idx // 8 = b.idx // 8
          GROUP BY a.tree, a.lvl, a.idx, a.top),
climb(doc_id, leaf, own, tree, lvl, idx, folded, path) AS (
  SELECT doc_id, leaf, keys.tree, CASE WHEN top > 0 THEN keys.tree ELSE -1 END, 0, CASE WHEN top > 0 THEN idx ELSE keys.tree END, tampered, ''
  FROM leaves JOIN keys ON leaves.lang IS NOT DISTINCT FROM keys.lang JOIN (SELECT tree, lvl AS top FROM subroots) s ON s.tree = keys.tree
  UNION ALL
  SELECT doc_id, leaf, own, CASE WHEN c.lvl + 1 = top THEN -1 ELSE c.tree END,
         CASE WHEN c.lvl + 1 = top AND c.tree >= 0 THEN 0 ELSE c.lvl + 1 END,
         CASE WHEN c.lvl + 1 = top AND c.tree >= 0 THEN own ELSE c.idx // 8 END,
         sha256(ahead || folded || after), path || ahead || after
  FROM climb c JOIN links USING (tree, lvl, idx))
SELECT doc_id, leaf, subroots.h AS subroot, root.h AS root, sha256(path) AS proof_sha256, folded AS folded_root,
       folded = root.h AS verified
FROM climb JOIN subroots ON own = subroots.tree, root WHERE climb.tree = -1 AND climb.lvl = root.lvl
"""

# least edits row by row: pairs (cost, audit) as text, the cost in ten digits
_BLANKS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
ORACLE["op13_structure"] = f"""
WITH RECURSIVE damage AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_CRC32.format(text="coalesce(cast(conv_id AS VARCHAR), ' ') || ':' || coalesce(cast(turn AS VARCHAR), ' ')")} % 20 AS kind
  FROM conversations),
rows AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM damage, range(2) copies(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
                  right(rtrim(text, {_BLANKS}), 1) AS last, left(role, 1) AS i
           FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM rows)),
faults AS (SELECT *, CASE WHEN last = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
                  lag(i) OVER (PARTITION BY conv_id ORDER BY pos) AS ahead FROM placed),
steps(p, i, q) AS (VALUES ('0', 's', 'S'), ('0', 'u', 'U'), ('S', 'u', 'U'), ('U', 'a', 'A'), ('A', 'u', 'U')),
closure(p, q, cost, edits) AS (VALUES ('0', '0', 0, ''), ('S', 'S', 0, ''), ('U', 'U', 0, ''), ('A', 'A', 0, ''), ('0', 'U', 3, 'I'),
  ('0', 'A', 6, 'II'), ('S', 'U', 3, 'I'), ('S', 'A', 6, 'II'), ('U', 'A', 3, 'I'), ('A', 'U', 3, 'I')),
edits AS (
  SELECT conv_id, pos, p, p AS q, 4 AS cost, 'D' AS edit FROM faults, (SELECT DISTINCT p FROM closure)
  UNION ALL
  SELECT conv_id, pos, p, q, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END + CASE edit WHEN 'R' THEN 3 ELSE 0 END, edit
  FROM faults, steps, (VALUES ('K'), ('R')) e(edit)
  WHERE fault IS DISTINCT FROM 'blank' AND fault IS DISTINCT FROM 'duplicate'
    AND CASE edit WHEN 'K' THEN steps.i = faults.i ELSE steps.i IN ('u', 'a') END),
walk(conv_id, pos, q, best) AS (
  SELECT c.conv_id, cast(0 AS BIGINT), q, lpad(cast(cost AS VARCHAR), 10, '0') || edits
  FROM (SELECT DISTINCT conv_id FROM rows) c, closure WHERE p = '0'
  UNION ALL
  SELECT w.conv_id, w.pos + 1, c.q, min(lpad(cast(cast(left(best, 10) AS BIGINT) + e.cost + c.cost AS VARCHAR), 10, '0')
                                       || substr(best, 11) || e.edit || c.edits)
  FROM walk w JOIN edits e ON w.conv_id IS NOT DISTINCT FROM e.conv_id AND e.pos = w.pos + 1 AND e.p = w.q JOIN closure c ON c.p = e.q
  GROUP BY w.conv_id, w.pos, c.q),
stats AS (SELECT conv_id, max(pos) AS pos, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                 count(*) FILTER (fault = 'truncated') AS truncated,
                 count(*) FILTER (ahead IS NOT NULL AND ahead || i NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id),
plans AS (SELECT s.conv_id, min(best) AS best FROM stats s JOIN walk w ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.pos = w.pos
          WHERE q IN ('0', 'A') GROUP BY s.conv_id),
spelled AS (SELECT conv_id, k, substr(best, 10 + k, 1) AS edit, best FROM (SELECT conv_id, best, unnest(range(1, len(best) - 9)) AS k FROM plans)),
turns AS (SELECT *, count(*) FILTER (edit <> 'I') OVER upto AS pos, count(*) FILTER (edit <> 'D') OVER upto AS put,
                 count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id) AS n
          FROM spelled WINDOW upto AS (PARTITION BY conv_id ORDER BY k)),
repaired AS (SELECT t.conv_id, string_agg(CASE WHEN edit = 'K' THEN f.role WHEN (put - n) % 2 = 0 THEN 'assistant' ELSE 'user' END
                                          || ':' || CASE WHEN edit = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY k) AS body
             FROM turns t LEFT JOIN faults f ON t.conv_id IS NOT DISTINCT FROM f.conv_id AND t.pos = f.pos
             WHERE edit <> 'D' GROUP BY t.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cast(coalesce(left(best, 10), '0') AS BIGINT) AS cost,
       coalesce(substr(best, 11), '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN stats s ON o.conv_id IS NOT DISTINCT FROM s.conv_id
LEFT JOIN plans p ON o.conv_id IS NOT DISTINCT FROM p.conv_id LEFT JOIN repaired r ON o.conv_id IS NOT DISTINCT FROM r.conv_id
"""
