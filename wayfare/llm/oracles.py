"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from wayfare.llm.embeddings import THRESHOLD
from wayfare.llm.minhash import THRESHOLD_PERCENT
from wayfare.llm.secrets import BASE_RULES, MORE_RULES

# Rows of `links` (a < b) and `nodes` (id) -> `comp` (id, component_id), by recursion.
_COMPONENTS = """
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT id, id AS seen FROM nodes UNION SELECT r.id, w.b FROM reach r JOIN both_ways w ON r.seen = w.a),
comp AS (SELECT id, MIN(seen) AS component_id FROM reach GROUP BY id)"""


def minhash_sql(width: int = 4) -> str:
    space = "[\\x20\\x09-\\x0D]+"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'),
  '{space}'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(2, len(words) - {width} + 2)),
  lambda i: array_to_string(words[i:i + {width - 1}], ' '))) AS sh FROM w WHERE len(words) > 0),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
inter AS (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS n FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id
  GROUP BY 1, 2),
links AS (SELECT a, b FROM inter JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * inter.n >= {THRESHOLD_PERCENT} * (na.n + nb.n - inter.n)),
nodes AS (SELECT doc_id AS id FROM documents),
{_COMPONENTS}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, component_id = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN comp ON comp.id = d.doc_id"""


def embeddings_sql() -> str:
    return f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id < y.vec_id
  AND len(x.e) = len(y.e) WHERE list_cosine_similarity(x.e, y.e) >= {THRESHOLD}),
nodes AS (SELECT vec_id AS id FROM embeddings),
{_COMPONENTS},
n AS (SELECT a, COUNT(*) AS n FROM both_ways GROUP BY a)
SELECT id AS vec_id, coalesce(n.n, 0) AS n_links, component_id, component_id = id AS kept
FROM comp LEFT JOIN n ON n.a = id"""


def secrets_sql() -> str:
    parts = []
    for rank, rule in enumerate(BASE_RULES + MORE_RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""SELECT doc_id, {rank} AS rank, '{rule.name}' AS kind, {rule.min_chars} AS least, {str(rule.tight).lower()} AS tight,
  list_transform(string_split_regex(text, '{pattern}'), lambda x: length(x)) AS gaps,
  list_transform(regexp_extract_all(text, '{pattern}', 0), lambda x: length(x)) AS spans,
  list_transform(regexp_extract_all(text, '{pattern}', {rule.group}), lambda x: length(x)) AS values
  FROM d WHERE regexp_matches(text, '{pattern}')""")
    names = ", ".join(f"'{r.name}'" for r in BASE_RULES)
    counts = ", ".join(f"COUNT(*) FILTER (WHERE kind = '{r.name}') AS n_{r.name}" for r in BASE_RULES)
    one = "kind || ':' || (e - n) || ':' || e"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({' UNION ALL '.join(parts)}),
x AS (SELECT doc_id, rank, kind, least, tight, gaps, spans, values, unnest(range(1, len(spans) + 1)) AS i FROM m),
p AS (SELECT doc_id, rank, kind, list_sum(gaps[1:i]) + list_sum(spans[1:i]) AS e,
  CASE WHEN tight THEN values[i] ELSE spans[i] END AS n FROM x
  WHERE values[i] >= least),
g AS (SELECT doc_id, {counts}, string_agg({one}, ',' ORDER BY e - n, rank) FILTER (WHERE kind IN ({names})) AS base,
  string_agg({one}, ',' ORDER BY e - n, rank) AS spans FROM p GROUP BY doc_id)
SELECT d.doc_id, {', '.join(f'coalesce(n_{r.name}, 0) AS n_{r.name}' for r in BASE_RULES)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g ON d.doc_id = g.doc_id"""


def quotes_sql() -> str:
    prefix, key = "^[ \\t>]*>[ \\t]?", "conv_id, turn, mid"
    hashed = """SELECT {key}, norm FROM (SELECT {key}, trim(regexp_replace(lower(unnest(list_distinct(
  list_prepend({text}, string_split({text}, chr(10)))))), '\\s+', ' ', 'g')) AS norm FROM {table}) WHERE norm <> ''"""
    return f"""
WITH RECURSIVE m AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, sha256(coalesce(text, '')) AS mid
  FROM conversations),
q AS (SELECT DISTINCT {key}, text FROM m WHERE regexp_matches(text, '(^|\\n)[ \\t]*>')),
l AS (SELECT {key}, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line,
  unnest(string_split(text, chr(10))) AS raw FROM q),
v AS (SELECT {key}, line, length(regexp_replace(regexp_extract(raw, '{prefix}'), '[^>]', '', 'g')) AS level,
  regexp_replace(raw, '{prefix}', '') AS body FROM l),
r AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY line)
  - row_number() OVER (PARTITION BY {key}, level ORDER BY line) AS run FROM v),
p AS (SELECT {key}, level, MIN(line) AS first_line, string_agg(body, chr(10) ORDER BY line) AS passage
  FROM r GROUP BY {key}, level, run),
clean AS (SELECT {key}, MAX(level) AS quote_level, COUNT(*) FILTER (WHERE level > 0) AS n_quotes,
  coalesce(string_agg(passage, chr(10) ORDER BY first_line) FILTER (WHERE level = 0), '') AS own FROM p GROUP BY {key}),
quoted AS (SELECT * FROM p WHERE level > 0 AND conv_id IS NOT NULL AND turn IS NOT NULL),
wanted AS (SELECT DISTINCT * FROM ({hashed.format(key=key + ', level', text='passage', table='quoted')})),
plain AS (SELECT conv_id, turn, text FROM m WHERE mid NOT IN (SELECT mid FROM q)
  UNION ALL SELECT conv_id, turn, own FROM clean),
firsts AS (SELECT conv_id, norm, MIN(turn) AS parent FROM ({hashed.format(key='conv_id, turn', text='text',
                                                                          table='plain')}) GROUP BY 1, 2),
sized AS (SELECT conv_id, turn, level, parent, SUM(length(norm)) AS size FROM wanted JOIN firsts USING (conv_id, norm)
  WHERE parent < turn GROUP BY 1, 2, 3, 4),
links AS (SELECT conv_id, turn, MAX({{'low': -level, 'size': size, 'parent': parent}}).parent AS parent FROM sized
  GROUP BY 1, 2),
up AS (SELECT conv_id, turn, parent AS thread_turn, 1 AS depth FROM links
  UNION ALL SELECT u.conv_id, u.turn, k.parent, depth + 1 FROM up u JOIN links k
  ON k.conv_id = u.conv_id AND k.turn = u.thread_turn),
top AS (SELECT conv_id, turn, MIN(thread_turn) AS thread_turn, MAX(depth) AS depth FROM up GROUP BY 1, 2)
SELECT m.conv_id, m.turn, m.role, links.parent AS reply_to, coalesce(top.thread_turn, m.turn) AS thread_turn,
  CAST(coalesce(top.depth, 0) AS BIGINT) AS depth, CAST(coalesce(quote_level, 0) AS BIGINT) AS quote_level,
  coalesce(n_quotes, 0) AS n_quotes, coalesce(own, m.text) AS text,
  '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(own, m.text) || chr(10) AS formatted
FROM m LEFT JOIN clean c ON m.conv_id IS NOT DISTINCT FROM c.conv_id AND m.turn IS NOT DISTINCT FROM c.turn
  AND m.mid = c.mid LEFT JOIN links ON links.conv_id = m.conv_id AND links.turn = m.turn
LEFT JOIN top ON top.conv_id = m.conv_id AND top.turn = m.turn"""


def crc32_sql(text: str) -> str:
    """crc32 of an ASCII string: eight shifts for each character."""
    step = "list_reduce(list_prepend(xor(x, c), range(8)), lambda y, i: xor(y >> 1, (y & 1) * 3988292384))"
    chars = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {chars}), lambda x, c: {step}), 4294967295)"


def repair_sql() -> str:
    """The cheapest edits row by row: a list of four ways, one for each state (nothing yet,
    after s, u, a), each its cost c, its edits a and the rows it leaves r."""
    space, key = "\\x20\\x09-\\x0D", "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    never = "{'c': 1000000000, 'a': '', 'r': ''}"

    def way(of: str, cost: str, edit: str, rows: str = "''") -> str:
        return f"{{'c': {of}.c + {cost}, 'a': {of}.a || '{edit}', 'r': {of}.r || {rows}}}"

    def least(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    both, other = f"{user} || {assistant}", f"{assistant} || {user}"
    ready = [least("s[1]"), least("s[2]"),
             least("s[3]", *[way(f"s[{k}]", "2", "I", user) for k in (1, 2, 4)]),
             least("s[4]", way("s[3]", "2", "I", assistant), *[way(f"s[{k}]", "4", "II", both) for k in (1, 2)])]
    kept = "chr(10) || role || ':' || text"

    def after(state: int, keep_from: list[int], initial: str, put_from: list[int], role: str) -> str:
        keeps = [way(f"e[{k}]", "cut", "K", kept) for k in keep_from]
        puts = [way(f"e[{k}]", "2 + cut", "R", f"{role} || text") for k in put_from]
        own = way(f"e[{state}]", "3", "D")
        keep = f"CASE WHEN NOT must AND initial = '{initial}' THEN {least(*keeps)} ELSE {never} END" if keeps else never
        put = f"CASE WHEN NOT must THEN {least(*puts)} ELSE {never} END" if puts else never
        return least(own, keep, put)
    done = [after(1, [], "", [], user), after(2, [1], "s", [], user), after(3, [1, 2, 4], "u", [1, 2, 4], user),
            after(4, [3], "a", [3], assistant)]
    return f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc32_sql(key)} % 20 AS kind FROM conversations),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN ''
  WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE kind <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS rn FROM d),
f AS (SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^{space}]') AS blank,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 AS again,
  NOT regexp_matches(text, '[.!?][{space}]*$') AS open FROM n),
g AS (SELECT *, blank OR again AS must, CASE WHEN open AND NOT blank AND NOT again THEN 1 ELSE 0 END AS cut FROM f),
w AS (SELECT conv_id, CAST(0 AS BIGINT) AS rn, [{{'c': 0, 'a': '', 'r': ''}}, {never}, {never}, {never}] AS s
  FROM (SELECT DISTINCT conv_id FROM g)
  UNION ALL SELECT conv_id, rn, [{', '.join(done)}] FROM (
  SELECT g.conv_id, g.rn, role, text, initial, must, cut, [{', '.join(ready)}] AS e
  FROM w JOIN g ON g.conv_id IS NOT DISTINCT FROM w.conv_id AND g.rn = w.rn + 1)),
z AS (SELECT conv_id, {least('s[1]', 's[4]', way('s[3]', '2', 'I', assistant), way('s[2]', '4', 'II', both))} AS b
  FROM (SELECT conv_id, s, row_number() OVER (PARTITION BY conv_id ORDER BY rn DESC) AS late FROM w) WHERE late = 1),
p AS (SELECT conv_id, lag(initial) OVER (PARTITION BY conv_id ORDER BY rn) || initial AS pair, rn FROM g),
i AS (SELECT conv_id, COUNT(*) FILTER (WHERE rn > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM p GROUP BY conv_id),
t AS (SELECT conv_id, coalesce(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps,
  COUNT(*) FILTER (WHERE blank) AS blank, COUNT(*) FILTER (WHERE again AND NOT blank) AS duplicate,
  CAST(SUM(cut) AS BIGINT) AS truncated FROM g GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(t.blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.c, 0) AS BIGINT) AS cost,
  coalesce(b.a, '') AS audit, sha256(coalesce(substr(b.r, 2), '')) AS repaired_sha256
FROM ids LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN i ON i.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM ids.conv_id"""


def trie_sql() -> str:
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL),
n AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
  sha256(length(role) || ':' || role || text) AS dig, length(text) AS chars FROM t),
c AS (SELECT conv_id, {crc32_sql('CAST(conv_id AS VARCHAR)')} % 6 AS h, conv_id - conv_id % 100 AS first
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, k AS place, dig, chars FROM c JOIN n ON n.conv_id = c.first AND k <= h
  UNION ALL SELECT c.conv_id, k + 5, dig, chars FROM c JOIN n ON n.conv_id = c.conv_id AND k > h),
m AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth, chars,
  string_agg(dig, '/') OVER (PARTITION BY conv_id ORDER BY place) AS path FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
l AS (SELECT conv_id, MAX(depth) AS len FROM m GROUP BY conv_id),
v AS (SELECT path, MIN(depth) AS depth, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs, MIN(chars) AS chars,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = len), '')) AS ends_sha256
  FROM m JOIN l USING (conv_id) GROUP BY path),
u AS (SELECT *, CASE WHEN depth > 1 THEN left(path, length(path) - 65) ELSE '' END AS up FROM v),
k AS (SELECT up, COUNT(*) AS n_children FROM u WHERE depth > 0 GROUP BY up),
s AS (SELECT m.path, COUNT(*) FILTER (WHERE n_children IS NULL) AS n_leaves,
  CAST(SUM((n_convs - 1) * u.chars) AS BIGINT) AS saved_tokens FROM u LEFT JOIN k ON k.up = u.path
  JOIN m ON m.conv_id = u.conv_id AND m.depth <= u.depth GROUP BY m.path)
SELECT u.conv_id, CAST(u.depth AS BIGINT) AS depth, CASE WHEN u.depth > 0 THEN p.conv_id END AS parent_conv_id, u.n_convs,
  coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, u.ends_sha256
FROM u LEFT JOIN k ON k.up = u.path JOIN s ON s.path = u.path LEFT JOIN u p ON p.path = u.up"""


ORACLE_SQL = {"op4_secret_scan": secrets_sql(), "op7_quotation_linking": quotes_sql(), "op8_minhash": minhash_sql(),
              "op9_embedding_dedup": embeddings_sql(), "op12_repair": repair_sql(), "op13_prefix_trie": trie_sql()}
