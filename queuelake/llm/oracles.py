"""DuckDB SQL of the operators on benchmark items, spellings and conversations."""

from __future__ import annotations

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


# The table of the reflected polynomial 0xEDB88320, and a checksum of a list of bytes.
_CRC_TABLE = """crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], repeat([0], 8)),
         lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab)"""


def _crc32(data: str) -> str:
    return f"xor(list_reduce(list_concat([4294967295], {data}), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295)"


def _ascii(text: str) -> str:
    return f"list_transform(string_split({text}, ''), lambda c: CAST(unicode(c) AS BIGINT))"


def _latin1(text: str) -> str:
    return f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, unicode(c) - 64] END))"


DECONTAMINATION = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_lower("coalesce(text, '')")}, '{_WORDS}') AS w FROM documents),
b AS (
  SELECT item, w, least(10, len(w)) AS k, row_number() OVER () AS rowno
  FROM (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({_lower("coalesce(text, '')")}, '{_WORDS}') AS w FROM benchmark)
  WHERE len(w) > 0),
t AS (SELECT item, rowno, k, j, array_to_string(w[j:j + k - 1], ' ') AS gram FROM b, unnest(range(1, len(w) - k + 2)) AS u(j)),
g AS (
  SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM d, (SELECT DISTINCT k FROM t), unnest(range(1, len(w) - k + 2)) AS u(i)),
o AS (SELECT r, i, k, item, rowno, j FROM g JOIN t USING (k, gram)),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM o, unnest(range(i, i + k)) AS u(p) GROUP BY r),
n AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM o) GROUP BY r),
-- windows of one item in consecutive places of item and text
e AS (SELECT r, k, rowno, i - j AS diag, j - row_number() OVER (PARTITION BY r, rowno, i - j ORDER BY j) AS part FROM o),
m AS (SELECT r, max(run) AS longest FROM (SELECT r, CASE WHEN k < 10 THEN k ELSE count(*) + 9 END AS run FROM e GROUP BY r, k, rowno, diag, part) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated, CAST(coalesce(longest, 0) AS BIGINT) AS longest_match
FROM d LEFT JOIN h USING (r) LEFT JOIN n USING (r) LEFT JOIN m USING (r)
"""

_BYTES = f"list_concat({_ascii("id || ':'")}, {_latin1('run')})"

VARIANTS = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all({_lower("text")}, '[a-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
h AS (SELECT run, times, {_crc32(_BYTES)} AS h FROM runs, crc),
v AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM h)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
x AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS cut FROM v, unnest(range(1, length(word) + 1)) AS u(i)),
near AS (
  SELECT a.word, b.word AS other FROM x a JOIN x b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT x.word, v.word FROM x JOIN v ON v.word = x.cut
  UNION SELECT v.word, x.word FROM x JOIN v ON v.word = x.cut),
f AS (
  SELECT near.word, count(*) AS n_near, max({{'n': v.n}}).n AS top FROM near JOIN v ON v.word = other GROUP BY near.word),
g AS (SELECT near.word, min(other) AS form FROM near JOIN v ON v.word = other JOIN f ON f.word = near.word AND f.top = v.n GROUP BY near.word),
w AS (
  SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 5 * n THEN form END AS form, CASE WHEN top >= 5 * n THEN top END AS form_n
  FROM v LEFT JOIN f ON f.word = v.word LEFT JOIN g ON g.word = v.word),
way AS (SELECT word, word AS here FROM w UNION ALL SELECT way.word, w.form FROM way JOIN w ON w.word = here WHERE w.form IS NOT NULL)
SELECT w.word, w.form, here AS root, w.n, w.n_near, w.form_n
FROM w JOIN way ON way.word = w.word WHERE here IN (SELECT word FROM w WHERE form IS NULL)
"""

_TURN_KEY = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
_SPACE = r"\x20\x09-\x0D"

REPAIR = f"""
WITH RECURSIVE {_CRC_TABLE},
t AS (
  SELECT row_number() OVER () AS id, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32(_ascii(_TURN_KEY))} % 20 AS what
  FROM conversations, crc),
d AS (
  SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE t.role END AS role,
         CASE WHEN what = 1 THEN '' WHEN what = 2 THEN translate(t.text, '.!?', '') ELSE t.text END AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, t.role, left(t.text, 64), md5(t.text), id, copy) - 1 AS i
  FROM t, unnest(CASE WHEN what = 3 THEN [0, 1] ELSE [0] END) AS u(copy) WHERE what <> 0),
r AS (
  SELECT *, left(role, 1) AS x,
         CASE WHEN NOT regexp_matches(text, '[^{_SPACE}]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][{_SPACE}]*\\z') THEN 'truncated' ELSE '' END AS fault
  FROM d),
ins(s, letters, said, s1) AS (VALUES
  ('-', '', '', '-'), ('-', 'I', chr(10) || 'user:', 'u'), ('-', 'II', chr(10) || 'user:' || chr(10) || 'assistant:', 'a'),
  ('s', '', '', 's'), ('s', 'I', chr(10) || 'user:', 'u'), ('s', 'II', chr(10) || 'user:' || chr(10) || 'assistant:', 'a'),
  ('u', '', '', 'u'), ('u', 'I', chr(10) || 'assistant:', 'a'), ('u', 'II', chr(10) || 'assistant:' || chr(10) || 'user:', 'u'),
  ('a', '', '', 'a'), ('a', 'I', chr(10) || 'user:', 'u'), ('a', 'II', chr(10) || 'user:' || chr(10) || 'assistant:', 'a')),
edit(s1, letter, s2, weight, role2) AS (VALUES
  ('-', 'K', 's', 0, ''), ('-', 'K', 'u', 0, ''), ('s', 'K', 'u', 0, ''), ('u', 'K', 'a', 0, ''), ('a', 'K', 'u', 0, ''),
  ('-', 'R', 'u', 2, 'user'), ('s', 'R', 'u', 2, 'user'), ('u', 'R', 'a', 2, 'assistant'), ('a', 'R', 'u', 2, 'user'),
  ('-', 'D', '-', 3, ''), ('s', 'D', 's', 3, ''), ('u', 'D', 'u', 3, ''), ('a', 'D', 'a', 3, '')),
dp AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '-' AS s, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'said': ''}} AS best FROM r
  UNION ALL
  SELECT dp.conv_id, dp.i + 1, s2,
         min({{'cost': CAST(dp.best.cost + 2 * length(letters) + weight + CASE WHEN letter <> 'D' AND fault = 'truncated' THEN 1 ELSE 0 END AS BIGINT),
              'audit': dp.best.audit || letters || letter,
              'said': dp.best.said || ins.said || CASE letter WHEN 'D' THEN '' WHEN 'R' THEN chr(10) || role2 || ':' || text ELSE chr(10) || role || ':' || text END}})
  FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i
       JOIN ins ON ins.s = dp.s
       JOIN edit ON edit.s1 = ins.s1 AND (letter = 'D' OR fault NOT IN ('blank', 'duplicate')) AND (letter <> 'K' OR x = s2)
  GROUP BY dp.conv_id, dp.i, s2),
size AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated
  FROM r GROUP BY conv_id),
goal AS (
  SELECT dp.conv_id, min({{'cost': CAST(dp.best.cost + 2 * length(letters) AS BIGINT), 'audit': dp.best.audit || letters, 'said': dp.best.said || ins.said}}) AS best
  FROM dp JOIN size ON size.conv_id IS NOT DISTINCT FROM dp.conv_id AND dp.i = n JOIN ins ON ins.s = dp.s AND s1 IN ('-', 'a') GROUP BY dp.conv_id),
jump AS (
  SELECT conv_id, count(*) FILTER (before || x NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT conv_id, x, lag(x) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM r) GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(goal.best.cost, 0) AS cost,
       coalesce(goal.best.audit, '') AS audit, sha256(coalesce(substr(goal.best.said, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN size ON size.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN jump ON jump.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN goal ON goal.conv_id IS NOT DISTINCT FROM c.conv_id
"""
