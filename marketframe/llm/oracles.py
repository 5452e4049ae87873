"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from . import mixing as M
from . import quality as Q

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"

EXACT = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM d
"""


def _quality_sql(min_group: int = Q.MIN_GROUP) -> str:
    ratios = ", ".join("{'ratio': '%s', 'x': %s::DOUBLE / greatest(%s, 1)::DOUBLE, 'floor_': %s::DOUBLE, 'low': %s::DOUBLE}"
                       % (r, n, d, f, "NULL" if low is None else low) for r, (n, d, f, low) in Q.RATIOS.items())
    return f"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '{_WORD}')) AS lines
  FROM documents),
win AS (
  SELECT rid, i, words[i:i + {Q.WINDOW - 1}] AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - {Q.WINDOW - 2})) AS i FROM w WHERE len(words) >= {Q.WINDOW})),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM win) WHERE c > 1),
rep AS (
  SELECT rid, sum(least({Q.WINDOW}, coalesce(nxt - i, {Q.WINDOW})))::BIGINT AS n_repeat_words
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM twice) GROUP BY rid),
m AS (
  SELECT rid, doc_id, lang, source, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '{_SPACE}', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1]))::BIGINT AS n_stutter
  FROM w LEFT JOIN rep USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
v AS (SELECT rid, lang, source, base_failed, r.ratio, r.x, r.floor_, r.low FROM (
  SELECT rid, lang, source, base_failed,
         unnest([{ratios}]) AS r FROM b)),
k AS (SELECT lang, source, ratio, floor_, low, CASE WHEN x > 0 THEN ceil(ln(x) / ln({Q.GAMMA}::DOUBLE))::INT END AS bucket
      FROM v WHERE NOT base_failed),
lv AS (SELECT 1 AS level, lang, source, ratio, floor_, low AS low_, bucket FROM k
       UNION ALL SELECT 2, lang, NULL, ratio, floor_, low, bucket FROM k
       UNION ALL SELECT 3, NULL, NULL, ratio, floor_, low, bucket FROM k),
s AS (SELECT level, lang, source, ratio, floor_, low_, bucket, count(*) AS n FROM lv GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, ratio ORDER BY bucket NULLS FIRST) AS cum,
             sum(n) OVER (PARTITION BY level, lang, source, ratio) AS size FROM s),
q AS (SELECT level, lang, source, ratio, floor_, low_, max(size) AS size,
             arg_min(coalesce(2.0 * pow({Q.GAMMA}::DOUBLE, bucket::DOUBLE) / {Q.GAMMA + 1.0}::DOUBLE, 0.0), cum) FILTER (WHERE cum * 100 >= size * 50) AS m,
             arg_min(coalesce(2.0 * pow({Q.GAMMA}::DOUBLE, bucket::DOUBLE) / {Q.GAMMA + 1.0}::DOUBLE, 0.0), cum) FILTER (WHERE cum * 100 >= size * 5) AS l
      FROM c GROUP BY level, lang, source, ratio, floor_, low_),
f AS (SELECT level, lang, source, ratio, size, m - {Q.K} * greatest(m - l, low_) AS low, m + {Q.K} * greatest(m - l, floor_) AS high FROM q),
t AS (SELECT a.lang, a.source, a.ratio,
             CASE WHEN a.size >= {min_group} THEN a.low WHEN l.size >= {min_group} THEN l.low ELSE g.low END AS low,
             CASE WHEN a.size >= {min_group} THEN a.high WHEN l.size >= {min_group} THEN l.high ELSE g.high END AS high
      FROM f a JOIN f l ON l.level = 2 AND l.ratio = a.ratio AND l.lang IS NOT DISTINCT FROM a.lang
      JOIN f g ON g.level = 3 AND g.ratio = a.ratio WHERE a.level = 1),
out AS (SELECT v.rid, bool_or(v.x > t.high OR (v.low IS NOT NULL AND v.x < t.low)) AS bad
        FROM v JOIN t ON t.ratio = v.ratio AND t.lang IS NOT DISTINCT FROM v.lang AND t.source IS NOT DISTINCT FROM v.source
        GROUP BY v.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(bad, false) AS kept
FROM b LEFT JOIN out USING (rid)
"""


QUALITY = _quality_sql()


def _mix_sql() -> str:
    """Target weights, one period by earliest deadline first (a recursive step per slot) and places."""
    return f"""
WITH RECURSIVE n AS (SELECT doc_id, source, coalesce(length(text), 0) + 1 AS size FROM documents),
sizes AS (SELECT source, sum(size) AS size, pow(sum(size)::DOUBLE, {M.ALPHA}::DOUBLE) AS weight FROM n GROUP BY source),
shares AS (SELECT source, weight,
                  greatest(1, floor({M.SLOTS} * weight / (SELECT sum(weight) FROM sizes) + 0.5::DOUBLE))::BIGINT AS w,
                  row_number() OVER (ORDER BY weight DESC, source NULLS FIRST) - 1 AS lane FROM sizes),
p AS (SELECT sum(w)::BIGINT AS period, list(w ORDER BY lane) AS ws, count(*)::BIGINT AS k FROM shares),
run AS (
  SELECT 0::BIGINT AS t, list_transform(ws, lambda x: 0::BIGINT) AS had, NULL::BIGINT AS pick FROM p
  UNION ALL
  SELECT t + 1, list_transform(range(1, k + 1), lambda i: had[i] + (i = pick)::BIGINT), pick
  FROM (SELECT t, had, k, ws, list_min(list_transform(range(1, k + 1), lambda i:
               CASE WHEN had[i] < ws[i] AND (had[i] * period) // ws[i] <= t
                    THEN ((had[i] + 1) * period + ws[i] - 1) // ws[i] * 100000 + i END)) % 100000 AS pick
        FROM run, p WHERE t < period)),
cyc AS (SELECT pick - 1 AS lane, list(t - 1 ORDER BY t) AS cycle FROM run WHERE t > 0 GROUP BY pick),
pos AS (SELECT n.doc_id, n.source, n.size, s.lane, s.w,
               sum(n.size) OVER (PARTITION BY s.lane ORDER BY md5(n.doc_id::VARCHAR) NULLS FIRST, n.doc_id NULLS FIRST, n.size
                                 ROWS UNBOUNDED PRECEDING) - n.size AS at_
        FROM n JOIN shares s ON s.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, source, size::BIGINT AS size, pos.lane::INT AS lane, (at_ // {M.BLOCK})::BIGINT AS block,
       ((at_ // {M.BLOCK}) // w * period + cycle[((at_ // {M.BLOCK}) % w + 1)::BIGINT])::BIGINT AS slot, at_::BIGINT AS at
FROM pos JOIN cyc ON cyc.lane = pos.lane, p
"""


MIX = _mix_sql()


LEAKS = r"""
WITH lower_ AS (SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
d AS (SELECT rid, doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM lower_),
i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
n AS (SELECT item, ws, least(len(ws), 10) AS n FROM i WHERE len(ws) > 0),
iw AS (SELECT DISTINCT item, n, array_to_string(ws[s:s + n - 1], ' ') AS win FROM (SELECT item, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM n)),
dw AS (SELECT rid, n, s, array_to_string(ws[s:s + n - 1], ' ') AS win
       FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM n) WHERE len(ws) >= n)),
f AS (SELECT rid, s, dw.n, item FROM dw JOIN iw USING (win)),
h AS (SELECT rid, count(DISTINCT at_)::BIGINT AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS at_ FROM (SELECT DISTINCT rid, s, n FROM f)) GROUP BY rid),
g AS (SELECT rid, count(DISTINCT item)::BIGINT AS n_items, array_to_string(list_sort(list_distinct(list(item))), ',') AS items FROM f GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN g USING (rid)
"""


DIVERGENCE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT lang, source FROM d GROUP BY ALL),
gn AS (SELECT lang, source, coalesce(sum(n), 0) AS size FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT gn.lang, gn.source, kept.term, coalesce(n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (size + v) AS p
      FROM gn JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = kept.term),
lp AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // (size + v) AS q
       FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL) JOIN (SELECT lang, sum(n) AS size FROM c GROUP BY lang) USING (lang) JOIN v USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p JOIN lp USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank_ FROM (FROM pairs UNION ALL FROM terms))
SELECT lang, source, part, item, value, rank_::INT AS rank FROM r WHERE part = 'pair' OR rank_ <= 200
"""


def _repair_sql() -> str:
    """Cheapest edits from the last row backwards: per state the least (cost, edits) and its lines. A
    conversation's states are 1 nothing yet, 2 after system, 3 after user and 4 after assistant."""
    best = lambda *ways: f"list_sort([{', '.join(ways)}])[1]"
    way = lambda cost, edit, line, then: ("{'c': (%s + %s.c)::BIGINT, 'e': '%s' || %s.e, 't': %s}" % (
        cost, then, edit, then, f"list_prepend({line}, {then}.t)" if line else f"{then}.t"))
    kept = "role || ':' || text"
    steps = []  # without inserts: keep, give another role or delete
    for s, (role, nxt) in enumerate((("user", 3), ("user", 3), ("assistant", 4), ("user", 3)), 1):
        no = "{'c': 1000000000::BIGINT, 'e': '', 't': []::VARCHAR[]}"
        keep = way("cut_", "K", kept, f"v{nxt}")
        keeps = f"CASE WHEN must THEN {no} WHEN initial = '{role[0]}' THEN {keep} "
        keeps += f"WHEN initial = 's' THEN {way('cut_', 'K', kept, 'v2')} ELSE {no} END" if s == 1 else f"ELSE {no} END"
        rerole = f"CASE WHEN must THEN {no} ELSE {way('2 + cut_', 'R', f"'{role}:' || text", f'v{nxt}')} END"
        steps.append(f"{best(keeps, rerole, way('3', 'D', None, f'v{s}'))} AS b{s}")
    more = lambda s: [f"b{s}"] + ([way("2", "I", "'user:'", "b3"), way("4", "II", "'user:'", "x4")] if s != 3 else
                                  [way("2", "I", "'assistant:'", "b4")])
    # a second insert's line stands between: x4 is b4 with the assistant's line before its lines
    values = ", ".join(f"{best(*more(s))} AS v{s}" for s in range(1, 5))
    base = lambda c, e, lines: "{'c': %d::BIGINT, 'e': '%s', 't': %s::VARCHAR[]}" % (c, e, lines)
    return f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n::BIGINT], [1, 2, 3, 4, 5, 6, 7, 8]),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT) AS bytes
      FROM conversations),
z AS (SELECT k.* EXCLUDE (bytes), xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], bytes),
         lambda c, x: xor(tab[(xor(c, x) & 255) + 1], c >> 8))) % 20 AS kind FROM k, crc),
dam AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
          CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
          unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM z WHERE kind <> 0),
r0 AS (SELECT *, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS final,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS nth FROM dam),
r AS (SELECT *, CASE WHEN final = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN final NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         role[1] AS initial, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS previous FROM r0),
f AS (SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS must, coalesce(fault = 'truncated', false)::INT AS cut_ FROM r),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
        count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
        count(*) FILTER (WHERE fault = 'truncated') AS truncated,
        count(*) FILTER (WHERE i > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM f GROUP BY conv_id),
dp AS (
  SELECT conv_id, n AS i, {base(0, '', '[]')} AS v1, {base(4, 'II', "['user:', 'assistant:']")} AS v2,
         {base(2, 'I', "['assistant:']")} AS v3, {base(0, '', '[]')} AS v4 FROM c
  UNION ALL
  SELECT conv_id, i, {values} FROM (
    SELECT *, {{'c': b4.c, 'e': b4.e, 't': list_prepend('assistant:', b4.t)}} AS x4 FROM (
      SELECT f.conv_id, f.i - 1 AS i, {', '.join(steps)}
      FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i)))
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(v1.c, 0) AS cost,
       coalesce(v1.e, '') AS audit, sha256(coalesce(array_to_string(v1.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN dp ON dp.conv_id IS NOT DISTINCT FROM o.conv_id AND dp.i = 0
"""


REPAIR = _repair_sql()
