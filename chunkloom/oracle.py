"""DuckDB SQL of the registered queries."""

from __future__ import annotations

from chunkloom.sources.files import duck_html_to_markdown

_WS = "' '||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"


def _strip(x: str) -> str:
    return f"trim({x}, {_WS})"


_MD = """md AS (
  SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(source,'none')||'/doc'||CAST(doc_id AS VARCHAR)||'.md' AS source,
    array_to_string(list_transform(string_split(coalesce(text,''), chr(10)), lambda x, i:
      CASE WHEN i = 1 THEN '# '||coalesce(source,'none')||chr(10)||chr(10)||x
           WHEN (i-1) % 6 = 1 THEN '## '||coalesce(lang,'none')||' '||CAST((i-1)//12 AS VARCHAR)||chr(10)||x
           WHEN (i-1) % 6 = 3 THEN '#### part'||chr(10)||'| key | value |'||chr(10)||'| --- | --- |'||chr(10)||'| line | '||CAST(i-1 AS VARCHAR)||' |'||chr(10)||'| size | '||CAST(length(x) AS VARCHAR)||' |'||chr(10)||repeat('| row | '||CAST(i-1 AS VARCHAR)||' |'||chr(10), ((i-1) % 40) * 4)
           WHEN (i-1) % 8 = 4 THEN '```'||chr(10)||x||chr(10)||chr(10)||'end'||chr(10)||'```'
           ELSE x||chr(10) END), chr(10)) AS markdown
  FROM documents)"""
_LINES = f"""{_MD}, l0 AS (
  SELECT doc_id, unnest(string_split(markdown, chr(10))) AS line, generate_subscripts(string_split(markdown, chr(10)), 1) AS i, len(string_split(markdown, chr(10))) AS n FROM md),
l AS (
  SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, line, {_strip("line")} AS s,
    CAST(sum(length(line) + CASE WHEN i < n THEN 1 ELSE 0 END) OVER w - length(line) - CASE WHEN i < n THEN 1 ELSE 0 END AS INTEGER) AS start,
    CAST(sum(length(line) + CASE WHEN i < n THEN 1 ELSE 0 END) OVER w AS INTEGER) AS "end"
  FROM l0 WHERE NOT (i = n AND line = '') WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING))"""
_LEVEL = "CAST(length({0}) - length(ltrim({0}, '#')) AS INTEGER)"
_HEAD = "(starts_with(s, '#') AND NOT starts_with(s, '#[['))"
_BODY = f"""{_LINES}, b0 AS (
  SELECT *, {_HEAD} AS head, CAST(sum(CASE WHEN {_HEAD} THEN 1 ELSE 0 END) OVER w AS INTEGER) AS section,
    last_value(CASE WHEN {_HEAD} THEN s END IGNORE NULLS) OVER w AS title
  FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING)),
body AS (SELECT *, {_LEVEL.format("title")} AS level FROM b0 WHERE NOT head)"""
_TYPED = f"""{_BODY}, f0 AS (
  SELECT *, starts_with(s, '```') AS fence, sum(CASE WHEN starts_with(s, '```') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, section ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS fences FROM body),
f1 AS (SELECT *, CASE WHEN fence OR fences % 2 = 1 THEN 'code' WHEN starts_with(s, '|') THEN 'table' ELSE 'text' END AS chunk_type FROM f0),
f2 AS (SELECT *, (fence AND fences % 2 = 1) OR chunk_type IS DISTINCT FROM lag(chunk_type) OVER (PARTITION BY doc_id, section ORDER BY line_no) AS turn FROM f1),
f3 AS (SELECT *, sum(CASE WHEN turn THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, section ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS run FROM f2),
f4 AS (SELECT *, max(CASE WHEN s <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, section, run) AS filled FROM f3),
f5 AS (SELECT *, CASE WHEN chunk_type = 'text' AND filled = 0 THEN min(CASE WHEN chunk_type = 'text' AND filled = 1 THEN run END) OVER (PARTITION BY doc_id, section ORDER BY line_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) ELSE run END AS run2 FROM f4),
f6 AS (SELECT doc_id, section, run2, min(title) AS title, min(level) AS level, min(chunk_type) AS chunk_type, string_agg(line||chr(10), '' ORDER BY line_no) AS content FROM f5 WHERE run2 IS NOT NULL GROUP BY ALL),
typed AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY section, run2) - 1 AS INTEGER) AS ord, title, level, chunk_type, content FROM f6 WHERE {_strip("content")} <> '')"""
_UUID = """substr(h,1,12)||'5'||substr(h,14,3)||translate(substr(h,17,1),'0123456789abcdef','89ab89ab89ab89ab')||substr(h,18,15)"""
_IDS = f"""{_TYPED}, h0 AS (SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(doc_id||'||'||CAST(ord AS VARCHAR))) AS h FROM typed),
c AS (SELECT doc_id, ord, title, level, chunk_type, content, {_UUID} AS chunk_id FROM h0)"""
_RUNS = f"""{_IDS}, r0 AS (SELECT *, CASE WHEN lag(ord) OVER w IS NULL OR title IS DISTINCT FROM lag(title) OVER w OR level IS DISTINCT FROM lag(level) OVER w THEN 1 ELSE 0 END AS turn FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY ord)),
r AS (SELECT *, sum(turn) OVER (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS run FROM r0)"""
_HEADS = f"""{_RUNS}, g AS (SELECT doc_id, run, min(level) AS level, min(title) AS title, max_by(chunk_id, ord) AS last_id FROM r WHERE title IS NOT NULL GROUP BY doc_id, run)"""
_TOK = "CAST(ceil(length({0}) / 4.0) AS INTEGER)"
_BLOCKS = f"""{_LINES}, k0 AS (SELECT *, CASE WHEN s = '' THEN 'blank' WHEN starts_with(s, '|') THEN 'table' ELSE 'text' END AS kind FROM l),
k1 AS (SELECT *, CASE WHEN kind <> 'blank' AND kind <> coalesce(lag(kind) OVER (PARTITION BY doc_id ORDER BY line_no), 'blank') THEN 1 ELSE 0 END AS opens FROM k0),
k2 AS (SELECT *, greatest(sum(opens) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING), 1) - 1 AS block_no FROM k1),
blk AS (SELECT k2.doc_id, CAST(block_no AS INTEGER) AS block_no, min(start) AS start, max("end") AS "end", max(CASE WHEN kind <> 'blank' THEN kind END) AS type FROM k2 GROUP BY ALL HAVING max(CASE WHEN kind <> 'blank' THEN 1 ELSE 0 END) = 1),
bt AS (SELECT blk.*, substr(markdown, start + 1, "end" - start) AS text, {_TOK.format('substr(markdown, start + 1, "end" - start)')} AS tokens FROM blk JOIN md USING (doc_id))"""
_WINDOWS = f"""WITH RECURSIVE {_BLOCKS}, step AS (
  SELECT doc_id, -1 AS i, 0 AS from_, 0 AS tok, 0 AS n, 0 AS last, CAST([] AS STRUCT(a INTEGER, b INTEGER, t INTEGER, o BOOLEAN)[]) AS done FROM (SELECT DISTINCT doc_id FROM bt)
  UNION ALL
  SELECT step.doc_id, step.i + 1,
    CASE WHEN bt.tokens > 400 AND bt.type = 'table' THEN bt."end" WHEN step.n > 0 AND step.tok + bt.tokens > 400 THEN bt.start ELSE step.from_ END,
    CASE WHEN bt.tokens > 400 AND bt.type = 'table' THEN 0 WHEN step.n > 0 AND step.tok + bt.tokens > 400 THEN bt.tokens ELSE step.tok + bt.tokens END,
    CASE WHEN bt.tokens > 400 AND bt.type = 'table' THEN 0 WHEN step.n > 0 AND step.tok + bt.tokens > 400 THEN 1 ELSE step.n + 1 END,
    bt."end",
    list_concat(list_concat(step.done,
      CASE WHEN step.n > 0 AND (step.tok + bt.tokens > 400 OR (bt.tokens > 400 AND bt.type = 'table')) THEN [{{'a': step.from_, 'b': bt.start, 't': step.tok, 'o': false}}] ELSE [] END),
      CASE WHEN bt.tokens > 400 AND bt.type = 'table' THEN [{{'a': bt.start, 'b': bt."end", 't': bt.tokens, 'o': true}}] ELSE [] END)
  FROM step JOIN bt ON bt.doc_id = step.doc_id AND bt.block_no = step.i + 1),
ended AS (SELECT doc_id, CASE WHEN n > 0 THEN list_append(done, {{'a': from_, 'b': last, 't': tok, 'o': false}}) ELSE done END AS ws FROM step QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY i DESC) = 1),
win AS (SELECT doc_id, CAST(j - 1 AS INTEGER) AS window_index, w.a AS start, w.b AS "end", w.t AS token_count, w.o AS oversized FROM (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS j FROM ended))"""
_SENTENCES = """CASE WHEN len(sent) <= 1 AND ceil(length('head'||chr(10)||text) / 4.0) > 100 THEN list_filter(string_split(text, chr(10)), lambda x: {0} <> '') ELSE sent END"""
_MERGE = f"""WITH RECURSIVE {_TYPED}, m0 AS (
  SELECT *, CASE WHEN lag(ord) OVER w IS NULL OR title IS DISTINCT FROM lag(title) OVER w OR level IS DISTINCT FROM lag(level) OVER w OR chunk_type IS DISTINCT FROM lag(chunk_type) OVER w THEN 1 ELSE 0 END AS turn,
    {_strip("ltrim(coalesce(title,''), '#')")} AS prefix FROM typed WINDOW w AS (PARTITION BY doc_id ORDER BY ord)),
m1 AS (SELECT *, CAST(ceil(length(CASE WHEN prefix <> '' THEN prefix||chr(10)||content ELSE content END) / 4.0) AS INTEGER) AS tok FROM m0),
fold AS (
  SELECT doc_id, ord, tok, tok AS held, 0 AS part FROM m1 WHERE ord = 0
  UNION ALL
  SELECT m1.doc_id, m1.ord, m1.tok,
    CASE WHEN m1.turn = 1 OR m1.chunk_type = 'code' OR (fold.held >= 40 AND m1.tok >= 40) OR fold.held + m1.tok > 150 THEN m1.tok ELSE fold.held + m1.tok END,
    fold.part + CASE WHEN m1.turn = 1 OR m1.chunk_type = 'code' OR (fold.held >= 40 AND m1.tok >= 40) OR fold.held + m1.tok > 150 THEN 1 ELSE 0 END
  FROM fold JOIN m1 ON m1.doc_id = fold.doc_id AND m1.ord = fold.ord + 1)"""
_ORDERS = """o AS (SELECT o_custkey AS id, o_orderkey, o_orderstatus FROM orders),
old AS (SELECT * FROM o WHERE o_orderstatus = 'F' QUALIFY row_number() OVER (PARTITION BY id ORDER BY o_orderkey DESC) = 1),
new AS (SELECT * FROM o WHERE o_orderstatus = 'O' QUALIFY row_number() OVER (PARTITION BY id ORDER BY o_orderkey DESC) = 1)"""

_OPEN = f"""win2 AS (
  SELECT doc_id, 0 AS window_index, 0 AS start, length(markdown) AS "end", {_TOK.format("markdown")} AS token_count, false AS oversized FROM md WHERE {_TOK.format("markdown")} <= 300
  UNION ALL SELECT win.* FROM win JOIN md USING (doc_id) WHERE {_TOK.format("markdown")} > 300),
hd AS (SELECT doc_id, start, s AS title, {_LEVEL.format("s")} AS level FROM l WHERE {_HEAD}),
live AS (SELECT w.doc_id, w.window_index, h.level, h.title FROM win2 w JOIN hd h ON h.doc_id = w.doc_id AND h.start < w.start
  WHERE NOT EXISTS (SELECT 1 FROM hd k WHERE k.doc_id = w.doc_id AND k.start > h.start AND k.start < w.start AND k.level <= h.level)),
paths AS (SELECT doc_id, window_index, string_agg({_strip("ltrim(title, '#')")}, '>' ORDER BY level) AS path FROM live GROUP BY ALL)"""
_OFFERED = f"""{_BLOCKS}, o0 AS (SELECT bt.doc_id, attempt, block_no AS chunk_index, start, "end", type, (CAST(bt.doc_id AS BIGINT) + attempt) % 7 AS f FROM bt, range(1, 4) AS t(attempt)),
o1 AS (SELECT doc_id, attempt, chunk_index, start, CASE WHEN f = 3 AND chunk_index = 1 THEN "end" + 5 WHEN f = 4 AND chunk_index = 0 THEN start + 1 ELSE "end" END AS e,
  CASE WHEN f = 2 AND chunk_index = 0 THEN 'list' ELSE type END AS kind, f = 5 AND chunk_index = 0 AS lacks FROM o0 WHERE f > 1),
o2 AS (SELECT o1.*, markdown, e <= length(markdown) AND start < e AS inside, substr(markdown, CAST(start + 1 AS BIGINT), CAST(e - start AS BIGINT)) AS own FROM o1 JOIN md USING (doc_id)),
o3 AS (SELECT doc_id, attempt, chunk_index, kind, lacks, inside, markdown,
  CASE WHEN inside AND {_strip("own")} <> '' THEN start + length(own) - length(ltrim(own, {_WS})) ELSE start END AS s2,
  CASE WHEN inside AND {_strip("own")} <> '' THEN e - length(own) + length(rtrim(own, {_WS})) ELSE e END AS e2 FROM o2),
o4 AS (SELECT *, lag(e2) OVER w > s2 AS overlap, CASE WHEN lead(s2) OVER w - e2 BETWEEN 1 AND 3 THEN lead(s2) OVER w ELSE e2 END AS e3 FROM o3 WINDOW w AS (PARTITION BY doc_id, attempt ORDER BY s2, e2, chunk_index)),
o5 AS (SELECT *, inside AND ceil(length(substr(markdown, CAST(s2 + 1 AS BIGINT), CAST(e3 - s2 AS BIGINT))) / 4.0) > 165 AS large FROM o4),
o6 AS (SELECT doc_id, attempt, markdown, coalesce(lag(e3) OVER (PARTITION BY doc_id, attempt ORDER BY s2, e2, chunk_index), 0) AS a, s2 AS b FROM o5 WHERE inside
  UNION ALL SELECT doc_id, attempt, markdown, max(e3), length(markdown) FROM o5 WHERE inside GROUP BY ALL),
holes AS (SELECT DISTINCT doc_id, attempt FROM o6 WHERE a < b AND {_strip("substr(markdown, CAST(a + 1 AS BIGINT), CAST(b - a AS BIGINT))")} <> ''),
per AS (SELECT doc_id, attempt, max(lacks) AS m, max(kind NOT IN ('text','code','table')) AS k, max(NOT inside) AS r, coalesce(max(overlap), false) AS o, max(large) AS g FROM o5 GROUP BY doc_id, attempt),
verdict AS (SELECT per.doc_id, per.attempt, CASE WHEN m THEN 'missing keys' WHEN k OR r THEN concat_ws(',', CASE WHEN k THEN 'bad type' END, CASE WHEN r THEN 'bad range' END) WHEN o THEN 'overlap'
    ELSE concat_ws(',', CASE WHEN holes.doc_id IS NOT NULL THEN 'uncovered' END, CASE WHEN g THEN 'too large' END) END AS reasons FROM per LEFT JOIN holes USING (doc_id, attempt)
  UNION ALL SELECT DISTINCT doc_id, attempt, CASE WHEN f = 0 THEN 'bad json' ELSE 'missing chunks' END FROM o0 WHERE f <= 1)"""

_PARAGRAPHS = f"""WITH RECURSIVE {_LINES}, n0 AS (SELECT *, s = '' AS blank, starts_with(s, '```') AS fence FROM l),
p0 AS (
  SELECT doc_id, -1 AS line_no, false AS inside, false AS fenced, 0 AS pid, NULL::INTEGER AS own FROM md
  UNION ALL
  SELECT n0.doc_id, n0.line_no,
    CASE WHEN p0.inside AND p0.fenced AND fence THEN false WHEN (NOT p0.inside OR (NOT p0.fenced AND (blank OR fence))) THEN NOT blank ELSE p0.inside END,
    CASE WHEN p0.inside AND p0.fenced AND fence THEN false WHEN (NOT p0.inside OR (NOT p0.fenced AND (blank OR fence))) THEN fence AND NOT blank ELSE p0.fenced END,
    p0.pid + CASE WHEN NOT (p0.inside AND p0.fenced) AND (NOT p0.inside OR blank OR fence) AND NOT blank THEN 1 ELSE 0 END,
    CASE WHEN NOT (p0.inside AND p0.fenced) AND (NOT p0.inside OR blank OR fence) THEN CASE WHEN blank THEN NULL ELSE p0.pid + 1 END ELSE p0.pid END
  FROM p0 JOIN n0 ON n0.doc_id = p0.doc_id AND n0.line_no = p0.line_no + 1),
q0 AS (SELECT n0.*, own, row_number() OVER (PARTITION BY n0.doc_id ORDER BY n0.line_no) AS j FROM p0 JOIN n0 ON n0.doc_id = p0.doc_id AND n0.line_no = p0.line_no WHERE own IS NOT NULL),
q1 AS (SELECT doc_id, own, max("end") - min(start) > 1200 AND NOT (min_by(fence, line_no) OR 2 * count(*) FILTER (starts_with(s, '|')) >= count(*) FILTER (NOT blank)) AS long FROM q0 GROUP BY doc_id, own),
q2 AS (SELECT q0.*, long FROM q0 JOIN q1 USING (doc_id, own)),
c0 AS (
  SELECT doc_id, j, own, start AS from_, 0 AS piece FROM q2 WHERE j = 1
  UNION ALL
  SELECT q2.doc_id, q2.j, q2.own, CASE WHEN q2.own <> c0.own OR (q2.long AND q2."end" - c0.from_ > 1200) THEN q2.start ELSE c0.from_ END,
    c0.piece + CASE WHEN q2.own <> c0.own OR (q2.long AND q2."end" - c0.from_ > 1200) THEN 1 ELSE 0 END
  FROM c0 JOIN q2 ON q2.doc_id = c0.doc_id AND q2.j = c0.j + 1),
d0 AS (SELECT c0.doc_id, piece, min(q2.start) AS a, max(q2."end") AS b, min_by(fence, q2.line_no) OR (2 * count(*) FILTER (starts_with(s, '|')) >= count(*) FILTER (NOT blank) AND count(*) FILTER (NOT blank) > 0) AS atomic
  FROM c0 JOIN q2 ON q2.doc_id = c0.doc_id AND q2.j = c0.j GROUP BY c0.doc_id, piece),
e0 AS (
  SELECT doc_id, piece, a AS from_, b AS to_, atomic, 0 AS grp FROM d0 WHERE piece = 0
  UNION ALL
  SELECT d0.doc_id, d0.piece, CASE WHEN NOT d0.atomic AND NOT e0.atomic AND e0.to_ - e0.from_ < 400 AND d0.b - e0.from_ <= 1200 THEN e0.from_ ELSE d0.a END, d0.b,
    d0.atomic, e0.grp + CASE WHEN NOT d0.atomic AND NOT e0.atomic AND e0.to_ - e0.from_ < 400 AND d0.b - e0.from_ <= 1200 THEN 0 ELSE 1 END
  FROM e0 JOIN d0 ON d0.doc_id = e0.doc_id AND d0.piece = e0.piece + 1),
g0 AS (SELECT doc_id, grp, min(from_) AS a, max(to_) AS b, max(atomic) AS atomic FROM e0 GROUP BY doc_id, grp),
g1 AS (SELECT *, lead(grp) OVER w IS NULL AND lag(grp) OVER w IS NOT NULL AND b - a < 400 AND NOT atomic AND NOT lag(atomic) OVER w AND b - lag(a) OVER w <= 1200 AS joins FROM g0 WINDOW w AS (PARTITION BY doc_id ORDER BY grp)),
para AS (SELECT doc_id, CAST(grp - CASE WHEN joins THEN 1 ELSE 0 END AS INTEGER) AS paragraph_id, min(a) AS start, max(b) AS "end" FROM g1 GROUP BY ALL)"""
_RULE = _MERGE.replace(_TYPED, _TYPED.replace("typed AS (", "typed0 AS (") + f""", ov AS (SELECT *, {_strip("ltrim(coalesce(title,''), '#')")} AS prefix FROM typed0),
ov1 AS (SELECT *, ceil(length(prefix||chr(10)||content) / 4.0) > 150 AND chunk_type <> 'code' AS over_ FROM ov),
ov2 AS (SELECT *, string_split(regexp_replace({_strip("content")}, '([.?!])\\s+', '\\1'||chr(1), 'g'), chr(1)) AS sent FROM ov1 WHERE over_ AND chunk_type = 'text'),
ov3 AS (SELECT doc_id, ord, prefix, CASE WHEN len(sent) <= 1 THEN list_filter(string_split(content, chr(10)), lambda x: {_strip("x")} <> '') ELSE sent END AS items FROM ov2),
sp AS (SELECT doc_id, ord, prefix, items, 0 AS i, CAST([] AS VARCHAR[]) AS done, '' AS now FROM ov3
  UNION ALL
  SELECT doc_id, ord, prefix, items, i + 1, CASE WHEN fits OR now = '' THEN done ELSE list_append(done, now) END, CASE WHEN fits THEN joined ELSE items[i + 1] END
  FROM (SELECT *, CASE WHEN now <> '' THEN {_strip("now||' '||items[i + 1]")} ELSE items[i + 1] END AS joined,
    ceil(length(prefix||chr(10)||CASE WHEN now <> '' THEN {_strip("now||' '||items[i + 1]")} ELSE items[i + 1] END) / 4.0) <= 150 AS fits FROM sp WHERE i < len(items))),
sp1 AS (SELECT doc_id, ord, CASE WHEN now <> '' THEN list_append(done, now) ELSE done END AS p FROM sp WHERE i = len(items)),
tb0 AS (SELECT doc_id, ord, prefix, list_filter(string_split(content, chr(10)), lambda x: {_strip("x")} <> '') AS rows_ FROM ov1 WHERE over_ AND chunk_type = 'table'),
tb AS (SELECT doc_id, ord, prefix, rows_[1]||chr(10)||rows_[2] AS top, rows_[3:] AS body, 0 AS i, 0 AS n, CAST([] AS VARCHAR[]) AS done, rows_[1]||chr(10)||rows_[2] AS now FROM tb0 WHERE len(rows_) > 2
  UNION ALL
  SELECT doc_id, ord, prefix, top, body, i + 1, CASE WHEN fits THEN n + 1 ELSE 1 END, CASE WHEN fits OR n = 0 THEN done ELSE list_append(done, now) END, CASE WHEN fits THEN now ELSE top END||chr(10)||body[i + 1]
  FROM (SELECT *, ceil(length(prefix||chr(10)||now||chr(10)||body[i + 1]) / 4.0) <= 150 AS fits FROM tb WHERE i < len(body))),
tb1 AS (SELECT doc_id, ord, list_append(done, now) AS q FROM tb WHERE i = len(body)),
pieces AS (SELECT ov1.doc_id, ov1.ord, title, level, chunk_type, unnest(coalesce(p, q, [content])) AS content, unnest(range(len(coalesce(p, q, [content])))) AS j FROM ov1 LEFT JOIN sp1 USING (doc_id, ord) LEFT JOIN tb1 USING (doc_id, ord)),
typed AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY ord, j) - 1 AS INTEGER) AS ord, title, level, chunk_type, content FROM pieces)""")


def _inner(sql: str, source: str) -> str:
    """The same chain over another table of markdown texts."""
    return sql.replace(_MD, f"md AS ({source})")


# The whole plan with small budgets (chunks 150, least 40, windows 400, threshold 300) and a chunk for each block as proposal.
_ASSEMBLED = f"""{_WINDOWS}, {_OPEN},
w AS (SELECT win2.doc_id, window_index, oversized, md.source, substr(markdown, start + 1, "end" - start) AS text, win2.doc_id||':'||CAST(window_index AS VARCHAR) AS k FROM win2 JOIN md USING (doc_id)),
wb AS (WITH {_inner(_BLOCKS, "SELECT k AS doc_id, text AS markdown FROM w WHERE NOT oversized")} SELECT bt.doc_id AS k, block_no, start AS s, "end" AS e, type, markdown, substr(markdown, start + 1, "end" - start) AS own FROM bt JOIN md USING (doc_id)),
t0 AS (SELECT k, block_no, type, markdown, s + length(own) - length(ltrim(own, {_WS})) AS s2, e - length(own) + length(rtrim(own, {_WS})) AS e2 FROM wb),
t1 AS (SELECT *, CASE WHEN lead(s2) OVER v - e2 BETWEEN 1 AND 3 THEN lead(s2) OVER v ELSE e2 END AS e3, row_number() OVER v - 1 AS chunk_index FROM t0 WINDOW v AS (PARTITION BY k ORDER BY s2, e2, block_no)),
t2 AS (SELECT k, chunk_index, type, substr(markdown, CAST(s2 + 1 AS BIGINT), CAST(e3 - s2 AS BIGINT)) AS content FROM t1),
bad AS (SELECT DISTINCT k FROM t2 WHERE ceil(length(content) / 4.0) > 165),
fb AS ({_inner(_RULE, "SELECT w.k AS doc_id, text AS markdown FROM w JOIN bad USING (k)")}
  SELECT m1.doc_id AS k, part AS chunk_index, min(title) AS title, min(level) AS level, min(chunk_type) AS chunk_type, string_agg(content, '' ORDER BY m1.ord) AS content FROM m1 JOIN fold ON fold.doc_id = m1.doc_id AND fold.ord = m1.ord GROUP BY m1.doc_id, part),
ch AS (SELECT w.doc_id, window_index, source, chunk_index, '' AS title, CAST(NULL AS INTEGER) AS level, type AS chunk_type, content, 'agent' AS producer FROM t2 JOIN w USING (k) WHERE k NOT IN (SELECT k FROM bad)
  UNION ALL SELECT w.doc_id, window_index, source, chunk_index, title, level, chunk_type, content, 'fallback' FROM fb JOIN w USING (k)
  UNION ALL SELECT w.doc_id, window_index, source, 0, coalesce((SELECT max_by({_strip("ltrim(title, '#')")}, level) FROM live WHERE live.doc_id = w.doc_id AND live.window_index = w.window_index), 'Oversized block'), NULL, 'table', text, 'agent' FROM w WHERE oversized),
a0 AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY window_index, chunk_index) - 1 AS INTEGER) AS ord, nullif({_strip("ltrim(coalesce(title, ''), '#')")}, '') AS bare FROM ch),
a1 AS (SELECT *, bare IS NOT NULL AND coalesce(level, 0) > 0 AS head,
  sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(doc_id||'|'||CASE WHEN window_index = 0 THEN '' ELSE CAST(window_index AS VARCHAR) END||'|'||CAST(row_number() OVER (PARTITION BY doc_id, window_index ORDER BY ord) - 1 AS VARCHAR))) AS h FROM a0),
a2 AS (SELECT * EXCLUDE (h), {_UUID} AS chunk_id,
  CASE WHEN lag(ord) OVER v IS NULL OR bare IS DISTINCT FROM lag(bare) OVER v OR level IS DISTINCT FROM lag(level) OVER v THEN 1 ELSE 0 END AS turn FROM a1 WINDOW v AS (PARTITION BY doc_id, window_index ORDER BY ord)),
a3 AS (SELECT *, CAST(sum(CASE WHEN head THEN turn ELSE 0 END) OVER (PARTITION BY doc_id, window_index ORDER BY ord ROWS UNBOUNDED PRECEDING) AS INTEGER) AS place FROM a2),
las AS (SELECT doc_id, bare, level, min(ord) AS first, max_by(chunk_id, ord) AS id FROM a3 WHERE head GROUP BY ALL),
s0 AS (SELECT doc_id, window_index, CAST(row_number() OVER (PARTITION BY doc_id, window_index ORDER BY level) AS INTEGER) AS i, nullif({_strip("ltrim(title, '#')")}, '') AS bare FROM live),
s1 AS (SELECT s0.*, coalesce((SELECT min(id) FROM las WHERE las.doc_id = s0.doc_id AND las.bare = s0.bare AND las.level = s0.i), (SELECT min_by(id, first) FROM las WHERE las.doc_id = s0.doc_id AND las.bare = s0.bare)) AS id FROM s0),
hs AS (SELECT doc_id, window_index, place, min(level) AS level, min(bare) AS bare, max_by(chunk_id, ord) AS id FROM a3 WHERE head GROUP BY doc_id, window_index, place
  UNION ALL SELECT doc_id, window_index, i - 1000, i, bare, id FROM s1 WHERE id IS NOT NULL),
pth AS (SELECT a3.doc_id, a3.ord, hs.place, hs.level, hs.bare, hs.id, row_number() OVER (PARTITION BY a3.doc_id, a3.ord ORDER BY hs.place DESC) AS up
  FROM a3 JOIN hs ON hs.doc_id = a3.doc_id AND hs.window_index = a3.window_index AND hs.place <= a3.place
  WHERE NOT EXISTS (SELECT 1 FROM hs k WHERE k.doc_id = a3.doc_id AND k.window_index = a3.window_index AND k.place > hs.place AND k.place <= a3.place AND k.level <= hs.level)),
par AS (SELECT a3.doc_id, a3.ord, min(pth.id) AS parent_chunk_id FROM a3 JOIN pth ON pth.doc_id = a3.doc_id AND pth.ord = a3.ord AND pth.up = CASE WHEN a3.head THEN 2 ELSE 1 END GROUP BY ALL),
nam AS (SELECT pth.doc_id, pth.ord, pth.place, pth.bare, coalesce(las.id, pth.id) AS id FROM pth LEFT JOIN las ON las.doc_id = pth.doc_id AND las.bare = pth.bare AND las.level = pth.level),
one AS (SELECT doc_id, ord, id, min(place) AS place, min_by(bare, place) AS bare FROM nam GROUP BY doc_id, ord, id),
chn AS (SELECT doc_id, ord, list(bare ORDER BY place) AS chain FROM one GROUP BY doc_id, ord),
a4 AS (SELECT a3.*, coalesce(chain, CAST([] AS VARCHAR[])) AS chain, parent_chunk_id FROM a3 LEFT JOIN chn USING (doc_id, ord) LEFT JOIN par USING (doc_id, ord)),
asm AS (SELECT *, lag(chunk_id) OVER v AS prev_chunk_id, lead(chunk_id) OVER v AS next_chunk_id, CAST(count(*) OVER (PARTITION BY doc_id, chain, bare, level, chunk_type) - 1 AS INTEGER) AS n_siblings, CAST(len(chain) AS INTEGER) AS depth,
  {_strip("regexp_extract(source, '[^/]*$')")}||CASE WHEN len(chain) > 0 THEN ' > '||array_to_string(chain, ' > ') ELSE '' END||chr(10)||content AS embedding_text FROM a4 WINDOW v AS (PARTITION BY doc_id ORDER BY ord))"""

ORACLE: dict[str, str] = {
    "lines": f'WITH {_LINES} SELECT doc_id, line_no, start, "end", length(line) AS size FROM l',
    "headings": f"WITH {_LINES} SELECT doc_id, line_no, start, s AS title, {_LEVEL.format('s')} AS level FROM l WHERE {_HEAD}",
    "sections": f"WITH {_BODY}, z AS (SELECT doc_id, section, min(title) AS title, min(level) AS level, string_agg(line||chr(10), '' ORDER BY line_no) AS content FROM body GROUP BY doc_id, section) SELECT doc_id, section, title, level, md5(content) AS digest FROM z WHERE {_strip('content')} <> ''",
    "typed_blocks": f"WITH {_TYPED} SELECT doc_id, ord, title, level, chunk_type, md5(content) AS digest FROM typed",
    "chunk_ids": f"WITH {_IDS} SELECT doc_id, ord, chunk_id FROM c",
    "seq_links": f"WITH {_IDS} SELECT doc_id, ord, lag(chunk_id) OVER w AS prev_chunk_id, lead(chunk_id) OVER w AS next_chunk_id FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY ord)",
    "siblings": f"WITH {_RUNS} SELECT a.doc_id, a.ord, coalesce(string_agg(b.chunk_id, ',' ORDER BY b.ord), '') AS siblings FROM r a LEFT JOIN r b ON a.doc_id = b.doc_id AND a.run = b.run AND a.ord <> b.ord GROUP BY a.doc_id, a.ord",
    "parents": f"WITH {_HEADS} SELECT r.doc_id, r.ord, max_by(g.last_id, g.run) AS parent_chunk_id FROM r LEFT JOIN g ON r.title IS NOT NULL AND g.doc_id = r.doc_id AND g.run < r.run AND g.level < r.level GROUP BY r.doc_id, r.ord",
    "title_paths": f"""WITH {_HEADS}, lastid AS (SELECT doc_id, title, level, max_by(chunk_id, ord) AS id FROM r WHERE title IS NOT NULL GROUP BY ALL),
live AS (SELECT r.doc_id, r.ord, g.run, g.level, g.title FROM r JOIN g ON g.doc_id = r.doc_id AND g.run <= r.run
  WHERE NOT EXISTS (SELECT 1 FROM g k WHERE k.doc_id = r.doc_id AND k.run > g.run AND k.run <= r.run AND k.level <= g.level)),
named AS (SELECT live.doc_id, live.ord, string_agg(lastid.id||'='||{_strip("ltrim(live.title, '#')")}, '>' ORDER BY live.level) AS path FROM live JOIN lastid USING (doc_id, title, level) GROUP BY live.doc_id, live.ord)
SELECT r.doc_id, r.ord, coalesce(path, '') AS path FROM r LEFT JOIN named USING (doc_id, ord)""",
    "blocks": f'WITH {_BLOCKS} SELECT doc_id, block_no, start, "end", type, tokens FROM bt',
    "window_packing": f"{_WINDOWS} SELECT * FROM win",
    "leading_paths": f"""{_WINDOWS}, {_OPEN} SELECT win2.*, coalesce(path, '') AS path FROM win2 LEFT JOIN paths USING (doc_id, window_index)""",
    "validation": f"WITH {_OFFERED} SELECT doc_id, CAST(attempt AS INTEGER) AS attempt, reasons = '' AS is_valid, reasons FROM verdict",
    "gap_snap": f'WITH {_OFFERED} SELECT doc_id, CAST(attempt AS INTEGER) AS attempt, chunk_index, CAST(s2 AS BIGINT) AS start, CAST(e3 AS BIGINT) AS "end", kind AS chunk_type FROM o5',
    "first_valid_attempt": f"WITH {_OFFERED} SELECT doc_id, 0 AS window_index, CAST(min(attempt) AS INTEGER) AS attempt FROM verdict WHERE reasons = '' GROUP BY doc_id",
    "fallback_windows": f"WITH {_OFFERED} SELECT doc_id, 0 AS window_index FROM md WHERE doc_id NOT IN (SELECT doc_id FROM verdict WHERE reasons = '')",
    "sentence_pack": f"""WITH RECURSIVE s0 AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s1 AS (SELECT doc_id, text, string_split(regexp_replace({_strip("text")}, '([.?!])\\s+', '\\1'||chr(1), 'g'), chr(1)) AS sent FROM s0),
s2 AS (SELECT doc_id, {_SENTENCES.format(_strip("x"))} AS items FROM s1),
step AS (SELECT doc_id, items, 0 AS i, CAST([] AS VARCHAR[]) AS done, '' AS now FROM s2
  UNION ALL
  SELECT doc_id, items, i + 1, CASE WHEN fits OR now = '' THEN done ELSE list_append(done, now) END, CASE WHEN fits THEN joined ELSE items[i + 1] END
  FROM (SELECT *, CASE WHEN now <> '' THEN {_strip("now||' '||items[i + 1]")} ELSE items[i + 1] END AS joined,
    ceil(length('head'||chr(10)||CASE WHEN now <> '' THEN {_strip("now||' '||items[i + 1]")} ELSE items[i + 1] END) / 4.0) <= 100 AS fits FROM step WHERE i < len(items))),
fin AS (SELECT doc_id, CASE WHEN now <> '' THEN list_append(done, now) ELSE done END AS p FROM step WHERE i = len(items))
SELECT doc_id, CAST(len(p) AS INTEGER) AS n_pieces, md5(array_to_string(p, '|')) AS digest FROM fin""",
    "table_pack": """WITH RECURSIVE t AS (SELECT c_nationkey, list('| '||c_name||' | '||c_mktsegment||' |' ORDER BY c_custkey) AS rows_ FROM customer GROUP BY 1),
step AS (SELECT c_nationkey, rows_, 0 AS i, 0 AS n, CAST([] AS VARCHAR[]) AS done, '| name | segment |'||chr(10)||'| --- | --- |' AS now FROM t
  UNION ALL
  SELECT c_nationkey, rows_, i + 1, CASE WHEN fits THEN n + 1 ELSE 1 END, CASE WHEN fits OR n = 0 THEN done ELSE list_append(done, now) END,
    CASE WHEN fits THEN now||chr(10)||rows_[i + 1] ELSE '| name | segment |'||chr(10)||'| --- | --- |'||chr(10)||rows_[i + 1] END
  FROM (SELECT *, ceil(length('customers'||chr(10)||now||chr(10)||rows_[i + 1]) / 4.0) <= 120 AS fits FROM step WHERE i < len(rows_)))
SELECT c_nationkey, CAST(len(done) + 1 AS INTEGER) AS n_pieces, md5(array_to_string(list_append(done, now), '#')) AS digest FROM step WHERE i = len(rows_)""",
    "run_merge": f"""{_MERGE} SELECT m1.doc_id, CAST(part AS INTEGER) AS ord, min(title) AS title, min(level) AS level, min(chunk_type) AS chunk_type, md5(string_agg(content, '' ORDER BY m1.ord)) AS digest FROM m1 JOIN fold ON fold.doc_id = m1.doc_id AND fold.ord = m1.ord GROUP BY m1.doc_id, part""",
    "rule_chunks": f"""{_RULE} SELECT m1.doc_id, CAST(part AS INTEGER) AS ord, min(title) AS title, min(level) AS level, min(chunk_type) AS chunk_type, md5(string_agg(content, '' ORDER BY m1.ord)) AS digest FROM m1 JOIN fold ON fold.doc_id = m1.doc_id AND fold.ord = m1.ord GROUP BY m1.doc_id, part""",
    "paragraph_spans": f'{_PARAGRAPHS} SELECT doc_id, paragraph_id, start, "end" FROM para',
    "proposal_offsets": f"""{_PARAGRAPHS}, pr AS (SELECT doc_id, CAST(paragraph_id // 2 AS INTEGER) AS chunk_index, min(paragraph_id) AS a, max(paragraph_id) AS b, CAST(doc_id AS BIGINT) % 5 AS k FROM para GROUP BY ALL),
rg AS (SELECT doc_id, chunk_index, CASE WHEN k = 1 AND chunk_index = 1 THEN a + 1 WHEN k = 2 AND chunk_index = 1 THEN a - 1 ELSE a END AS a, CASE WHEN k = 3 AND chunk_index = 0 THEN b + 1000 ELSE b END AS b FROM pr),
ex AS (SELECT *, coalesce(lag(b) OVER w, -1) + 1 AS x, lead(b) OVER w IS NULL AS fin, (SELECT max(paragraph_id) FROM para WHERE para.doc_id = rg.doc_id) AS last_ FROM rg WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_index)),
rs AS (SELECT *, CASE WHEN a < 0 OR b > last_ THEN 'out of range' WHEN a > b THEN 'start after end' WHEN a > x THEN 'gap' WHEN a < x THEN 'overlap' WHEN fin AND b <> last_ THEN 'short tail' END AS reason FROM ex),
er AS (SELECT doc_id, min_by(reason, chunk_index) FILTER (reason IS NOT NULL) AS error FROM rs GROUP BY doc_id)
SELECT rs.doc_id, rs.chunk_index, s.start, e."end", error FROM rs JOIN er USING (doc_id) LEFT JOIN para s ON s.doc_id = rs.doc_id AND s.paragraph_id = rs.a LEFT JOIN para e ON e.doc_id = rs.doc_id AND e.paragraph_id = rs.b""",
    "payload_defaults": f"WITH {_IDS} SELECT chunk_id, chunk_type AS primary_type, chunk_type = 'text' AS has_text, chunk_type = 'code' AS has_code, chunk_type = 'table' AS has_table, true AS no_group, '' AS summary FROM c",
    "retry_routing": "SELECT event_id, contains(lower(concat_ws(' ', event_type, props)), 'rate') OR regexp_matches(concat_ws(' ', event_type, props), '429|500|503') AS retry FROM events",
    "sparse_bm25": """WITH t AS (SELECT doc_id AS id, unnest(list_filter(string_split_regex(lower(coalesce(text,'')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) AS term FROM documents),
c AS (SELECT id, term, count(*) AS tf FROM t GROUP BY ALL), n AS (SELECT id, sum(tf) AS len FROM c GROUP BY 1), a AS (SELECT avg(len) AS mean FROM n)
SELECT c.id, term, tf, round(tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean)), 6) AS weight FROM c JOIN n USING (id) CROSS JOIN a""",
    "topk_cosine": """SELECT q.vec_id AS query_id, v.vec_id, CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])), 9) DESC, v.vec_id) AS INTEGER) AS rank
FROM embeddings q, embeddings v WHERE q.vec_id % 50 = 0 QUALIFY rank <= 5""",
    "upsert_latest": "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1",
    "log_insert": f"WITH {_ORDERS} SELECT * FROM old UNION ALL SELECT * FROM new WHERE id NOT IN (SELECT id FROM old)",
    "log_replace": f"WITH {_ORDERS} SELECT * FROM old WHERE id NOT IN (SELECT id FROM new) UNION ALL SELECT * FROM new WHERE id IN (SELECT id FROM old)",
    "upsert_batches": "SELECT c_nationkey AS collection, c_custkey AS id, CAST((row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 250 AS INTEGER) AS batch FROM customer",
    "message_split": """SELECT conv_id, coalesce(string_agg(text, chr(10)||chr(10) ORDER BY turn) FILTER (role = 'system'), '') AS system, CAST(count(*) FILTER (role IN ('user','assistant')) AS INTEGER) AS n_turns,
md5(coalesce(string_agg(role||':'||coalesce(text,''), '|' ORDER BY turn) FILTER (role IN ('user','assistant')), '')) AS digest FROM conversations GROUP BY conv_id""",
    "html_markdown": f"WITH p AS (SELECT page_id, {duck_html_to_markdown('html')} AS m FROM pages) SELECT page_id, length(m) AS size, md5(m) AS digest FROM p",
    "input_guards": """SELECT conv_id, turn, CASE WHEN turn % 3 = 0 OR coalesce(role,'') = '' THEN 'user_id required' WHEN turn % 2 <> 0 THEN 'doc_id required' WHEN turn % 5 = 0 OR NOT regexp_matches(coalesce(text,''), '\\S') THEN 'empty document' END AS error FROM conversations""",
    "assembled_chunks": f"""{_ASSEMBLED} SELECT doc_id, ord, chunk_id, parent_chunk_id, prev_chunk_id, next_chunk_id, n_siblings, depth, producer, {_TOK.format("embedding_text")} AS token_count, md5(embedding_text) AS digest FROM asm""",
    "embedding_text": f"""{_ASSEMBLED} SELECT chunk_id, CAST(length(embedding_text) AS INTEGER) AS size, md5(embedding_text) AS digest, {_TOK.format("embedding_text")} AS token_count FROM asm""",
    "points": f"""{_ASSEMBLED} SELECT 'user-'||split_part(source, '/', 1) AS collection, chunk_id AS id, doc_id, chunk_type, {_TOK.format("embedding_text")} AS token_count, chunk_type = 'table' AS has_table, depth, md5(content) AS digest, 64 AS vector_size, true AS embed_ok,
  CAST(len(list_distinct(list_filter(string_split_regex(lower(embedding_text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> ''))) AS INTEGER) AS n_terms FROM asm""",
    "job_stream": "",
    "payload_check": f"""{_ASSEMBLED}, ids AS (SELECT chunk_id AS t FROM asm) SELECT count(*) AS n_broken, CAST(NULL AS VARCHAR) AS missing_key, 19 AS n_keys
FROM (SELECT parent_chunk_id AS t FROM asm UNION ALL SELECT prev_chunk_id FROM asm UNION ALL SELECT next_chunk_id FROM asm UNION ALL SELECT id FROM one) x WHERE t IS NOT NULL AND t NOT IN (SELECT t FROM ids)""",
    "job_log": """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id, 'doc'||CAST(o_orderkey AS VARCHAR) AS doc, o_orderstatus <> 'F' AS error, o_orderpriority AS msg,
strftime(o_orderdate + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S') AS start, printf('%02d:%02d:%02d', o_orderkey * 7 // 3600, o_orderkey * 7 % 3600 // 60, o_orderkey * 7 % 60) AS elapsed,
strftime(o_orderdate + INTERVAL 330 MINUTE + to_seconds(o_orderkey * 7), '%Y-%m-%dT%H:%M:%S') AS end_, 'Asia/Kolkata' AS tz FROM orders""",
    "job_messages": """SELECT CAST(o_orderkey AS VARCHAR) AS job_id, CAST(o_custkey AS VARCHAR) AS user_id, CASE o_orderstatus WHEN 'F' THEN 'finished' ELSE 'failed' END AS queue, '{"job_id":"'||CAST(o_orderkey AS VARCHAR)||'"}' AS body, 'embedding' AS stage, o_orderstatus = 'F' AS ok
FROM orders WHERE o_orderstatus IN ('F', 'O')""",
    "dense_vectors": "SELECT doc_id AS id, 64 AS size, true AS embed_ok FROM documents",
}
ORACLE["job_stream"] = ORACLE["points"]  # the stream leaves what the batch does
