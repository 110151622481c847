"""DuckDB SQL that says the same as the queries, written independently of their expressions."""

from __future__ import annotations

SIZE, WORD_CAP, PREFIX_CAP, FORCED_CAP = 96, 9, 60, 7
BARE_PAGE = "<html><head><title>t</title></head><body><nav><a>menu</a></nav><p> <b>&nbsp;</b></p></body></html>"
_W = r"\t-\r\x1c-\x20\x{85}\p{Z}"
_TOKEN = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{_W}]"
_END = rf"([.!?…]+[)\]\"''»]*)(?:[{_W}]+|$)"


def _trim(x: str) -> str:
    return f"regexp_replace({x}, '^[{_W}]+|[{_W}]+$', '', 'g')"


def _tokens(x: str) -> str:
    return f"len(regexp_extract_all({x}, '{_TOKEN}'))"


def _sentences(x: str) -> str:
    return f"list_filter(list_transform(string_split(regexp_replace({x}, '{_END}', '\\1' || chr(1), 'g'), chr(1)), lambda s: {_trim('s')}), lambda s: s <> '')"


def _words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[{_W}]+'), lambda w: w <> '')"


_TITLE = "replace(replace(replace(replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"
_PAGES = f"SELECT page_id::VARCHAR AS page_id, {_trim(_TITLE)} AS title, regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1) AS host, coalesce(url, '') AS url, html FROM pages"

# The grammar of the provided pages is small enough for regular expressions: see the recipe in the survey.
_BODY = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)^.*?<body[^>]*>', ''), '(?s)<nav>.*?</nav>', '', 'g'), '(?s)<footer>.*?(</footer>|$)', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '<br ?/?>', ' ', 'g')"
_BLOCKS = rf"""
b AS (SELECT page_id::VARCHAR AS page_id, {_BODY} AS body FROM pages),
x AS (SELECT page_id, unnest(regexp_extract_all(body, '(?s)<(?:p|h1|div)\b[^>]*>(?:[^<]|</?b>)*')) AS x, generate_subscripts(regexp_extract_all(body, '(?s)<(?:p|h1|div)\b[^>]*>(?:[^<]|</?b>)*'), 1) AS pos FROM b),
y AS (SELECT page_id, pos, regexp_extract(x, '^<([a-z0-9]+)', 1) AS block_type, x LIKE '<div class="ad"%' AS ad,
             trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&'), '[ \t\r\n]+', ' ', 'g')) AS text FROM x),
y1 AS (SELECT *, row_number() OVER (PARTITION BY page_id, block_type ORDER BY pos) AS place FROM y),
z AS (SELECT page_id, block_type, ad, text, place, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS index FROM y1 WHERE text <> '')
"""
_HTML_BLOCKS = f"WITH {_BLOCKS}"
def _lines(source: str = "documents") -> str:
    return f"""
a AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM {source}),
l0 AS (SELECT doc_id, unnest(l) AS text, generate_subscripts(l, 1) AS pos FROM a),
l AS (SELECT doc_id, text, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS i FROM l0 WHERE {_trim('text')} <> '')
"""


_LINES = _lines()
_DOC_BLOCKS = f"""
WITH {_LINES}
SELECT doc_id::VARCHAR AS page_id, i::INT AS index, 'EDU:' || doc_id || '-' || i AS id, text,
       coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS text_offset, length(text)::INT AS text_length FROM l
"""


def _word_runs(source: str, key: str, cap: object) -> str:
    """Recursive next-fit over the words of ``source`` (key, t), ``cap`` a number or a column of it: rows (key, bin, words)."""
    return f"""
ws AS (SELECT {key}, {cap} AS cap, {_words('t')} AS w FROM {source}),
wu AS (SELECT {key}, cap, w, list_transform(w, lambda x: {_tokens('x')}) AS n FROM ws WHERE len(w) > 0),
wf AS (SELECT {key}, 1 AS i, 0 AS bin, n[1] AS used FROM wu
       UNION ALL
       SELECT wf.{key}, i + 1, CASE WHEN used + wu.n[i + 1] > wu.cap THEN bin + 1 ELSE bin END, CASE WHEN used + wu.n[i + 1] > wu.cap THEN wu.n[i + 1] ELSE used + wu.n[i + 1] END
       FROM wf JOIN wu USING ({key}) WHERE i < len(wu.w)),
wr AS (SELECT {key}, bin, string_agg(wu.w[i], ' ' ORDER BY i) AS words, sum(wu.n[i]) AS n FROM wf JOIN wu USING ({key}) GROUP BY {key}, bin)
"""


def _units(size: int) -> str:
    """The sentences of all lines in order, oversized ones as runs of words: u (doc_id, k from 1, t, n)."""
    return f"""
{_LINES},
s0 AS (SELECT doc_id, i, {_sentences('text')} AS s FROM l),
s AS (SELECT row_number() OVER () AS sid, doc_id, i, j, t, {_tokens('t')} AS n FROM (SELECT doc_id, i, unnest(s) AS t, generate_subscripts(s, 1) AS j FROM s0)),
big AS (SELECT sid, t FROM s WHERE n > {size}),
{_word_runs('big', 'sid', size)},
v AS (SELECT doc_id, i, j, 0 AS bin, t, n FROM s WHERE n <= {size} UNION ALL SELECT doc_id, i, j, bin, words, wr.n FROM s JOIN wr USING (sid)),
u AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, j, bin) AS k, i, t, n::BIGINT AS n FROM v)
"""


def _chunks(size: int) -> str:
    """Next-fit over the units: c (doc_id, chunk_no, text, n)."""
    return f"""
{_units(size)},
p AS (SELECT doc_id, list(n ORDER BY k) AS n, list(t ORDER BY k) AS t, list(i ORDER BY k) AS line FROM u GROUP BY doc_id),
f AS (SELECT doc_id, 1 AS k, 0 AS chunk_no, n[1] AS used FROM p
      UNION ALL
      SELECT f.doc_id, k + 1, CASE WHEN used + p.n[k + 1] > {size} THEN chunk_no + 1 ELSE chunk_no END, CASE WHEN used + p.n[k + 1] > {size} THEN p.n[k + 1] ELSE used + p.n[k + 1] END
      FROM f JOIN p USING (doc_id) WHERE k < len(p.n)),
c AS (SELECT doc_id, chunk_no, string_agg(p.t[k], ' ' ORDER BY k) AS text, sum(p.n[k])::BIGINT AS n FROM f JOIN p USING (doc_id) GROUP BY doc_id, chunk_no)
"""


def _parts(size: int, source: str = "documents") -> str:
    """Blocks as chunks see them: b (doc_id, k: unit, i: line, part, t, n, first, last, raw), oversized lines in parts of whole sentences or runs of words."""
    return f"""
{_lines(source)},
s0 AS (SELECT doc_id, i, text AS raw, {_tokens('text')} AS lt, {_sentences('text')} AS s FROM l),
s AS (SELECT row_number() OVER () AS sid, doc_id, i, j, raw, lt, t, {_tokens('t')} AS n FROM (SELECT doc_id, i, raw, lt, unnest(s) AS t, generate_subscripts(s, 1) AS j FROM s0)),
big AS (SELECT sid, t FROM s WHERE n > {size}),
{_word_runs('big', 'sid', size)},
v AS (SELECT doc_id, i, j, 0 AS bin, raw, lt, t, n, true AS whole FROM s WHERE n <= {size} UNION ALL SELECT doc_id, i, j, bin, raw, lt, words, wr.n, false FROM s JOIN wr USING (sid)),
o AS (SELECT doc_id, i, list(n ORDER BY j, bin) AS n, list(whole ORDER BY j, bin) AS whole, list(t ORDER BY j, bin) AS t, any_value(raw) AS raw, any_value(lt) AS lt FROM v GROUP BY doc_id, i),
q AS (SELECT doc_id, i, 1 AS k, 0 AS part, n[1] AS used, NOT whole[1] AS closed FROM o WHERE lt > {size}
      UNION ALL
      SELECT q.doc_id, q.i, k + 1,
             CASE WHEN closed OR NOT o.whole[k + 1] OR used + o.n[k + 1] > {size} THEN part + 1 ELSE part END,
             CASE WHEN closed OR NOT o.whole[k + 1] OR used + o.n[k + 1] > {size} THEN o.n[k + 1] ELSE used + o.n[k + 1] END, NOT o.whole[k + 1]
      FROM q JOIN o USING (doc_id, i) WHERE k < len(o.n)),
b0 AS (SELECT o.doc_id, o.i, q.k, q.part, o.t[q.k] AS t, o.n[q.k] AS n, raw, lt FROM q JOIN o USING (doc_id, i)
       UNION ALL SELECT doc_id, i, unnest(range(1, len(n) + 1)) AS k, 0, unnest(t), unnest(n), raw, lt FROM o WHERE lt <= {size}),
b AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, k) AS k, i, part, t, n::BIGINT AS n, raw, lt,
             row_number() OVER (PARTITION BY doc_id, i, part ORDER BY k) = 1 AS first, row_number() OVER (PARTITION BY doc_id, i, part ORDER BY k DESC) = 1 AS last FROM b0)
"""


def _fragments(size: int, source: str = "documents") -> str:
    """What each chunk holds of each block: g (doc_id, chunk_no, block_index, text, text_offset)."""
    return f"""
{_parts(size, source)},
p AS (SELECT doc_id, list(n ORDER BY k) AS n FROM b GROUP BY doc_id),
f AS (SELECT doc_id, 1 AS k, 0 AS chunk_no, n[1] AS used FROM p
      UNION ALL
      SELECT f.doc_id, k + 1, CASE WHEN used + p.n[k + 1] > {size} THEN chunk_no + 1 ELSE chunk_no END, CASE WHEN used + p.n[k + 1] > {size} THEN p.n[k + 1] ELSE used + p.n[k + 1] END
      FROM f JOIN p USING (doc_id) WHERE k < len(p.n)),
g0 AS (SELECT doc_id, chunk_no, i, part, min(k) AS k, CASE WHEN bool_or(first) AND bool_or(last) AND any_value(lt) = sum(n) THEN any_value(raw) ELSE string_agg(t, ' ' ORDER BY k) END AS text
       FROM b JOIN f USING (doc_id, k) GROUP BY doc_id, chunk_no, i, part),
g AS (SELECT doc_id, chunk_no, text, row_number() OVER w - 1 AS block_index, coalesce(sum(length(text) + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS text_offset
      FROM g0 WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
h AS (SELECT doc_id, chunk_no, 'EDU:' || doc_id || ':' || min(block_index) || '-' || max(block_index) AS chunk_id, min(block_index) AS first_index, min(text_offset) AS text_offset, string_agg(text, ' ' ORDER BY block_index) AS text
      FROM g GROUP BY doc_id, chunk_no)
"""


def _shown(side: str, overlap: int) -> str:
    """What a neighbour shows of a core of words s to e of a document's words w (their running tokens c; first words of blocks b, and of units u): from its end or
    its start whole blocks while they fit, and of the next block the bins of sentences, or of words of longer sentences, that fit; as columns text and n."""
    end = side == "end"
    sums = "c[e] - coalesce(c[x - 1], 0)" if end else "c[x] - coalesce(c[s - 1], 0)"
    # x: the last (first) word of the run of whole blocks; from, upto: the block that is cut
    edges = "list_filter(list_concat([s], b), lambda x: x >= s AND x <= e)" if end else "list_append(list_transform(list_filter(b, lambda x: x > s AND x <= e), lambda x: x - 1), e)"
    fitting = f"list_filter({edges}, lambda x: {sums} <= {overlap})"
    x = f"coalesce(list_min({fitting}), e + 1)" if end else f"coalesce(list_max({fitting}), s - 1)"
    done = "x <= s" if end else "x >= e"
    cut = (
        "list_max(list_filter(list_concat([s], b), lambda y: y >= s AND y < x)) AS a, x - 1 AS z"
        if end
        else "x + 1 AS a, least(e, coalesce(list_min(list_filter(b, lambda y: y > x + 1)) - 1, e)) AS z"
    )
    spare = f"{overlap} - (c[e] - coalesce(c[x - 1], 0))" if end else f"{overlap} - (coalesce(c[x], 0) - coalesce(c[s - 1], 0))"
    unit_n = "c[least(z, coalesce(list_min(list_filter(u, lambda y: y > v)) - 1, z))] - coalesce(c[v - 1], 0)"
    atoms = f"""flatten(list_transform(list_filter(list_distinct(list_concat([a], u)), lambda v: v >= a AND v <= z), lambda v: CASE WHEN {unit_n} <= spare
      THEN [{{'s': v, 'n': {unit_n}, 'k': 0}}]
      ELSE list_transform(range(v, least(z, coalesce(list_min(list_filter(u, lambda y: y > v)) - 1, z)) + 1), lambda j: {{'s': j, 'n': c[j] - coalesce(c[j - 1], 0), 'k': v}}) END))"""
    start = "{'s': 0, 'n': 0::BIGINT, 'k': -1, 'used': 0::BIGINT, 'starts': []::BIGINT[], 'sums': []::BIGINT[]}"
    bins = f"""list_reduce(list_transform(list_sort({atoms}), lambda t: {{'s': t.s::BIGINT, 'n': t.n::BIGINT, 'k': t.k::BIGINT, 'used': 0::BIGINT, 'starts': []::BIGINT[], 'sums': []::BIGINT[]}}),
      lambda acc, t: CASE WHEN len(acc.starts) = 0 OR t.k <> acc.k OR acc.used + t.n > spare
        THEN {{'s': t.s, 'n': t.n, 'k': t.k, 'used': t.n, 'starts': list_append(acc.starts, t.s), 'sums': list_append(acc.sums, t.n)}}
        ELSE {{'s': t.s, 'n': t.n, 'k': t.k, 'used': acc.used + t.n, 'starts': acc.starts, 'sums': list_append(acc.sums[:len(acc.sums) - 1], acc.used + t.n)}} END, {start.replace("'s': 0", "'s': 0::BIGINT").replace("-1", "-1::BIGINT")})"""
    m = "len(list_filter(range(1, len(f.sums) + 1), lambda i: list_sum({}) <= spare))".format("f.sums[len(f.sums) - i + 1:]" if end else "f.sums[:i]")
    piece = (
        "CASE WHEN m = 0 THEN substr(array_to_string(w[f.starts[len(f.starts)]:z], ' '), 1, 200) ELSE array_to_string(w[f.starts[len(f.starts) - m + 1]:z], ' ') END"
        if end
        else "CASE WHEN m = 0 THEN substr(array_to_string(w[a:coalesce(f.starts[2] - 1, z)], ' '), 1, 200) ELSE array_to_string(w[a:coalesce(f.starts[m + 1] - 1, z)], ' ') END"
    )
    whole = "CASE WHEN x <= e THEN array_to_string(w[x:e], ' ') END" if end else "CASE WHEN x >= s THEN array_to_string(w[s:x], ' ') END"
    order = f"concat_ws(' ', piece, {whole})" if end else f"concat_ws(' ', {whole}, piece)"
    return f"""(SELECT {order} AS text FROM (SELECT x, CASE WHEN {done} OR spare <= 0 THEN NULL ELSE {piece} END AS piece FROM (
      SELECT *, {m} AS m FROM (SELECT *, CASE WHEN {done} OR spare <= 0 THEN NULL ELSE {bins} END AS f FROM (
      SELECT *, {cut} FROM (SELECT *, {spare} AS spare FROM (SELECT {x} AS x)))))))"""


def _overlapping(size: int, overlap: int) -> str:
    """Chunks of documents that show up to ``overlap`` tokens of their neighbours: chain (doc_id, no, s, e: first and last word, before)."""
    fill = lambda s, room: f"""coalesce(list_max(list_filter(ends, lambda y: y >= {s} AND c[y] - coalesce(c[{s} - 1], 0) <= {room})),
      list_max(list_filter(range({s}, least(len(w), {s} + {size}) + 1), lambda y: c[y] - coalesce(c[{s} - 1], 0) <= {room})), {s})"""  # noqa: E731
    return f"""
{_parts(max(10, size - 2 * overlap))},
n0 AS (SELECT doc_id, k, i, part, first, {_words('t')} AS t FROM b),
n1 AS (SELECT doc_id, k, i, part, first, unnest(t) AS t, generate_subscripts(t, 1) AS j FROM n0),
n2 AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k, j) AS p, {_tokens('t')} AS n FROM n1),
n3 AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY p)::BIGINT AS c, lead(j) OVER (PARTITION BY doc_id ORDER BY p) IS DISTINCT FROM j + 1 AS final FROM n2),
d AS MATERIALIZED (SELECT doc_id, list(t ORDER BY p) AS w, list(c ORDER BY p) AS c, coalesce(list(p ORDER BY p) FILTER (first AND j = 1), []) AS b, list(p ORDER BY p) FILTER (j = 1) AS u, list(p ORDER BY p) FILTER (final) AS ends FROM n3 GROUP BY doc_id),
chain AS (SELECT doc_id, 0 AS no, 1::BIGINT AS s, {fill("1", size - overlap)}::BIGINT AS e, '' AS before FROM d
      UNION ALL
      SELECT doc_id, no + 1, e + 1, {fill("(e + 1)", f"CASE WHEN free > 0 THEN free ELSE {size - overlap} END")}::BIGINT, CASE WHEN free > 0 THEN shown ELSE '' END
      FROM (SELECT *, {size - overlap} - {_tokens('shown')} AS free FROM (SELECT chain.*, d.* EXCLUDE (doc_id), {_shown("end", overlap)} AS shown FROM chain JOIN d USING (doc_id) WHERE chain.e < len(d.w))))
"""


def _page_chunks(size: int) -> str:
    """Chunks of the provided pages, whose only heading is one h1: room depends on the title's and the heading's tokens."""
    return f"""
{_BLOCKS},
t AS ({_PAGES}),
e AS (SELECT page_id, min(index) AS at, arg_min(text, index) AS head FROM z WHERE block_type = 'h1' GROUP BY page_id),
d AS (SELECT z.page_id, z.index AS i, z.block_type, z.text AS raw, {_tokens('z.text')} AS lt, t.title, t.host, t.url, coalesce(z.index >= e.at, false) AS under, e.head,
             '/body[1]/' || CASE WHEN ad THEN '' ELSE 'article[1]/' END || block_type || '[' || place || ']' AS xpath,
             'body:nth-of-type(1) > ' || CASE WHEN ad THEN 'div.ad' ELSE 'article:nth-of-type(1) > ' || block_type || ':nth-of-type(' || place || ')' END AS css
      FROM z JOIN t USING (page_id) LEFT JOIN e USING (page_id)),
r0 AS (SELECT *, CASE WHEN title <> '' THEN {_tokens("'[PAGE] ' || title")} ELSE 0 END + CASE WHEN under THEN {_tokens("'[SECTION] ' || head")} ELSE 0 END AS tags FROM d),
r1 AS (SELECT *, {size} - CASE WHEN tags > 0 THEN tags + 3 ELSE 0 END AS free FROM r0),
r AS (SELECT *, CASE WHEN free > 0 THEN free ELSE greatest(10, {size // 4}) END AS cap, greatest(free, 10) AS block_cap FROM r1),
s0 AS (SELECT *, CASE WHEN block_type = 'h1' THEN [raw] ELSE {_sentences('raw')} END AS s FROM r),
s AS (SELECT row_number() OVER () AS sid, page_id, i, j, t, {_tokens('t')} AS n, block_type = 'h1' OR lt <= block_cap AS small, block_cap
      FROM (SELECT page_id, i, block_type, lt, block_cap, unnest(s) AS t, generate_subscripts(s, 1) AS j FROM s0)),
big AS (SELECT sid, t, block_cap FROM s WHERE NOT small AND n > block_cap),
{_word_runs('big', 'sid', 'block_cap')},
v AS (SELECT page_id, i, j, 0 AS bin, t, n, true AS whole FROM s WHERE small OR n <= block_cap UNION ALL SELECT page_id, i, j, bin, words, wr.n, false FROM s JOIN wr USING (sid)),
o AS (SELECT page_id, i, list(n ORDER BY j, bin) AS n, list(whole ORDER BY j, bin) AS whole, list(t ORDER BY j, bin) AS t FROM v GROUP BY page_id, i),
q AS (SELECT page_id, i, 1 AS k, 0 AS part, n[1] AS used, NOT whole[1] AS closed FROM o JOIN r USING (page_id, i) WHERE block_type <> 'h1' AND lt > block_cap
      UNION ALL
      SELECT q.page_id, q.i, k + 1,
             CASE WHEN closed OR NOT o.whole[k + 1] OR used + o.n[k + 1] > r.block_cap THEN part + 1 ELSE part END,
             CASE WHEN closed OR NOT o.whole[k + 1] OR used + o.n[k + 1] > r.block_cap THEN o.n[k + 1] ELSE used + o.n[k + 1] END, NOT o.whole[k + 1]
      FROM q JOIN o USING (page_id, i) JOIN r USING (page_id, i) WHERE k < len(o.n)),
b0 AS (SELECT o.page_id, o.i, q.k, q.part, o.t[q.k] AS t, o.n[q.k] AS n FROM q JOIN o USING (page_id, i)
       UNION ALL SELECT page_id, i, unnest(range(1, len(n) + 1)) AS k, 0, unnest(t), unnest(n) FROM o JOIN r USING (page_id, i) WHERE block_type = 'h1' OR lt <= block_cap),
units AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i, k) AS k, i, part, t, n::BIGINT AS n,
             row_number() OVER (PARTITION BY page_id, i, part ORDER BY k) = 1 AS first, row_number() OVER (PARTITION BY page_id, i, part ORDER BY k DESC) = 1 AS last FROM b0),
p AS (SELECT page_id, list(n ORDER BY k) AS n, list(cap ORDER BY k) AS caps FROM units JOIN r USING (page_id, i) GROUP BY page_id),
f AS (SELECT page_id, 1 AS k, 0 AS chunk_no, n[1] AS used, caps[1] AS cap FROM p
      UNION ALL
      SELECT f.page_id, k + 1, CASE WHEN used + p.n[k + 1] > cap THEN chunk_no + 1 ELSE chunk_no END, CASE WHEN used + p.n[k + 1] > cap THEN p.n[k + 1] ELSE used + p.n[k + 1] END,
             CASE WHEN used + p.n[k + 1] > cap THEN p.caps[k + 1] ELSE cap END
      FROM f JOIN p USING (page_id) WHERE k < len(p.n)),
g0 AS (SELECT page_id, chunk_no, i, part, min(k) AS k, CASE WHEN bool_or(first) AND bool_or(last) AND any_value(lt) = sum(n) THEN any_value(raw) ELSE string_agg(t, ' ' ORDER BY k) END AS text
       FROM units JOIN f USING (page_id, k) JOIN r USING (page_id, i) GROUP BY page_id, chunk_no, i, part),
g AS (SELECT page_id, chunk_no, i, k, text, row_number() OVER w - 1 AS block_index, coalesce(sum(length(text) + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS text_offset
      FROM g0 WINDOW w AS (PARTITION BY page_id ORDER BY k)),
h AS (SELECT page_id, chunk_no, 'EDU:' || page_id || ':' || min(block_index) || '-' || max(block_index) AS chunk_id, string_agg(block_index, ',' ORDER BY block_index) AS indices, min(i) AS i,
             min(text_offset) AS text_offset, string_agg(text, ' ' ORDER BY block_index) AS text
      FROM g GROUP BY page_id, chunk_no),
c AS (SELECT h.*, title, host, url, xpath, css, CASE WHEN under THEN head ELSE '' END AS heads FROM h JOIN r USING (page_id, i))
"""


def _quote(x: str) -> str:
    return f"replace(url_encode({x}), '%2F', '/')"


def _overlapping_rows(size: int, overlap: int) -> str:
    return f"""WITH RECURSIVE {_overlapping(size, overlap)},
links AS (SELECT chain.*, d.* EXCLUDE (doc_id), 1 + len(list_filter(b, lambda x: x > s AND x <= e)) AS parts FROM chain JOIN d USING (doc_id)),
h AS (SELECT *, {_shown("start", overlap)} AS opening, sum(parts) OVER (PARTITION BY doc_id ORDER BY no) AS upto FROM links)
SELECT 'EDU:' || doc_id || ':' || (upto - parts) || '-' || (upto - 1) AS chunk_id, doc_id::VARCHAR AS page_id, no::INT AS chunk_no, array_to_string(w[s:e], ' ') AS normalized_text,
       before AS overlap_prev_text, coalesce(lead(opening) OVER (PARTITION BY doc_id ORDER BY no), '') AS overlap_next_text FROM h"""


_READ = "page_id % 11 > 0 AND page_id % 13 > 0 AND page_id % 17 > 0 AND page_id % 19 > 0"

ORACLES = {
    "page_info_rows": f"SELECT page_id, title AS page_title, host AS space_key, 1::INT AS page_version, '' AS last_modified FROM ({_PAGES})",
    "block_counts": f"{_HTML_BLOCKS} SELECT block_type, count(*) AS n_blocks, sum(length(text))::BIGINT AS n_chars FROM z GROUP BY block_type",
    "excluded_class_blocks": f"WITH {_BLOCKS} SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY index) - 1)::INT AS index, block_type, text FROM z WHERE NOT ad",
    "html_blocks": f"""{_HTML_BLOCKS} SELECT page_id, index::INT AS index, 'EDU:' || page_id || '-' || index AS id, block_type, text,
'/body[1]/' || CASE WHEN ad THEN '' ELSE 'article[1]/' END || block_type || '[' || place || ']' AS xpath,
'body:nth-of-type(1) > ' || CASE WHEN ad THEN 'div.ad' ELSE 'article:nth-of-type(1) > ' || block_type || ':nth-of-type(' || place || ')' END AS css_selector,
coalesce(sum(length(text) + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS text_offset, length(text)::INT AS text_length,
last_value(CASE WHEN block_type = 'h1' THEN 'EDU:' || page_id || '-' || index END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS parent_heading_id,
NULL::VARCHAR AS html_id FROM z WINDOW w AS (PARTITION BY page_id ORDER BY index)""",
    "lateral_blocks": f"""{_HTML_BLOCKS} SELECT page_id, index::INT AS index, block_type, text, '/body[1]/' || CASE WHEN ad THEN '' ELSE 'article[1]/' END || block_type || '[' || place || ']' AS xpath,
'body:nth-of-type(1) > ' || CASE WHEN ad THEN 'div.ad' ELSE 'article:nth-of-type(1) > ' || block_type || ':nth-of-type(' || place || ')' END AS css_selector, NULL::VARCHAR AS html_id FROM z""",
    "empty_pages": "SELECT page_id::VARCHAR AS page_id FROM pages WHERE page_id % 5 = 0",
    "json_page_rows": """SELECT page_id::VARCHAR AS page_id, 'Page ' || page_id AS title, CASE WHEN page_id % 3 > 0 THEN 'K' ELSE '' END AS space_key, CASE WHEN page_id % 3 > 0 THEN 'Name' ELSE '' END AS space_name,
CASE WHEN page_id % 4 > 0 THEN page_id % 7 ELSE 1 END::INT AS version, CASE WHEN page_id % 4 > 0 THEN '2024-01-01' ELSE '' END AS last_modified, md5(html) AS body_md5, 'http://wiki.example.com/pages/' || page_id AS url
FROM pages WHERE """
    + _READ,
    "json_fetch_failures": """SELECT page_id::VARCHAR AS id, CASE WHEN page_id % 11 = 0 THEN 'not found' ELSE 'unreadable page' END AS error FROM pages
WHERE page_id % 11 = 0 OR page_id % 13 = 0 OR page_id % 17 = 0 OR page_id % 19 = 0""",
    "made_page_blocks": """WITH n AS (SELECT n_regionkey AS r, n_nationkey AS k, n_name AS name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS i, count(*) OVER (PARTITION BY n_regionkey) AS c FROM nation),
x AS (SELECT r_regionkey AS r, 0 AS index, 'h1' AS block_type, r_name AS text, '/body[1]/h1[1]' AS xpath, 'top' AS html_id FROM region WHERE r_regionkey IN (SELECT r FROM n)
      UNION ALL SELECT DISTINCT r, 1, 'h3', 'Table', '/body[1]/h3[1]', NULL FROM n
      UNION ALL SELECT DISTINCT r, 2, 'tr', 'Nation | Key', '/body[1]/table[1]/thead[1]/tr[1]', NULL FROM n
      UNION ALL SELECT r, 2 + i, 'tr', name || ' | ' || k, '/body[1]/table[1]/tbody[1]/tr[' || i || ']', NULL FROM n
      UNION ALL SELECT DISTINCT r, 3 + c, 'h2', 'List', '/body[1]/h2[1]', NULL FROM n
      UNION ALL SELECT r, 2 + c + 2 * i, 'li', name, '/body[1]/ul[1]/li[' || i || ']', NULL FROM n
      UNION ALL SELECT r, 3 + c + 2 * i, 'li', 'key ' || k, '/body[1]/ul[1]/li[' || i || ']/ol[1]/li[1]', NULL FROM n)
SELECT r::VARCHAR AS page_id, x.index::INT AS index, block_type, text, xpath, html_id, length(text)::INT AS text_length,
       coalesce(sum(length(text) + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS text_offset,
       CASE WHEN x.index > 0 THEN 'EDU:' || r || '-' || CASE WHEN x.index > 3 + m.c THEN 3 + m.c WHEN x.index > 1 THEN 1 ELSE 0 END END AS parent_heading_id,
       CASE WHEN x.index = 0 THEN '' WHEN x.index >= 3 + m.c THEN 'List > ' ELSE 'Table > ' END || m.top AS hierarchy
FROM x JOIN (SELECT r_regionkey AS r, r_name AS top, count(*) AS c FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY ALL) AS m USING (r) WINDOW w AS (PARTITION BY r ORDER BY x.index)""",
    "mixed_page_blocks": """WITH x AS (SELECT n_nationkey AS k, unnest([0, 1, 2, 3]) AS i, unnest(['div', 'p', 'div', 'p']) AS t, unnest(['Intro ' || n_name, 'Para ' || n_nationkey, 'More of ' || n_name, 'kept']) AS text,
       unnest(['/body[1]/div[1]', '/body[1]/div[1]/p[1]', '/body[1]/div[1]', '/body[1]/section[1]/p[1]']) AS xpath FROM nation)
SELECT k::VARCHAR AS page_id, i::INT AS index, t AS block_type, text, xpath, coalesce(sum(length(text) + 1) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS text_offset FROM x""",
    "run_counters": f"""WITH {_BLOCKS}, g AS (SELECT page_id::VARCHAR AS page_id, page_id % 100 = 50 AS refused FROM pages WHERE {_READ})
SELECT (SELECT count(*) FROM pages) AS page_ids, count(*) AS pages_fetched, (SELECT count(*) FROM pages WHERE NOT ({_READ})) AS pages_fetch_failed, count(*) AS pages_processed, 0::BIGINT AS pages_process_failed, 0::BIGINT AS pages_with_errors,
       count_if(refused)::BIGINT AS pages_write_failed, (SELECT count(*) FROM z WHERE page_id IN (SELECT page_id FROM g WHERE NOT refused)) AS blocks_written FROM g""",
    "run_sections": f"""WITH {_BLOCKS}, g AS (SELECT page_id::VARCHAR AS page_id FROM pages WHERE {_READ} AND page_id % 100 <> 50)
SELECT 'page' AS section, page_id, 'Page ' || page_id AS text FROM g UNION ALL SELECT 'block', page_id, text FROM z WHERE page_id IN (SELECT page_id FROM g)""",
    "conversation_blocks": """WITH t AS (SELECT conv_id, text, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations)
SELECT conv_id::VARCHAR AS page_id, i::INT AS index, 'EDU:' || conv_id || '-' || i AS id, coalesce(text, '') AS text, concat_ws('/', '/turn', role) AS xpath,
       coalesce(sum(length(coalesce(text, '')) + 1) OVER (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS text_offset, length(coalesce(text, ''))::INT AS text_length FROM t""",
    "split_text_parts": f"""WITH RECURSIVE
s0 AS (SELECT doc_id, {_sentences('text')} AS s FROM documents),
s AS (SELECT row_number() OVER () AS sid, doc_id, j, t, {_tokens('t')} AS n FROM (SELECT doc_id, unnest(s) AS t, generate_subscripts(s, 1) AS j FROM s0)),
big AS (SELECT sid, t FROM s WHERE n > {SIZE}),
{_word_runs('big', 'sid', SIZE)},
v AS (SELECT doc_id, j, 0 AS bin, t, n, true AS whole FROM s WHERE n <= {SIZE} UNION ALL SELECT doc_id, j, bin, words, wr.n, false FROM s JOIN wr USING (sid)),
o AS (SELECT doc_id, list(n ORDER BY j, bin) AS n, list(whole ORDER BY j, bin) AS whole, list(t ORDER BY j, bin) AS t FROM v GROUP BY doc_id),
q AS (SELECT doc_id, 1 AS k, 0 AS part, n[1] AS used, NOT whole[1] AS closed FROM o
      UNION ALL
      SELECT q.doc_id, k + 1,
             CASE WHEN closed OR NOT o.whole[k + 1] OR used + o.n[k + 1] > {SIZE} THEN part + 1 ELSE part END,
             CASE WHEN closed OR NOT o.whole[k + 1] OR used + o.n[k + 1] > {SIZE} THEN o.n[k + 1] ELSE used + o.n[k + 1] END, NOT o.whole[k + 1]
      FROM q JOIN o USING (doc_id) WHERE k < len(o.n))
SELECT doc_id, part::INT AS part, string_agg(o.t[k], ' ' ORDER BY k) AS text FROM q JOIN o USING (doc_id) GROUP BY doc_id, part""",
    "sentence_prefix_forced": f"""WITH a AS (SELECT doc_id, text, {_sentences('text')} AS s, {_words('text')} AS w FROM documents),
b AS (SELECT *, len(s) > 0 AND {_tokens("coalesce(s[1], '')")} > {FORCED_CAP} AS torn FROM a),
c AS (SELECT doc_id, CASE WHEN torn THEN w ELSE s END AS u FROM b),
d AS (SELECT doc_id, u, list_transform(u, lambda x: {_tokens('x')}) AS n FROM c),
e AS (SELECT doc_id, u, greatest(1, len(list_filter(range(1, len(n) + 1), lambda i: list_sum(n[:i]) <= {FORCED_CAP}))) AS k FROM (SELECT doc_id, u, n[:20] AS n FROM d))
SELECT doc_id, array_to_string(u[:k], ' ') AS prefix, md5(array_to_string(u[k + 1:], ' ')) AS rest_md5 FROM e""",
    "block_split_counts": f"WITH RECURSIVE {_parts(SIZE)} SELECT doc_id::VARCHAR AS page_id, count(*) AS splits FROM b WHERE first AND part > 0 GROUP BY doc_id",
    "page_chunks": f"""WITH RECURSIVE {_page_chunks(SIZE)}
SELECT chunk_id, page_id, host AS space_key, title AS page_title, 1::INT AS page_version, '' AS last_modified, indices AS block_indices, indices AS core_block_indices,
'' AS overlap_prev_block_indices, '' AS overlap_next_block_indices, heads AS full_heading_hierarchy, heads AS text_heading_hierarchy, NULL::VARCHAR AS nearest_heading_id,
text AS normalized_text, '' AS overlap_prev_text, '' AS overlap_next_text, text AS full_text,
CASE WHEN title = '' AND heads = '' THEN text ELSE concat_ws(chr(10), CASE WHEN title <> '' THEN '[PAGE] ' || title END, CASE WHEN heads <> '' THEN '[SECTION] ' || heads END, '[TEXT] ' || text) END AS embedding_text,
xpath AS xpath_start, css AS css_selector_start, text_offset::INT AS text_offset_start, length(text)::INT AS text_length, url || '#:~:text=' || {_quote(_trim('substr(text, 1, 80)'))} AS navigation_url, chunk_no::INT AS chunk_no FROM c""",
    "chunk_fragments": f"WITH RECURSIVE {_fragments(SIZE)} SELECT chunk_id, block_index::INT AS block_index, 'EDU:' || doc_id || '-' || block_index AS block_id, g.text_offset::INT AS text_offset, length(g.text)::INT AS text_length, g.text FROM g JOIN h USING (doc_id, chunk_no)",
    "chunk_payload_fields": f"""WITH RECURSIVE {_fragments(SIZE)} SELECT chunk_id, doc_id::VARCHAR AS page_id, 1::INT AS page_version, md5(text) AS text_md5, 'EDU:' || doc_id || '-' || first_index AS first_block,
text_offset::INT AS text_offset, length(text)::INT AS text_length, NULL::VARCHAR AS nearest_heading_id FROM h""",
    "doc_blocks": _DOC_BLOCKS,
    "parsed_block_ids": f"WITH {_LINES} SELECT 'EDU:' || doc_id || '-' || i AS id, doc_id::VARCHAR AS page_id FROM l",
    "token_counts": f"SELECT doc_id, {_tokens('text')}::BIGINT AS n_tokens FROM documents",
    "normalized_text": f"SELECT doc_id, md5({_trim(r'''regexp_replace(regexp_replace(replace(text, chr(160), ' '), '[ \t]*[\r\n]+[ \t]*', ' ', 'g'), '[ \t]+', ' ', 'g')''')}) AS text_md5 FROM documents",
    "sentence_rows": f"WITH a AS (SELECT doc_id, {_sentences('text')} AS s FROM documents), b AS (SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) AS pos FROM a) SELECT doc_id, (pos - 1)::INT AS place, sentence, {_tokens('sentence')}::BIGINT AS n_tokens FROM b",
    "word_bins": f"WITH RECURSIVE src AS (SELECT item_id, text AS t FROM benchmark), {_word_runs('src', 'item_id', WORD_CAP)} SELECT item_id, bin::INT AS bin, words FROM wr",
    "greedy_bins": f"""WITH RECURSIVE w AS (SELECT item_id, list_transform({_words('text')}, lambda x: length(x)) AS n FROM benchmark),
f AS (SELECT item_id, 1 AS i, 0 AS bin, n[1] AS used FROM w WHERE len(n) > 0
      UNION ALL SELECT f.item_id, i + 1, CASE WHEN used + w.n[i + 1] > 40 THEN bin + 1 ELSE bin END, CASE WHEN used + w.n[i + 1] > 40 THEN w.n[i + 1] ELSE used + w.n[i + 1] END FROM f JOIN w USING (item_id) WHERE i < len(w.n))
SELECT item_id, (i - 1)::INT AS place, bin::INT AS bin FROM f""",
    "sentence_prefix": f"""WITH a AS (SELECT doc_id, text, {_sentences('text')} AS s FROM documents),
b AS (SELECT doc_id, unnest(s) AS t, generate_subscripts(s, 1) AS i FROM a),
c AS (SELECT doc_id, t, i, sum({_tokens('t')}) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM b),
d AS (SELECT doc_id, string_agg(t, ' ' ORDER BY i) FILTER (n <= {PREFIX_CAP}) AS prefix, string_agg(t, ' ' ORDER BY i) FILTER (n > {PREFIX_CAP}) AS rest FROM c GROUP BY doc_id)
SELECT a.doc_id, coalesce(prefix, '') AS prefix, length(CASE WHEN prefix IS NULL THEN a.text ELSE coalesce(rest, '') END)::INT AS rest_length FROM a LEFT JOIN d USING (doc_id)""",
    "parent_heading_rows": f"{_HTML_BLOCKS} SELECT page_id, index::INT AS index, last_value(CASE WHEN block_type = 'h1' THEN 'EDU:' || page_id || '-' || index END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS parent_heading_id FROM z",
    "hierarchy_rows": f"{_HTML_BLOCKS} SELECT page_id, index::INT AS index, coalesce(last_value(CASE WHEN block_type = 'h1' THEN text END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS hierarchy FROM z",
    "tag_token_rows": f"""WITH t AS (SELECT page_id, title, CASE WHEN page_id::BIGINT % 3 > 0 THEN array_to_string(string_split(host, '.'), ' > ') END AS heads FROM ({_PAGES})),
n AS (SELECT page_id, CASE WHEN title <> '' THEN {_tokens("'[PAGE] ' || title")} ELSE 0 END + CASE WHEN heads IS NOT NULL THEN {_tokens("'[SECTION] ' || heads")} ELSE 0 END AS n FROM t)
SELECT page_id, CASE WHEN n > 0 THEN n + 3 ELSE 0 END::BIGINT AS n_tokens FROM n""",
    "embedding_rows": f"""WITH t AS (SELECT page_id, title, CASE WHEN page_id::BIGINT % 3 > 0 THEN array_to_string(string_split(host, '.'), ' > ') END AS heads, {_trim("coalesce(html, '')")} AS text FROM ({_PAGES}))
SELECT page_id, CASE WHEN title = '' AND heads IS NULL THEN text ELSE concat_ws(chr(10), CASE WHEN title <> '' THEN '[PAGE] ' || title END, '[SECTION] ' || heads, '[TEXT] ' || text) END AS embedding_text FROM t""",
    "navigation_rows": f"""SELECT doc_id, 'http://example.com/x#' || CASE WHEN doc_id % 3 = 0 THEN 'b' || doc_id WHEN doc_id % 2 = 0 THEN 'h' || doc_id ELSE ':~:text=' || {_quote(_trim('substr(text, 1, 80)'))} END AS navigation_url FROM documents""",
    "chunk_texts": f"WITH RECURSIVE {_chunks(SIZE)} SELECT doc_id::VARCHAR AS page_id, chunk_no::INT AS chunk_no, text AS normalized_text, length(text)::INT AS text_length, '#:~:text=' || {_quote(_trim('substr(text, 1, 80)'))} AS navigation_url, text AS embedding_text FROM c",
    "long_page_chunks": f"WITH RECURSIVE {_chunks(SIZE)} SELECT doc_id::VARCHAR AS page_id, chunk_no::BIGINT AS chunk_no, count(*) AS n_sentences, sum(p.n[k])::BIGINT AS n_tokens, string_agg(p.t[k], ' ' ORDER BY k) AS normalized_text FROM f JOIN p USING (doc_id) GROUP BY doc_id, chunk_no",
    "chunk_bounds": f"WITH RECURSIVE {_chunks(512)} SELECT doc_id::VARCHAR AS page_id, chunk_no::INT AS chunk_no, length(text)::INT AS text_length, n AS n_tokens FROM c",
    "chunk_count": f"WITH RECURSIVE {_chunks(SIZE)} SELECT count(*) AS n_chunks FROM c",
    "chunk_lookup": f"WITH RECURSIVE {_chunks(512)} SELECT 'EDU:7:0-5' AS chunk_id, text AS normalized_text FROM c WHERE doc_id = 7 AND chunk_no = 0",
    "stored_table": f"""WITH RECURSIVE
changed AS (SELECT doc_id, CASE WHEN doc_id % 100 = 0 THEN '' WHEN doc_id % 10 = 0 THEN 'New. ' || string_split(text, chr(10))[1] ELSE text END AS text FROM documents),
{_fragments(512, "changed")} SELECT chunk_id, doc_id::VARCHAR AS page_id, md5(text) AS text_md5 FROM h""",
    "chunks_overlapping": _overlapping_rows(SIZE, 16),
    "chunks_overlapping_wide": _overlapping_rows(512, 64),
    "chunk_upsert": """WITH new AS (SELECT doc_id // 10 AS chunk_id, arg_max(doc_id || '/' || quality || '/' || toxic, doc_id) AS payload FROM labels GROUP BY 1)
SELECT chunk_id, payload FROM new UNION ALL SELECT doc_id // 10, 'old ' || min(source) FROM documents WHERE doc_id // 10 NOT IN (SELECT chunk_id FROM new) GROUP BY 1""",
    "explicit_ids": "SELECT page_id::VARCHAR AS page_id, url FROM pages JOIN (VALUES (3), (5), (3), (8)) AS v(i) ON page_id = i",
    "run_statistics": f"WITH RECURSIVE {_chunks(SIZE)} SELECT (SELECT count(*) FROM documents) AS pages, (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM l)) AS pages_empty, 0::BIGINT AS pages_with_errors, (SELECT count(*) FROM l) AS blocks, (SELECT count(*) FROM c) AS chunks",
}
