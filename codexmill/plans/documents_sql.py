"""DuckDB SQL of the queries in ``documents``."""

from functools import reduce

from codexmill.functions.citations import DEFINITIONS, LISTED_TERM, TERM_LIST
from codexmill.functions.text import transliteration

_ST = "SELECT DISTINCT g, s, p, o, o_kind, o_datatype, o_lang FROM triples WHERE s IS NOT NULL AND o IS NOT NULL"
_URIS = f"WITH st AS ({_ST}), u AS (SELECT s AS uri FROM st UNION SELECT o FROM st WHERE o_kind = 'uri')"
_CASE = r"^http://rinfo\.example/publ/rattsfall/([0-9A-Za-z_]+)/([0-9]+)(?:s([0-9]+)|(?::| nr | ref )([0-9]+))"
_DEC = r"^http://rinfo\.example/publ/beslut/([0-9A-Za-z_]+)/([^\n]*)"
_ACT = r"^http://rinfo\.example/publ/sfs/([0-9]{4}:[0-9A-Za-z_]+)#?(?:K([0-9a-z]+))?(?:P([0-9a-z]+))?(?:S([0-9a-z]+))?(?:N([0-9a-z]+))?"


def _g(p: str, i: int, c: str = "uri") -> str:
    return f"nullif(regexp_extract({c}, '{p}', {i}), '')"


_PARSED = _URIS + f""", r AS (SELECT uri, CASE WHEN regexp_matches(uri, '{_CASE}') THEN 7 WHEN regexp_matches(uri, '{_DEC}') THEN 8 WHEN regexp_matches(uri, '{_ACT}') THEN 1 END AS type,
{_g(_ACT, 1)} AS law, {_g(_ACT, 2)} AS chapter, {_g(_ACT, 3)} AS section, {_g(_ACT, 4)} AS piece, {_g(_ACT, 5)} AS item, {_g(_CASE, 1)} AS publikation, {_g(_CASE, 2)} AS artal,
{_g(_CASE, 4)} AS lopnummer, {_g(_CASE, 3)} AS sidnummer, {_g(_DEC, 1)} AS myndighet, {_g(_DEC, 2)} AS dnr FROM u),
again AS (SELECT *, CASE type WHEN 7 THEN 'http://rinfo.example/publ/rattsfall/' || coalesce(publikation, 'None') || '/' || coalesce(artal, 'None') ||
  CASE WHEN publikation = 'nja' THEN 's' || coalesce(sidnummer, 'None') ELSE ':' || coalesce(lopnummer, 'None') END
 WHEN 1 THEN 'http://rinfo.example/publ/sfs/' || law || CASE WHEN chapter IS NULL AND section IS NULL AND piece IS NULL AND item IS NULL THEN '' ELSE '#' || coalesce('K' || chapter, '') || coalesce('P' || section, '') || coalesce('S' || piece, '') || coalesce('N' || item, '') END
 WHEN 8 THEN 'http://rinfo.example/publ/beslut/' || coalesce(myndighet, 'None') || '/' || coalesce(dnr, 'None') END AS again FROM r)
"""


def _chunks(d: str) -> str:
    return f"""WITH a AS (SELECT doc_id, string_split(text, {d}) AS parts FROM documents WHERE text IS NOT NULL),
b AS (SELECT doc_id, CASE WHEN parts[-1] = '' THEN parts[1:len(parts) - 1] ELSE parts END AS parts FROM a),
c AS (SELECT doc_id, CAST(unnest(range(len(parts))) AS INT) AS pos, unnest(parts) AS chunk FROM b)"""


_SLUG_FROM, _SLUG_TO = "".join(transliteration()), "".join(transliteration().values())


def _slug(c: str) -> str:
    x = rf"regexp_replace(translate({c}, '{_SLUG_FROM}', '{_SLUG_TO}'), '[^a-zA-Z0-9\-_\s.]', '', 'g')"
    return rf"lower(regexp_replace(regexp_replace(regexp_replace({x}, '[\s._]', '-', 'g'), '-+', '-', 'g'), '^-+|-+$', '', 'g'))"


def _short(n: int) -> str:
    return rf"""CASE WHEN length(description) > {n} THEN trim(regexp_replace(substr(description, 1, CASE WHEN contains(left(description, {n}), ' ')
THEN length(left(description, {n})) - strpos(reverse(left(description, {n})), ' ') + 1 ELSE {n} END - 1), '[ \t\r\n]+', ' ', 'g'), ' ') || '...' ELSE description END"""


_NR = r"regexp_extract(basefile, '([0-9]{4})\s*[:/]\s*([0-9]+)', 1) || ':' || regexp_replace(regexp_extract(basefile, '([0-9]{4})\s*[:/]\s*([0-9]+)', 2), '^0+([0-9])', '\1')"


def nr_sql() -> str:
    return _NR


def slug_sql(c: str) -> str:
    return _slug(c)


_NUMBERED = rf"SELECT *, {_NR} AS nr FROM direktiv_records WHERE regexp_matches(basefile, '([0-9]{{4}})\s*[:/]\s*([0-9]+)')"
_C = r"\b(AD|MD|RH|RÅ|HFD|NJA) ([0-9]{4})(?::| nr | ref\. | s\. )([0-9]+)"
_PROP = r"\b[Pp]rop\. ([0-9]{4}(?:/[0-9]{2,4})?:[0-9]+)"
_BET = r"\b[Bb]et\. ([0-9]{4}/[0-9]{2,4}:[A-Z][A-Za-z]+[0-9]+)"
_RSKR = r"\b[Rr]skr\. ([0-9]{4}/[0-9]{2,4}:[0-9]+)"
_CELEX = r"\b(3[0-9]{4}[A-Z][0-9]{4}|3[0-9]{2}[A-Z][0-9]{4})\b"


def defs_sql() -> str:
    """List of the terms that ``text`` defines."""
    lists = [f"regexp_extract_all(text, '{p}', 1)" for p in DEFINITIONS] + [f"regexp_extract_all(regexp_extract(text, '{TERM_LIST}', 1), '{LISTED_TERM}', 1)"]
    return reduce(lambda a, b: f"list_concat({a}, {b})", lists)



ORACLE = {
    "uri_parse": _PARSED + "SELECT * FROM r WHERE type IS NOT NULL",
    "uri_construct": """SELECT DISTINCT case_id, 'http://rinfo.example/publ/rattsfall/' || coalesce(publikation, 'None') || '/' || coalesce(artal, 'None') ||
CASE WHEN publikation = 'nja' THEN 's' || coalesce(sidnummer, 'None') ELSE ':' || coalesce(lopnummer, 'None') END AS uri FROM (SELECT DISTINCT case_id, publikation, artal, lopnummer, sidnummer FROM dv_cases)""",
    "uri_roundtrip": _PARSED + "SELECT coalesce(uri = again, false) AS same, count(*) AS n FROM again GROUP BY 1",
    "tally": _PARSED + "SELECT type, count(*) AS n, CAST(sum(CASE WHEN uri = again THEN 1 ELSE 0 END) AS BIGINT) AS passed FROM again WHERE type IS NOT NULL GROUP BY type",
    "uri_parts": _URIS + "SELECT uri, regexp_extract(uri, '^(.*[#/:])', 1) AS ns, regexp_extract(uri, '([^#/:]*)$', 1) AS name, CAST(CASE WHEN contains(uri, '/') THEN length(uri) - strpos(reverse(uri), '/') + 1 ELSE 0 END AS INT) AS last_slash FROM u",
    "segment_lines": _chunks("chr(10)") + "SELECT doc_id, pos, chunk FROM c",
    "segment_paragraphs": _chunks("chr(10) || chr(10)") + r""", d AS (SELECT *, replace(regexp_replace(regexp_replace(chunk, '^\s+', ''), '\s+$', ''), chr(10), ' ') AS x FROM c)
SELECT doc_id, pos, chunk, list_reduce(string_split(x, chr(9)), lambda a, y: rpad(a, CAST((length(a) // 8 + 1) * 8 AS INT), ' ') || y) AS clean FROM d""",
    "segment_positions": _chunks("chr(10) || chr(10)") + "SELECT doc_id, pos, CAST(coalesce(sum(length(chunk) + 2) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start, CAST(length(chunk) AS INT) AS length FROM c",
    "peek_prev": _chunks("chr(10)") + "SELECT doc_id, pos, chunk, lead(chunk) OVER w AS peek, lag(chunk) OVER w AS prev FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY pos)",
    "cue_readto": "SELECT doc_id, CAST(nullif(strpos(text, '§'), 0) - 1 AS INT) AS cue, CAST(nullif(strpos(text, '§'), 0) AS INT) AS past, CASE WHEN strpos(text, '§') > 0 THEN substr(text, 1, strpos(text, '§') - 1) END AS upto, substr(text, 11, 20) AS part FROM documents",
    "truncate_desc": f"SELECT DISTINCT case_id, {_short(80)} AS short80, {_short(200)} AS short200 FROM dv_cases",
    "string_functions": r"""SELECT title, CASE WHEN contains(title, ' om ') THEN split_part(title, ' om ', 1) WHEN title IS NOT NULL THEN '' END AS head,
CASE WHEN contains(title, ' om ') THEN substr(title, strpos(title, ' om ') + 4) WHEN title IS NOT NULL THEN '' END AS tail,
trim(regexp_replace(title, '[ \t\r\n]+', ' ', 'g'), ' ') AS plain, CAST(length(title) AS INT) AS n FROM (SELECT DISTINCT title FROM sfs_snapshots)""",
    "slug": f"SELECT rubrik, {_slug('rubrik')} AS slug FROM (SELECT DISTINCT rubrik FROM nodes WHERE rubrik IS NOT NULL)",
    "short_urls": r"""WITH u AS (SELECT DISTINCT unnest(regexp_extract_all(text, '(https?://[^\s\])]+)', 1)) AS url FROM documents),
b AS (SELECT url, string_split(rtrim(url, '/'), '/')[-1] AS name, length(url) - length(rtrim(url, '/')) AS slashes FROM u),
c AS (SELECT url, CASE WHEN name = '' OR slashes > 1 THEN '' ELSE '/' || name || repeat('/', slashes) END AS last FROM b),
d AS (SELECT url, last, substr(url, 1, length(url) - length(last)) AS head FROM c)
SELECT url, CASE WHEN length(url) <= 40 OR last = '' THEN url WHEN length(head) > 37 THEN substr(head, 1, 37) || '...' || last ELSE head || substr(last, 1, 37) || '...' END AS short FROM d""",
    "pdf_rule": """WITH f AS (SELECT DISTINCT fsnummer, TRY_CAST(split_part(fsnummer, ':', 1) AS INT) AS y, TRY_CAST(regexp_extract(fsnummer, ':([0-9]+)', 1) AS INT) AS n FROM sfs_snapshots WHERE fsnummer IS NOT NULL),
h AS (SELECT *, (y > 1998 OR (y = 1998 AND n >= 306)) AND (y < 2018 OR (y = 2018 AND n < 160)) AS official_pdf FROM f)
SELECT fsnummer, official_pdf, y > 2018 OR (y = 2018 AND n >= 160) AS authentic, CASE WHEN official_pdf THEN substr(fsnummer, 3, 2) || printf('%04d', n) END AS pdf FROM h""",
    "title_fallback": "SELECT DISTINCT snapshot_id, coalesce(title, fsnummer) AS shown FROM sfs_snapshots WHERE coalesce(title, fsnummer, '') <> ''",
    "amendment_list": "WITH a AS (SELECT DISTINCT uri, unnest(konsolideringsunderlag) AS act FROM sfs_snapshots WHERE uri IS NOT NULL) SELECT uri, string_agg(regexp_extract(act, '([^/]*)$', 1), ', ' ORDER BY regexp_extract(act, '([^/]*)$', 1)) AS amendments, count(*) AS n FROM a WHERE act IS NOT NULL GROUP BY uri",
    "toc_projection": "SELECT DISTINCT doc, node_id, node_type, rubrik, seq FROM nodes WHERE node_type IN ('Avdelning', 'Kapitel', 'Rubrik', 'Bilaga') AND withdrawn_at IS NULL",
    "asof_version": "SELECT DISTINCT node_row, doc, node_id FROM nodes WHERE withdrawn_at IS NULL AND coalesce(valid_from, DATE '0001-01-01') <= DATE '2000-01-01' AND DATE '2000-01-01' < coalesce(valid_to, DATE '9999-12-31')",
    "paragraph_markers": """WITH n AS (SELECT DISTINCT doc, node_id, regexp_extract(node_id, 'S([0-9]+)', 1) AS s, regexp_extract(node_id, '^K([0-9a-z]+)', 1) AS k FROM nodes WHERE node_type = 'Stycke')
SELECT doc, node_id, CASE WHEN s = '1' AND k <> '' THEN 'K' || k WHEN s <> '1' AND s <> '' THEN 'S' || s END AS marker FROM n""",
    "first_paragraph": """WITH n AS (SELECT DISTINCT doc, node_id, regexp_extract(node_id, '^(.*)S[0-9]+$', 1) AS section, TRY_CAST(regexp_extract(node_id, 'S([0-9]+)$', 1) AS INT) AS piece FROM nodes WHERE node_type = 'Stycke' AND node_id IS NOT NULL)
SELECT doc, node_id, CASE WHEN piece = min(piece) OVER (PARTITION BY doc, section) THEN nullif(regexp_extract(section, 'P([0-9a-z]+)$', 1), '') END AS number FROM n""",
    "type_dispatch": """SELECT node_type, CASE WHEN node_type IN ('Avdelning', 'Kapitel', 'Rubrik') THEN 'heading' WHEN node_type IN ('Paragraf', 'Stycke') THEN 'text' WHEN node_type = 'Listelement' THEN 'list' ELSE 'unexpected' END AS rendered_as, count(*) AS n FROM nodes GROUP BY 1, 2""",
    "part_of_emitted": """WITH n AS (SELECT DISTINCT doc, node_id, regexp_extract(node_id, '^(.*)[A-Z][0-9]+[a-z]*$', 1) AS up FROM nodes WHERE node_id IS NOT NULL)
SELECT doc || '#' || node_id AS s, CASE WHEN up = '' THEN doc ELSE doc || '#' || up END AS o FROM n""",
    "heading_numbering": """WITH n AS (SELECT DISTINCT doc, node_row, node_id, CASE node_type WHEN 'Avdelning' THEN 1 WHEN 'Kapitel' THEN 2 WHEN 'Paragraf' THEN 3 END AS level FROM nodes),
a AS (SELECT *, sum(CASE WHEN level < 2 THEN 1 ELSE 0 END) OVER w AS a2, sum(CASE WHEN level < 3 THEN 1 ELSE 0 END) OVER w AS a3, count(*) FILTER (level = 1) OVER w AS c1
  FROM n WHERE level IS NOT NULL WINDOW w AS (PARTITION BY doc ORDER BY node_row ROWS UNBOUNDED PRECEDING)),
b AS (SELECT *, count(*) FILTER (level = 2) OVER (PARTITION BY doc, a2 ORDER BY node_row ROWS UNBOUNDED PRECEDING) AS c2, count(*) FILTER (level = 3) OVER (PARTITION BY doc, a3 ORDER BY node_row ROWS UNBOUNDED PRECEDING) AS c3 FROM a)
SELECT node_row, node_id, level, concat_ws('.', CASE WHEN c1 > 0 THEN c1 END, CASE WHEN level >= 2 AND c2 > 0 THEN c2 END, CASE WHEN level >= 3 AND c3 > 0 THEN c3 END) AS number FROM b""",
    "anchor_dedup": f"""WITH n AS (SELECT DISTINCT doc, node_row, {_slug('rubrik')} AS anchor FROM nodes WHERE rubrik IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY doc, anchor ORDER BY node_row) AS k FROM n) SELECT doc, node_row, anchor, CASE WHEN k = 1 THEN anchor ELSE anchor || '_' || k END AS unique_anchor FROM r""",
    "first_repo_wins": f"""SELECT nr AS basefile, record_id, subrepo FROM ({_NUMBERED}) QUALIFY row_number() OVER (PARTITION BY nr
ORDER BY CASE subrepo WHEN 'dir-trips' THEN 0 WHEN 'dir-asp' THEN 1 WHEN 'dir-sou' THEN 2 WHEN 'dir-polo' THEN 3 ELSE 9 END, record_id) = 1""",
    "newest_only": """WITH r AS (SELECT reg_id, split_part(basefile, '/', 1) AS series, TRY_CAST(split_part(basefile, '/', 2) AS INT) AS year, TRY_CAST(split_part(basefile, '/', 3) AS INT) AS number, fetched_at FROM skvfs_regulations WHERE NOT contains(coalesce(title, ''), 'bilaga'))
SELECT series, year, number, reg_id, year >= 2007 AS needs_pdf FROM r QUALIFY row_number() OVER (PARTITION BY series, year ORDER BY number DESC, fetched_at DESC, reg_id DESC) = 1""",
    "repository_paths": f"""WITH d AS (SELECT DISTINCT nr AS basefile, TRY_CAST(split_part(nr, ':', 1) AS INT) AS y, TRY_CAST(split_part(nr, ':', 2) AS INT) AS n FROM ({_NUMBERED}))
SELECT basefile, printf('%02d/%02d%04d', y % 100, y % 100, n) AS paged, y || '/dir' || y || '_' || n AS by_year FROM d""",
    "index_grouping": """WITH s AS (SELECT fsnummer, min(title) AS title FROM sfs_snapshots WHERE title IS NOT NULL AND fsnummer IS NOT NULL GROUP BY fsnummer),
p AS (SELECT left(fsnummer, 4) AS category, fsnummer, upper(left(CASE WHEN contains(title, ' om ') THEN substr(title, strpos(title, ' om ') + 4) ELSE '' END, 1)) AS topic FROM s)
SELECT category, CASE WHEN topic <> '' THEN topic ELSE '#' END AS page, string_agg(fsnummer, ' ' ORDER BY fsnummer) AS acts, count(*) AS n FROM p GROUP BY 1, 2""",
    "news_trailing_30d": "SELECT doc_id, coalesce(about, '') AS about, strftime(fetched_at, '%Y-%m-%d') AS day FROM documents WHERE fetched_at >= (SELECT max(fetched_at) - INTERVAL 30 DAYS FROM documents)",
    "collection_include": """WITH w AS (SELECT DISTINCT split_part(o, '#', 1) AS doc, nullif(regexp_extract(o, '#(.*)$', 1), '') AS fragment FROM triples WHERE p = 'rinfo:lagrum' AND s IS NOT NULL AND o IS NOT NULL),
n AS (SELECT DISTINCT doc, node_id FROM nodes WHERE withdrawn_at IS NULL) SELECT w.doc, w.fragment, count(*) AS n_nodes FROM w JOIN n ON n.doc = w.doc AND (w.fragment IS NULL OR w.fragment = n.node_id) GROUP BY 1, 2""",
    "delete_subject": f"SELECT g, p, count(*) AS n FROM ({_ST}) WHERE s NOT IN (SELECT uri FROM dv_cases WHERE withdrawn_at IS NOT NULL AND uri IS NOT NULL) GROUP BY g, p",
    "graph_merge": "SELECT DISTINCT s, p, o FROM triples WHERE g IN ('sfs', 'intertwine', 'dv') AND s IS NOT NULL AND o IS NOT NULL",
    "grit_group": f"SELECT s, string_agg(p || '=' || o, ' | ' ORDER BY p, o, o_kind) AS properties, CAST(count(*) AS INT) AS n FROM (SELECT DISTINCT s, p, o, o_kind FROM ({_ST})) GROUP BY s",
    "n_triples": rf"""SELECT '<' || s || '> <' || replace(replace(p, 'dct:', 'http://purl.org/dc/terms/'), 'rinfo:', 'http://rinfo.example/taxo/pub#') || '> ' || CASE WHEN o_kind = 'uri' THEN '<' || o || '>'
ELSE '"' || replace(replace(replace(replace(replace(o, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t') || '"' || CASE WHEN o_lang IS NOT NULL THEN '@' || o_lang WHEN o_datatype IS NOT NULL THEN '^^<' || replace(o_datatype, 'xsd:', 'http://www.w3.org/2001/XMLSchema#') || '>' ELSE '' END END || ' .' AS line FROM ({_ST})""",
    "quarantine": f"SELECT 'kept' AS what, count(*) AS n FROM (SELECT DISTINCT s, p, o FROM ({_ST})) UNION ALL SELECT 'rejected', 0",
    "citation_extract": rf"""WITH x AS (
SELECT unnest(list_transform(regexp_extract_all(text, '{_C}', 0), lambda m: 'http://rinfo.example/publ/rattsfall/' || lower(regexp_extract(m, '{_C}', 1)) || '/' || regexp_extract(m, '{_C}', 2) || CASE WHEN regexp_extract(m, '{_C}', 1) = 'NJA' THEN 's' ELSE ':' END || regexp_extract(m, '{_C}', 3))) AS uri FROM documents
UNION ALL SELECT 'http://rinfo.example/publ/prop/' || unnest(regexp_extract_all(text, '{_PROP}', 1)) FROM documents
UNION ALL SELECT 'http://rinfo.example/ext/bet/' || unnest(regexp_extract_all(text, '{_BET}', 1)) FROM documents
UNION ALL SELECT 'http://rinfo.example/ext/rskr/' || unnest(regexp_extract_all(text, '{_RSKR}', 1)) FROM documents
UNION ALL SELECT 'http://rinfo.example/ext/celex/' || regexp_replace(unnest(regexp_extract_all(text, '{_CELEX}', 1)), '^3([0-9]{{2}})([A-Z])', '319\1\2') FROM documents
UNION ALL SELECT 'http://rinfo.example/publ/sfs/' || unnest(regexp_extract_all(text, '\(([0-9]{{4}}:[0-9]+)\)', 1)) FROM documents)
SELECT uri, count(*) AS n FROM x GROUP BY uri""",
    "celex_normalise": r"""WITH d AS (SELECT DISTINCT case_id, artal, '3' || substr(artal, 3, 2) || 'L' || printf('%04d', case_id % 10000) AS old FROM dv_cases WHERE artal IS NOT NULL)
SELECT case_id, old, regexp_replace(old, '^3([0-9]{2})([A-Z])', '319\1\2') AS celex, regexp_replace('3' || artal || 'L0019', '^3([0-9]{2})([A-Z])', '319\1\2') AS kept FROM d""",
    "definitions": f"WITH x AS (SELECT doc_id, unnest({defs_sql()}) AS term FROM documents" + """)
SELECT DISTINCT doc_id, term, 'http://rinfo.example/concept/' || upper(left(replace(trim(term), ' ', '_'), 1)) || substr(replace(trim(term), ' ', '_'), 2) AS concept FROM x""",
    "amendment_notes": r"SELECT act, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '(?:Lag|Förordning) \(([0-9]{4}:[0-9]+)\)\.', 1)) AS act FROM documents) GROUP BY act",
    "wiki_links": r"SELECT target, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '\[\[([^\]|]+)', 1)) AS target FROM documents WHERE source = 'wiki') GROUP BY target",
    "top_cited": "SELECT o, count(*) AS n FROM (SELECT DISTINCT s, o FROM triples WHERE p = 'dct:references' AND s IS NOT NULL AND o IS NOT NULL) GROUP BY o ORDER BY n DESC, o LIMIT 20",
}
