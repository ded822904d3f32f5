"""DuckDB SQL that gives the rows of the core queries by itself: plain SQL over the same tables."""

from __future__ import annotations

from hortulus.functions import text as tx
from hortulus.functions.text import q
from hortulus.operators.legend import RARE_SHARE, patterns
from hortulus.operators.match import Fuzzy
from hortulus.operators.names import FIELDS, MATCHABLE, SOURCES

RANKS = ", ".join(f"({q(s)}, {q(raw)}, {q(rank)})" for (s, raw), rank in {(s, raw): rank for s, spec in SOURCES.items() for rank, raws in reversed(spec.ranks.items()) for raw in raws}.items())

# ---------------------------------------------------------------- names

_LONE = q(tx.LONE_X)
_CANONICAL = tx.sql_strip(f"regexp_replace(n.canonical_name, {_LONE}, ' × ', 'g')")
NAMES = f"""ranks(source, raw_rank, rank) AS (VALUES {RANKS}),
names AS (SELECT n.ord, {_CANONICAL} AS canonical_name, nullif(n.genus, '') AS genus, nullif(n.epithet, '') AS epithet,
    nullif(n.infraspecific_epithet, '') AS infraspecific_epithet, nullif(n.authorship, '') AS authorship, r.rank AS taxon_rank, n.source,
    coalesce(s.priority, -1) AS prio
    FROM name_lookup n JOIN ranks r ON n.source = r.source AND lower(n.taxon_rank) = r.raw_rank LEFT JOIN name_sources s ON n.source = s.source),
matchable AS (SELECT *, {tx.sql_name_key('canonical_name')} AS key FROM names WHERE canonical_name IS NOT NULL AND genus IS NOT NULL AND taxon_rank IN ({', '.join(map(q, MATCHABLE))})),
canonical AS (SELECT * FROM matchable WHERE key <> '' QUALIFY row_number() OVER (PARTITION BY key ORDER BY prio, ord) = 1),
genera AS (SELECT * FROM matchable WHERE key <> '' AND taxon_rank = 'genus' QUALIFY row_number() OVER (PARTITION BY key ORDER BY prio, ord) = 1),
epithets AS (SELECT * FROM (SELECT * EXCLUDE (key), {tx.sql_name_key("concat_ws(' ', epithet, infraspecific_epithet)")} AS key FROM matchable WHERE epithet IS NOT NULL)
    WHERE key <> '' QUALIFY row_number() OVER (PARTITION BY key ORDER BY prio DESC, ord DESC) = 1)"""
ALL_FIELDS = ", ".join((*FIELDS, "taxon_rank", "source"))

AUTHORS = """authors AS (SELECT key, string_agg(author || ' [' || source || ']', '; ' ORDER BY prio, ord) AS listed FROM (
    SELECT key, coalesce(authorship, 'None') AS author, arg_min(source, (prio, ord)) AS source, min((prio, ord)).prio AS prio, min((prio, ord)).ord AS ord
    FROM (SELECT key, authorship, coalesce(source, 'None') AS source, prio, ord FROM matchable WHERE key <> '') GROUP BY key, author) GROUP BY key)"""
AUTHORS = AUTHORS.replace("min((prio, ord)).prio", "min({'prio': prio, 'ord': ord}).prio").replace("min((prio, ord)).ord", "min({'prio': prio, 'ord': ord}).ord").replace("arg_min(source, (prio, ord))", "arg_min(source, {'prio': prio, 'ord': ord})")
FULL = tx.sql_strip("canonical_name || ' ' || coalesce(authorship, '')")

# ---------------------------------------------------------------- lines

_GARDEN = "nullif(regexp_extract(filename, '^[A-Za-z]+'), '')"
_YEAR = f"CAST(nullif(regexp_extract(filename, {q(tx.YEAR)}, 1), '') AS INTEGER)"
_TEXT = "replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"
_CLEAN = tx.sql_strip("replace(c, chr(9), '    ')")
# XHTML of the regular form that the test tables have: nothing but paragraphs of plain text in divisions
CONTENTS = f"""contents AS (SELECT file_id, content, regexp_matches(content, '^\\s*<') AS marked FROM seedlist_files WHERE file_format = 'json' AND content IS NOT NULL),
divisions AS (SELECT file_id, generate_subscripts(string_split(content, '<div'), 1) AS page, unnest(string_split(content, '<div')) AS part FROM contents WHERE marked),
paragraphs AS (SELECT file_id, page, generate_subscripts(regexp_extract_all(part, '(?s)<p>(.*?)</p>', 1), 1) AS k, unnest(regexp_extract_all(part, '(?s)<p>(.*?)</p>', 1)) AS t FROM divisions),
marked_lines AS (SELECT file_id, page, k, generate_subscripts({tx.sql_split_lines(_TEXT)}, 1) AS j, unnest({tx.sql_split_lines(_TEXT)}) AS c FROM paragraphs),
content_lines AS (SELECT file_id, CAST(row_number() OVER (PARTITION BY file_id ORDER BY page, k, j) AS INTEGER) AS line_nr, CAST(page AS INTEGER) AS page, {_CLEAN} AS raw FROM marked_lines
    UNION ALL SELECT file_id, CAST(line_nr - 1 AS INTEGER), 0, {_CLEAN} FROM (SELECT file_id, generate_subscripts({tx.sql_split_lines('content')}, 1) AS line_nr, unnest({tx.sql_split_lines('content')}) AS c FROM contents WHERE NOT marked))"""
LINES = f"""{CONTENTS},
raw_lines AS (SELECT file_id AS doc, line_nr, coalesce(arg_max(raw_line, line_id), '') AS raw FROM document_lines GROUP BY file_id, line_nr UNION ALL SELECT file_id, line_nr, raw FROM content_lines),
lines AS (SELECT l.doc, l.line_nr, l.raw, f.filename, {_GARDEN} AS garden_code, {_YEAR} AS year, {tx.sql_preprocess('l.raw')} AS pre
    FROM raw_lines l LEFT JOIN seedlist_files f ON l.doc = f.file_id)"""


def ratios(pairs: str) -> str:
    """CTEs lcs and ratio(a, b, score) for the distinct (a, b) of a CTE: the longest common subsequence letter by letter of b. Needs WITH RECURSIVE."""
    step = "greatest(r[i + 1], coalesce(list_max(list_transform(list_filter(range(1, i + 1), lambda k: substring(a, k, 1) = substring(b, j + 1, 1)), lambda k: r[k] + 1)), 0))"
    return f"""lcs(a, b, j, r) AS (SELECT a, b, 0, list_transform(range(0, length(a) + 1), lambda i: 0::BIGINT) FROM (SELECT DISTINCT a, b FROM {pairs})
    UNION ALL SELECT a, b, j + 1, list_transform(range(0, length(a) + 1), lambda i: {step}) FROM lcs WHERE j < length(b)),
ratio AS (SELECT a, b, CASE WHEN length(a) + length(b) = 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * r[length(a) + 1] / (length(a) + length(b)) END AS score FROM lcs WHERE j = length(b))"""


def starts_lower(t: str) -> str:
    return f"(lower(left({t}, 1)) = left({t}, 1) AND upper(left({t}, 1)) <> left({t}, 1))"


def windows(name: str, source: str, ids: str, text: str) -> str:
    """CTEs {name}_tok and {name}_hit: every window of tokens tried, the leftmost and then longest kept for each kind."""
    key = f"array_to_string(list_filter(cleaned[i + 1:j], lambda z: z <> ''), ' ')"
    return f"""{name}_tok AS (SELECT {ids}, {text} AS text, {tx.sql_tokens(text)} AS tokens, list_transform({tx.sql_tokens(text)}, lambda t: {tx.sql_name_key('t')}) AS cleaned FROM {source}),
{name}_i AS (SELECT *, unnest(range(len(tokens))) AS i FROM {name}_tok),
{name}_win AS (SELECT *, unnest(range(i + 1, len(tokens) + 1)) AS j FROM {name}_i),
{name}_key AS (SELECT {ids}, text, tokens, i, j, {key} AS key, NOT {starts_lower('tokens[i + 1]')} AS capital FROM {name}_win),
{name}_hit AS (SELECT w.*, d.kind, d.m FROM {name}_key w JOIN dictionary d USING (key) WHERE d.kind = 'epithet' OR w.capital OR NOT d.genus_rank
    QUALIFY row_number() OVER (PARTITION BY {ids}, d.kind ORDER BY i, j DESC) = 1)"""


_M = "struct_pack(canonical_name := {c}, genus := {g}, epithet := {e}, infraspecific_epithet := {i}, authorship := {a}, taxon_rank := {r}, source := source, authors := {l})"
DICTIONARY = f"""dictionary AS (SELECT key, 'name' AS kind, taxon_rank = 'genus' AS genus_rank, {_M.format(c='canonical_name', g='genus', e='epithet', i='infraspecific_epithet', a='authorship', r='taxon_rank', l='listed')} AS m FROM canonical JOIN authors USING (key)
    UNION ALL SELECT key, 'genus', true, {_M.format(c='canonical_name', g='genus', e='NULL', i='NULL', a='authorship', r='taxon_rank', l="''")} FROM genera
    UNION ALL SELECT key, 'epithet', false, {_M.format(c='NULL', g='NULL', e='epithet', i='infraspecific_epithet', a='NULL', r="'epithet'", l="''")} FROM epithets)"""
_WINDOW = "array_to_string(tokens[i + 1:j], ' ')"
_INNER = tx.sql_trim_outer(_WINDOW)
_PIECES = f"list_filter([left({_WINDOW}, position({_INNER} IN {_WINDOW}) - 1), substring({_WINDOW}, position({_INNER} IN {_WINDOW}) + length({_INNER}))], lambda p: p <> '')"
_REMAINING = f"array_to_string(list_concat(list_concat(tokens[1:i], {_PIECES}), tokens[j + 1:]), ' ')"

RECOGNISED = f"""{DICTIONARY},
syn AS (SELECT doc, line_nr, pre, unnest({tx.sql_synonym_strings('pre')}) AS string, generate_subscripts({tx.sql_synonym_strings('pre')}, 1) AS k FROM lines WHERE length(pre) > 0),
{windows('syn', 'syn', 'doc, line_nr, k', 'string')},
synonyms AS (SELECT doc, line_nr, list({tx.sql_strip("m.canonical_name || ' ' || coalesce(m.authorship, '')")} || ' [' || {_INNER} || ']' ORDER BY k) AS listed, list(text ORDER BY k) AS strings FROM syn_hit WHERE kind = 'name' GROUP BY doc, line_nr),
txt AS (SELECT l.doc, l.line_nr, l.pre, s.listed, CASE WHEN s.strings IS NULL THEN l.pre ELSE list_reduce(list_concat([l.pre], s.strings), lambda a, b: replace(a, b, '')) END AS body
    FROM lines l LEFT JOIN synonyms s USING (doc, line_nr) WHERE length(l.pre) > 0),
{windows('t', 'txt', 'doc, line_nr', 'body')},
t_item AS (SELECT doc, line_nr, kind, {_INNER} AS found, m, {_REMAINING} AS remaining FROM t_hit),
wide AS (SELECT x.doc, x.line_nr, x.body, x.listed, n.found AS name_text, n.m AS name, g.found AS genus_text, g.m AS genus, e.found AS epithet_text, e.m AS epithet, coalesce(n.remaining, x.body) AS rest1
    FROM txt x LEFT JOIN (SELECT * FROM t_item WHERE kind = 'name') n USING (doc, line_nr) LEFT JOIN (SELECT * FROM t_item WHERE kind = 'genus') g USING (doc, line_nr)
    LEFT JOIN (SELECT * FROM t_item WHERE kind = 'epithet') e USING (doc, line_nr)),
cult AS (SELECT *, CASE WHEN name_text IS NOT NULL OR epithet_text IS NOT NULL THEN {tx.sql_cultivar('rest1')} END AS cultivar FROM wide),
cult2 AS (SELECT *, CASE WHEN cultivar IS NULL THEN rest1 ELSE replace(rest1, cultivar, '') END AS rest2 FROM cult),
code AS (SELECT *, {tx.sql_ipen('rest2')} AS ipen FROM cult2),
rec AS (SELECT l.doc, l.line_nr, l.raw, l.filename, l.garden_code, l.year, c.* EXCLUDE (doc, line_nr, rest1, rest2, body), CASE WHEN c.ipen IS NULL THEN c.rest2 ELSE replace(c.rest2, c.ipen, '') END AS rest
    FROM lines l LEFT JOIN code c USING (doc, line_nr))"""
BASE = f"WITH RECURSIVE {NAMES}, {AUTHORS}, {LINES}, {RECOGNISED}"

_AT = "position(epithet_text IN rest)"
_ENTRY = "(has_name OR has_epithet OR has_genus)"
CONTEXT = f"""seen AS (SELECT * EXCLUDE (rest), name_text IS NOT NULL AS has_name, epithet_text IS NOT NULL AS has_epithet, genus_text IS NOT NULL AS has_genus, coalesce(len(listed), 0) > 0 AS has_synonyms,
    CASE WHEN epithet_text IS NOT NULL AND name_text IS NULL AND {_AT} > 0 THEN left(rest, {_AT} - 1) || substring(rest, {_AT} + length(epithet_text)) ELSE rest END AS rest FROM rec),
seen2 AS (SELECT *, CASE WHEN {_ENTRY} AND length(rest) > 0 THEN {tx.sql_strip('rest')} END AS meta_rest, {_ENTRY} OR cultivar IS NOT NULL OR has_synonyms AS has_any,
    has_name OR has_epithet OR cultivar IS NOT NULL OR has_synonyms AS boundary, {tx.sql_strip('raw')} AS bare FROM seen),
blocks AS (SELECT *, sum(CAST(boundary AS INTEGER)) OVER (PARTITION BY doc ORDER BY line_nr) AS block FROM seen2),
behind AS (SELECT a.doc, a.line_nr, list(b.bare ORDER BY b.line_nr)[1:5] AS items FROM blocks a JOIN blocks b ON a.doc = b.doc AND a.block = b.block AND b.line_nr > a.line_nr AND NOT b.boundary AND length(b.bare) > 0
    WHERE a.has_name OR a.has_epithet OR a.has_genus GROUP BY a.doc, a.line_nr),
ranked AS (SELECT s.*, h.items, coalesce(len(h.items), 0) AS size, CASE WHEN has_name THEN row_number() OVER (PARTITION BY s.doc, has_name ORDER BY s.line_nr) END AS rank, sum(CAST(has_name AS INTEGER)) OVER (PARTITION BY s.doc) AS names
    FROM seen2 s LEFT JOIN behind h USING (doc, line_nr)),
kept AS (SELECT *, CAST(ceil(avg(CASE WHEN rank > 1 AND rank < names THEN size END) OVER (PARTITION BY doc)) AS INTEGER) AS keep FROM ranked),
ctx AS (SELECT * EXCLUDE (items), CASE WHEN names > 3 AND rank = names AND items IS NOT NULL THEN CASE WHEN len(items[1:keep]) > 0 THEN items[1:keep] END ELSE items END AS meta_next FROM kept)"""
IN_CONTEXT = f"{BASE}, {CONTEXT}"

_TMP = "CASE WHEN length(coalesce(meta_rest, '')) > 0 THEN meta_rest ELSE coalesce(array_to_string(meta_next, ' '), '') END"
_SYMBOLS = ", ".join(f"({i}, {q(s)}, {str(a).lower()}, {q(p1)}, {q(p2)}, {q(p3)}, {q(p4)}, {q(p5)})" for i, s, a, p1, p2, p3, p4, p5 in patterns())
_CAPITALS = "length(regexp_replace({t}, '\\P{{Lu}}', '', 'g'))"
_SINGLE = f"regexp_replace(raw, '[{tx.BLANK}]+', ' ', 'g')"
LEGEND = f"""symbols(sym, symbol, alphabetic, seen_p, starts_p, quoted_p, loose_p, noted_p) AS (VALUES {_SYMBOLS}),
noted AS (SELECT * FROM (SELECT doc, line_nr, {_TMP} AS tmp FROM ctx WHERE has_any) WHERE tmp <> ''),
counted AS (SELECT doc, sym, symbol, alphabetic, count(*) AS n, min(line_nr) AS first_line FROM noted, symbols WHERE regexp_matches(tmp, seen_p) GROUP BY ALL),
detected AS (SELECT doc, sym, symbol, n, first_line FROM (SELECT *, sum(n) OVER (PARTITION BY doc) AS total FROM counted) WHERE NOT alphabetic OR n / total > {RARE_SHARE}),
near AS (SELECT doc, sym, symbol, line_nr, {tx.sql_strip(_SINGLE)} AS text FROM (SELECT * FROM ctx WHERE length(trim(raw)) > 0 AND ipen IS NULL AND regexp_matches(raw, '[a-zA-Z]')) JOIN detected USING (doc) JOIN symbols USING (sym, symbol)
    WHERE regexp_matches(raw, starts_p) OR regexp_matches(raw, quoted_p)),
prim AS (SELECT doc, sym, text AS a FROM near WHERE length(text) > 10 AND contains(text, ' ') QUALIFY row_number() OVER (PARTITION BY doc, sym ORDER BY {_CAPITALS.format(t='text')}, position(symbol IN text), line_nr) = 1),
loose AS (SELECT doc, sym, raw FROM ctx JOIN detected USING (doc) JOIN symbols USING (sym, symbol) WHERE NOT has_any AND regexp_matches(raw, '\\p{{L}}') AND regexp_matches(raw, loose_p)
    QUALIFY row_number() OVER (PARTITION BY doc, sym ORDER BY {_CAPITALS.format(t='raw')}, ctx.line_nr) = 1),
fallback AS (SELECT doc, sym, {tx.sql_strip('raw')} AS b FROM loose WHERE length({tx.sql_strip('raw')}) > 10 AND contains({tx.sql_strip('raw')}, ' ')),
described AS (SELECT d.doc, d.sym, d.symbol, d.first_line, coalesce(a, b) AS descriptor FROM detected d LEFT JOIN prim USING (doc, sym) LEFT JOIN fallback USING (doc, sym) WHERE coalesce(a, b) IS NOT NULL),
notes AS (SELECT doc, line_nr, string_agg(descriptor, '; ' ORDER BY first_line, sym) AS notes FROM noted JOIN described USING (doc) JOIN symbols USING (sym, symbol) WHERE regexp_matches(tmp, noted_p) GROUP BY doc, line_nr)"""

_FORWARD = "(PARTITION BY doc ORDER BY line_nr ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
_BACKWARD = "(PARTITION BY doc ORDER BY line_nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_NEXT_TWO = "(PARTITION BY doc ORDER BY line_nr RANGE BETWEEN 1 FOLLOWING AND 2 FOLLOWING)"
_CODE = "CASE WHEN has_name THEN '' WHEN ipen IS NOT NULL THEN ipen END"
_LISTED = "nullif(array_to_string(listed, '; '), '')"


def _next(value: str) -> str:
    return f"coalesce({value}, first_value(CASE WHEN NOT has_name THEN {value} END IGNORE NULLS) OVER {_NEXT_TWO}, '')"


NEXT = f"""nxt AS (SELECT *, coalesce(ipen, first_value({_CODE} IGNORE NULLS) OVER {_FORWARD}, '') AS ipen_next, coalesce(ipen, last_value({_CODE} IGNORE NULLS) OVER {_BACKWARD}, '') AS ipen_before,
    {_next(_LISTED)} AS synonyms_next, {_next("nullif(cultivar, '')")} AS cultivar_next FROM ctx)"""

_ITEM = "coalesce(name, epithet, genus)"
_OTHER = "(has_name AND has_genus AND genus.genus IS DISTINCT FROM name.genus)"
_STRIPPED = f"list_filter(list_transform(meta_next, lambda x: {tx.sql_strip('CASE WHEN ipen_next = chr(39) || chr(39) THEN x ELSE replace(x, ipen_next, chr(39) || chr(39)) END')}), lambda x: x <> '')".replace("chr(39) || chr(39)", "''")
ROWS = f"""SELECT doc, line_nr AS line, coalesce(name_text, epithet_text, genus_text) AS extracted_name, name.canonical_name AS match_name, 1.0::DOUBLE AS match_score, {_ITEM}.taxon_rank AS match_rank,
    CASE WHEN has_name THEN name.genus WHEN NOT has_epithet THEN genus.genus END AS match_genus, CASE WHEN has_name THEN name.epithet WHEN has_epithet THEN epithet.epithet END AS match_epithet,
    CASE WHEN has_name OR has_epithet THEN {_ITEM}.infraspecific_epithet END AS match_infraspecific_epithet, {_ITEM}.authors AS match_authorship,
    coalesce(has_name AND contains({tx.sql_strip("name.canonical_name || ' ' || coalesce(name.authorship, '')")}, ' × '), false) AS match_is_hybrid, {_ITEM}.source AS match_source,
    CASE WHEN {_OTHER} THEN genus_text END AS genus_extracted_name, CASE WHEN {_OTHER} THEN genus.genus END AS genus_match_genus, CASE WHEN {_OTHER} THEN 1.0::DOUBLE END AS genus_match_score,
    CASE WHEN {_OTHER} THEN genus.source END AS genus_match_source, synonyms_next AS extracted_synonyms, cultivar_next AS extracted_cultivar_form, ipen_next AS extracted_ipen, meta_rest AS extracted_metadata_remnant,
    CASE WHEN len({_STRIPPED}) > 0 THEN array_to_string({_STRIPPED}, '; ') END AS extracted_metadata_next_lines, notes AS extracted_notes, raw AS raw_line, filename, garden_code, year
    FROM nxt LEFT JOIN notes USING (doc, line_nr) WHERE has_name OR has_epithet OR has_genus"""

_S = Fuzzy()
_SPLIT_A, _SPLIT_B = "pre", "next_pre"


def _longest(code: str, part: str) -> str:
    return f"coalesce(list_max(list_filter(range(1, length({code}) + 1), lambda k: k <= length({part}) AND contains({code}, {{}}))), 0)"


_OPTIONS = f"""t AS (SELECT doc, line_nr, raw, list_filter(list_transform({tx.sql_tokens('raw')}, lambda x: {tx.sql_clean_name(tx.sql_drop_abbreviations('x'))}), lambda x: length(x) >= {_S.min_token_length}) AS t FROM looked),
            i AS (SELECT *, unnest(range(len(t))) AS i FROM t), j AS (SELECT *, unnest(range(i + 1, len(t) + 1)) AS j FROM i),
            c AS (SELECT doc, line_nr, raw, array_to_string(t[i + 1:j], ' ') AS option, j - i AS num_tokens, i, j FROM j
                WHERE CASE WHEN len(t) >= {_S.min_tokens} THEN len(t) - i <= {_S.max_tokens} AND j - i >= {_S.min_tokens} ELSE j = i + 1 AND length(t[i + 1]) >= {_S.large_token_length} END)"""


def fuzzy(first: str, threshold: float = 0.9) -> str:
    """Lines with a fuzzy name; `first` orders the options of a line."""
    base = f"{BASE}, looked AS (SELECT * FROM rec WHERE name_text IS NULL OR name.taxon_rank = 'genus')"
    return f"""{base}, {_OPTIONS},
uniq AS (SELECT DISTINCT option AS lookup FROM c),
reach AS (SELECT lookup, key, prio, ord, lower(canonical_name) AS name, levenshtein(lookup, key) AS d FROM uniq, canonical WHERE taxon_rank <> 'genus'
    AND abs(length(lookup) - length(canonical_name)) <= {1 - threshold:.3f} * (length(lookup) + length(canonical_name)) + 1e-6
    AND levenshtein(lookup, lower(canonical_name)) <= {1 - threshold:.3f} * (length(lookup) + length(canonical_name)) + 1e-6),
least AS (SELECT lookup, min(d) AS d FROM reach GROUP BY lookup),
nearest AS (SELECT l.lookup, c.key, lower(c.canonical_name) AS name FROM least l JOIN canonical c ON abs(length(l.lookup) - length(c.key)) <= l.d
    QUALIFY row_number() OVER (PARTITION BY l.lookup ORDER BY levenshtein(l.lookup, c.key), c.prio, c.ord) = 1),
pairs AS (SELECT lookup AS a, name AS b FROM nearest),
{ratios('pairs')},
scored AS (SELECT n.lookup, c.canonical_name, CAST(printf('%.2f', r.score) AS DOUBLE) AS score FROM nearest n JOIN ratio r ON n.lookup = r.a AND n.name = r.b JOIN canonical c USING (key) WHERE r.score >= {threshold} AND c.taxon_rank <> 'genus'),
shared AS (SELECT doc, lower(lookup) AS low, arg_max(canonical_name, lookup) AS canonical_name, arg_max(score, lookup) AS score FROM (SELECT DISTINCT doc, option AS lookup FROM c) JOIN scored USING (lookup) GROUP BY ALL),
best AS (SELECT c.doc, c.line_nr, option, s.canonical_name, s.score FROM c JOIN shared s ON c.doc = s.doc AND lower(c.option) = s.low
    QUALIFY row_number() OVER (PARTITION BY c.doc, c.line_nr ORDER BY {first}, num_tokens, i, j DESC) = 1)
SELECT b.doc, b.line_nr, option, canonical_name, score, list_reduce(list_concat([coalesce(l.rest, '')], string_split(option, ' ')), lambda t, b: {tx.sql_strip("replace(t, b, '')")}) AS rest
FROM best b JOIN looked l USING (doc, line_nr) WHERE score < 1"""


_TOKENS = tx.sql_tokens("t.name || ' ' || epithet")
_PLACES = f"flatten(list_transform(range(1, len({_TOKENS}) + 1), lambda i: list_transform(range(len({_TOKENS}), i - 1, -1), lambda j: [i, j])))"
_OF_PLACE = f"array_to_string({_TOKENS}[p[1]:p[2]], ' ')"
_KEY = tx.sql_name_key(_OF_PLACE)
_MET = f"list_filter({_PLACES}, lambda p: map_contains(d, {_KEY}) AND NOT (d[{_KEY}].is_genus AND {starts_lower(f'{_TOKENS}[p[1]]')}))[1]"
_FOUND = f"list_transform([{_MET}], lambda p: struct_pack(state := t.name, orig := t.orig, key := {_KEY}, piece := {tx.sql_trim_outer(_OF_PLACE)}, canonical := d[{_KEY}].canonical_name))[1]"
_WORDS = tx.sql_tokens("named")
_EPITHETS_OF = f"""solo AS (SELECT doc, line_nr, row_number() OVER (PARTITION BY doc ORDER BY line_nr) AS k, len({tx.sql_repeat_symbols(tx.sql_preprocess('raw'))}) AS repeats, name_text, name.canonical_name AS canonical, name.taxon_rank AS name_rank, genus.genus AS genus, epithet.epithet AS epithet
    FROM rec WHERE name_text IS NOT NULL OR genus_text IS NOT NULL OR epithet_text IS NOT NULL),
held AS (SELECT DISTINCT doc, unnest(string_split({tx.sql_name_key('t')}, ' ')) AS word FROM (SELECT doc, unnest([canonical, genus, epithet]) AS t FROM solo) WHERE t IS NOT NULL),
needed AS (SELECT key, canonical_name, taxon_rank = 'genus' AS is_genus, unnest(list_distinct(string_split(key, ' '))) AS word, len(list_distinct(string_split(key, ' '))) AS n FROM canonical),
reachable AS (SELECT doc, key, any_value(canonical_name) AS canonical_name, any_value(is_genus) AS is_genus FROM held JOIN needed USING (word) GROUP BY doc, key HAVING count(*) = any_value(n)),
maps AS (SELECT doc, map(list(key ORDER BY key), list(struct_pack(canonical_name := canonical_name, is_genus := is_genus) ORDER BY key)) AS d FROM reachable GROUP BY doc),
fold(doc, k, line_nr, p_genus, p_other, p_species, txt, key) AS (
    SELECT DISTINCT doc, 0::BIGINT, 0, NULL::VARCHAR, NULL::STRUCT(name VARCHAR, orig VARCHAR), NULL::STRUCT(name VARCHAR, orig VARCHAR), NULL::VARCHAR, NULL::VARCHAR FROM solo
    UNION ALL SELECT doc, k, line_nr,
        CASE WHEN genus IS NOT NULL AND repeats = 0 THEN genus WHEN named IS NOT NULL AND below AND repeats = 0 THEN {_WORDS}[1] ELSE p_genus END,
        CASE WHEN genus IS NOT NULL AND repeats = 0 THEN CASE WHEN named IS NOT NULL AND below AND {_WORDS}[1] <> genus THEN struct_pack(name := {_WORDS}[1], orig := genus) END
            WHEN named IS NOT NULL AND below AND repeats = 0 THEN NULL ELSE p_other END,
        CASE WHEN named IS NOT NULL THEN struct_pack(name := array_to_string({_WORDS}[1:2], ' '), orig := named_text) WHEN genus IS NOT NULL AND repeats = 0 THEN NULL ELSE p_species END,
        CASE WHEN hit IS NOT NULL THEN named_text END, hit.key
    FROM (SELECT *, hit IS NOT NULL AND {tx.sql_name_key('named_text')} <> {tx.sql_name_key('named')} AS below FROM (SELECT *, coalesce(hit.canonical, canonical) AS named,
        CASE WHEN hit IS NULL THEN name_text WHEN hit.orig IS NOT NULL THEN hit.orig || ' ' || epithet ELSE hit.piece END AS named_text
        FROM (SELECT *, list_filter(list_transform(tries, lambda t: {_FOUND}), lambda h: h.key IS NOT NULL AND h.canonical <> h.state)[1] AS hit FROM (
            SELECT l.*, m.d, f.p_genus, f.p_other, f.p_species, CASE WHEN epithet IS NOT NULL AND (name_text IS NULL OR name_rank = 'genus') AND m.d IS NOT NULL THEN list_filter([
                CASE WHEN f.p_species IS NOT NULL AND repeats IN (0, 2) THEN f.p_species END, CASE WHEN f.p_genus IS NOT NULL AND repeats <= 1 THEN struct_pack(name := f.p_genus, orig := NULL::VARCHAR) END,
                CASE WHEN f.p_other IS NOT NULL AND repeats <= 1 THEN f.p_other END], lambda t: t IS NOT NULL) ELSE [] END AS tries
            FROM fold f JOIN solo l ON l.doc = f.doc AND l.k = f.k + 1 LEFT JOIN maps m ON m.doc = l.doc)))))"""
_FIRST_WORD = "string_split(name_text, ' ')[1]"
_CUT = "length(acc[1]) - position(reverse(g[1]) IN reverse(acc[1])) - length(g[1]) + 2"


def oracle_sql() -> dict[str, str]:
    """By query."""
    lookups = "(SELECT entry_id, extracted_name FROM list_entries WHERE extracted_name IS NOT NULL)"
    of_lines = "(SELECT line_id, raw_line AS t FROM document_lines WHERE raw_line IS NOT NULL)"
    pre = tx.sql_preprocess("t")
    end_size = _longest("code", "pre").format("right(pre, k)")
    start_size = _longest("code", "next_pre").format("left(next_pre, k)")
    return {
        "names_rank_filter": f"WITH {NAMES} SELECT ord, source, taxon_rank FROM names",
        "names_clean": f"WITH {NAMES} SELECT ord, {ALL_FIELDS}, prio FROM names",
        "names_union": f"WITH {NAMES} SELECT source, taxon_rank, count(*) AS n_names FROM (SELECT source, taxon_rank FROM names UNION ALL SELECT 'list', taxon_rank FROM reference_names) GROUP BY ALL",
        "canonical_dedup": f"WITH {NAMES} SELECT key, {ALL_FIELDS} FROM canonical",
        "genus_dedup": f"WITH {NAMES} SELECT key, {ALL_FIELDS} FROM genera",
        "epithet_dedup": f"WITH {NAMES} SELECT key, epithet, infraspecific_epithet, taxon_rank, source FROM epithets",
        "authorship_list": f"WITH {NAMES}, {AUTHORS} SELECT key, listed AS match_authorship, contains({FULL}, ' × ') AS is_hybrid FROM canonical JOIN authors USING (key)",
        "lines_explode": f"SELECT doc_id, CAST(generate_subscripts(p, 1) - 1 AS INTEGER) AS line_nr, unnest(p) AS raw FROM (SELECT doc_id, {tx.sql_split_lines('text')} AS p FROM documents WHERE text IS NOT NULL)",
        "line_preprocess": f"SELECT line_id, {pre} AS pre FROM {of_lines}",
        "name_cleaning": f"""SELECT line_id, {tx.sql_clean_name(tx.sql_drop_abbreviations('t'))} AS fully, regexp_replace(t, '[{tx.BLANK}]+', ' ', 'g') AS single,
            {tx.sql_drop_abbreviations('t')} AS short, {tx.sql_clean_name('t')} AS letters FROM {of_lines}""",
        "outer_trim": f"SELECT line_id, {tx.sql_trim_outer('t')} AS inner_text FROM {of_lines}",
        "line_parts": f"""WITH p AS (SELECT line_id, {pre} AS pre FROM {of_lines}) SELECT line_id, array_to_string({tx.sql_synonym_strings('pre')}, '|') AS synonyms, {tx.sql_cultivar('pre')} AS cultivar,
            {tx.sql_ipen('pre')} AS ipen, CAST(coalesce(position({tx.sql_ipen('pre')} IN pre) - 1, -1) AS INTEGER) AS ipen_at, array_to_string({tx.sql_repeat_symbols('pre')}, '') AS repeats FROM p""",
        "filename_vars": f"SELECT file_id, {_GARDEN} AS garden, {_YEAR} AS year FROM seedlist_files",
        "exact_canonical": f"""WITH {NAMES} SELECT entry_id, canonical_name, taxon_rank, source FROM {lookups} l JOIN canonical c ON {tx.sql_name_key('extracted_name')} = c.key
            WHERE NOT (taxon_rank = 'genus' AND {starts_lower('extracted_name')})""",
        "exact_genus": f"""WITH {NAMES}, w AS (SELECT entry_id, string_split(extracted_name, ' ')[1] AS word FROM {lookups}) SELECT entry_id, genus, source FROM w JOIN genera g ON {tx.sql_name_key('word')} = g.key
            WHERE NOT {starts_lower('word')}""",
        "exact_epithet": f"""WITH {NAMES}, w AS (SELECT entry_id, string_split(extracted_name, ' ')[-1] AS word FROM {lookups}) SELECT entry_id, epithet, infraspecific_epithet, source
            FROM w JOIN epithets e ON {tx.sql_name_key('word')} = e.key""",
        "leftmost_longest": f"""WITH {NAMES}, {AUTHORS}, {LINES}, {DICTIONARY}, {windows('t', 'lines', 'doc, line_nr', 'pre')}
            SELECT doc, line_nr, kind, i::INTEGER AS i, j::INTEGER AS j, coalesce(m.canonical_name, m.epithet) AS matched, m.source AS source FROM t_hit""",
        "recognised_lines": f"""{BASE} SELECT doc, line_nr, name_text, name.canonical_name AS canonical_name, genus.genus AS genus, epithet.epithet AS epithet, {_LISTED} AS synonyms, cultivar, ipen, rest FROM rec""",
        "fuzzy_candidates": f"""WITH {LINES}, looked AS (SELECT * FROM lines), {_OPTIONS}
            SELECT doc, line_nr, option, num_tokens::INTEGER AS num_tokens, i::INTEGER AS i, j::INTEGER AS j, CAST(position(lower(option) IN lower(raw)) - 1 AS INTEGER) AS index FROM c""",
        "nearest_names": f"""WITH keys AS (SELECT {tx.sql_name_key('canonical_name')} AS key, min(ref_id) AS ord FROM reference_names GROUP BY 1),
            asked AS (SELECT DISTINCT {tx.sql_clean_name(tx.sql_drop_abbreviations('extracted_name'))} AS lookup FROM {lookups})
            SELECT lookup, arg_min(key, (d, ord)) AS key, CAST(min(d) AS INTEGER) AS distance FROM (SELECT lookup, key, ord, levenshtein(lookup, key) AS d FROM asked, keys WHERE lookup <> '') GROUP BY lookup""".replace("arg_min(key, (d, ord))", "arg_min(key, {'d': d, 'ord': ord})"),
        "near_blocks": f"""WITH l AS (SELECT file_id AS doc, line_nr, coalesce(arg_max(raw_line, line_id), '') AS raw FROM document_lines GROUP BY ALL),
            e AS (SELECT DISTINCT file_id AS doc, line AS line_nr FROM list_entries WHERE match_name IS NOT NULL),
            m AS (SELECT l.*, e.doc IS NOT NULL AS named, {tx.sql_preprocess('raw')} AS pre FROM l LEFT JOIN e USING (doc, line_nr)),
            n AS (SELECT doc, line_nr, line_nr - lag(line_nr) OVER (PARTITION BY doc ORDER BY line_nr) > 10 AS gap FROM m WHERE named),
            g AS (SELECT doc, line_nr, sum(CASE WHEN gap THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY line_nr) AS grp FROM n),
            b AS (SELECT doc, grp, min(line_nr) AS lo, max(line_nr) AS hi FROM g GROUP BY ALL), s AS (SELECT doc, count(*) AS n, count(*) FILTER (WHERE named) AS k FROM m GROUP BY doc)
            SELECT m.doc, m.line_nr FROM m JOIN s USING (doc) WHERE s.n <= 100 OR s.k = 0 OR (length(pre) > 0 AND len({tx.sql_tokens('pre')}) < 10
                AND EXISTS (SELECT 1 FROM b WHERE b.doc = m.doc AND m.line_nr BETWEEN b.lo AND b.hi))""",
        "split_codes": f"""WITH {LINES}, s AS (SELECT doc, line_nr, pre, lead(line_nr) OVER w AS next_nr, lead(pre) OVER w AS next_pre FROM lines WHERE length(pre) > 0 WINDOW w AS (PARTITION BY doc ORDER BY line_nr)),
            c AS (SELECT *, {tx.sql_ipen('pre || next_pre')} AS code FROM s WHERE next_pre IS NOT NULL AND {tx.sql_ipen('pre')} IS NULL AND {tx.sql_ipen('next_pre')} IS NULL)
            SELECT doc, line_nr, code AS ipen, right(pre, {end_size}) AS first_half, next_nr, left(next_pre, {start_size}) AS second_half FROM c WHERE code IS NOT NULL""",
        "next_values": f"{IN_CONTEXT}, {NEXT} SELECT doc, line_nr, ipen_next, ipen_before, synonyms_next, cultivar_next FROM nxt",
        "meta_lines": f"{IN_CONTEXT} SELECT doc, line_nr, meta_rest, array_to_string(meta_next, '|') AS meta_next FROM ctx WHERE has_name OR has_epithet OR has_genus",
        "legend_detect": f"{IN_CONTEXT}, {LEGEND} SELECT doc, sym, symbol, n, first_line FROM detected",
        "legend_describe": f"{IN_CONTEXT}, {LEGEND} SELECT doc, sym, symbol, first_line, descriptor FROM described",
        "legend_notes": f"{IN_CONTEXT}, {LEGEND} SELECT doc, line_nr, notes FROM notes",
        "exact_rows": f"{IN_CONTEXT}, {LEGEND}, {NEXT} {ROWS}",
        "content_lines": f"WITH {CONTENTS} SELECT file_id, line_nr, page, raw FROM content_lines",
        "fuzzy_best_score": fuzzy("s.score DESC, length(option) DESC"),
        "fuzzy_longest_name": fuzzy("length(option) DESC, s.score DESC"),
        "epithet_resolution": f"{BASE}, {_EPITHETS_OF} SELECT doc, line_nr, txt AS text, key FROM fold WHERE key IS NOT NULL",
        "genera_scores": f"""{BASE}, named AS (SELECT doc, line_nr, lower(coalesce(genus.genus, {_FIRST_WORD})) AS a, lower(name.genus) AS b FROM rec WHERE name_text IS NOT NULL), {ratios('named')}
            SELECT doc, line_nr, round(score, 9) AS score FROM named JOIN ratio USING (a, b)""",
        "split_on_genera": f"""WITH RECURSIVE {NAMES}, l AS (SELECT line_id, raw_line AS raw, {tx.sql_preprocess('raw_line')} AS pre FROM document_lines WHERE raw_line IS NOT NULL),
            t AS (SELECT line_id, generate_subscripts({tx.sql_tokens('pre')}, 1) AS i, unnest({tx.sql_tokens('pre')}) AS token FROM l),
            g AS (SELECT line_id, list([token] ORDER BY i DESC) AS found FROM t WHERE {tx.sql_name_key('token')} IN (SELECT key FROM genera) AND NOT {starts_lower('token')} GROUP BY line_id HAVING count(*) > 1),
            s AS (SELECT line_id, list_reduce(list_concat([[pre]], found), lambda acc, g: list_concat(CASE WHEN contains(acc[1], g[1]) THEN [left(acc[1], {_CUT} - 1), substring(acc[1], {_CUT})]
                ELSE [left(acc[1], length(acc[1]) - 1), right(acc[1], 1)] END, acc[2:])) AS parts FROM g JOIN l USING (line_id)),
            w AS (SELECT line_id, list_concat([parts[1] || parts[2]], parts[3:]) AS parts FROM s)
            SELECT line_id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS part, unnest(parts) AS raw FROM w UNION ALL SELECT line_id, 0, raw FROM l WHERE line_id NOT IN (SELECT line_id FROM w)""",
        "skip_existing": "SELECT file_id, filename FROM seedlist_files WHERE file_id NOT IN (SELECT file_id FROM list_entries WHERE file_id IS NOT NULL)",
    }
