"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force in tests/llm."""

from __future__ import annotations

from hortulus.llm.records import ABSENT_AUTHORS, RANK_WORDS

_INNER = "regexp_replace(replace(lower(coalesce({c}, '')), 'ß', 'ss'), '(\\p{{L}})[-­‐‑‒–—](\\p{{L}})', '\\1\\2', 'g')"
_PLAIN = "trim(regexp_replace(regexp_replace(" + _INNER + ", '([×&])', ' \\1 ', 'g'), '[^\\p{{L}}\\p{{M}}\\p{{N}}×&]+', ' ', 'g'))"


def plain(column: str) -> str:
    return _PLAIN.format(c=column)


def unordered(column: str) -> str:
    glued = f"regexp_replace({plain(column)}, '(^| )({'|'.join(RANK_WORDS)}|×) ', '\\1\\2~', 'g')"
    return f"array_to_string(list_sort(string_split({glued}, ' ')), ' ')"


NAME_KEY = f"""concat_ws(chr(2), {unordered('canonical_name')}, least({plain('genus')}, {plain('epithet')}), greatest({plain('genus')}, {plain('epithet')}),
    {plain('infraspecific_epithet')}, {plain('taxon_rank')})"""
RECORD_KEY = f"concat_ws(chr(2), {NAME_KEY}, {plain('authorship')}, {plain('source')})"
HAS_AUTHOR = f"({plain('authorship')} NOT IN ({', '.join(repr(x) for x in ABSENT_AUTHORS)}) AND regexp_matches({plain('authorship')}, '\\p{{L}}'))"
ORDER = "coalesce(priority, 2147483648), coalesce(epoch_us(loaded_at), -4611686018427387904) DESC, ord"


def oracle_sql() -> dict[str, str]:
    """By query."""
    return {
        "p1_found": f"""
            WITH k AS (SELECT n.*, s.priority, {NAME_KEY} AS k, {HAS_AUTHOR} AS has FROM name_lookup n LEFT JOIN name_sources s USING (source)),
            r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY {ORDER}) AS a, row_number() OVER (PARTITION BY k, has ORDER BY {ORDER}) AS b FROM k)
            SELECT min(ord) AS group_ord, min(CASE WHEN a = 1 THEN ord END) AS name_ord, coalesce(min(CASE WHEN b = 1 AND has THEN ord END), -1) AS authorship_ord
            FROM r GROUP BY k HAVING count(*) > 1""",
        "p1_voted": f"""
            WITH k AS (SELECT n.*, s.priority, {NAME_KEY} AS k, {HAS_AUTHOR} AS has, coalesce(1.0 / s.priority, 0) AS trust,
                coalesce(pow(0.5, (max(epoch_us(loaded_at)) OVER () - epoch_us(loaded_at)) / 86400000000.0 / 365.0), pow(0.5, 10)) AS recency FROM name_lookup n LEFT JOIN name_sources s USING (source)),
            l AS (SELECT k, ord, priority, loaded_at, trust * recency AS vote, 'n' AS field, concat(coalesce(canonical_name, ''), chr(1), coalesce(source, '')) AS v FROM k
                UNION ALL SELECT k, ord, priority, loaded_at, trust * recency, 'a', authorship FROM k WHERE has),
            f AS (SELECT k, field, round(sum(vote) OVER (PARTITION BY k, field, {plain('v')}), 6) AS votes, v, ord, row_number() OVER (PARTITION BY k, field ORDER BY {ORDER}) AS place FROM l),
            w AS (SELECT k, field, v FROM f QUALIFY row_number() OVER (PARTITION BY k, field ORDER BY votes DESC, place) = 1),
            g AS (SELECT k, min(ord) AS group_ord, count(*) AS copies FROM k GROUP BY k HAVING count(*) > 1)
            SELECT group_ord, copies, string_split(n.v, chr(1))[1] AS canonical_name, string_split(n.v, chr(1))[2] AS source, a.v AS authorship
            FROM g JOIN (SELECT * FROM w WHERE field = 'n') n USING (k) LEFT JOIN (SELECT * FROM w WHERE field = 'a') a USING (k)""",
        "p4_found": f"""
            WITH k AS (SELECT ord, min(ord) OVER (PARTITION BY {RECORD_KEY}) AS ord_a FROM name_lookup)
            SELECT ord_a, ord AS ord_b FROM k WHERE ord_a < ord""",
        "p4_collapsed": f"SELECT min(ord) AS ord, count(*) AS copies FROM name_lookup GROUP BY {RECORD_KEY}",
    }
