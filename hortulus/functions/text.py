"""Scalar text functions, each as a Spark column and as DuckDB SQL of the same meaning.

White space is Python's notion of it, written out as a class, because the engines' own \\s differ.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space, and characters that break lines.
BLANK = "\\t-\\r\\x1c-\\x20\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
BLANKS = "".join(map(chr, (*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
LINE_BREAK = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\x{2028}\\x{2029}]"
# The characters that are one dash.
DASHES = "\\x{2013}\\x{2014}\\x{002d}\\x{00ad}\\x{2010}\\x{2011}\\x{2e5d}\\x{058a}\\x{05be}\\x{1806}\\x{1b60}\\x{2e17}\\x{30fb}\\x{fe63}\\x{ff0d}\\x{ff65}\\x{1400}\\x{2027}\\x{2043}\\x{2e1a}\\x{2e40}\\x{30a0}"
# Abbreviations that are dropped from names, with or without their dot.
ABBREVIATIONS = ("aff.", "agg.", "ambig.", "cl.", "f.", "gx", "ssp.", "sp.", "subsp.", "subvar.", "var.", "convar.")
DROPPED = (*ABBREVIATIONS, *(a[:-1] for a in ABBREVIATIONS if a.endswith(".")))
# Delimiters of variety names, in order of precedence.
CULTIVAR_DELIMITERS = (("’", "‘"), ("„", "”"), ("'", "'"), ('"', '"'), ("´", "´"), ("‘", "’"))
CULTIVAR = "(?i)(" + "|".join([*(f"{a}[A-Za-z ]+{b}" for a, b in CULTIVAR_DELIMITERS), "\\([A-Za-z ]+form\\)"]) + ")"
# Fixed value: country, restriction, garden and number of an accession code.
IPEN = f"(?:[A-Z]{{2}}|[a-z]{{2}})[-.][O01][-.](?:[A-Z]{{1,5}}|[a-z]{{1,5}})[-./_][^{BLANK}\\]:)]+"
SYNONYMS = "(?i)\\[(?:sin|syn)\\.?:? [^\\]]*\\]|\\((?:sin|syn)\\.?:? [^)]\\]*\\)"
INDEX_TITLE = f"(?i)Index[{BLANK}]+seminum"
LONE_X = f"[{BLANK}][xX][{BLANK}]"
REPEATED = 5
YEAR = "(?:^|[^0-9])([12][0-9]{3})"


# ---------------------------------------------------------------- Spark


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def tokens_of(text: Column) -> Column:
    """The words between white space; none for a blank text."""
    return F.filter(F.split(text, f"[{BLANK}]+"), lambda t: t != "")


def preprocess_line(text: Column) -> Column:
    """Tabs to blanks, dashes unified, the standard title removed, lone x as hybrid sign, five or more of a sign to one, stripped."""
    text = F.replace(text, F.lit("\t"), F.lit(" "))
    text = F.regexp_replace(text, f"[{DASHES}]+", "-")
    text = F.regexp_replace(text, INDEX_TITLE, "")
    text = F.regexp_replace(text, LONE_X, " × ")
    text = F.regexp_replace(text, f"([^A-Za-z0-9])\\1{{{REPEATED - 1},}}", "$1")
    return strip(F.replace(text, F.lit("■"), F.lit(" ")))


def trim_outer(text: Column) -> Column:
    """Without leading characters that are no ASCII letters and trailing ones that are no letters, dots or closing brackets;
    also without a closing bracket that was never opened."""
    cleaned = F.regexp_replace(strip(text), "^[^a-zA-Z]+|[^a-zA-Z.)]+\\z", "")
    return F.when(cleaned.endswith(")") & ~cleaned.contains("("), F.substring(cleaned, F.lit(1), F.length(cleaned) - 1)).otherwise(cleaned)


def single_blanks(text: Column) -> Column:
    return F.regexp_replace(text, f"[{BLANK}]+", " ")


def clean_name(text: Column) -> Column:
    """ASCII letters and single blanks only."""
    return F.trim(F.regexp_replace(text, "[^a-zA-Z]+", " "))


def drop_abbreviations(text: Column) -> Column:
    return F.array_join(F.filter(tokens_of(text), lambda t: ~t.isin(*DROPPED)), " ")


def fully_clean(text: Column) -> Column:
    return clean_name(drop_abbreviations(text))


def name_key(text: Column) -> Column:
    """What names are looked up by."""
    return F.lower(fully_clean(text))


def synonym_strings(text: Column) -> Column:
    """The contents of [syn. ...] without the mark. Round brackets count only around a single character, as the original has it."""
    return F.transform(
        F.regexp_extract_all(text, F.lit(SYNONYMS), F.lit(0)), lambda s: F.regexp_replace(F.substring(s, F.lit(2), F.length(s) - 2), "(sin|syn)\\.?:? ", "")
    )


def _or_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def cultivar(text: Column) -> Column:
    return _or_null(F.regexp_extract(strip(text), CULTIVAR, 1))


def ipen(text: Column) -> Column:
    return _or_null(F.regexp_extract(strip(text), IPEN, 0))


def position_of(part: Column, text: Column) -> Column:
    """From 0; -1 if it isn't there or null."""
    return F.coalesce(F.instr(text, part) - 1, F.lit(-1))


def repeat_symbols(text: Column) -> Column:
    """The dashes for repeated names that a line begins with, behind its number."""
    rest = strip(F.regexp_replace(text, f"^[0-9IiogS^]+\\.?[{BLANK}]+", ""))
    return F.regexp_extract_all(F.regexp_extract(rest, f"^(?:[-–—−][{BLANK}]*)*", 0), F.lit("[-–—−]"), F.lit(0))


def garden_of(filename: Column) -> Column:
    return _or_null(F.regexp_extract(filename, "^[A-Za-z]+", 0))


def year_of(filename: Column) -> Column:
    return _or_null(F.regexp_extract(filename, YEAR, 1)).cast("int")


def split_lines(text: Column) -> Column:
    """As str.splitlines(): no element after a final line end, none for an empty text."""
    parts = F.split(text, LINE_BREAK)
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


# ---------------------------------------------------------------- DuckDB


def q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def sql_strip(t: str) -> str:
    return f"regexp_replace({t}, {q(f'^[{BLANK}]+|[{BLANK}]+$')}, '', 'g')"


def sql_tokens(t: str) -> str:
    return f"list_filter(string_split_regex({t}, {q(f'[{BLANK}]+')}), lambda z: z <> '')"


def sql_preprocess(t: str, signs: str = " .,-_*=+~#!?:;/|°'\"()[]<>．·…–—") -> str:
    """Without back references: one replacement for each sign that may be repeated."""
    t = f"replace({t}, chr(9), ' ')"
    t = f"regexp_replace({t}, {q(f'[{DASHES}]+')}, '-', 'g')"
    t = f"regexp_replace({t}, {q(INDEX_TITLE)}, '', 'g')"
    t = f"regexp_replace({t}, {q(LONE_X)}, ' × ', 'g')"
    for sign in signs:
        t = f"regexp_replace({t}, {q(f'[{chr(92) + sign if sign.isascii() and not sign.isspace() else sign}]{{{REPEATED},}}')}, {q(sign)}, 'g')"
    return sql_strip(f"replace({t}, '■', ' ')")


def sql_trim_outer(t: str) -> str:
    c = f"regexp_replace(regexp_replace({sql_strip(t)}, '^[^a-zA-Z]+', ''), '[^a-zA-Z.)]+$', '')"
    return f"(CASE WHEN ends_with({c}, ')') AND NOT contains({c}, '(') THEN left({c}, length({c}) - 1) ELSE {c} END)"


def sql_clean_name(t: str) -> str:
    return f"trim(regexp_replace({t}, '[^a-zA-Z]+', ' ', 'g'))"


def sql_drop_abbreviations(t: str) -> str:
    return f"array_to_string(list_filter({sql_tokens(t)}, lambda w: w NOT IN ({', '.join(map(q, DROPPED))})), ' ')"


def sql_name_key(t: str) -> str:
    return f"lower({sql_clean_name(sql_drop_abbreviations(t))})"


def sql_synonym_strings(t: str) -> str:
    return f"list_transform(regexp_extract_all({t}, {q(SYNONYMS)}), lambda s: regexp_replace(s[2:-2], '(sin|syn)\\.?:? ', '', 'g'))"


def sql_cultivar(t: str) -> str:
    return f"nullif(regexp_extract({sql_strip(t)}, {q(CULTIVAR)}, 1), '')"


def sql_ipen(t: str) -> str:
    return f"nullif(regexp_extract({sql_strip(t)}, {q(IPEN)}), '')"


def sql_repeat_symbols(t: str) -> str:
    rest = sql_strip(f"regexp_replace({t}, {q(f'^[0-9IiogS^]+[.]?[{BLANK}]+')}, '')")
    return f"regexp_extract_all(regexp_extract({rest}, {q(f'^(?:[-–—−][{BLANK}]*)*')}), '[-–—−]')"


def sql_split_lines(t: str) -> str:
    parts = f"string_split_regex({t}, {q(LINE_BREAK)})"
    return f"(CASE WHEN length({t}) = 0 THEN [] WHEN {parts}[-1] = '' THEN {parts}[:-2] ELSE {parts} END)"
