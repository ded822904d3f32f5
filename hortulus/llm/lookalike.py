"""Text that looks the same in other characters, brought to one form: composed letters, one script within a word, plain spaces."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hortulus.llm.words import Tables, matching_words, one_relation, replace_words, rows_with_words
from hortulus.runtime import cut_lineage

# Letters of one script that look like those of another, pairwise.
CYRILLIC = "АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁԛԝѵӏ"
CYRILLIC_AS_LATIN = "ABESIJKMHOPCTYXaesijopcyxhdqwvl"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονκιρυχ"
GREEK_AS_LATIN = "ABEZHIKMNOPTYXovkipux"
# Characters that are invisible beside the ordinary ones.
INVISIBLE = "\u200b\u200c\u200d\u200e\u200f\u2060\u2061\u2062\u2063\u2064\ufeff\u00ad\u180e\u034f"
# What a space and a soft hyphen that are remnants of garbling are hidden behind; two code points that are no characters.
HIDDEN = {"\u00a0": "\ufdd0", "\u00ad": "\ufdd1"}
# What stands before a character of a multi-byte encoding read as a single-byte page; a space or soft hyphen there is its remnant.
GARBLE_LEADS = "ÃĂГРÐÂÅ€Ђ\u0080\u0090"


@functools.cache
def decompositions() -> dict[str, str]:
    """Each character that is written otherwise here: canonical decompositions, wide and narrow forms, letter ligatures, spaces."""
    out = {}
    for point in [*range(0xA0, 0xAC00), *range(0xF900, 0x10000)]:
        c = chr(point)
        tag = unicodedata.decomposition(c).partition(" ")[0]
        if unicodedata.category(c) == "Zs":
            out[c] = " "
        elif c in INVISIBLE:
            out[c] = ""
        elif tag in ("<wide>", "<narrow>") or 0xFB00 <= point <= 0xFB06:
            out[c] = unicodedata.normalize("NFD", unicodedata.normalize("NFKC", c))
        elif tag and tag[0] != "<":
            out[c] = unicodedata.normalize("NFD", c)
    return out


@functools.cache
def compositions() -> dict[str, str]:
    """From a letter with its marks in canonical order to the composed letter."""
    return {d: c for c, d in decompositions().items() if len(d) > 1 and unicodedata.normalize("NFC", d) == c}


# The ranges that hold every character that may be a case (marks, Greek and Cyrillic, odd spaces and invisible
# characters, compatibility letters, wide and narrow forms); a few ranges match much faster than the characters one by one.
AFFECTED = "[\\u00a0\\u00ad\\u0300-\\u052f\\u1680\\u180e\\u1f00-\\u200f\\u202f\\u205f-\\u2064\\u2126\\u212a\\u212b\\u3000\\uf900-\\ufaff\\ufb00-\\ufb06\\ufeff\\uff00-\\uffee]"


def code_points(spark: SparkSession) -> DataFrame:
    """(ch, parts): for each mark, letter and decomposable character its parts in order, each with its combining class, its kind and
    the look-alikes of it. Kinds: m mark; l, c, g letters of one script, L, C, G the same but with a look-alike; - anything else. A
    letter composed with a mark has no look-alike. Fixed, some ten thousand rows."""
    from_c, from_g = dict(zip(CYRILLIC, CYRILLIC_AS_LATIN)), dict(zip(GREEK, GREEK_AS_LATIN))
    to_c, to_g = {b: a for a, b in from_c.items()}, {b: a for a, b in from_g.items()}

    def describe(c: str) -> tuple:
        if unicodedata.combining(c):
            return (c, unicodedata.combining(c), "m", None, None, None)
        if not c.isalpha():
            return (c, 0, "-", None, None, None)
        kind = {"LATIN": "l", "CYRILLIC": "c", "GREEK": "g"}.get(unicodedata.name(c, "").split(" ")[0], "o")
        latin = from_c.get(c) or from_g.get(c)
        if not latin and c not in to_c and c not in to_g:
            return (c, 0, kind, None, None, None)
        return (c, 0, kind.upper(), latin, to_c.get(latin or c), to_g.get(latin or c))

    rows = []
    for point in [*range(0x2000), *map(ord, decompositions())]:
        c = chr(point)
        parts = [describe(p) for p in decompositions().get(c, c)]
        if len(parts) > 1 and c.isalpha() and point < 0x2000:
            own = describe(c)
            parts[0] = (parts[0][0], 0, own[2].lower(), None, None, None)
        rows.append((c, [(i, *p) for i, p in enumerate(parts)]))
    part = "sub: int, part: string, class: int, kind: string, latin: string, cyrillic: string, greek: string"
    return spark.createDataFrame(list(dict(rows).items()), f"ch string, parts array<struct<{part}>>")


def unify_words(words: DataFrame) -> DataFrame:
    """(word, unified) of (word): the words whose form changes.

    Words are exploded to positioned code points, joined to the table of their parts and look-alikes (broadcast: it is fixed),
    marks are ordered by class behind their letter, letters recomposed, look-alikes of another script turned into the script
    that the unambiguous letters around them have, and the words are built again. A run of letters with unambiguous ones of two
    scripts is garbled text and stays, as does a mark without a composed letter, and a space that is a remnant of garbling.
    """
    spark = words.sparkSession
    # a remnant of garbling stays: it is hidden, unless the word has such code points of its own
    hidden = F.col("word")
    for remnant, sign in HIDDEN.items():
        hidden = F.regexp_replace(hidden, f"(?<=[{GARBLE_LEADS}]){remnant}", sign)
    own = F.col("word").rlike(f"[{''.join(HIDDEN.values())}]")
    hidden = F.when(own, F.col("word")).otherwise(hidden)
    points = words.select("word", F.posexplode(F.split(hidden, "")).alias("pos", "ch"))
    unknown = F.array(F.struct(F.lit(0).alias("sub"), F.col("ch").alias("part"), F.lit(0).alias("class"), F.lit("-").alias("kind"), *[F.lit(None).cast("string").alias(c) for c in ("latin", "cyrillic", "greek")]))
    known = points.join(F.broadcast(code_points(spark)), "ch", "left").select("word", "pos", F.inline(F.coalesce("parts", unknown))).where("part <> ''")
    order = Window.partitionBy("word").orderBy("pos", "sub")
    runs = known.withColumn("run", F.sum((F.col("kind") == "-").cast("int")).over(order)).withColumn("segment", F.sum((F.col("class") == 0).cast("int")).over(order))
    in_run = Window.partitionBy("word", "run")
    count = lambda kind: F.sum((F.col("kind") == kind).cast("int")).over(in_run)
    latin, cyrillic, greek = (count(k) for k in "lcg")
    upper = {k: count(k) for k in "LCG"}
    mixed = (F.signum(latin) + F.signum(cyrillic) + F.signum(greek)) > 1
    several = (F.signum(latin + upper["L"]) + F.signum(cyrillic + upper["C"]) + F.signum(greek + upper["G"])) > 1
    # without an unambiguous letter the script with more letters counts, Latin first; one letter of another script makes no Latin ones its own
    script = (
        F.when(mixed | ~several, F.lit(None))
        .when(latin > 0, "l")
        .when((cyrillic > 0) & ((cyrillic > 1) | (upper["L"] == 0)), "c")
        .when((greek > 0) & ((greek > 2) | (upper["L"] == 0)), "g")
        .when(cyrillic + greek > 0, F.lit(None))
        .when((upper["L"] >= upper["C"]) & (upper["L"] >= upper["G"]), "l")
        .when(upper["C"] >= upper["G"], "c")
        .otherwise("g")
    )
    chosen = runs.withColumn("script", script).withColumn(
        "part",
        F.when((F.col("script") == "l") & F.col("latin").isNotNull(), F.col("latin"))
        .when((F.col("script") == "c") & F.col("cyrillic").isNotNull(), F.col("cyrillic"))
        .when((F.col("script") == "g") & F.col("greek").isNotNull(), F.col("greek"))
        .otherwise(F.col("part")),
    )
    segments = chosen.groupBy("word", "segment").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("class", "pos", "sub", "part"))), lambda x: x["part"]), "").alias("letters")
    )
    composed = F.broadcast(spark.createDataFrame(list(compositions().items()), "letters string, whole string"))
    pair = composed.select(F.col("letters").alias("__pair"), F.col("whole").alias("first"))
    built = (
        segments.join(composed, "letters", "left")
        .join(pair, F.when(F.length("letters") > 2, F.substring("letters", 1, 2)) == F.col("__pair"), "left")
        .withColumn("letters", F.coalesce("whole", F.concat("first", F.expr("substring(letters, 3)")), "letters"))
    )
    whole = built.groupBy("word").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("segment", "letters"))), lambda x: x["letters"]), "").alias("unified"))
    shown = F.translate("unified", "".join(HIDDEN.values()), "".join(HIDDEN))
    whole = whole.withColumn("unified", F.when(own, F.col("unified")).otherwise(shown))
    # a word of nothing but invisible characters has no part left
    empty = words.join(whole.select("word"), "word", "left_anti").select("word", F.lit("").alias("unified"))
    return whole.where("unified <> word").select("word", "unified").unionByName(empty.where("word <> ''"))


def affected_words(texts: DataFrame) -> DataFrame:
    """The distinct words with a character that may be a case."""
    return texts.where(F.col("text").rlike(AFFECTED)).select(F.explode(matching_words("text", AFFECTED)).alias("word")).distinct()


def find_lookalikes(tables: Tables) -> DataFrame:
    """(table_name, row_id): the rows whose text has another form than unify_words() gives its words.

    Null, empty and pure ASCII texts are none. Rows with the same ident give one row. Texts are searched whole; further columns are
    ignored; an empty table gives nothing.
    """
    texts = one_relation(tables)
    return rows_with_words(texts, AFFECTED, unify_words(cut_lineage(affected_words(texts))), ["word"])


def unify_lookalikes(tables: Tables) -> DataFrame:
    """(table_name, row_id, text): the affected rows in the one form."""
    texts = one_relation(tables)
    return replace_words(texts, AFFECTED, unify_words(cut_lineage(affected_words(texts))), ["word"], "unified")
